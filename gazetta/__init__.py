"""gazetta: a Spark-native engine for audited contact directories."""
