"""Sources and sinks: flexible target lists, configuration trees, table sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from gazetta.functions.geo import is_capital, state_code, state_name
from gazetta.functions.text import blank, fold, norm_python_key, parse_count, parse_flag

# Header names that stand for the columns of a target list.
ALIASES = {
    "municipio": "name", "cidade": "name", "nome_municipio": "name", "uf": "state", "sigla_uf": "state", "estado": "state_name", "nome_estado": "state_name",
    "populacao": "population", "habitantes": "population", "populacao_estimada": "population", "capital": "capital", "eh_capital": "capital",
    "site": "site", "site_oficial": "site", "url": "site", "link": "site",
}
TARGET = ["state", "state_name", "name", "population", "capital", "site"]


#: Encodings of a target list, tried in turn.
ENCODINGS = ("UTF-8", "ISO-8859-1")
DEFAULT_INPUTS = ("data/targets.csv", "input/targets.csv", "targets.csv")


def _delimited(spark: SparkSession, path: str) -> DataFrame:
    """A delimited text with any separator of ``,``, ``;``, tab or ``|``; text that is no UTF-8 is read as Latin-1."""
    head = spark.read.text(path).limit(1).collect()
    first = head[0][0].lstrip("\ufeff") if head else ""
    sep = max(",;\t|", key=first.count)
    broken = not spark.read.text(path).where(~F.is_valid_utf8("value")).isEmpty()
    df = spark.read.option("header", True).option("sep", sep).option("multiLine", True).option("encoding", ENCODINGS[broken]).csv(path)
    return df.toDF(*(c.lstrip("\ufeff") for c in df.columns))


READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    ".csv": _delimited,
    ".txt": _delimited,
    ".parquet": lambda spark, path: spark.read.parquet(path),
    ".json": lambda spark, path: spark.read.option("multiLine", True).json(path),
}


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """A table by the end of its name; workbooks are to be exported first."""
    reader = next((r for end, r in READERS.items() if path.lower().rstrip("/").endswith(end)), None)
    if reader is None:
        raise ValueError(f"{path}: not one of {', '.join(READERS)}; export workbooks to CSV")
    return reader(spark, path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at a path, which may hold wildcards."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at))


def listed(spark: SparkSession, path: str) -> list[str]:
    """What is at a path with wildcards."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().toString() for s in at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or ()]


def remove(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete files or folders; those that are absent are passed over."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def resolve_input(spark: SparkSession, path: str | None = None, candidates: Sequence[str] = DEFAULT_INPUTS) -> str:
    """The path that was given, else the first of the usual places that exists."""
    if path:
        return path
    found = next((c for c in candidates if exists(spark, c)), None)
    if found is None:
        raise FileNotFoundError(f"no target list among {', '.join(candidates)}")
    return found


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """A list of targets with flexible headers.

    Raises FileNotFoundError where there is none, and ValueError with the number of rows that have no name or no state.
    """
    if not exists(spark, path):
        raise FileNotFoundError(path)
    out = map_headers(read_any(spark, path))
    missing = out.where(blank(F.col("name")) | blank(F.col("state"))).count()
    if missing:
        raise ValueError(f"{missing} rows without name or state")
    return out


def map_headers(df: DataFrame) -> DataFrame:
    """The columns of a target list under their own names; the first header that claims a name has it."""
    found: dict[str, str] = {}
    for c in df.columns:
        name = ALIASES.get(norm_python_key(c))
        if name and name not in found:
            found[name] = c
    col = lambda n: F.coalesce(F.trim(F.col(f"`{found[n]}`").cast("string")), F.lit("")) if n in found else F.lit("")
    code = F.coalesce(F.nullif(F.upper(col("state")), F.lit("")), state_code(col("state_name")))
    return df.select(
        code.alias("state"),
        F.coalesce(F.nullif(col("state_name"), F.lit("")), state_name(code)).alias("state_name"),
        col("name").alias("name"),
        parse_count(col("population")).alias("population"),
        (parse_flag(col("capital")) | is_capital(col("name"), code)).alias("capital"),
        col("site").alias("site"),
    )


def column_like(df: DataFrame, wanted: str) -> str | None:
    """The column of that name, whatever its accents, case and spacing."""
    return next((c for c in df.columns if norm_python_key(c) == norm_python_key(wanted)), None)


def flatten(tree: object, path: str = "") -> Iterator[tuple[str, str]]:
    """(dotted path, value) of every leaf of a configuration."""
    if isinstance(tree, dict):
        for k, v in tree.items():
            yield from flatten(v, f"{path}.{k}" if path else str(k))
    elif isinstance(tree, list):
        for i, v in enumerate(tree):
            yield from flatten(v, f"{path}[{i}]")
    else:
        yield path, "" if tree is None else str(tree)


def config_table(spark: SparkSession, files: dict[str, object]) -> DataFrame:
    rows = [(name, *leaf) for name, tree in files.items() for leaf in flatten(tree)]
    return spark.createDataFrame(rows, "file string, key string, value string")


def read_yaml(path: str) -> object:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def observed_write(df: DataFrame, path: str, keys: Sequence[str] = (), **measures: Column) -> dict[str, int]:
    """Write a table and count in the same pass: its ``rows`` and whatever ``measures`` (aggregates) ask for. Partitioned tables replace only the partitions that they bring."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(name) for name, c in measures.items())).write.mode("overwrite")
    if keys:
        writer = writer.partitionBy(*keys).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return {"rows": 0, **dict.fromkeys(measures, 0), **{k: v or 0 for k, v in seen.get.items()}}


def write_tables(tables: dict[str, DataFrame], folder: str, partition_by: dict[str, Sequence[str]] | None = None) -> dict[str, int]:
    """One Parquet folder a table; partitioned tables replace only the partitions that they bring. Returns the rows of each, counted as they were written."""
    return {name: observed_write(df, f"{folder}/{name}", (partition_by or {}).get(name, ()))["rows"] for name, df in tables.items()}


def read_table(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """A table of a set; one that is absent is empty."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(f"{folder}/{name}")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def population_rows(series: DataFrame, key: str = "code", value: str = "value") -> DataFrame:
    """Rows of a statistics response whose value is a number; its header record isn't."""
    return series.where(F.col(value).rlike("^[0-9]+$")).select(F.col(key), F.col(value).cast("long").alias("population"))


def read_population_series(spark: SparkSession, path: str, codes: DataFrame, chunk: int = 300, code: str = "code") -> DataFrame:
    """The population of places from the recorded answers of a statistics service that is asked for ``chunk`` codes at a time.

    ``path``: a folder of answers, each a JSON array of records (``D1C``: code, ``V``: value) behind a header record; every answer is read by
    a task of its own. Values that aren't numbers are passed over; of several values of a code the greatest counts. ``codes`` tells what was
    asked for, in the order of its codes: a chunk of which no code is answered was not recorded, and raises ValueError with the number of such chunks and the first code of each of the first five.
    """
    answers = spark.read.text(path, wholetext=True).select(F.from_json("value", "array<struct<D1C: string, V: string>>").alias("records"))
    rows = answers.select(F.inline(F.slice("records", F.lit(2), F.greatest(F.size("records") - 1, F.lit(0))))).where("D1C IS NOT NULL")
    known = rows.groupBy(F.col("D1C").alias("code")).agg(F.max(F.when(F.col("V").rlike("^[0-9]+$"), F.col("V").cast("long"))).alias("population"))
    # Codes of a statistics office: some thousands, numbered in one window.
    asked = codes.select(F.col(code).cast("string").alias("code")).distinct().withColumn("chunk", F.floor((F.row_number().over(Window.orderBy("code")) - 1) / chunk))
    met = asked.join(known.withColumn("answered", F.lit(True)), "code", "left")
    gaps = met.groupBy("chunk").agg(F.min("code").alias("first"), F.bool_or(F.coalesce("answered", F.lit(False))).alias("any")).where("NOT any")
    lacking = [r["first"] for r in gaps.orderBy("chunk").select("first").collect()]
    if lacking:
        raise ValueError(f"{len(lacking)} chunks without an answer, from code {', '.join(lacking[:5])}")
    return met.where("population IS NOT NULL").select("code", "population")


def frozen_list(places: DataFrame, population: DataFrame, stamp: str) -> DataFrame:
    """Places with their population (0 where none is known), ready to be written in order."""
    joined = places.join(population, "code", "left").withColumn("population", F.coalesce("population", F.lit(0)))
    return joined.withColumn("frozen_on", F.lit(stamp)).orderBy("state", fold(F.col("name")))


def write_list(df: DataFrame, path: str) -> None:
    """One CSV part with a header, in the order of the frame; lists of targets are small by nature."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_frozen(places: DataFrame, population: DataFrame, stamp: str, path: str) -> None:
    """The frozen list as a sink."""
    write_list(frozen_list(places, population, stamp), path)


def read_localities(spark: SparkSession, path: str) -> DataFrame:
    """Localities of a statistics office's nested JSON: code, name and state, by either of the two paths of regions.

    Raises ValueError with the number of places of which neither path names a state.
    """
    schema = (
        "id long, nome string, `regiao-imediata` struct<`regiao-intermediaria`: struct<UF: struct<sigla: string>>>, "
        "microrregiao struct<mesorregiao: struct<UF: struct<sigla: string>>>"
    )
    raw = spark.read.option("multiLine", True).schema(schema).json(path)
    uf = F.coalesce(F.col("`regiao-imediata`.`regiao-intermediaria`.UF.sigla"), F.col("microrregiao.mesorregiao.UF.sigla"))
    out = raw.select(F.col("id").cast("string").alias("code"), F.col("nome").alias("name"), uf.alias("state"))
    missing = out.where("state IS NULL").count()
    if missing:
        raise ValueError(f"{missing} places without a state")
    return out


def write_sites(resolved: DataFrame, stamp: str, path: str, pending_path: str | None = None) -> None:
    """Targets with their sites and how these were found, and beside them those that are still to be found."""
    out = resolved.withColumn("validated_on", F.lit(stamp))
    write_list(out, path)
    if pending_path:
        write_list(out.where(F.col("site_status") != "Encontrado"), pending_path)


def write_report(issues: DataFrame, path: str) -> int:
    """Write a report of issues; the exit code of a run: 1 where there are any. The pass that writes counts."""
    return int(observed_write(issues, path)["rows"] > 0)


def write_manifest(tables: dict[str, DataFrame], folder: str) -> None:
    """JSON lines of what a run found and did: one folder a table."""
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")
