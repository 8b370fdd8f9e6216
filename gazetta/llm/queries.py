"""The queries opN_<name> over the whole tables, and their SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm import collocations, decontaminate, embedding_dedup, filter_audit, line_dedup, minhash_dedup, mixing, quality, sharding, substring_dedup, token_files, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.minhash_dedup(table(spark, sf_dir, "documents"), percent=85)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op1_line_dedup": op1_line_dedup, "op2_substring_dedup": op2_substring_dedup, "op3_decontaminate": op3_decontaminate, "op4_embedding_dedup": op4_embedding_dedup, "op5_minhash_dedup": op5_minhash_dedup, "op6_sharding": op6_sharding, "op7_token_files": op7_token_files, "op8_mixing": op8_mixing, "op9_warc": op9_warc, "op10_toxicity": op10_toxicity}
QUERIES |= {"op11_collocations": op11_collocations, "op12_quality": op12_quality, "op13_filter_audit": op13_filter_audit}
ORACLES = {"op1_line_dedup": line_dedup.ORACLE, "op2_substring_dedup": substring_dedup.ORACLE, "op8_mixing": mixing.oracle(), "op9_warc": warc.ORACLE}
ORACLES |= {"op11_collocations": collocations.ORACLE, "op13_filter_audit": filter_audit.ORACLE}
