"""The corpus pipeline: toxicity, near duplicates, decontamination, mixing, token files.

Each stage takes what the one before kept and, but for the last, returns the columns
of ``documents``; other columns go. ``run`` writes each stage's result to the shared folder and rereads
it, so a lost executor costs a part of one stage and no stage runs twice.

For all stages: an empty table gives an empty result. Nulls may stand in any column. Texts are
read whole, however long. A null, an empty text or one without words is clean, is no
near duplicate, overlaps nothing, has probability 1 in the mixture and is the end id alone
in a token file. Repeated rows count as one document in the near-duplicate stage and
stand side by side in all others; ties go to the smaller id, then to hashes of the text. Names of extra columns can't clash with
the operators' own, as the documents' columns travel in one struct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazetta.llm import decontaminate, minhash_dedup, mixing, token_files, toxicity
from gazetta.llm.common import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of documents that are not held out.

    Without labels of both classes everything stays or, where all labels are toxic, goes. Documents without an id are judged as others are.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, labels), carry=COLUMNS)
    return scored.where("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id.

    Rows with the same id and text are one document, of which one row stays. Rows that share
    an id but not the text are documents of their own, and so are rows without an id, which come last in their group.
    """
    keyed = docs.withColumn("key", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.coalesce("text", F.lit(""))))
    groups = materialise(minhash_dedup.minhash_dedup(keyed, id_col="key").select("key", "component_id").distinct())
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("first")
    named = keyed.select("doc_id", "key").join(groups.hint("rebalance"), "key")
    kept = named.groupBy("component_id").agg(first).select("first.key").hint("rebalance")
    order = Window.partitionBy("key").orderBy("source", "lang", "n_chars")
    found = keyed.join(kept, "key", "left_semi").withColumn("nth", F.row_number().over(order)).where("nth = 1")
    return found.select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go. Null and empty items are ignored; without items everything stays."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, bench, carry=COLUMNS).where("NOT contaminated").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are kept with the calibrated probability of their cell, by a hash of their id: documents without an id share one draw.

    Documents of a null source or language, and those of a language without a target, are cells of their own.
    """
    return mixing.mix(docs, carry=COLUMNS).where("sampled").select("row.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, and what they say when read back: a row a document, in the order of the ids, those without an id last."""
    return token_files.token_round_trip(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("minhash_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("token_files", write_tokens),
]

#: A trained classifier, similarity search and a tokenizer: no stage but the fourth is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialise(docs)
    return docs
