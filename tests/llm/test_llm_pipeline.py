"""The pipeline against its parts, and every query over the smallest tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from gazetta.llm import decontaminate, minhash_dedup, token_files, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = corpus_pipeline.reject_toxic(spark, docs, SF)
    assert clean.columns == docs.columns and 0 < clean.count() < docs.count()
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert toxicity.score_toxicity(clean, model).where("predicted = 1").count() == 0
    single = corpus_pipeline.drop_near_duplicates(spark, clean, SF)
    assert minhash_dedup.minhash_dedup(single).where("NOT kept").count() == 0
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    safe = corpus_pipeline.drop_contaminated(spark, single, SF)
    assert safe.columns == docs.columns
    assert decontaminate.decontaminate(safe, bench).where("contaminated").count() == 0
    mixed = corpus_pipeline.mix_sources(spark, safe, SF)
    assert mixed.join(safe, docs.columns, "left_anti").count() == 0
    assert token_files.token_round_trip(mixed).count() == mixed.count()


def test_repeated_rows_and_rows_without_id(spark):
    rows = [(1, "a b c d e f g", "en", "s", 1), (1, "a b c d e f g", "en", "s", 1), (None, "x y", None, None, None), (2, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "2", "None"]


def test_texts_of_one_id_and_copies_without_id(spark):
    text = lambda c: " ".join(f"{c}{k}" for k in range(30))
    rows = [(1, text("a")), (1, text("b")), (2, text("b")), (None, text("c")), (None, text("c")), (None, text("a")), (3, text("d"))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in got) == [(0, text("c")), (1, text("a")), (1, text("b")), (3, text("d"))]


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """Documents with nulls in every column, an empty and a very long text, repeated rows and columns whose names clash."""
    folder = str(tmp_path_factory.mktemp("odd"))
    long = " ".join(f"w{k}" for k in range(40_000))
    rows = [(1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "s", 1), (2, None, None, None, None), (None, "x y z u v w", "de", None, 2), (3, "", "fr", "t", 0), (4, long, "en", "t", 9), (5, long, "en", "t", 9), (6, " \n ", None, "t", 1)]
    docs = spark.createDataFrame(rows, COLUMNS).withColumns({"row": F.lit("clash"), "key": F.lit(1), "predicted": F.lit(0), "n_tokens": F.lit(None).cast("int")})
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 0, 0), (2, 1, 1), (4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, None), (2, ""), (3, "q r s t u v w x y z")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_run_over_odd_rows(spark, odd_tables):
    docs = spark.read.parquet(f"{odd_tables}/documents.parquet")
    names = {"toxicity": 8, "minhash_dedup": 6, "decontaminate": 6}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, odd_tables)
        assert docs.columns == corpus_pipeline.COLUMNS
        assert name not in names or docs.count() == names[name], name
    out = corpus_pipeline.run(spark, odd_tables)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and 0 < out.count() <= 6
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in out.collect())
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_run_over_empty_tables(spark, odd_tables, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{odd_tables}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", [n for n in __spark_entry__.queries() if n.startswith("op")])
def test_queries_run(spark, name):
    assert __spark_entry__.queries()[name](spark, SF).count() > 0


def test_the_pipeline_is_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    want = sorted(map(tuple, docs.collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == want
