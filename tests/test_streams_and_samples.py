"""The latest state as a stream, samples without a state's rows in one place, recorded answers in chunks, keys of categories."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gazetta.operators import delivery, quality
from gazetta.sources.tables import read_population_series
from gazetta.streaming import incremental

EVENT = "k string, ts timestamp, v string"


def add(spark, folder, rows):
    spark.createDataFrame(rows, "k string, ts string, v string").select("k", F.col("ts").cast("timestamp").alias("ts"), "v").coalesce(1).write.mode("append").parquet(folder)


def test_latest_states_goes_on_from_its_checkpoint(spark, tmp_path):
    folder, checkpoint, got = str(tmp_path / "in"), str(tmp_path / "checkpoint"), []

    def run():
        stream = incremental.latest_states(spark.readStream.schema(EVENT).parquet(folder), ["k"], "ts", idle_ms=3_600_000)
        fresh = []
        query = stream.writeStream.foreachBatch(lambda df, _: fresh.extend((r.k, r.v, r.closed) for r in df.collect())).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        got.extend(fresh)
        return sorted(fresh)

    add(spark, folder, [("a", "2024-01-01 10:00:00", "1"), ("a", "2024-01-01 10:02:00", "2"), ("b", "2024-01-01 10:01:00", "1")])
    assert run() == [("a", "2", False), ("b", "1", False)]
    # After a restart: a row that is late but within the watermark changes nothing, an equal time goes by the other columns, a newer one counts.
    add(spark, folder, [("a", "2024-01-01 10:01:00", "9"), ("b", "2024-01-01 10:01:00", "3"), ("c", "2024-01-01 10:03:00", None)])
    assert run() == [("b", "3", False), ("c", None, False)]
    add(spark, folder, [("a", "2024-01-01 10:02:00", "0"), ("b", "2024-01-01 10:04:00", "x")])
    assert run() == [("b", "x", False)]
    latest = {r.k: r.v for r in incremental.latest(spark.read.schema(EVENT).parquet(folder), ["k"], "ts").collect()}
    assert {k: v for k, v, closed in got if not closed} == latest == {"a": "2", "b": "x", "c": None}
    # Hours later all that is quiet is closed; a row behind the watermark is passed over.
    add(spark, folder, [("z", "2024-01-01 15:00:00", "end")])
    run()
    add(spark, folder, [("a", "2024-01-01 09:00:00", "far too late"), ("z", "2024-01-01 15:01:00", "end")])
    run()
    assert sorted((k, v) for k, v, closed in got if closed) == [("a", "2"), ("b", "x"), ("c", None)] and not [v for _, v, _ in got if v == "far too late"]


@pytest.mark.parametrize("rows,most", [(3000, 40), (3000, 1), (50, 40), (0, 3)])
def test_stratified_sample_is_the_first_draws_of_each(spark, rows, most):
    rng = random.Random(1)
    data = [(rng.choice(["x", "y", "y", "y", None]), i // 2) for i in range(rows)]
    df = spark.createDataFrame(data, "s string, k long")
    got = sorted(((r.s or "", r.k) for r in quality.stratified_sample(df, "s", F.col("k"), most).collect()))
    from hashlib import md5

    want = []
    for s in {s for s, _ in data}:
        want += [(s or "", k) for k in sorted((k for t, k in data if t == s), key=lambda k: (md5(str(k).encode()).hexdigest(), k))[:most]]
    assert got == sorted(want)


def test_samples_bring_no_states_rows_together(spark):
    df = spark.range(1000).select(F.lit("s").alias("state"), F.col("id").cast("string").alias("target"), F.lit("Prefeito").alias("role"), *(F.lit("x").alias(c) for c in ("name", "email", "phone", "mobile")), F.lit("Encontrado").alias("status"), F.col("id").alias("ordinal"))
    out = quality.verification_sample(df, 10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "TakeOrderedAndProject" in plan and out.where("ordinal = 0").count() == 1 and out.count() == 10


def test_recorded_answers_in_chunks(spark, tmp_path):
    codes = spark.createDataFrame([(str(1000 + i),) for i in range(10)], "code string")
    header = {"D1C": "Código", "V": "Valor"}

    def record(name, rows):
        (tmp_path / name).write_text(json.dumps([header, *({"D1C": str(c), "V": v} for c, v in rows)], indent=1))

    record("0.json", [(1000 + i, str(i * 10)) for i in range(4)])
    record("1.json", [(1004, "..."), (1005, "7")])
    record("2.json", [])
    with pytest.raises(ValueError, match="1 chunks without an answer, from code 1008"):
        read_population_series(spark, str(tmp_path), codes, 4)
    record("2.json", [(1008, "1"), (1008, "3")])
    got = {r.code: r.population for r in read_population_series(spark, str(tmp_path), codes, 4).collect()}
    assert got == {"1000": 0, "1001": 10, "1002": 20, "1003": 30, "1005": 7, "1008": 3}


def test_categories_by_label_and_by_key(spark):
    listed = [("agencia_desenvolvimento; financas_fazenda",), ("Desenvolvimento-Econômico, planejamento",), ("desenvolvimento_economico;desenvolvimento",), ("agência de coisas",), (None,)]
    got = [r[0] for r in spark.createDataFrame(listed, "c string").select(delivery.parse_categories(F.col("c"))).collect()]
    assert got == [["Agências municipais de desenvolvimento", "Finanças/Fazenda"], ["Desenvolvimento econômico", "Planejamento"], ["Desenvolvimento econômico", "Desenvolvimento"], [], []]


def test_small_inputs_are_dealt_out_and_streams_and_large_ones_left(spark, tmp_path):
    from gazetta.functions.contacts import extract_contacts
    from gazetta.scratch import spread

    spark.createDataFrame([(1, "Contato: a@v.example"), (2, "nada")], "id long, text string").coalesce(1).write.parquet(str(tmp_path / "in"))
    small = spark.read.parquet(str(tmp_path / "in"))
    assert spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and sorted(spread(small).collect()) == sorted(small.collect())
    large = small.crossJoin(spark.range(10**9).select((F.col("id") * 2).alias("other")))
    assert spread(large) is large
    stream = spark.readStream.schema("id long, text string").parquet(str(tmp_path / "in"))
    assert spread(stream) is stream
    query = extract_contacts(stream, ["id"]).writeStream.format("memory").queryName("contacts_of_a_stream").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r.id, r.email) for r in spark.table("contacts_of_a_stream").collect()] == [(1, "a@v.example")]
