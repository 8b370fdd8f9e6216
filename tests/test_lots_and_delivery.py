"""Lots in one plan, delivery with its exit codes, the whole command line, and the scope against several sources."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from gazetta.operators import batch, quality
from gazetta.plans import catalog
from gazetta.sources.tables import observed_write, write_report, write_tables

TARGETS = [("SP", f"t{i}", "Municipal", i) for i in range(5)] + [("RJ", "r", "Municipal", 9)]


@pytest.fixture
def targets(spark):
    return spark.createDataFrame(TARGETS, "state string, target string, sphere string, ordinal int")


def files(folder, lot=None):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet") if lot is None or f"lot={lot}" in str(p)}


def worker(pages, calls, version=None):
    """Work that counts the pages of each target, and lists as pending those without."""

    def work(some):
        calls.append(sorted(r["lot"] for r in some.select("lot").distinct().collect()))
        met = some.join(pages.groupBy("target").agg(F.count(F.lit(1)).alias("n")), "target", "left").withColumn("version", F.lit(version or len(calls)))
        return {"data": met.where("n > 0").drop("lot"), "targets": some, "pending": met.where("n IS NULL").select("target")}

    return work


def test_one_plan_and_one_scan_for_all_lots(spark, targets, tmp_path):
    pages = spark.createDataFrame([("t0", 1), ("t0", 2), ("t3", 3), ("r", 4)], "target string, page_id long")
    pages.write.parquet(str(tmp_path / "pages"))
    pages, calls, scans = spark.read.parquet(str(tmp_path / "pages")), [], []
    work = worker(pages, calls)

    def watched(some):
        tables = work(some)
        scans.append(tables["data"]._jdf.queryExecution().optimizedPlan().toString().count("Relation [target"))
        return tables

    folder = tmp_path / "lots"
    assert batch.run_lots(targets, watched, str(folder), chunk_size=1) == ["RJ-001", *(f"SP-00{i}" for i in range(1, 6))]
    assert len(calls) == 1 and scans == [1]
    whole = batch.consolidate(spark, str(folder), batch.lots_done(spark, str(folder)))
    assert {(r.target, r.n) for r in whole["data"].collect()} == {("t0", 2), ("t3", 1), ("r", 1)}
    assert {r.target for r in whole["pending"].collect()} == {"t1", "t2", "t4"} and whole["targets"].count() == 6 and "lot" not in whole["data"].columns


def test_a_rerun_of_one_lot_touches_its_partitions_only(spark, targets, tmp_path):
    folder, calls = tmp_path / "lots", []
    some = spark.createDataFrame([("t0", 1), ("t1", 1)], "target string, page_id long")
    batch.run_lots(targets, worker(some, calls), str(folder), chunk_size=2)
    before, own = files(folder), files(folder, "SP-001")
    # Now t0 has no page any more, t1 is pending no more: what the lot had and has not goes, other lots stay as they are.
    batch.run_lots(targets.where("ordinal < 2"), worker(some.where("target = 't1'"), calls, 7), str(folder), chunk_size=2, force=True)
    after = files(folder)
    assert {k: v for k, v in after.items() if "lot=SP-001" not in k} == {k: v for k, v in before.items() if "lot=SP-001" not in k}
    assert own and not set(own) & set(after)
    whole = batch.consolidate(spark, str(folder), ["SP-001", "SP-002", "SP-003", "RJ-001"])
    assert {(r.target, r.version) for r in whole["data"].collect()} == {("t1", 7)}
    assert {r.target for r in whole["pending"].collect()} == {"t0", "t2", "t3", "t4", "r"}
    assert batch.consolidate(spark, str(folder), ["SP-002"])["targets"].count() == 2
    # A table without any row has its columns all the same; without marks there is nothing.
    none = batch.run_lots(targets, lambda some: {"targets": some, "pending": some.where("false").select("target")}, str(tmp_path / "none"))
    empty = batch.consolidate(spark, str(tmp_path / "none"), none)
    assert empty["pending"].columns == ["target"] and empty["pending"].count() == 0 and "data" not in empty
    assert batch.consolidate(spark, str(tmp_path / "nowhere"), none) == {}


def test_a_killed_run_is_taken_up(spark, targets, tmp_path):
    folder, calls = str(tmp_path / "lots"), []
    pages = spark.createDataFrame([("t0", 1), ("t4", 1)], "target string, page_id long")
    work = worker(pages, calls, 1)

    def dies(some):
        if len(calls) == 2:
            raise RuntimeError("killed")
        return work(some)

    with pytest.raises(RuntimeError):
        batch.run_lots(targets, dies, folder, chunk_size=2, at_once=1)
    assert batch.lots_done(spark, folder) == ["RJ-001", "SP-001"]
    assert batch.run_lots(targets, work, folder, chunk_size=2, at_once=1) == ["SP-002", "SP-003"]
    assert calls == [["RJ-001"], ["SP-001"], ["SP-002"], ["SP-003"]]
    whole = batch.consolidate(spark, folder, batch.lots_done(spark, folder))
    assert {r.target for r in whole["data"].collect()} == {"t0", "t4"} and whole["targets"].count() == 6
    assert batch.lot_done(spark, folder, "SP-003") and not batch.lot_done(spark, folder, "XX-001")


def test_many_lots_share_partitions(spark, tmp_path, monkeypatch):
    """Files are bounded, lots of over three digits stay apart, and a rerun or a killed run in a shared partition changes its own lots only."""
    monkeypatch.setattr(batch, "MOST_PARTITIONS", 3)
    many = spark.range(1, 1012).select(F.lit("SP").alias("state"), F.concat(F.lit("t"), "id").alias("target"), F.col("id").alias("ordinal"))
    folder, tables = tmp_path / "lots", lambda version: lambda some: {"data": some.withColumn("version", F.lit(version))}
    names = batch.run_lots(many, tables(1), str(folder), chunk_size=1)
    assert len(names) == 1011 and {"SP-001", "SP-101", "SP-999", "SP-1010"} <= set(names) and set(batch.lots_done(spark, str(folder))) == set(names)
    parts = {p.name for p in (folder / "data").glob("lot=*")}
    assert len(parts) == 3 and parts == {p.name for p in (folder / "marks").glob("lot=*")}

    def versions(lots=names):
        return {r.target: r.version for r in batch.consolidate(spark, str(folder), lots)["data"].collect()}

    def dies(some):
        tables(9)(some)["data"].join(some.select("target"), "target").withColumns({"_lot": F.col("lot"), "_part": F.col("lot"), "_run": F.lit("9"), "lot": F.lit("x")}).write.mode("append").partitionBy("lot").parquet(f"{folder}/data")
        raise RuntimeError("killed")

    assert versions() == {f"t{i}": 1 for i in range(1, 1012)} and versions(["SP-007"]) == {"t7": 1}
    before = files(folder)
    with pytest.raises(RuntimeError):
        batch.run_lots(many.where("ordinal = 1"), dies, str(folder), chunk_size=1, force=True)
    assert versions() == {f"t{i}": 1 for i in range(1, 1012)}
    assert batch.run_lots(many.where("ordinal = 1"), tables(2), str(folder), chunk_size=1, force=True) == ["SP-001"]
    assert versions() == {f"t{i}": 1 + (i == 1) for i in range(1, 1012)} and before.items() <= files(folder).items()
    # A whole rerun leaves nothing of the runs before it.
    batch.run_lots(many, tables(3), str(folder), chunk_size=1, force=True)
    assert versions() == {f"t{i}": 3 for i in range(1, 1012)} and not set(before) & set(files(folder))
    assert {p.name for p in (folder / "marks").glob("lot=*")} == parts


def test_lot_assign_beyond_999_lots_of_a_state(spark, tmp_path):
    """The query writes numbers as its SQL does, which cuts them to three characters; the lots that the operator names stay apart."""
    customers = spark.range(1, 10_026).select(F.col("id").alias("c_custkey"), F.concat(F.lit("c"), "id").alias("c_name"), F.when(F.col("id") > 10_013, 1).otherwise(0).alias("c_nationkey"))
    tables = {"customer": customers, "nation": spark.createDataFrame([(0, "Big-12"), (1, "Small")], "n_nationkey int, n_name string")}
    con = duckdb.connect()
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = [tuple(r) for r in catalog.QUERIES["lot_assign"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(con.execute(catalog.ORACLES["lot_assign"]).fetchall()) and len(got) == 10_025
    assert {(991, "BIG-12-100"), (9_990, "BIG-12-999"), (9_991, "BIG-12-100"), (10_013, "BIG-12-100"), (10_025, "SMALL-002")} <= set(got)
    named = batch.lots(customers.where("c_nationkey = 0").select(F.lit("Big-12").alias("state"), F.col("c_name").alias("target"), F.col("c_custkey").alias("ordinal")), 10)
    assert named.select("lot").distinct().count() == 1_002 and named.where("lot = 'BIG-12-1000'").count() == 10


def test_pages_laid_out_by_lot_are_pruned(spark, targets, tmp_path):
    pages = spark.createDataFrame([(f"t{i}", i, "h") for i in range(5)] + [("r", 9, "h"), ("stranger", 10, "h")], "target string, page_id long, html string")
    placed = batch.lots(targets, 2)
    laid = batch.lay_out_pages(pages, placed, str(tmp_path / "pages"))
    assert {(r.target, r.lot) for r in laid.collect()} == {("t0", "SP-001"), ("t1", "SP-001"), ("t2", "SP-002"), ("t3", "SP-002"), ("t4", "SP-003"), ("r", "RJ-001")}
    one = laid.where(F.col("lot").isin(["SP-002"]))
    assert one.count() == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "SP-002" in plan.split("PartitionFilters: [")[1].split("]")[0]
    before = files(tmp_path / "pages")
    batch.lay_out_pages(pages.where("target = 't4'"), placed, str(tmp_path / "pages"))
    assert {k: v for k, v in files(tmp_path / "pages").items() if "SP-003" not in k} == {k: v for k, v in before.items() if "SP-003" not in k}


def test_counts_come_from_the_pass_that_writes(spark, tmp_path):
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    assert observed_write(df, str(tmp_path / "a"), odd=F.count_if(F.col("id") % 2 == 1)) == {"rows": 10, "odd": 5}
    assert observed_write(df.where("id > 99"), str(tmp_path / "b"), odd=F.count_if(F.col("id") % 2 == 1)) == {"rows": 0, "odd": 0}
    assert observed_write(spark.createDataFrame([], "a int"), str(tmp_path / "c")) == {"rows": 0}
    assert write_tables({"x": df, "y": df.limit(3)}, str(tmp_path / "t"), {"x": ("k",)}) == {"x": 10, "y": 3}
    assert spark.read.parquet(str(tmp_path / "t" / "x")).count() == 10
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("report", "")
    assert write_report(df, str(tmp_path / "r")) == 1 and len(tracker.getJobIdsForGroup("report")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert write_report(df.where("false"), str(tmp_path / "r")) == 0


DATA = "state string, target string, sphere string, role string, unit string, name string, email string, phone string, mobile string, source_url string, page_url string, status string, ordinal int"


@pytest.mark.parametrize("email,issues,code,problems", [("a@v.example", 0, 0, []), ("b@v.example", 0, 1, ["verification"]), ("a@v.example", 1, 1, ["audit"]), ("b@v.example", 2, 1, ["audit", "verification"])])
def test_delivery_publishes_what_passes(spark, tmp_path, email, issues, code, problems):
    data = spark.createDataFrame([("SP", "Vila", "Municipal", "Prefeito", "Gabinete", "Ana Lima Souza", email, "", "", "u", "", "Encontrado", 1)], DATA)
    audit = spark.createDataFrame([("Status", f"n{i}") for i in range(issues)], "kind string, description string")
    pages = spark.createDataFrame([("u", "Prefeito\nAna Lima Souza\na@v.example", "Encontrado")], "url string, text string, status string")
    assert batch.deliver({"data": data, "audit": audit}, pages, str(tmp_path), 0) == (code, problems)
    assert spark.read.parquet(str(tmp_path / "audit")).count() == issues and spark.read.parquet(str(tmp_path / "verification")).count() == 1
    assert (tmp_path / "published" / "data").exists() is (code == 0) and not (tmp_path / "published" / "audit").exists()


def slow_scope(sources, expected, state_expected):
    out = []
    for name, rows in sources.items():
        present = {(s.upper(), t, sp or "Municipal") for s, t, sp in rows}
        other = {k for k in present if k[2] != "Municipal"}
        want = {(s.upper(), t, sp or "Municipal") for s, t, sp in expected}
        out += [(k[0], k[1], f"Município/capital esperado ausente em {name}.") for k in want - present]
        if state_expected is None:
            out += [(k[0], k[1], f"Alvo fora do escopo municipal em {name}: Esfera={k[2]}.") for k in other]
        else:
            states = {(s.upper(), t, sp or "Municipal") for s, t, sp in state_expected}
            out += [(k[0], k[1], f"Alvo estadual não configurado em {name}: {k[1]}.") for k in other - states]
            out += [(k[0], k[1], f"Alvo estadual configurado ausente em {name}.") for k in states - other]
    return sorted(out)


@pytest.mark.parametrize("states", [None, [("sp", "Gov", "Estadual"), ("RJ", "Org", "Estadual")]])
def test_scope_of_all_sources_in_one_shuffle(spark, states):
    schema = "state string, target string, sphere string"
    expected = [("sp", "Vila", "Municipal"), ("SP", "Serra", None), ("SP", "Vila", "Municipal")]
    sources = {"targets": [("SP", "Vila", None), ("sp", "Gov", "Estadual"), ("SP", "Gov", "Estadual"), ("SP", "Outro", "Estadual")], "data": [("SP", "Serra", "Municipal"), ("RJ", "Org", "Estadual"), ("SP", "Nova", "Municipal")], "empty": []}
    frame = lambda rows: spark.createDataFrame(rows, schema)
    out = quality.scope_issues({n: frame(r) for n, r in sources.items()}, frame(expected), frame(states) if states is not None else None)
    assert sorted((r.state, r.target, r.description) for r in out.collect()) == slow_scope(sources, expected, states)
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_the_command_line_with_everything(spark, tmp_path):
    """State governments, known contacts, rules, sites found among addresses that are up, lots by partition, verification and the gate."""
    (tmp_path / "t.csv").write_text("Município;UF;População;Site\nVila;SP;40000;\nSerra;SP;50000;https://serra.example/\n", encoding="utf-8")
    (tmp_path / "gov.json").write_text(json.dumps([{"state": "sp", "government": "Governo SP", "site": "https://sp.example/", "organs": [{"name": "Secretaria X", "site": "https://x.example/", "categories": ["Planejamento"]}]}, {"state": "RJ", "government": "Governo RJ", "site": "https://rj.example/", "organs": []}]))
    (tmp_path / "rules.csv").write_text("kind,pattern\nname_word,proibida\n")
    spark.createDataFrame([("SP", "Serra", "Municipal", "Vice-prefeito", "Bia Melo Reis", "vice@serra.example", "https://serra.example/vice", "Encontrado")], "state string, name string, sphere string, role string, person string, email string, source_url string, status string").write.parquet(str(tmp_path / "known.parquet"))
    spark.createDataFrame([("https://vila.sp.gov.br/", True), ("https://www.vila.sp.gov.br/", False)], "url string, ok boolean").write.parquet(str(tmp_path / "live.parquet"))
    pages = [(1, "Vila", "https://vila.sp.gov.br/equipe", "<p>Prefeita: Ana Lima Souza</p><p>a@v.example</p>"), (2, "Serra", "https://serra.example/equipe", "<p>Prefeita: Eva Proibida Souza</p><p>e@s.example</p>"), (3, "Secretaria X", "https://x.example/", "<p>Secretaria de Planejamento</p><p>x@x.example</p>")]
    spark.createDataFrame(pages, "page_id long, target string, url string, html string").write.parquet(str(tmp_path / "pages"))
    out = str(tmp_path / "out")
    args = ["--targets", str(tmp_path / "t.csv"), "--pages", str(tmp_path / "pages"), "--output", out, "--collected-on", "2024-01-01", "--governments", str(tmp_path / "gov.json"), "--overrides", str(tmp_path / "known.parquet"), "--rules", str(tmp_path / "rules.csv"), "--live", str(tmp_path / "live.parquet"), "--chunk-size", "1", "--layout"]
    batch.main([*args, "--verify", "0"])
    data = spark.read.parquet(f"{out}/tables/data")
    found = {(r.target, r.sphere, r.role, r["name"], r.email) for r in data.where("email <> ''").collect()}
    assert ("Vila", "Municipal", "Prefeito", "Ana Lima Souza", "a@v.example") in found and ("Serra", "Municipal", "Vice-prefeito", "Bia Melo Reis", "vice@serra.example") in found
    assert not [f for f in found if "Proibida" in f[3]]
    targets = {(r.target, r.sphere): r.site for r in spark.read.parquet(f"{out}/tables/targets").collect()}
    assert set(targets) == {("Vila", "Municipal"), ("Serra", "Municipal"), ("Governo SP", "Estadual"), ("Secretaria X", "Estadual")} and targets["Vila", "Municipal"] == "https://vila.sp.gov.br/"
    assert spark.read.parquet(f"{out}/delivery/verification").count() > 0
    # The states' rows are of their own categories only; a run of one sphere leaves the other out.
    assert {r.role for r in data.where("target = 'Secretaria X'").collect()} == {"Município/Capital e UF", "Planejamento"}
    only = batch.arguments([*args, "--sphere", "estadual"])
    places = spark.createDataFrame([("SP", "Vila", 0)], "state string, name string, ordinal int")
    assert {r.target for r in batch.chosen_targets(spark, batch.arguments([*args[:12], "--sphere", "estadual"]), places, places)[0].collect()} == {"Governo SP", "Secretaria X"} and only.layout
