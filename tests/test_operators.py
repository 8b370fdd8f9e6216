"""Behaviours of scope, records, quality, frontier, sources and streaming."""

import shutil

import pytest
from pyspark.sql import functions as F

from gazetta.operators import frontier, quality, records, scope
from gazetta.plans import catalog
from gazetta.sources import tables
from gazetta.streaming import incremental


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_scope_limits_are_strict(spark):
    t = spark.createDataFrame([("SP", "A", 30000, False), ("SP", "B", 30001, False), ("MG", "C", 15001, False), ("MG", "D", 10, True), ("AC", "E", 10, True), ("AC", "F", 10**6, False)], "state string, name string, population long, capital boolean")
    out = scope.scope_filter(t, scope.limits(spark))
    assert rows(out, "name", "reason") == [("B", "SP acima de 30.000 habitantes"), ("C", "MG acima de 15.000 habitantes"), ("D", "Capital incluída pela regra da UF"), ("E", "Capital dos demais estados/DF")]


def test_choose(spark):
    t = spark.createDataFrame([("SP", "São João", 2), ("SP", "Outra", 1), ("RJ", "Sao Joao", 3)], "state string, name string, ordinal int")
    assert rows(scope.choose(t, state="sp", name="sao joao"), "name") == [("São João",)]
    assert rows(scope.choose(t, most=1), "name") == [("Outra",)]
    assert scope.choose(t, most=0).count() == 3


def test_site_candidates_and_resolution(spark):
    t = spark.createDataFrame([(1, "Vila da Serra", "SP", ""), (2, "X", "SP", "https://given.example/"), (3, "Nada", "RJ", None)], "id int, name string, state string, site string")
    got = t.where("id = 1").select(scope.site_candidates(F.col("name"), F.col("state")).alias("u")).first()["u"]
    assert got[0] == "https://viladaserra.sp.gov.br/" and got[1] == "https://www.viladaserra.sp.gov.br/" and got[4] == "https://prefeitura.viladaserra.sp.gov.br/" and len(got) == len(set(got)) == 24
    live = spark.createDataFrame([(got[8], True), (got[2], False), (got[12], True)], "url string, ok boolean")
    out = scope.resolve_sites(t, live)
    assert rows(out, "id", "site", "site_status") == [(1, got[8], "Encontrado"), (2, "https://given.example/", "Encontrado"), (3, "", "Site não localizado")]


def test_places_are_no_persons(spark):
    t = spark.createDataFrame([("Nova Vila", "Nova Vila Alta", "SP"), ("Ana Lima", "Nova Vila", "SP"), ("nova vila sp", "Nova Vila", "SP"), ("Nova Vila Norte", "Nova Vila", "SP")], "p string, m string, s string")
    got = [r[0] for r in t.select(scope.names_a_place(F.col("p"), F.col("m"), F.col("s"))).collect()]
    assert got == [True, False, True, True]


def test_coverage_fills_each_required_category(spark):
    targets = spark.createDataFrame([("A",), ("B",)], "target string")
    required = spark.createDataFrame([(c,) for c in records.CATEGORIES], "category string")
    have = spark.createDataFrame([("A", "Prefeito", "Encontrado", "")], "target string, category string, status string, notes string")
    out = records.fill_coverage(have, targets, required, ["target"], "Não publicado", "n")
    assert out.count() == 16 and records.coverage(targets, out, required, ["target"]).count() == 0


def test_keep_first_is_by_ordinal(spark):
    t = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b")], "ordinal int, k string")
    once = records.keep_first(t, ["k", "absent"], "ordinal")
    assert rows(once, "ordinal") == [(1,), (2,)] and rows(records.keep_first(once, ["k"], "ordinal"), "ordinal") == [(1,), (2,)]


def test_normalise_and_downgrade(spark):
    t = spark.createDataFrame([(1, " sp", "vila DA serra", "Prefeito", "", "", "", "encontrado"), (2, "SP", "Vila da Serra", "Prefeito", "", "", "", "Encontrado"), (3, "SP", "Outra", "", "Ana Lima", "A@x.org", "1133334444", "Encontrado")], "ordinal int, state string, target string, role string, name string, email string, phone string, status string")
    out = records.normalise(t)
    assert rows(out, "target", "role", "phone", "status") == [("Outra", "Contato geral", "(11) 3333-4444", "Encontrado"), ("Vila da Serra", "Prefeito", "", "Necessita validação manual")]
    found = t.where("ordinal > 1").withColumns({"mobile": F.lit(""), "notes": F.lit("x")})
    assert rows(records.downgrade(found), "ordinal", "status", "notes") == [(2, "Não publicado", "x Sem dado publicado."), (3, "Encontrado", "x")]


def test_category_order(spark):
    t = spark.createDataFrame([("Vice-Prefeito",), ("Chefa de Gabinete do Prefeito",), ("Secretaria de Desenvolvimento e Trabalho",), ("Agência de Desenvolvimento",), ("Secretaria de Desenvolvimento Urbano",), ("",)], "r string")
    got = [r[0] for r in t.select(records.category(F.col("r"))).collect()]
    assert got == ["Vice-prefeito", "Chefe de gabinete", "Desenvolvimento econômico", "Agências municipais de desenvolvimento", "Desenvolvimento", ""]


def test_rank_prefers_found_then_contact_then_source(spark):
    t = spark.createDataFrame([(1, "Parcial", "c", "n", "u"), (2, "Encontrado", "", "n", "u"), (3, "Encontrado", "c", "n", "x/default.aspx"), (4, "Encontrado", "c", "n", "x/equipe-de-governo"), (5, "Encontrado", "c", "n", "x/equipe-de-governo")], "i int, s string, c string, n string, u string")
    keys = records.score(F.col("s"), F.col("c"), F.col("n"), F.col("u"))
    out = records.rank_candidates(t.withColumn("g", F.lit(1)), ["g"], keys, "i")
    assert [r["i"] for r in out.orderBy("rank").collect()] == [4, 5, 3, 2, 1]


def test_audits(spark):
    t = spark.createDataFrame([(1, "Encontrado", "u", "d", ""), (2, "bad", "u", None, "n"), (3, "Parcial", "", "d", " ")], "k int, status string, source_url string, collected_on string, notes string")
    assert rows(quality.row_audit(t, ["k"]), "k", "issue") == [(2, "date"), (2, "status"), (3, "note"), (3, "source")]


def test_verify_compares_digits_and_folded_names(spark):
    r = spark.createDataFrame([(1, "u", "José Lima", "(11) 3333-4444"), (2, "u", "Outro Nome", ""), (3, "v", "x", ""), (4, "", "x", "")], "k int, source_url string, name string, phone string")
    p = spark.createDataFrame([("u", "JOSE\nLIMA tel 11 3333 4444", "Encontrado"), ("v", "", "Encontrado"), ("u", "JOSE\nLIMA tel 11 3333 4444", "Encontrado")], "url string, text string, status string")
    out = quality.verify(r, p, ["name", "phone"], digits=["phone"])
    assert rows(out, "k", "checked", "verdict") == [(1, 2, "Validado"), (2, 1, "Divergente"), (3, 1, "Não validado"), (4, 1, "Divergente")]


def test_near_lines(spark):
    lines = [("d", i, "value" if i == 0 else "term" if i == 13 else "-") for i in range(20)] + [("e", 0, "value"), ("e", 12, "term")]
    t = spark.createDataFrame(lines, "doc string, pos int, line string")
    assert rows(quality.near_lines(t, F.col("line") == "value", F.col("line") == "term"), "doc", "pos") == [("e", 0)]


def test_frontier_visits_once_and_within_its_site(spark):
    seeds = spark.createDataFrame([("t", "https://h.example/")], "target string, url string")
    links = [("http://www.h.example", "https://h.example/gabinete", 1), ("https://h.example/", "http://www.h.example/gabinete/", 2), ("https://h.example/", "https://other.example/", 3), ("https://h.example/", "https://h.example/x.pdf", 4), ("https://h.example/gabinete", "https://h.example/contato", 0), ("https://h.example/contato", "https://h.example/", 0)]
    out = frontier.crawl(seeds, spark.createDataFrame(links, "from_url string, to_url string, pos int"), rounds=3)
    assert [(r["url"], r["round"]) for r in out.orderBy("rank").collect()] == [("https://h.example/", 0), ("https://h.example/gabinete", 1), ("https://h.example/contato", 2)]


def test_frontier_follows_links_to_the_end(spark):
    url = lambda k: f"https://h.example/p{k}"
    links = spark.createDataFrame([(url(k), url(k + 1), 0) for k in range(9)], "from_url string, to_url string, pos int")
    seeds = spark.createDataFrame([("t", url(0))], "target string, url string")
    assert [(r["url"], r["round"], r["rank"]) for r in frontier.crawl(seeds, links).orderBy("rank").collect()] == [(url(k), k, k + 1) for k in range(10)]
    assert frontier.crawl(seeds, links, most_pages=4).count() == 4


def test_frontier_query_crawls_every_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = catalog.frontier_bfs(spark, "/root/testdata/sf0.001")
    assert out.select("target").distinct().count() == pages.where("url IS NOT NULL AND url <> ''").count()


def test_target_lists(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("Cidade;UF;Habitantes;Capital;Site\nVila;sp;1.200;sim;vila.example\nOutra;RJ;;não;\n", encoding="utf-8")
    out = tables.read_targets(spark, str(p))
    assert rows(out, "name", "state", "population", "capital") == [("Outra", "RJ", 0, False), ("Vila", "SP", 1200, True)]
    p.write_text("municipio,uf\nVila,\n,SP\n", encoding="utf-8")
    with pytest.raises(ValueError, match="2 rows"):
        tables.read_targets(spark, str(p))


def test_table_sets(spark, tmp_path):
    t = spark.createDataFrame([("SP", 1), ("RJ", 2)], "uf string, n int")
    tables.write_tables({"data": t}, str(tmp_path), {"data": ["uf"]})
    tables.write_tables({"data": t.where("uf = 'SP'").withColumn("n", F.lit(9))}, str(tmp_path), {"data": ["uf"]})
    assert rows(tables.read_table(spark, str(tmp_path), "data", "uf string, n int"), "uf", "n") == [("RJ", 2), ("SP", 9)]
    assert tables.read_table(spark, str(tmp_path), "absent", "n int").count() == 0
    assert list(tables.flatten({"a": [1, {"b": None}]})) == [("a[0]", "1"), ("a[1].b", "")]


def test_streams(spark, tmp_path):
    src = spark.createDataFrame([("2024-01-01 00:01:00", "a"), ("2024-01-01 00:02:00", "a"), ("2024-01-01 00:07:00", "b")], "ts string, status string")
    src.select(F.to_timestamp("ts").alias("ts"), "status", F.col("status").alias("url_key")).write.parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema("ts timestamp, status string, url_key string").parquet(f"{tmp_path}/in")
    for name, df, mode in (("first_pages", incremental.first_pages(stream()), "append"), ("counts", incremental.status_counts(stream()), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").start()
        q.processAllAvailable()
        q.stop()
    assert spark.table("first_pages").count() == 2
    assert rows(spark.table("counts"), "status", "n") == [("a", 2), ("b", 1)]


def test_upsert_twice_changes_nothing(spark):
    kept = {"df": spark.createDataFrame([("a", 1, "x")], "k string, t int, v string")}
    batch = spark.createDataFrame([("a", 2, "y"), ("b", 1, "z"), ("a", 0, "old")], "k string, t int, v string")
    apply = incremental.upsert(lambda: kept["df"], lambda df: kept.update(df=df), ["k"], "t")
    apply(batch, 0)
    once = rows(kept["df"], "k", "t", "v")
    apply(batch, 0)
    assert rows(kept["df"], "k", "t", "v") == once == [("a", 2, "y"), ("b", 1, "z")]


def test_official_sites(spark):
    from gazetta.operators import delivery

    t = spark.createDataFrame([("https://www.vilaserra.sp.gov.br/x", "Vila da Serra", ""), ("https://camara.vilaserra.sp.gov.br/", "Vila da Serra", ""), ("https://pm.sp.gov.br/", "Vila da Serra", "Prefeitura de Vila Serra"), ("https://vilaserra.example/", "Vila da Serra", "")], "u string, n string, t string")
    got = [r[0] for r in t.select(delivery.official_site(F.col("u"), F.col("n"), F.lit("SP"), F.col("t"))).collect()]
    assert got == [True, False, True, False]
    wrapped = spark.createDataFrame([("//r.example/l/?uddg=https%3A%2F%2Fh.example%2Fa&x=1",), ("https://h.example/",), ("/x",)], "h string")
    assert [r[0] for r in wrapped.select(delivery.unwrap_result(F.col("h"))).collect()] == ["https://h.example/a", "https://h.example/", ""]


def test_invalid_rows_and_gate(spark):
    from gazetta.operators import delivery

    t = spark.createDataFrame([(1, "Encontrado", "", "", "", "", "Prefeito", "u", "Vila", "SP"), (2, "Encontrado", "Vila", "a@x", "", "", "Prefeito", "u", "Vila", "SP"), (3, "Encontrado", "Ana Lima", "a@x", "", "", "Planejamento", "https://h/educacao", "Vila", "SP"), (4, "Encontrado", "Ana Lima", "a@x", "", "", "Prefeito", "u", "Vila", "SP")], "k int, status string, name string, email string, phone string, mobile string, role string, source_url string, target string, state string")
    bad = delivery.invalid_rows(t, ["k"])
    assert rows(bad, "k", "reasons") == [(1, ["no data"]), (2, ["no person", "place"]), (3, ["source"])]
    assert rows(delivery.to_rerun(t, bad, ["k"]), "k") == [(1,), (2,), (3,)]
    verified = spark.createDataFrame([("Validado",)], "verdict string")
    assert delivery.gate(t.where("false"), verified) == (True, [])
    assert delivery.gate(t, verified.unionByName(spark.createDataFrame([("Divergente",)], "verdict string"))) == (False, ["audit", "verification"])


def test_directory_covers_every_category(spark):
    from gazetta.plans import directory

    page = "<main><p>Prefeito: Ana Lima Souza</p><p>E-mail: prefeita@v.example.org</p>" + "<p>texto institucional da vila</p>" * 5 + "</main>"
    targets = spark.createDataFrame([("Vila", "SP", "Municipal", "https://v.example/"), ("Outra", "SP", "Municipal", ""), ("Fechada", "SP", "Municipal", "https://f.example/")], "target string, state string, sphere string, site string")
    rows_ = [(1, "Vila", "https://v.example/gabinete", page, 200), (2, "Fechada", "https://f.example/", "<p>Access denied</p>", 200), (3, "Vila", "https://v.example/x", "", 404)]
    pages = spark.createDataFrame(rows_, "page_id long, target string, url string, html string, http_status int")
    out = directory.build(targets, pages, "2024-01-01")
    data = out["data"]
    assert data.count() == 27
    assert rows(data.where("status = 'Encontrado' AND role <> 'Município/Capital e UF'"), "target", "role", "name", "email") == [("Vila", "Prefeito", "Ana Lima Souza", "prefeita@v.example.org")]
    assert rows(out["targets"], "target", "status") == [("Fechada", "Bloqueio técnico"), ("Outra", "Site não localizado"), ("Vila", "Encontrado")]
    assert {r["status"] for r in data.where("target = 'Fechada' AND name = ''").collect()} == {"Bloqueio técnico"}
    assert rows(out["sources"], "page_id", "status") == [(1, "Encontrado"), (2, "Bloqueio técnico"), (3, "Página sem informação pública")]
    assert rows(out["pending"], "kind", "target") == [("Coleta", "Fechada"), ("Site", "Outra")]
    assert out["audit"].isEmpty()
    figures = {r["indicator"]: r["value"] for r in out["summary"].where("section = 'Indicadores gerais'").collect()}
    assert figures["Total de municípios no escopo"] == "3" and figures["Total de bloqueios técnicos"] == "1" and figures["Total de municípios com algum dado encontrado"] == "1"
    known = spark.createDataFrame([("sp", "outra", "municipal", "Vice-prefeito", "Bia Melo Reis", "vice@o.example", "https://o.example/vice", "Encontrado")], "state string, name string, sphere string, role string, person string, email string, source_url string, status string")
    with_known = directory.build(targets, pages, "2024-01-01", known)
    assert rows(with_known["data"].where("role = 'Vice-prefeito' AND email <> ''"), "target", "name") == [("Outra", "Bia Melo Reis")]


def test_cover_ranks_candidates_and_drops_places(spark):
    schema = "state string, target string, sphere string, role string, unit string, name string, email string, phone string, mobile string, source_url string, page_url string, status string, notes string, ordinal int"
    def row(n, role, name, email, url, status):
        return ("SP", "Vila", "Municipal", role, "", name, email, "", "", url, "", status, "", n)
    contacts = spark.createDataFrame([
        row(1, "Prefeito", "Ana Lima", "", "https://v/x", "Parcial"), row(2, "Prefeito", "Ana Lima", "a@v", "https://v/equipe-de-governo", "Encontrado"), row(3, "Prefeito", "Vila", "", "https://v/y", "Parcial"),
        row(4, "Contato geral", "", "g@v", "https://v/z", "Parcial"), row(5, "Prefeito", "Vila", "b@v", "https://v/w", "Encontrado")], schema)
    targets = spark.createDataFrame([("SP", "São Paulo", "Vila", "Vila", 5, "r", "Municipal", "https://v/", [], "Não publicado", "n"), ("SP", "São Paulo", "Órgão", "Órgão", None, "", "Estadual", "https://o/", ["Planejamento"], "Não publicado", "n")],
        "state string, state_name string, target string, municipality string, population long, reason string, sphere string, site string, categories array<string>, filler_status string, filler_note string")
    out = records.cover(targets, contacts, "2024-01-01")
    got = [(r["role"], r["name"], r["email"], r["status"]) for r in out.where("target = 'Vila'").orderBy("ordinal").collect()]
    assert got[:4] == [("Município/Capital e UF", "Vila/SP", "", "Encontrado"), ("Prefeito", "Ana Lima", "a@v", "Encontrado"), ("Prefeito", "", "b@v", "Encontrado"), ("Prefeito", "Ana Lima", "", "Parcial")]
    assert len(got) == 11 and {s for _, n, _, s in got[4:]} == {"Não publicado"}
    assert rows(out.where("target = 'Órgão'"), "role", "source_url") == [("Município/Capital e UF", records.TERRITORY_URL), ("Planejamento", "https://o/")]
    organ = contacts.where("ordinal = 4").withColumns({"target": F.lit("Órgão"), "sphere": F.lit("Estadual")})
    assert rows(records.cover(targets, organ, "x").where("target = 'Órgão' AND email <> ''"), "role", "email") == [("Planejamento", "g@v")]


def test_verification_wants_values_near_their_category(spark):
    far = "\n".join(f"linha {i}" for i in range(30))
    texts = {
        "near": "Prefeito\nAna Lima Souza\na@v.example",
        "far": f"Prefeito\n{far}\nAna Lima Souza\na@v.example",
        "hop": f"a@v.example\nAna Lima Souza\n{far}\nPrefeito\nAna Lima Souza",
        "split": "Prefeito\nAna\nLima Souza\na@v.example",
        "credit": "Prefeito\nFoto: Ana Lima Souza\na@v.example",
    }
    pages = spark.createDataFrame([*((k, t, "Encontrado") for k, t in texts.items()), ("down", "x", "Site fora do ar"), ("near", "", "Site fora do ar")], "url string, text string, status string")
    def row(url, sphere="Municipal", name="Ana Lima Souza", email="a@v.example"):
        return ("SP", "Vila", sphere, "Prefeito", "Gabinete", name, email, "", "", url, "", "Encontrado")
    data = spark.createDataFrame([row("near"), row("far"), row("far", "Estadual"), row("hop"), row("split"), row("credit"), row("down"), row(""), row("near", name="Menu"), row("near", email="b@v.example")],
        "state string, target string, sphere string, role string, unit string, name string, email string, phone string, mobile string, source_url string, page_url string, status string")
    got = [(r["source_url"], r["sphere"], r["name"], r["email"][0], r["verdict"]) for r in quality.verify_records(data, pages).collect()]
    verdicts = {k[:4]: k[4] for k in got}
    assert verdicts == {
        ("near", "Municipal", "Ana Lima Souza", "a"): "Validado", ("far", "Municipal", "Ana Lima Souza", "a"): "Divergente", ("far", "Estadual", "Ana Lima Souza", "a"): "Validado", ("hop", "Municipal", "Ana Lima Souza", "a"): "Validado",
        ("split", "Municipal", "Ana Lima Souza", "a"): "Validado", ("credit", "Municipal", "Ana Lima Souza", "a"): "Divergente", ("down", "Municipal", "Ana Lima Souza", "a"): "Não validado", ("", "Municipal", "Ana Lima Souza", "a"): "Divergente",
        ("near", "Municipal", "Menu", "a"): "Divergente", ("near", "Municipal", "Ana Lima Souza", "b"): "Divergente",
    }


def test_verification_sample_takes_every_state_first(spark):
    base = [("SP" if n < 8 else "RJ", f"t{n}", "Prefeito" if n else "Município/Capital e UF", "n" if n != 3 else "", "", "", "", "Encontrado" if n != 5 else "Não publicado", n) for n in range(12)]
    data = spark.createDataFrame(base, "state string, target string, role string, name string, email string, phone string, mobile string, status string, ordinal int")
    assert {r["target"] for r in quality.verification_sample(data, 2).collect()} == {"t1", "t8"}
    four = quality.verification_sample(data, 4, seed=7)
    assert {"t1", "t8"} < {r["target"] for r in four.collect()} and four.count() == 4
    assert quality.verification_sample(data, 0).count() == quality.verification_sample(data, 100).count() == 9


def test_audit_of_a_delivery(spark):
    data = spark.createDataFrame([("SP", "Vila", "Municipal", "Prefeito", "ok?", "", "", "", "", 1), ("SP", "Gov", "Estadual", "Prefeito", "Encontrado", "u", "", "d", "", 2)], "state string, target string, sphere string, role string, status string, source_url string, page_url string, collected_on string, notes string, ordinal int")
    tables = {"data": data, "targets": data.select("state", "target", "sphere")}
    expected = spark.createDataFrame([("sp", "Vila", "Municipal"), ("SP", "Serra", "Municipal")], "state string, target string, sphere string")
    out = quality.audit(tables, ["ordinal"], expected)
    kinds = {r["kind"]: r["n"] for r in out.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert kinds == {"Aba": 5, "Status": 1, "Fonte": 1, "Data": 1, "Cobertura": 8, "Escopo": 4}
    assert {r["line"] for r in out.where("kind IN ('Status', 'Fonte')").collect()} == {2}
    state = spark.createDataFrame([("SP", "Gov", "Estadual"), ("SP", "Org", "Estadual")], "state string, target string, sphere string")
    texts = {r["description"] for r in quality.audit(tables, ["ordinal"], expected, state).where("kind = 'Escopo'").collect()}
    assert texts == {"Município/capital esperado ausente em targets.", "Município/capital esperado ausente em data.", "Alvo estadual configurado ausente em targets.", "Alvo estadual configurado ausente em data."}


def test_summary_of_nothing_says_so(spark):
    data = spark.createDataFrame([], "state string, municipality string, role string, status string")
    targets = spark.createDataFrame([], "state string, target string, sphere string, status string")
    got = quality.summary(data, targets, targets, "now").where("indicator = 'Sem dados'")
    assert rows(got, "section") == [("Por Cargo/Área",), ("Por Esfera",), ("Por Município/Capital",), ("Por Status",), ("Por UF",)]


def test_expected_scope(spark):
    config = spark.createDataFrame([("sp", "Governo", "https://g/", [("Org", "https://o/", None), ("", "https://p/", None), ("Q", "", None)]), ("RJ", "Sem site", "", [])], "state string, government string, site string, organs array<struct<name: string, site: string, categories: array<string>>>")
    assert rows(quality.expected_state(config), "state", "target", "sphere") == [("SP", "Governo", "Estadual"), ("SP", "Org", "Estadual")]
    places = spark.createDataFrame([("SP", "Grande", 40000, False), ("SP", "Pequena", 100, False), ("AC", "Rio Branco", 5, True)], "state string, name string, population long, capital boolean")
    assert rows(quality.expected_municipal(places, scope.limits(spark)), "state", "target") == [("AC", "Rio Branco"), ("SP", "Grande")]


def test_lots_resume_and_reprocess(spark, tmp_path):
    from gazetta.operators import batch

    targets = spark.createDataFrame([("SP", f"t{i}", "Municipal", i) for i in range(5)] + [("RJ", "r", "Municipal", 9)], "state string, target string, sphere string, ordinal int")
    ran: list[list[str]] = []

    def work(some):
        ran.append(sorted(r["target"] for r in some.collect()))
        extra = some.select("state", "target", "sphere", F.lit("Prefeito").alias("role"), F.lit("Encontrado").alias("status"), F.when(F.col("target") == "t1", "Menu").otherwise("Ana Lima").alias("name"), *(F.lit("").alias(c) for c in ("email", "phone", "mobile", "source_url")))
        return {"data": extra, "targets": some}

    folder = str(tmp_path / "lots")
    assert batch.run_lots(targets, work, folder, chunk_size=2) == ["RJ-001", "SP-001", "SP-002", "SP-003"]
    assert ran == [["r", "t0", "t1", "t2", "t3", "t4"]] and batch.run_lots(targets, work, folder, chunk_size=2) == []
    shutil.rmtree(tmp_path / "lots" / "marks" / "lot=SP-002")
    assert batch.run_lots(targets, work, folder, chunk_size=2) == ["SP-002"] and ran[-1] == ["t2", "t3"]
    whole = batch.consolidate(spark, folder, ["RJ-001", "SP-001", "SP-002", "SP-003", "XX-001"], "municipal")
    assert whole["data"].count() == 6
    again = batch.reprocess(targets, whole["data"], work, str(tmp_path / "re"))
    assert again.count() == 6 and ran[-1] == ["t1"]
    assert [r["target"] for r in spark.read.json(str(tmp_path / "re" / "manifest" / "invalid_rows")).collect()] == ["t1"]


def test_command_line(spark, tmp_path):
    from gazetta.operators import batch

    (tmp_path / "t.csv").write_bytes("Município;UF;População;Site\nVila;SP;40.000;https://v.example/\nPequena;SP;10;\nGoiânia;GO;9;\n".encode("latin-1"))
    spark.createDataFrame([(1, "Vila", "https://v.example/equipe", "<p>Prefeita: Ana Lima Souza</p><p>a@v.example</p>")], "page_id long, target string, url string, html string").write.parquet(str(tmp_path / "pages"))
    out = str(tmp_path / "out")
    code = batch.main(["--targets", str(tmp_path / "t.csv"), "--pages", str(tmp_path / "pages"), "--output", out, "--collected-on", "2024-01-01"])
    data = spark.read.parquet(f"{out}/tables/data")
    assert code == 1 and {r["kind"] for r in spark.read.parquet(f"{out}/audit").collect()} <= {"Aba"} or code == 0
    assert rows(data.where("email <> ''"), "state", "target", "name") == [("SP", "Vila", "Ana Lima Souza")] and data.count() == 18
    assert batch.main(["--pages", "x", "--targets", str(tmp_path / "t.csv"), "--output", out, "--filter-only"]) == 0


def test_lookups_of_states(spark):
    from gazetta.functions import geo

    df = spark.createDataFrame([("São Paulo", "sp"), ("sao paulo", "SP"), ("RJ", "xx"), (None, None), ("Goiânia", " go ")], "n string, c string")
    got = [tuple(r) for r in df.select(geo.state_code(F.col("n")), geo.state_name(F.col("c")), geo.is_capital(F.col("n"), F.col("c"))).collect()]
    assert got == [("SP", "São Paulo", True), ("SP", "São Paulo", True), ("RJ", "", False), ("", "", False), ("", "Goiás", True)]
    assert geo.states(spark).count() == 27


def test_sources_and_sinks(spark, tmp_path):
    path = str(tmp_path / "l.json")
    place = '{"id": %d, "nome": "%s", %s}'
    near, far = '"regiao-imediata": {"regiao-intermediaria": {"UF": {"sigla": "SP"}}}', '"microrregiao": {"mesorregiao": {"UF": {"sigla": "RJ"}}}'
    (tmp_path / "l.json").write_text(f"[{place % (1, 'A', near)}, {place % (2, 'B', far)}]")
    assert rows(tables.read_localities(spark, path), "code", "state") == [("1", "SP"), ("2", "RJ")]
    (tmp_path / "l.json").write_text('[{"id": 3, "nome": "C"}]')
    with pytest.raises(ValueError, match="1 places"):
        tables.read_localities(spark, path)
    with pytest.raises(ValueError, match="export workbooks"):
        tables.read_any(spark, "x.xlsx")
    with pytest.raises(FileNotFoundError):
        tables.read_targets(spark, str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError):
        tables.resolve_input(spark, None, [str(tmp_path / "none.csv")])
    assert tables.resolve_input(spark, None, [str(tmp_path / "none.csv"), path]) == path
    sites = spark.createDataFrame([("a", "https://a/", "Encontrado"), ("b", "", "Site não localizado")], "name string, site string, site_status string")
    tables.write_sites(sites, "2024-01-01", str(tmp_path / "s"), str(tmp_path / "p"))
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "p")), "name", "validated_on") == [("b", "2024-01-01")]
    assert tables.write_report(sites, str(tmp_path / "r")) == 1 and tables.write_report(sites.where("false"), str(tmp_path / "r")) == 0
    tables.write_frozen(spark.createDataFrame([("1", "Ávila", "SP")], "code string, name string, state string"), spark.createDataFrame([], "code string, population long"), "x", str(tmp_path / "f"))
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "f")), "name", "population") == [("Ávila", "0")]


def test_best_attempt_and_links(spark):
    from gazetta.operators import delivery

    t = spark.createDataFrame([("u", "Encontrado", "abc", 2), ("u", "Encontrado", "abc", 1), ("u", "Site fora do ar", "abcdef", 0)], "url string, status string, text string, attempt int")
    assert rows(delivery.best_attempt(t, ["url"]), "url", "attempt") == [("u", 1)]
    html = "<a href='/gabinete'>Gabinete</a><a href='x/../contato#top'>Contato</a><a href='/contato'>again</a><a href='mailto:a@b'>contato</a><a href='//o.example/contato'>contato</a><a href='/noticias/1'>contato</a><a href='/sobre'>nada</a><a href='javascript:x'>contato</a>"
    pages = spark.createDataFrame([("https://v.example/", html)], "url string, html string")
    assert rows(frontier.page_links(pages), "to_url", "pos", "priority") == [("https://v.example/contato", 1, 3), ("https://v.example/gabinete", 0, 1)]
    seeds = spark.createDataFrame([("t", "https://v.example/")], "target string, url string")
    got = frontier.crawl(seeds, frontier.page_links(pages), blocked=spark.createDataFrame([("t",)], "target string"))
    assert got.where("round = 0").count() == 11 and got.where("url = 'https://v.example/contato'").count() == 1


def test_resume_runs_new_files_only(spark, tmp_path):
    folder, out, done = (str(tmp_path / x) for x in ("in", "out", "done"))
    schema = "k int, v string"
    run = lambda: incremental.resume(spark, folder, schema, lambda df: df.withColumn("v", F.upper("v")), out, done)
    spark.createDataFrame([(1, "a")], schema).coalesce(1).write.parquet(folder)
    assert run() == 1 and run() == 0
    spark.createDataFrame([(2, "b")], schema).coalesce(1).write.mode("append").parquet(folder)
    assert run() == 1 and rows(spark.read.parquet(out), "k", "v") == [(1, "A"), (2, "B")]
