"""Rules as tables against scans of all of them, and the frontier against plain walks and recursive SQL."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from gazetta.functions import urls
from gazetta.functions.text import norm_python
from gazetta.operators import frontier, rules
from gazetta.operators.records import downgrade


def given(spark, listed):
    return rules.rules_of(spark, listed)


ADDRESSES = [
    "https://v.example/a/noticias/b", "https://v.example/Página/x?pg=3", "https://sub.v.example/x.PDF", "https://v.example/%6Eoticias-locais/", "https://v.example/", None, "", "https://v.example/x.pdfx",
    "https://transito.v.example/", "https://v.example/prefixo/longo", "https://v.example/nada/prefixo/longo", "https://v.example/?a=1&curto=2", "https://vendor.example/shop", "https://v.example/ab", "https://v.example/b",
]
LISTED = [("segment", "/noticias/"), ("segment", "noticias-"), ("segment", "b"), ("segment", "ab"), ("query", "pg="), ("query", "curto="), ("file", ".pdf"), ("prefix", "/prefixo"), ("subdomain", "://transito."), ("host", "vendor."), ("network", "Example/Shop")]


def test_hits_are_those_of_a_scan_in_sql(spark):
    """The rules are written out in the SQL, which compares every address with every rule."""
    df = spark.createDataFrame([(u,) for u in ADDRESSES], "url string")
    parts = df.where("url IS NOT NULL").distinct().withColumns({"raw": F.lower(urls.unquoted(F.col("url"))), "path": F.lower(urls.unquoted(urls.path(F.col("url")))), "query": F.lower(urls.query(F.col("url")))})
    parts = parts.withColumn("path", F.translate("path", "á", "a"))
    got = {tuple(r) for r in rules.matches(parts, "url", {"raw": "raw", "path": "path", "query": "query"}, given(spark, LISTED)).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (url VARCHAR, raw VARCHAR, path VARCHAR, query VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", [tuple(r) for r in parts.collect()])
    want = con.execute("""
        WITH r(kind, pattern) AS (VALUES ('segment', '/noticias/'), ('segment', 'noticias-'), ('segment', 'b'), ('segment', 'ab'), ('query', 'pg='), ('query', 'curto='), ('file', '.pdf'),
          ('prefix', '/prefixo'), ('subdomain', '://transito.'), ('host', 'vendor.'), ('network', 'example/shop'))
        SELECT url, kind, pattern FROM t, r WHERE CASE WHEN kind IN ('host', 'subdomain', 'network') THEN contains(raw, pattern) WHEN kind = 'segment' THEN contains(path, pattern)
          WHEN kind = 'query' THEN contains(query, pattern) WHEN kind = 'file' THEN suffix(path, pattern) ELSE prefix(path, pattern) END""").fetchall()
    assert got == set(want) and len(got) > 10


def test_judgement_by_the_default_table_is_that_of_the_lists(spark):
    more = [f"https://v.example{p}x" for p in urls.PREFIXES[:8]] + [f"https://v.example/k{s}" for s in urls.SEGMENTS[::5]] + [f"https://v.example/d{f}" for f in urls.FILES] + [f"https://v.example/?{q}1" for q in urls.QUERIES[::4]]
    more += ["https://www.facebook.com/x", "https://v.example/secretaria/saude", "https://v.example/2020/01/x", "https://v.example/gabinete"]
    df = spark.createDataFrame([(u,) for u in ADDRESSES + more], "url string")
    got = {r.url: r.reason for r in rules.judge_urls(df, "url", rules.default_rules(spark)).collect()}
    want = {r.url: r.reason for r in df.where("url IS NOT NULL").distinct().withColumn("reason", urls.ignore_reason(F.col("url"))).collect()}
    assert got == want and len(set(want.values())) > 7


def test_twenty_thousand_rules_and_none(spark):
    """The pieces that a text is cut into are the same for any number of rules; hits are those of a scan."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcde/-") for _ in range(n))
    listed = sorted({("segment", word(rng.randrange(2, 9))) for _ in range(20_000)})
    texts = [word(30) for _ in range(60)]
    df = spark.createDataFrame([(t, t) for t in texts], "k string, t string")
    got = {(r.k, r.pattern) for r in rules.matches(df, "k", {"path": "t"}, given(spark, listed)).collect()}
    assert got == {(t, p) for t in texts for _, p in listed if p in t} and got
    assert rules.matches(df, "k", {"path": "t"}, given(spark, [])).count() == 0
    assert rules.matches(df.where("false"), "k", {"path": "t"}, given(spark, LISTED)).count() == 0


def test_names_and_sources(spark):
    table = given(spark, [("name_word", "Secretária"), ("name_phrase", "casa civil"), ("unavailable", "down.example")])
    names = spark.createDataFrame([("Ana Lima",), ("Ana Secretaria",), ("Secretariana Lima",), ("Casa  Civil Souza",), ("Ana Secretaria.",), ("",), (None,)], "name string")
    assert {r.name for r in rules.wrong_names(names, "name", table).collect()} == {"Ana Secretaria", "Casa  Civil Souza", "Ana Secretaria."}
    pages = spark.createDataFrame([("https://Down.example/x",), ("https://up.example/",), (None,)], "u string")
    assert [r.url for r in rules.down_sources(pages, "u", table).collect()] == ["https://Down.example/x"]
    assert rules.name_rules(table) == (frozenset({"secretaria"}), ("casa civil",))
    with pytest.raises(ValueError, match="at most 5"):
        rules.name_rules(table, 5)
    low = {norm_python(n) for n in ("Ana Secretaria", "Casa Civil Souza")}
    assert all(re.search("secretaria|casa civil", n) for n in low)


def test_rules_from_files(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Kind;Pattern\nsegment;/Própria/\nSegment;/própria/\nprefix;\nquery;abc=\n", encoding="utf-8")
    own = rules.read_rules(spark, str(tmp_path / "r.csv"))
    assert {("segment", "/propria/"), ("query", "abc="), ("segment", "/noticias/")} <= {tuple(r) for r in own.collect()}
    only = {tuple(r) for r in rules.read_rules(spark, str(tmp_path / "r.csv"), extend=False).collect()}
    assert ("segment", "/noticias/") not in only and ("prefix", "/noticia") in only and ("segment", "/propria/") in only
    (tmp_path / "bad.csv").write_text("kind,pattern\nnothing,x\n")
    with pytest.raises(ValueError, match="no such kind of rule: nothing"):
        rules.read_rules(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "bad2.csv").write_text("what,pattern\nx,y\n")
    with pytest.raises(ValueError, match="without kind"):
        rules.read_rules(spark, str(tmp_path / "bad2.csv"))


def test_a_run_with_rules(spark, tmp_path):
    """Names, sources and redirects that only the table speaks against."""
    from gazetta.plans import directory

    page = "<main><p>Prefeito: Ana Nopessoa Souza</p><p>E-mail: prefeita@v.example.org</p>" + "<p>texto institucional da vila</p>" * 5 + "</main>"
    targets = spark.createDataFrame([("Vila", "SP", "Municipal", "https://v.example/"), ("Fora", "SP", "Municipal", "https://f.example/")], "target string, state string, sphere string, site string")
    pages = spark.createDataFrame([(1, "Vila", "https://v.example/gabinete", page, None), (2, "Fora", "https://f.example/gabinete", page, "https://f.example/semvalor/x"), (3, "Fora", "https://down.example/gabinete", page, None)], "page_id long, target string, url string, html string, final_url string")
    plain = {(r.target, r.role, r["name"], r.status) for r in directory.build(targets, pages, "2024-01-01")["data"].where("email <> ''").collect()}
    assert plain == {("Vila", "Prefeito", "Ana Nopessoa Souza", "Encontrado"), ("Fora", "Prefeito", "Ana Nopessoa Souza", "Encontrado")}
    table = rules.default_rules(spark).unionByName(given(spark, [("name_word", "nopessoa"), ("segment", "/semvalor/"), ("unavailable", "down.example")]))
    out = directory.build(targets, pages, "2024-01-01", rules=table)
    assert {r.page_id: r.status for r in out["sources"].collect()} == {1: "Encontrado", 2: "Página sem informação pública", 3: "Encontrado"}
    assert not [r for r in out["data"].collect() if "Nopessoa" in r["name"]]
    assert {r.status for r in out["data"].where("source_url LIKE '%down.example%'").collect()} <= {"Site fora do ar"}


def test_downgrade_by_a_table_of_names(spark):
    columns = "role string, name string, email string, phone string, mobile string, status string, notes string, source_url string, bad boolean"
    df = spark.createDataFrame([("Prefeito", "Ana Lima", "", "", "", "Encontrado", "", "u", True), ("Prefeito", "Ana Lima", "", "", "", "Encontrado", "", "u", False)], columns)
    assert sorted((r["name"], r.status) for r in downgrade(df, wrong_name=F.col("bad")).collect()) == [("", "Não publicado"), ("Ana Lima", "Encontrado")]


# --- frontier ------------------------------------------------------------------------------


def chain(n, target="t", site="https://v.example"):
    """A chain of pages with a side page on every second one, and links back."""
    out = []
    for i in range(n):
        own = f"{site}/p{i}"
        out += [(own, f"{site}/p{i + 1}", 0), (own, f"{site}/p0", 1), (own, f"http://www.v.example/p{i}/", 2)]
        if i % 2:
            out.append((own, f"{site}/side{i}", 3))
    return out


LINK = "from_url string, to_url string, pos int"


def test_ten_rounds_against_recursive_sql(spark):
    seeds = spark.createDataFrame([("t", "https://v.example/p0"), ("u", "https://v.example/p4")], "target string, url string")
    links = chain(10)
    got = {(r.target, r.url, r["round"]) for r in frontier.crawl(seeds, spark.createDataFrame(links, LINK)).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE s (target VARCHAR, url VARCHAR); CREATE TABLE l (a VARCHAR, b VARCHAR, pos INT)")
    con.executemany("INSERT INTO s VALUES (?, ?)", [tuple(r) for r in seeds.collect()])
    con.executemany("INSERT INTO l VALUES (?, ?, ?)", [x for x in links if x[2] != 2])
    want = con.execute("WITH RECURSIVE w AS (SELECT target, url, 0 AS round FROM s UNION SELECT target, b, round + 1 FROM w JOIN l ON a = url WHERE round < 12) SELECT target, url, min(round) FROM w GROUP BY 1, 2").fetchall()
    assert got == set(want) and max(r for *_, r in got) == 10


def test_ranks_and_the_cap(spark):
    seeds = spark.createDataFrame([("t", "https://v.example/p0"), ("t", "https://v.example/extra")], "target string, url string")
    out = frontier.crawl(seeds, spark.createDataFrame(chain(10), LINK), most_pages=5)
    assert sorted((r["rank"], r.url.rsplit("/", 1)[1]) for r in out.collect()) == [(1, "extra"), (2, "p0"), (3, "p1"), (4, "p2"), (5, "side1")]
    assert frontier.crawl(seeds.where("false"), spark.createDataFrame(chain(3), LINK)).count() == 0
    assert frontier.crawl(seeds, spark.createDataFrame([], LINK)).count() == 2


def test_a_finished_crawl_goes_on_with_new_pages_only(spark, tmp_path):
    store = str(tmp_path / "store")
    seeds = spark.createDataFrame([("t", "https://v.example/p0"), ("u", "https://o.example/")], "target string, url string")
    links = chain(4)
    first = frontier.crawl(seeds, spark.createDataFrame(links, LINK), store=store)
    assert first.count() == 8 and frontier.crawl(seeds, spark.createDataFrame(links, LINK), store=store).count() == 0
    # One page is recorded that was visited before without links; it leads to two new ones and an old one.
    fresh = [("https://v.example/p4", "https://v.example/p5", 0), ("https://v.example/p4", "https://v.example/p1", 1), ("https://v.example/p5", "https://v.example/p6", 0)]
    again = frontier.crawl(seeds, spark.createDataFrame(fresh, LINK), store=store)
    assert sorted((r.target, r.url.rsplit("/", 1)[1], r["round"], r["rank"]) for r in again.collect()) == [("t", "p5", 1, 8), ("t", "p6", 2, 9)]
    # A new target begins, the others rest; the store holds every visit once, and in all as many as one crawl would have made.
    more = seeds.unionByName(spark.createDataFrame([("w", "https://v.example/p5")], "target string, url string"))
    last = frontier.crawl(more, spark.createDataFrame(links + fresh, LINK), store=store)
    assert {(r.target, r["round"]) for r in last.collect()} >= {("w", 0), ("w", 1)} and last.where("target <> 'w'").count() == 0
    held = frontier.visited(spark, store)
    whole = frontier.crawl(more, spark.createDataFrame(links + fresh, LINK))
    assert sorted((r.target, r.url) for r in held.collect()) == sorted((r.target, r.url) for r in whole.collect())


def test_a_crawl_that_was_killed_goes_on(spark, tmp_path):
    store = str(tmp_path / "store")
    seeds = spark.createDataFrame([("t", "https://v.example/p0")], "target string, url string")
    links = spark.createDataFrame(chain(8), LINK)
    frontier.crawl(seeds, links, rounds=3, store=store)
    rest = frontier.crawl(seeds, links, store=store)
    assert rest.count() > 0
    assert sorted(r.url for r in frontier.visited(spark, store).collect()) == sorted(r.url for r in frontier.crawl(seeds, links).collect())


def test_a_round_reads_the_round_before_and_the_links(spark, monkeypatch):
    """Of what is written to scratch, a round draws on two tables, however many rounds there were."""
    read = []
    write = frontier.materialise

    def watched(df):
        read.append(len({f.rsplit("/", 1)[0] for f in df.inputFiles()}))
        return write(df)

    monkeypatch.setattr(frontier, "materialise", watched)
    seeds = spark.createDataFrame([("t", "https://v.example/p0")], "target string, url string")
    frontier.crawl(seeds, spark.createDataFrame(chain(8), LINK))
    assert len(read) >= 10 and set(read[2:]) == {2}


def test_links_are_judged_by_rules_once(spark):
    html = "<a href='/gabinete'>Gabinete</a><a href='/proibido/x'>Gabinete</a><a href='/gabinete'>again</a>"
    pages = spark.createDataFrame([("https://v.example/", html), ("https://v.example/b", html)], "url string, html string")
    assert {r.to_url for r in frontier.page_links(pages).collect()} == {"https://v.example/gabinete", "https://v.example/proibido/x"}
    table = rules.default_rules(spark).unionByName(given(spark, [("segment", "/proibido/")]))
    out = frontier.page_links(pages, rules=table)
    assert {(r.from_url, r.to_url) for r in out.collect()} == {("https://v.example/", "https://v.example/gabinete"), ("https://v.example/b", "https://v.example/gabinete")}
    assert frontier.judged(out, "to_url", table).count() == 1
