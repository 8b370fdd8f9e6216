"""Behaviours of text, URL, extraction and contact functions; all names and hosts are invented."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gazetta.functions import contacts, extract, html, text, urls


def one(spark, build, *values):
    row = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return row.select(build(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first()["x"]


def many(spark, build, values):
    rows = [(i, v) for i, v in enumerate(values)]
    out = spark.createDataFrame(rows, "i int, c string").select("i", build(F.col("c")).alias("x")).orderBy("i").collect()
    return [r["x"] for r in out]


def test_normal_forms(spark):
    assert many(spark, text.norm_search, ["  São  Bento\tdo  SUL ", "", None]) == ["sao bento do sul", "", None]
    assert many(spark, text.norm_key, [" Município / Capital ", "É--x_"]) == ["municipio_capital", "e_x"]
    assert many(spark, text.slugify, ["Vila d'Água Fria"]) == ["viladaguafria"]
    assert many(spark, text.title_name, ["VILA DE SANTO-amaro  DO e", "de x", ""]) == ["Vila de Santo-Amaro do e", "De X", ""]
    assert many(spark, text.norm_emails, ["A@x.org; b@x.org ;a@X.org;", None]) == ["a@x.org; b@x.org", ""]
    assert many(spark, text.norm_phones, ["+55 11 91234-5678; 1112345678", "912345678", "12345678", "ramal 12"]) == ["(11) 91234-5678; (11) 1234-5678", "91234-5678", "1234-5678", "ramal 12"]
    assert many(spark, text.norm_status, ["Parcial", "NAO PUBLICADO", "???", None]) == ["Parcial", "Não publicado", "Necessita validação manual", "Necessita validação manual"]
    assert many(spark, text.parse_count, ["1.139.047", "1000", "", "x", None]) == [1139047, 1000, 0, 0, 0]
    assert many(spark, text.parse_flag, ["Sim", "não", "TRUE", None]) == [True, False, True, False]
    assert many(spark, text.unit_of_role, ["Prefeito", "", "Sala X"]) == ["Gabinete/Prefeitura", "Contato geral", "Sala X"]
    assert one(spark, text.merge_lists, "a; b", "b;c") == "a; b; c"
    assert many(spark, lambda c: text.add_note(c, "n."), ["", "m.", "n. m."]) == ["n.", "m. n.", "n. m."]


def test_normal_forms_stay(spark):
    values = ["São Bento", "x@Y.org;z@y.org", "(11) 91234-5678", "Não publicado", "  a   B "]
    for f in (text.norm_search, text.norm_key, text.norm_emails, text.norm_phones, text.norm_status, text.title_name):
        once = many(spark, f, values)
        assert many(spark, f, once) == once


def test_urls(spark):
    assert many(spark, urls.clean_url, [" HTTP://Www.Example.GOV.br/A b?x=1#f", "example.gov.br", "", "nan", "https://h.example/p;v=1?q"]) == [
        "http://www.example.gov.br/Ab?x=1",
        "https://example.gov.br/",
        "",
        "",
        "https://h.example/p?q",
    ]
    keys = many(spark, urls.url_key, ["http://www.h.example//a//b/", "https://h.example/a/b"])
    assert keys[0] == keys[1]
    assert one(spark, urls.same_domain, "https://a.h.example/", "http://www.h.example/x") and not one(spark, urls.same_domain, "https://xh.example/", "https://h.example/")
    assert many(spark, urls.is_root, ["https://h.example/", "https://h.example/Home/", "https://h.example/x"]) == [True, True, False]
    assert many(spark, urls.link_priority, ["https://h/equipe-de-governo", "https://h/gabinete", "https://h/financas", "https://h/contato", "https://h/noticias", "https://h/x"]) == [0, 1, 2, 3, 4, 5]
    reasons = many(spark, urls.ignore_reason, ["https://saude.h.example/", "https://www.facebook.com/h", "https://h.example/a.pdf", "https://h.example/2020/05/x", "https://h.example/secretaria/educacao", "https://h.example/secretaria/fazenda", "https://h.example/sitemap"])
    assert reasons == ["subdomain", "network", "file", "dated", "off topic unit", None, "index"]
    long_page = "Prefeitura e secretaria de contato. " * 20
    assert one(spark, urls.block_page, "Access Denied", "") and one(spark, urls.block_page, "captcha", "") and not one(spark, urls.block_page, long_page, "<form captcha>")


def test_extraction(spark):
    assert many(spark, extract.emails, ["Write A.b@x.gov.br, or c@y.orgtelefone; a.b@x.gov.br", None]) == [["a.b@x.gov.br", "c@y.org"], []]
    found = many(spark, extract.phones, ["Tel (11) 3333-4444, 2019-2024, 12345678, 98765-4321, +55 (21) 99999-8888"])
    assert found == [["(11) 3333-4444", "98765-4321", "+55 (21) 99999-8888"]]
    assert many(spark, extract.blocks, ["a\n b \n\n\nc", "", None, "\n".join(["x" * 100] * 20)]) == [["a\nb", "c"], [], [], ["\n".join(["x" * 100] * n) for n in (8, 8, 4)]]
    assert many(spark, extract.before_noise, ["a\nÚltimas notícias\nb", "a\nb"]) == ["a", "a\nb"]
    assert many(spark, extract.roles, ["Vice-prefeito: X", "O Prefeito e a Secretaria da Fazenda", "nothing"]) == [["Vice-prefeito"], ["Prefeito", "Secretaria de Finanças/Fazenda"], []]


def test_html():
    page = "<html><nav><a href='/x'>Menu</a></nav><main><h1>Title</h1><p>" + "Body text. " * 12 + "<p>More</main><script>no()</script><footer>End</footer>"
    got = html.read_text(page)
    assert got.startswith("Title\nBody text.") and got.endswith("More") and "Menu" not in got and "no()" not in got
    assert html.read_text("<title>T</title><body><form>kept</form><div class='site-menu'>no</div><svg><text>no</text></svg><div id='content'>short</div>") == "kept\nshort"
    assert html.read_text(f"<body>out<div class='x entry-content'>{'long ' * 20}<p>in</div>") == ("long " * 20).strip() + "\nin"
    assert html.read_text("<div class='social-share'>s</div><div class='assistencia-social'>kept<br>too") == "kept\ntoo"
    assert html.read_text(None) == "" and html.read_links("<a href='/a'>One <b>two</b></a>") == [{"href": "/a", "anchor": "One two"}]


def test_html_in_spark(spark):
    df = spark.createDataFrame([("<p>a<p>b",), (None,)], "html string")
    assert [r[0] for r in df.select(html.html_text(F.col("html"))).collect()] == ["a\nb", ""]


PROFILE = """Prefeito: Ana Lima Souza
E-mail: prefeita@vila.example.org
Telefone: (11) 3333-4444

Secretaria de Planejamento
Bruno Costa Alves
planejamento@vila.example.org
"""


def records(t, url=""):
    return {r[0]: r for r in contacts.contacts_of_text(t, url)}


def test_profiles_keep_their_contacts():
    got = records(PROFILE)
    assert got["Prefeito"][1:6] == ("Ana Lima Souza", "prefeita@vila.example.org", "(11) 3333-4444", "", "Encontrado")
    assert got["Secretaria de Planejamento"][1:3] == ("Bruno Costa Alves", "planejamento@vila.example.org")


def test_contact_without_role_is_general_and_partial():
    got = records("Fale: geral@vila.example.org")
    assert list(got) == ["Contato geral"] and got["Contato geral"][5] == "Parcial"


def test_role_without_contact_is_partial():
    got = records("Vice-prefeito: Carlos Dias Neto", "https://v.example.org/equipe")
    assert got["Vice-prefeito"][1] == "Carlos Dias Neto" and got["Vice-prefeito"][5] == "Parcial"


def test_noise_ends_a_text():
    assert records("Últimas notícias\nPrefeito: Ana Lima Souza\na@x.example.org") == {}


def test_caps_on_pages_of_many_contacts():
    five = "Secretaria de Planejamento\nBruno Costa Alves\n" + "\n".join(f"p{i}@v.example.org" for i in range(5))
    assert records(five, "https://v.example.org/equipe")["Secretaria de Planejamento"][2] == ""


def test_vice_address_is_not_the_mayors():
    assert records("Prefeito: Ana Lima Souza\nvice@v.example.org", "https://v.example.org/equipe")["Prefeito"][2] == ""


@pytest.mark.parametrize(("name", "ok"), [("Ana Lima", True), ("Ana", False), ("da Silva Ana", False), ("Secretaria Ana", False), ("Ana Ana", False), ("Ana 2", False), ("", False)])
def test_valid_names(name, ok):
    assert contacts.valid_name(name) is ok


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300))
def test_any_text_gives_records_of_one_shape(t):
    assert all(len(r) == len(contacts.FIELDS) for r in contacts.contacts_of_text(t, "https://x.example/"))


def test_extract_contacts_in_spark(spark):
    df = spark.createDataFrame([(1, PROFILE), (2, None), (3, "")], "k long, text string")
    rows = contacts.extract_contacts(df, ["k"]).collect()
    assert {(r["k"], r["role"]) for r in rows} == {(1, "Prefeito"), (1, "Secretaria de Planejamento")}
