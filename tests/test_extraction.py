"""Extraction of contacts: cases a directory of town halls meets."""

import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gazetta.functions import contacts, lexicon as lexicon_module, names
from gazetta.functions.contacts import contacts_of_text, extract_contacts, may_hold_records
from gazetta.functions.extract import ROLES
from gazetta.functions.lexicon import lexicon, role_pattern
from gazetta.functions.patterns import Automaton, stems
from gazetta.functions.text import norm_python
from gazetta.plans import catalog

MAYOR = {"Prefeito": ["prefeito", "prefeita"], "Vice-prefeito": ["vice-prefeito", "vice prefeito"]}
TOWN = "https://vila.example.org"


def rows(text, url="", config=None):
    return [dict(zip(contacts.FIELDS, r, strict=True)) for r in contacts.contacts_of_text(text, url, config)]


def by_role(text, url="", config=None):
    return {r["role"]: r for r in rows(text, url, config)}


def test_a_unit_with_its_contacts_in_one_block():
    text = "\n    Secretaria de Finanças: Maria Silva\n    E-mail: financas@vila.example.org\n    Telefone: 11 3333-3333\n"
    got = rows(text, f"{TOWN}/financas", {"Secretaria de Finanças/Fazenda": ["secretaria de finanças"]})
    assert (got[0]["name"], got[0]["email"], got[0]["status"]) == ("Maria Silva", "financas@vila.example.org", "Encontrado")


def test_a_biography_is_neither_a_name_nor_a_role():
    text = """
    Prefeito
    Otávio Braga Lins
    Prefeito

    Otávio Braga Lins nasceu no dia 24 de junho de 1975, em Rio Claro.
    Foi eleito vice-prefeito nas eleicoes de 2024.
    Foi secretario Municipal de Educacao, de fevereiro de 2025 ate 04/04/2026
    Contatos:
    otavio.braga@vila.example.org
    +55 (68) 3212-7336

    Ultimas noticias
    Prefeito Otávio Braga acompanha obras
    """
    got = rows(text, f"{TOWN}/prefeito/", MAYOR)
    assert [(r["role"], r["name"], r["email"], r["phone"], r["status"]) for r in got] == [("Prefeito", "Otávio Braga Lins", "otavio.braga@vila.example.org", "+55 (68) 3212-7336", "Encontrado")]


def test_profiles_that_touch_keep_their_own_contacts():
    got = by_role("\nPrefeito\nJoao Silva\nVice-Prefeito\nMaria Souza\nContatos:\nmaria@vila.example.org\n(11) 3333-4444\n", f"{TOWN}/equipe", MAYOR)
    assert (got["Prefeito"]["name"], got["Prefeito"]["email"], got["Prefeito"]["phone"], got["Prefeito"]["status"]) == ("Joao Silva", "", "", "Parcial")
    assert (got["Vice-prefeito"]["name"], got["Vice-prefeito"]["email"], got["Vice-prefeito"]["phone"]) == ("Maria Souza", "maria@vila.example.org", "(11) 3333-4444")


@pytest.mark.parametrize("second", ["Vice-Prefeito: Maria Souza", "Vice-Prefeito Maria Souza"])
@pytest.mark.parametrize("phone", ["(11) 2222-2222", "(11) 1111-1111"])
def test_a_shared_number_hides_no_role(second, phone):
    text = f"\nPrefeito\nJoao Silva\nContatos:\nprefeito@vila.example.org\n(11) 1111-1111\n\n{second}\nE-mail: vice@vila.example.org\nTelefone: {phone}\n"
    got = by_role(text, f"{TOWN}/equipe", MAYOR)
    assert (got["Prefeito"]["name"], got["Prefeito"]["email"]) == ("Joao Silva", "prefeito@vila.example.org")
    assert (got["Vice-prefeito"]["name"], got["Vice-prefeito"]["email"], got["Vice-prefeito"]["phone"]) == ("Maria Souza", "vice@vila.example.org", phone)


@pytest.mark.parametrize("title", ["Ouvidoria", "Secretaria Municipal de Saude", "Contato da Ouvidoria", "Contato Ouvidoria", "Contato - Ouvidoria", "Contato: Ouvidoria"])
@pytest.mark.parametrize("own", ["Contatos:\nprefeito@vila.example.org\n(11) 1111-1111\n", ""])
def test_a_blank_line_ends_a_profile(title, own):
    got = by_role(f"\nPrefeito\nJoao Silva\n{own}\n{title}\natendimento@vila.example.org\n(11) 2222-2222\n", f"{TOWN}/prefeito", MAYOR)
    assert (got["Prefeito"]["name"], got["Prefeito"]["email"]) == ("Joao Silva", "prefeito@vila.example.org" if own else "")
    assert (got["Contato geral"]["email"], got["Contato geral"]["phone"]) == ("atendimento@vila.example.org", "(11) 2222-2222")


@pytest.mark.parametrize("title", ["Gabinete do Prefeito", "Prefeito - Gabinete"])
def test_an_office_without_a_name_keeps_its_role(title):
    got = by_role(f"\n{title}\nprefeito@vila.example.org\n(11) 1111-1111\n", f"{TOWN}/gabinete", {"Prefeito": ["prefeito"]})
    assert (got["Prefeito"]["name"], got["Prefeito"]["email"], got["Prefeito"]["status"]) == ("", "prefeito@vila.example.org", "Encontrado")


def test_a_unit_that_presents_its_head():
    text = "Secretaria de Planejamento\nConheça o Secretário\nBruno Costa Alves\nSecretário Municipal de Planejamento\nplanejamento@vila.example.org\nEndereço: Rua Um\nx@vila.example.org"
    got = rows(text, f"{TOWN}/planejamento")
    assert [(r["role"], r["name"], r["email"]) for r in got] == [("Secretaria de Planejamento", "Bruno Costa Alves", "planejamento@vila.example.org")]


def test_a_list_of_units():
    text = "Secretaria Municipal de Planejamento\nSecretário: Bruno Costa Alves\n(11) 3333-4444\nSecretaria Municipal da Fazenda\nResponsável\nCarla Dias Melo\nfazenda@vila.example.org\nDepartamento de Obras\nobras@vila.example.org"
    got = by_role(text, f"{TOWN}/estrutura")
    assert (got["Secretaria de Planejamento"]["name"], got["Secretaria de Planejamento"]["phone"]) == ("Bruno Costa Alves", "(11) 3333-4444")
    assert (got["Secretaria de Finanças/Fazenda"]["name"], got["Secretaria de Finanças/Fazenda"]["email"]) == ("Carla Dias Melo", "fazenda@vila.example.org")


def test_names_one_word_a_line():
    assert names.Names(lexicon()).stacked(["Ana", "de", "Souza", "x@y.zz"], 0) == ("Ana de Souza", 2)
    got = by_role("Prefeito\nAna\nLima\nana@vila.example.org", f"{TOWN}/equipe", MAYOR)
    assert (got["Prefeito"]["name"], got["Prefeito"]["email"]) == ("Ana Lima", "ana@vila.example.org")


@pytest.mark.parametrize(
    ("block", "name"),
    [
        ("nome: Ana Lima Souza, 40", "Ana Lima Souza"),
        ("Titular: Bruno Costa\nx", "Bruno Costa"),
        ("Responsável\nBruno Costa", "Bruno Costa"),
        ("Foto: Bruno Costa", ""),
        ("Rua Bruno Costa, 30", ""),
        ("o prefeito e sua esposa Ana Lima", ""),
        ("O prefeito Ana Lima recebeu", "Ana Lima"),
        ("Ana Lima é a prefeita", "Ana Lima"),
    ],
)
def test_the_name_that_a_block_is_about(block, name):
    assert names.Names(lexicon()).near(block) == name


@pytest.mark.parametrize(
    ("line", "found"),
    [
        ("Prefeito", ("Prefeito", "")),
        ("O Prefeito:", ("Prefeito", "")),
        ("Prefeito: Ana Lima", ("Prefeito", "Ana Lima")),
        ("Prefeita Ana Lima", ("Prefeito", "Ana Lima")),
        ("Prefeito de Vila", None),
        ("Vice-Prefeito, desde 2021", ("Vice-prefeito", "")),
        ("Chefia de Gabinete – Ana Lima", ("Chefe de gabinete", "Ana Lima")),
        ("Prefeitura", None),
    ],
)
def test_lines_that_begin_with_a_role(line, found):
    assert names.Names(lexicon()).role_start(line) == found


@pytest.mark.parametrize(
    ("text", "roles"),
    [("o vice-prefeito", ["Vice-prefeito"]), ("prefeito e vice-prefeito", ["Prefeito", "Vice-prefeito"]), ("chefe de gabinete do secretario", []), ("chefe de gabinete do prefeito", ["Prefeito", "Chefe de gabinete"]), ("secretaria de desenvolvimento economico", ["Secretaria de Desenvolvimento Econômico"])],
)
def test_roles_of_a_text(text, roles):
    config = {"Prefeito": ["prefeito"], "Vice-prefeito": ["vice-prefeito"], "Chefe de gabinete": ["chefe de gabinete"], "Secretaria de Desenvolvimento Econômico": ["desenvolvimento econômico"], "Secretaria de Desenvolvimento": ["secretaria de desenvolvimento"]}
    assert lexicon_module.Lexicon(config).roles(text) == roles


@pytest.mark.parametrize(
    ("role", "path", "bad"),
    [("Prefeito", "/vice", True), ("Prefeito", "/prefeito-e-vice", False), ("Prefeito", "/secretaria/x", True), ("Prefeito", "/gabinete/secretaria", False), ("Secretaria de Planejamento", "/saude", True), ("Contato geral", "/servicos", False), ("Vice-prefeito", "/primeira-dama", True)],
)
def test_sources_that_speak_against_a_role(role, path, bad):
    assert lexicon_module.against(role, TOWN + path) is bad


def test_the_front_page_gives_no_one_without_contact():
    assert rows("Prefeito: Ana Lima Souza", f"{TOWN}/", MAYOR) == []


def test_contact_pages_give_general_contacts_only():
    got = rows("Prefeito: Ana Lima\nana@vila.example.org\n\nGeral\ngeral@vila.example.org", f"{TOWN}/fale-conosco", MAYOR)
    assert [r["role"] for r in got] == ["Contato geral"]


def test_sql_functions(spark):
    contacts.register(spark, MAYOR)
    df = spark.sql("SELECT role, name FROM extract_contacts('Prefeito: Ana Lima\nana@vila.example.org', 'https://v.example/equipe')")
    assert [tuple(r) for r in df.collect()] == [("Prefeito", "Ana Lima")]
    got = spark.sql("SELECT extract_emails('A@b.cc'), extract_phones('11 3333-4444'), detect_roles('a prefeita'), nearest_name('nome: Ana Lima'), valid_name('Rua Um')").first()
    assert tuple(got) == (["a@b.cc"], ["11 3333-4444"], ["Prefeito"], "Ana Lima", False)


def _by_pattern(low):
    """Mentions of roles as the patterns of the JVM find them, a role at a time."""
    found = [role for role, variants in ROLES.items() if re.search(role_pattern(variants), low)]
    if "Secretaria de Desenvolvimento Econômico" in found and "desenvolvimento economico" in low:
        found = [r for r in found if r != "Secretaria de Desenvolvimento"]
    return found


_PIECES = sorted({w for variants in ROLES.values() for v in variants for w in re.split(r"([ ,-])", norm_python(v)) if w}) + ["do", "executivo", "cidade", "x", "_", ".", "vice", " ", " ", "-", "municipio", "1"]


@given(st.lists(st.sampled_from(_PIECES), max_size=14))
@settings(max_examples=400, deadline=None)
def test_mentions_are_those_of_the_patterns(pieces):
    low = norm_python("".join(pieces))
    assert lexicon().roles(low) == _by_pattern(low)
    for start, end, role in lexicon().places(low):
        assert low[start:end].replace("-", " ") in {norm_python(v).replace("-", " ") for v in ROLES[role]}
    assert lexicon().named(low) or not _by_pattern(low)


@given(st.lists(st.text("ab ", min_size=1, max_size=4), max_size=12), st.text("ab ", max_size=40))
@settings(max_examples=300, deadline=None)
def test_automaton_finds_every_phrase_at_every_place(phrases, text):
    want = {(i + len(p), p) for p in phrases for i in range(len(text)) if text.startswith(p, i)}
    assert set(Automaton(phrases).find(text)) == want


def test_stems_are_held_by_every_form():
    held = stems([v for variants in ROLES.values() for v in variants])
    assert all(any(s in norm_python(v) for s in held) for variants in ROLES.values() for v in variants)
    assert len(held) < 16 and lexicon().may_name("SECRETÁRIO do município") and not lexicon().may_name("nada aqui é de ninguém")


def test_time_of_a_match_is_flat_in_the_number_of_phrases():
    """Steps are counted, not seconds: an automaton of 20,000 phrases looks at each character as often as one of 20."""
    few, many = (Automaton(f"phrase number {i:05d}x" for i in range(n)) for n in (20, 20_000))
    text = "a phrase with number and phrase numbers " * 50

    def steps(a):
        looked, state = 0, 0
        for c in text:
            while state and c not in a.next[state]:
                state, looked = a.fail[state], looked + 1
            state, looked = a.next[state].get(c, 0), looked + 1
        return looked

    assert steps(many) == steps(few) <= 2 * len(text)


def test_texts_without_a_mark_stay_behind_and_lose_nothing(spark):
    texts = ["Prefeito João da Silva", "PRÉFEITÔ", "Gabinete\nfone 3333-4444", "nothing", "a@b.org", "ﬁnanças e planejamento", "12345678", None, "", "é só isto"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = {(r.id, r.pos, r.role, r.name) for r in extract_contacts(rows, ["id"]).collect()}
    want = {(i, pos, r[0], r[1]) for i, t in enumerate(texts) for pos, r in enumerate(contacts_of_text(t))}
    assert found == want and {2, 4} <= {i for i, *_ in found}
    kept = {r.id for r in rows.where(may_hold_records(F.col("text"))).collect()}
    assert not kept & {3, 7, 8}


def test_mentions_are_kept_whatever_follows_them(spark, tmp_path):
    """A chief of staff of others is a mention too, marked as one, and the query agrees with its SQL where texts go on so."""
    text = "Chefia de Gabinete do Secretário; chefe de gabinete do prefeito"
    got = contacts.role_mentions(spark.createDataFrame([(1, text), (2, None)], "id long, text string"), ["id"]).collect()
    assert sorted((r.start, r.role, r.of_others) for r in got) == [(0, "Chefe de gabinete", True), (34, "Chefe de gabinete", False), (43, "Prefeito", False), (55, "Prefeito", False)]
    assert lexicon().roles("chefia de gabinete do secretario") == []
    spark.createDataFrame([(i, "de " * 100) for i in range(60)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(catalog.ORACLES["role_mentions"]).fetchall()
    assert sorted(map(tuple, catalog.QUERIES["role_mentions"](spark, str(tmp_path)).collect())) == sorted(want) and any(r[3] == "Chefe de gabinete" for r in want)
