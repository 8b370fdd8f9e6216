"""Extraction of e-mails, phones, blocks and roles from text, as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazetta.functions.text import is_mobile, norm_python, norm_search

# Patterns of e-mail addresses and of phones with an optional country and area code.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(?<!\d)(?:\+?55\s*)?(?:\(?([1-9]{2})\)?\s*)?(9?\d{4})[\s.\-]?(\d{4})(?!\d)"
GLUED = ["telefones", "telefone", "fone", "celular", "whatsapp"]
# The roles in scope and the words that name them; words too general to name a role by themselves are left out.
ROLES = {
    "Prefeito": ["prefeito", "prefeita", "gabinete do prefeito", "gabinete da prefeita", "chefe do executivo"],
    "Vice-prefeito": ["vice-prefeito", "vice prefeito", "vice-prefeita", "vice prefeita"],
    "Chefe de gabinete": ["chefe de gabinete", "chefia de gabinete"],
    "Secretaria de Desenvolvimento Econômico": [
        "desenvolvimento econômico", "secretaria de desenvolvimento econômico", "secretaria municipal de desenvolvimento econômico", "secretário municipal de desenvolvimento econômico",
        "indústria e comércio", "desenvolvimento, indústria e comércio", "desenvolvimento econômico e turismo", "trabalho e desenvolvimento econômico",
    ],
    "Secretaria de Desenvolvimento": ["secretaria de desenvolvimento", "secretaria municipal de desenvolvimento", "secretário municipal de desenvolvimento", "desenvolvimento urbano"],
    "Secretaria de Finanças/Fazenda": [
        "secretaria de finanças", "secretaria municipal de finanças", "secretaria da fazenda", "secretaria municipal da fazenda", "secretário municipal de finanças", "secretário municipal da fazenda",
        "administração e finanças", "finanças e planejamento",
    ],
    "Secretaria de Planejamento": [
        "planejameto", "secretaria de planejamento", "secretaria municipal de planejamento", "secretaria municipal de planejameto", "secretário municipal de planejamento", "planejamento urbano",
        "gestão e planejamento", "planejamento e gestão",
    ],
    "Agência/Sala de Desenvolvimento": ["agência de desenvolvimento", "desenvolvimento municipal", "sala do empreendedor", "banco do povo", "casa do empreendedor"],
}
# Beginnings of lines that open a section of news.
NOISE = ["ultimas noticias", "noticias recentes", "agendamento de consulta on-line", "telefones uteis", "veja tambem", "leia tambem", "noticias relacionadas"]


def emails(text: Column) -> Column:
    """Distinct addresses in order, in lower case, without a label glued to their end."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(EMAIL), F.lit(0))
    clean = F.transform(found, lambda x: F.btrim(F.regexp_replace(F.lower(x), f"({'|'.join(GLUED)})$", ""), F.lit(".,;:")))
    return F.array_distinct(F.filter(clean, lambda x: x != ""))


def phones(text: Column, pattern: str = PHONE) -> Column:
    """Distinct phones in order; ranges of years and bare runs of eight digits are none."""
    t = F.coalesce(text, F.lit(""))
    groups = [F.regexp_extract_all(t, F.lit(pattern), F.lit(i)) for i in range(4)]
    found = F.arrays_zip(*(g.alias(n) for g, n in zip(groups, "abcd", strict=True)))

    def sound(m: Column) -> Column:
        start, end = m["c"], m["d"]
        years = (F.length(start) == 4) & ((start.rlike("^(19|20)") & end.rlike("^(19|20)")) | (end.startswith("20") & start.cast("int").between(101, 3112)))
        bare = F.trim(m["a"]).rlike("^[0-9]{8}$")
        return (m["b"] != "") | ~(years | bare)

    return F.array_distinct(F.transform(F.filter(found, sound), lambda m: F.trim(m["a"])))


def mobiles(text: Column) -> Column:
    return F.filter(phones(text), is_mobile)


def blocks(text: Column, longest: int = 1200, lines: int = 8) -> Column:
    """Paragraphs as arrays of trimmed lines; one that is too long is cut every ``lines`` lines."""
    unix = F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n")
    raw = F.transform(F.split(unix, "\n{2,}"), lambda b: F.filter(F.transform(F.split(b, "\n"), lambda x: F.trim(x)), lambda x: x != ""))

    def cut(b: Column) -> Column:
        many = F.ceil(F.size(b) / lines).cast("int")
        groups = F.transform(F.sequence(F.lit(0), many - 1), lambda i: F.array_join(F.slice(b, i * lines + 1, lines), "\n"))
        return F.when(F.length(F.array_join(b, " ")) > longest, groups).otherwise(F.array(F.array_join(b, "\n")))

    return F.flatten(F.transform(F.filter(raw, lambda b: F.size(b) > 0), cut))


def before_noise(text: Column, noise: list[str] = NOISE) -> Column:
    """The lines before the first that opens a section of noise."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    opens = "^(" + "|".join(map(re.escape, noise)) + ")"
    at = F.array_position(F.transform(lines, lambda x: norm_search(x).rlike(opens)), True)
    return F.when(at > 0, F.array_join(F.slice(lines, F.lit(1), (at - 1).cast("int")), "\n")).otherwise(F.array_join(lines, "\n"))


def roles(text: Column, config: dict[str, list[str]] = ROLES) -> Column:
    """The roles that a text names as whole words, in the order of the configuration."""
    from gazetta.functions.lexicon import role_pattern

    low = norm_search(text)
    listed = F.array_compact(F.array(*(F.when(low.rlike(role_pattern(variants)), F.lit(role)) for role, variants in config.items())))
    wide, narrow = "Secretaria de Desenvolvimento", "Secretaria de Desenvolvimento Econômico"
    return F.when(F.array_contains(listed, narrow) & low.contains("desenvolvimento economico"), F.array_remove(listed, wide)).otherwise(listed)
