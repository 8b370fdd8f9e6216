"""Text functions as Column expressions: folding, keys, names, e-mails, phones, status."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _folding() -> tuple[str, str]:
    """Latin letters whose decomposition is one base letter with marks, and those letters."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))) for c in range(0xC0, 0x250)]
    pairs = [(a, b[0]) for a, b in pairs if len(b) > 1 and all(unicodedata.combining(x) for x in b[1:])]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _folding()

# Words that stay lower-case inside a name, the states of a record, and
# the states that are recognised without their accents.
PARTICLES = ["da", "de", "do", "das", "dos", "e"]
STATUSES = [
    "Encontrado",
    "Parcial",
    "Não encontrado",
    "Site fora do ar",
    "Site não localizado",
    "Página sem informação pública",
    "Bloqueio técnico",
    "Necessita validação manual",
    "Não publicado",
]
UNSURE = "Necessita validação manual"
TRUE_WORDS = ["1", "s", "sim", "true", "t", "yes", "y", "capital"]


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def fold(c: Column) -> Column:
    """Letters without their accents."""
    return F.translate(c, ACCENTED, PLAIN)


def norm_search(c: Column) -> Column:
    """Folded, lower-case, white space collapsed: what searches compare."""
    return F.trim(F.regexp_replace(F.lower(fold(c)), r"(?U)\s+", " "))


def norm_key(c: Column) -> Column:
    """Folded, lower-case, everything else to single underscores: what headers compare."""
    return F.regexp_replace(F.regexp_replace(F.lower(fold(F.trim(c))), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def slugify(c: Column) -> Column:
    return F.regexp_replace(norm_search(c), "[^a-z0-9]", "")


def identity(c: Column) -> Column:
    """ASCII words with single spaces between them."""
    ascii_only = F.regexp_replace(fold(c), r"[^\x00-\x7F]", "")
    return F.trim(F.regexp_replace(F.lower(ascii_only), "[^a-z0-9]+", " "))


def norm_ascii(c: Column) -> Column:
    """ASCII in lower case, trimmed: letters without their accents, other characters dropped."""
    return F.trim(F.lower(F.regexp_replace(fold(F.coalesce(c, F.lit(""))), r"[^\x00-\x7F]", "")))


def parse_flag(c: Column) -> Column:
    return F.coalesce(norm_search(c.cast("string")).isin(TRUE_WORDS), F.lit(False))


def parse_count(c: Column) -> Column:
    """A number as typed, else its digits alone; nothing is 0."""
    digits = F.regexp_replace(c.cast("string"), "[^0-9]", "")
    return F.coalesce(c.try_cast("long"), digits.try_cast("long"), F.lit(0).cast("long"))


def split_list(c: Column) -> Column:
    """The trimmed non-empty parts of a "; " list."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")


def join_list(c: Column) -> Column:
    return F.array_join(F.array_distinct(c), "; ")


def merge_lists(a: Column, b: Column) -> Column:
    """The union of two "; " lists in order of first appearance."""
    return join_list(F.concat(split_list(a), split_list(b)))


def title_name(c: Column) -> Column:
    """Words and their hyphenated parts capitalised, particles inside the name in lower case."""
    words = F.filter(F.split(F.lower(F.trim(c)), r"\s+"), lambda w: w != "")

    def capital(p: Column) -> Column:
        return F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))

    def word(w: Column, i: Column) -> Column:
        return F.when((i > 0) & w.isin(PARTICLES), w).otherwise(F.array_join(F.transform(F.split(w, "-"), capital), "-"))

    return F.array_join(F.transform(words, word), " ")


def norm_emails(c: Column) -> Column:
    return join_list(F.transform(split_list(c), F.lower))


def digits(c: Column) -> Column:
    """Digits without the country code, where the length shows that one is there."""
    d = F.regexp_replace(c, r"\D", "")
    return F.when(d.startswith("55") & F.length(d).isin(12, 13), F.substr(d, F.lit(3))).otherwise(d)


def format_phone(c: Column) -> Column:
    """One phone number by the number of its digits: 11, 10, 9 or 8; else as it is."""
    d, n = digits(c), F.length(digits(c))

    def part(start: int, size: int) -> Column:
        return F.substring(d, start, size)

    return (
        F.when(n == 11, F.concat(F.lit("("), part(1, 2), F.lit(") "), part(3, 5), F.lit("-"), part(8, 4)))
        .when(n == 10, F.concat(F.lit("("), part(1, 2), F.lit(") "), part(3, 4), F.lit("-"), part(7, 4)))
        .when(n == 9, F.concat(part(1, 5), F.lit("-"), part(6, 4)))
        .when(n == 8, F.concat(part(1, 4), F.lit("-"), part(5, 4)))
        .otherwise(F.trim(c))
    )


def norm_phones(c: Column) -> Column:
    return join_list(F.transform(split_list(c), format_phone))


def is_mobile(c: Column) -> Column:
    return digits(c).rlike("^([0-9]{2})?9[0-9]{8}$")


def norm_status(c: Column) -> Column:
    """A state of the domain, also where it was written without accents; else the one that asks for a check."""
    out = F.when(F.trim(c).isin(STATUSES), F.trim(c))
    for status in STATUSES:
        if not status.isascii():
            out = out.when(F.lower(fold(F.trim(c))) == unicodedata.normalize("NFKD", status).encode("ascii", "ignore").decode().lower(), F.lit(status))
    return out.otherwise(F.lit(UNSURE))


def norm_role(c: Column) -> Column:
    return F.when(blank(c), "Contato geral").otherwise(F.trim(c))


def unit_of_role(c: Column) -> Column:
    """The unit that a role belongs to, where none was given."""
    role = norm_role(c)
    return F.when(role.isin("Prefeito", "Vice-prefeito", "Chefe de gabinete"), "Gabinete/Prefeitura").otherwise(role)


def add_note(notes: Column, note: str) -> Column:
    """Append a note unless it is there."""
    return F.when(blank(notes), F.lit(note)).when(notes.contains(note), notes).otherwise(F.concat(F.trim(notes), F.lit(" "), F.lit(note)))


def norm_python_key(value: str) -> str:
    """``norm_key`` for a name that the driver holds."""
    import re

    bare = "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))
    return re.sub("[^a-z0-9]+", "_", bare.strip().lower()).strip("_")


#: The combining marks of Latin letters, which a search for one range finds fast, and all of them.
_LATIN_MARKS = re.compile("[\u0300-\u034e\u0350-\u036f]+")
_MARKS = re.compile("[" + "".join(chr(c) for c in range(0x300, 0x1F000) if unicodedata.combining(chr(c))) + "]")


def norm_python(text: str) -> str:
    """``norm_search`` for text that Python holds."""
    if not text.isascii():
        text = _LATIN_MARKS.sub("", unicodedata.normalize("NFKD", text))
        if not text.isascii() and max(text) > "\u036f":
            text = _MARKS.sub("", text)
    return " ".join(text.lower().split())
