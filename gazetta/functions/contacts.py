"""Text to contact records: one pass over a text's lines and blocks, in Arrow batches.

A text is read in three ways, in this order: units that present who leads them, role
lines with the profile below them, and blocks of text that hold contacts. Rules for names
are in ``names``, words in ``lexicon``; both are compiled once a worker. ASCII texts without an
address, a number or a word of a role can't have a record and never leave the JVM; others are told so before they are read.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field, replace

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.functions.extract import EMAIL, GLUED, NOISE, PHONE, ROLES
from gazetta.functions.lexicon import AGENCY_NAMES, CONTACT_LINES, DATA_SECTIONS, EXECUTIVE, GENERAL, GENERIC_BOXES, PROFILE_STARTS, SUBUNITS, UNIT_TITLES, Lexicon, folded, is_agency, is_root_path, lexicon, out_of_place, path_scope, role_stems
from gazetta.functions.names import NAME, Names, full_lines, line_key, near_address, only_in_addresses
from gazetta.functions.text import norm_python
from gazetta.functions.urls import let
from gazetta.scratch import spread

WINDOW, NAME_REACH, LABEL_REACH, MOST_CONTACTS = 80, 4, 9, 4
NO_CONTACT, NO_ROLE = "Cargo ou nome identificado, mas sem contato direto no mesmo bloco.", "Contato geral sem associação clara a cargo específico."
_EMAIL, _PHONE = re.compile(rf"\b{EMAIL}\b"), re.compile(PHONE)
FIELDS = ["role", "name", "email", "phone", "mobile", "status", "notes"]
SCHEMA = ", ".join(f"{f} string" for f in FIELDS)


@dataclass(frozen=True)
class Record:
    role: str
    name: str = ""
    emails: tuple[str, ...] = ()
    phones: tuple[str, ...] = ()
    mobiles: tuple[str, ...] = ()

    def contacts(self) -> tuple[str, ...]:
        return (*self.emails, *self.phones, *self.mobiles)

    def strong(self) -> bool:
        return bool(self.name and self.contacts()) and self.role != GENERAL

    def keys(self) -> set[str]:
        """What tells contacts apart: addresses in lower case, digits of numbers."""
        return {e.lower() for e in self.emails} | {digits(p) for p in (*self.phones, *self.mobiles)}

    def without_contacts(self) -> Record:
        return replace(self, emails=(), phones=(), mobiles=())

    def row(self) -> tuple:
        general, some = self.role == GENERAL, bool(self.contacts())
        note = NO_ROLE if general else "" if some else NO_CONTACT
        return (self.role, self.name, "; ".join(self.emails), "; ".join(self.phones), "; ".join(self.mobiles), "Encontrado" if some and not general else "Parcial", note)


def digits(value: str) -> str:
    d = re.sub(r"\D", "", value)
    return d[2:] if d.startswith("55") and len(d) in (12, 13) else d


def is_mobile(value: str) -> bool:
    return re.fullmatch(r"(\d\d)?9\d{8}", digits(value)) is not None


def emails(text: str) -> list[str]:
    found = (re.sub(f"({'|'.join(GLUED)})$", "", m.lower()).strip(".,;:") for m in _EMAIL.findall(text))
    return list(dict.fromkeys(filter(None, found)))


def phones(text: str) -> list[str]:
    out = []
    for m in _PHONE.finditer(text):
        area, start, end = m.groups()
        years = len(start) == 4 and (start[:2] in ("19", "20") and end[:2] in ("19", "20") or end[:2] == "20" and 101 <= int(start) <= 3112)
        if area or not (years or re.fullmatch(r"\d{8}", m[0].strip())):
            out.append(m[0].strip())
    return list(dict.fromkeys(out))


def has_contact(text: str) -> bool:
    return bool(emails(text) or phones(text))


def with_contacts(record: Record, text: str) -> Record:
    found = phones(text)
    mobile = tuple(p for p in found if is_mobile(p))
    return replace(record, emails=tuple(emails(text)), mobiles=mobile, phones=tuple(p for p in found if p not in mobile))


def valid_name(name: str) -> bool:
    return Names(lexicon()).valid(name)


# --- what belongs to a role --------------------------------------------------------------


def _address_of(role: str, address: str) -> bool:
    """Whether an address can be one of the role's own."""
    vice, generic = "vice" in address, address.startswith(GENERIC_BOXES)
    if role == "Prefeito":
        return not vice and not generic
    if role == "Vice-prefeito":
        return vice or not (generic or "prefeito" in address or address.startswith("prefeitura"))
    return role != "Chefe de gabinete" or "gabinete" in address


def for_role(record: Record, text: str) -> Record:
    """Addresses and numbers that another role owns go; numbers go too where the addresses beside them were another's."""
    keep = tuple(e for e in record.emails if _address_of(record.role, e))
    gone = len(keep) < len(record.emails)
    if record.role in ("Prefeito", "Vice-prefeito") and gone and not keep or record.role == "Chefe de gabinete" and gone:
        return replace(record, emails=keep, phones=(), mobiles=())

    def others(number: str) -> bool:
        own = re.sub(r"\D", "", number)
        line = next((norm_python(x) for x in full_lines(text) if own in re.sub(r"\D", "", x)), "")
        return "gabinete" in line and "vice" not in line

    if record.role == "Vice-prefeito":
        return replace(record, emails=keep, phones=tuple(p for p in record.phones if not others(p)), mobiles=tuple(p for p in record.mobiles if not others(p)))
    return replace(record, emails=keep)


def capped(record: Record, url: str) -> Record:
    """Pages that list many contacts own none of them."""
    n, general = len(record.contacts()), record.role == GENERAL
    if not general and (record.role != "Prefeito" and is_root_path(url) and n > 1 or "prefeito-e-equipe-de-governo" in path_scope(url) and n > 2):
        return record.without_contacts()
    if record.role == "Prefeito" and len(record.phones) > 2:
        record = replace(record, phones=())
    return record.without_contacts() if n > MOST_CONTACTS and not general else record


def distinct(records: list[Record]) -> list[Record]:
    """Weak records go where a strong one has their role; equal ones stand once."""
    strong = {r.role for r in records if r.strong()}
    return list(dict.fromkeys(r for r in records if r.strong() or r.role not in strong))


def path_names(role: str, url: str) -> bool:
    """Whether a page's path is about the role itself."""
    path, wanted = path_scope(url).replace("-", " "), norm_python(role).replace("-", " ")
    return "prefeito" in path and "vice prefeito" not in path if role == "Prefeito" else wanted in path


def merged(records: list[Record], url: str = "") -> list[Record]:
    """Records of one role whose names agree or are absent are one; the first that takes a record decides.

    A record without a name joins one with a name only on a page about the role.
    """
    union = lambda a, b: tuple(dict.fromkeys((*a, *b)))
    out: list[Record] = []
    for r in records:
        fits = (i for i, o in enumerate(out) if o.role == r.role and (r.name == o.name or not o.name or not r.name and path_names(r.role, url)))
        i = next(fits, None)
        if i is None:
            out.append(r)
        else:
            o = out[i]
            out[i] = Record(o.role, o.name or r.name, union(o.emails, r.emails), union(o.phones, r.phones), union(o.mobiles, r.mobiles))
    return out


# --- lines -----------------------------------------------------------------------------


def opens_data(line: str) -> bool:
    return line_key(line).startswith(DATA_SECTIONS)


def opens_subunit(line: str) -> bool:
    return line_key(line).startswith(SUBUNITS)


def opens_noise(line: str) -> bool:
    return norm_python(line).startswith(tuple(NOISE))


def titles_unit(line: str) -> bool:
    return line_key(line).startswith(UNIT_TITLES)


def goes_on_with_contacts(line: str) -> bool:
    """A bare contact label, or one with a contact behind it."""
    low = norm_python(line)
    m = re.match(rf"(?:{'|'.join(sorted(CONTACT_LINES, key=len, reverse=True))})(?:\s*[:\-–—]\s*(.*))?$", low)
    return bool(m) and (not m[1] or has_contact(m[1]))


def without_noise(text: str | None) -> str:
    lines = re.split(r"\r\n?|\n", text or "")
    return "\n".join(lines[: next((i for i, x in enumerate(lines) if opens_noise(x)), len(lines))])


def profile_lines(text: str) -> list[str]:
    """Trimmed lines; a run of blank ones is one empty line."""
    lines = [x.strip() for x in re.split(r"\r\n?|\n", text)]
    kept = [x for x, before in zip(lines, ["", *lines], strict=False) if x or before]
    return kept[:-1] if kept and not kept[-1] else kept


def blocks(text: str) -> Iterator[str]:
    for part in re.split(r"\n{2,}", re.sub(r"\r\n?", "\n", text)):
        lines = full_lines(part)
        step = 8 if len(" ".join(lines)) > 1200 else max(1, len(lines))
        yield from ("\n".join(lines[i : i + step]) for i in range(0, len(lines), step))


class Extraction:
    """The three readings of a text, for one lexicon."""

    def __init__(self, lex: Lexicon):
        self.lex, self.names = lex, Names(lex)

    def _starts_profile(self, line: str) -> bool:
        key = line_key(line)
        return 0 < len(key) <= 140 and (self.names.role_start(line) is not None or key in ("gabinete", "prefeito", "prefeita", "vice prefeito", "vice-prefeito") or key.startswith(PROFILE_STARTS))

    def window_end(self, lines: list[str], start: int, name_at: int, name: str, role: str) -> int:
        """The line at which the profile of ``role``, begun at ``start``, is over."""
        end = min(len(lines), start + WINDOW)
        for i in range(name_at + 1, end):
            line = lines[i]
            if not line:
                following = next((x for x in lines[i + 1 :] if x), "")
                if goes_on_with_contacts(following):
                    continue
                before = next((self.names.role_start(x) for x in reversed(lines[:i]) if x), None)
                biography = bool(before) and before[0] == role and norm_python(name) in norm_python(following)
                if has_contact("\n".join(lines[start:i])) or not biography:
                    return i
                continue
            begun = self.names.role_start(line)
            if opens_data(line) or opens_subunit(line) or opens_noise(line) or (begun[0] if begun else None) != role and (begun or self._starts_profile(line)):
                return i
            if begun and i > start + 4 and has_contact("\n".join(lines[start:i])):
                return i
        return end

    def _name_below(self, lines: list[str], at: int, role: str) -> tuple[str, int]:
        """The name under a role line: one word a line, or behind a label, or a line of its own among the next few."""
        name, last = self.names.stacked(lines, at + 1)
        if name:
            return name, last
        for i in range(at + 1, min(len(lines), at + 1 + NAME_REACH)):
            if not lines[i]:
                continue
            begun = self.names.role_start(lines[i])
            if begun and begun[0] != role:
                break
            name, last = (self.names.within(begun[1]), i) if begun else self.names.after_responsible(lines, i)
            if not name and not begun:
                name, last = self.names.of_line(lines[i]), i
            if name:
                return name, last
        return "", at

    def profiles(self, text: str, url: str) -> list[Record]:
        """Records of role lines with their names and what stands in their windows."""
        lines, out = profile_lines(text), []
        for i, line in enumerate(lines):
            begun = self.names.role_start(line) if line else None
            if line and not begun and line_key(line) == "gabinete" and i + 1 < len(lines) and self.names.of_line(lines[i + 1]):
                begun = "Chefe de gabinete", ""
            if not begun:
                continue
            role, rest = begun
            name, name_at = self.names.within(rest), i
            if not name:
                name, name_at = self._name_below(lines, i, role)
            if name:
                span = "\n".join(x for x in lines[i : self.window_end(lines, i, name_at, name, role)] if x)
                record = capped(for_role(with_contacts(Record(role, name), span), span), url)
                if not out_of_place(role, url, bool(record.contacts())):
                    out.append(record)
        return distinct(out)

    def _unit_end(self, lines: list[str], start: int) -> int:
        for i in range(start + 1, min(len(lines), start + WINDOW)):
            low = norm_python(lines[i])
            if low == "secretarias" or low.startswith(("endereco", "ultimas noticias", "noticias relacionadas", "ver todas")) or titles_unit(lines[i]) or opens_subunit(lines[i]):
                return i
        return min(len(lines), start + WINDOW)

    def _of_unit(self, roles: list[str], name: str, span: str, url: str) -> Iterator[Record]:
        for role in roles:
            record = with_contacts(Record(role, name), span)
            record = capped(replace(record, phones=()) if record.mobiles else record, url)
            if not out_of_place(role, url, bool(record.contacts())):
                yield record

    def presentations(self, text: str, url: str) -> list[Record]:
        """Units that present who leads them: an invitation to get to know the person, the name, the role."""
        lines, out = full_lines(text), []
        for i, line in enumerate(lines):
            if not norm_python(line).startswith(("conheca o secretario", "conheca a secretaria")):
                continue
            name, at = next(((n, k) for k in range(i + 1, min(len(lines), i + 6)) if (n := self.names.of_line(lines[k]))), ("", i))
            if not name:
                continue
            roles = self.lex.roles(norm_python(lines[at + 1])) if at + 1 < len(lines) else []
            if not roles:
                above = [norm_python(x) for x in reversed(lines[max(0, i - 3) : i]) if "secretaria" in norm_python(x)]
                roles = list(dict.fromkeys(r for low in above for r in self.lex.roles(low)))
            out += self._of_unit(roles, name, "\n".join(lines[i : self._unit_end(lines, i)]), url)
        return distinct(out)

    def unit_list(self, text: str, url: str) -> list[Record]:
        """Lists of units: a title that names a role, and within a few lines a label with the person."""
        lines, out = full_lines(text), []
        areas = {"secretaria de desenvolvimento economico", "secretaria de desenvolvimento", "secretaria de financas/fazenda", "secretaria de planejamento"}
        for i, line in enumerate(lines):
            low = norm_python(line)
            roles = self.lex.roles(low)
            short = len(low) <= 90 and not re.search(r"[@\d.;]", line) and any(norm_python(r) in areas for r in roles)
            if not roles or not (titles_unit(line) or low.startswith("agencia") or short):
                continue
            name, at = "", i
            for k in range(i + 1, min(len(lines), i + 1 + LABEL_REACH)):
                label = norm_python(lines[k])
                if label.startswith(("secretario", "secretaria")):
                    name, at = self.names.after_secretary(lines, k)
                elif label.startswith(("responsavel", "titular", "autoridade administrativa")):
                    name, at = self.names.after_responsible(lines, k)
                if name:
                    break
            span = "\n".join(lines[i : self._unit_end(lines, at)])
            if name and not only_in_addresses(span, name) and not near_address(span, name):
                out += self._of_unit(roles, name, span, url)
        return distinct(out)

    # --- blocks ------------------------------------------------------------------------

    def names_executive(self, block: str, role: str) -> bool:
        """A line of the block begins with the role or with its office."""
        offices = {"Prefeito": ("gabinete do prefeito", "gabinete da prefeita"), "Vice-prefeito": ("gabinete do vice", "vice prefeito", "vice-prefeito"), "Chefe de gabinete": ("chefia de gabinete", "chefe de gabinete", "gabinete")}
        return any((self.names.role_start(x) or ("",))[0] == role or line_key(x).startswith(offices[role]) for x in full_lines(block))

    @staticmethod
    def contact_before_role(block: str, roles: list[str]) -> bool:
        """The first contact of the block stands before the first mention of a role."""
        terms = {"Prefeito": ("prefeito", "prefeita"), "Vice-prefeito": ("vice prefeito", "vice prefeita"), "Chefe de gabinete": ("chefe de gabinete",)}
        low = folded(block)
        at = [low.find(t) for r in roles for t in (norm_python(r).replace("-", " "), *terms.get(r, ())) if t in low]
        contacts = [m.start() for p in (_EMAIL, _PHONE) for m in p.finditer(block)]
        return bool(at and contacts) and min(contacts) < min(at)

    def headline(self, block: str, role: str) -> bool:
        """The block begins like a headline: the role, a name, and a sentence that goes on."""
        m = re.match(r"[\s-]+".join(map(re.escape, re.split(r"[\s-]+", norm_python(role)))) + r"\s+(?=\S)", folded(block.strip()))
        tail = block.strip()[m.end() :] if m else ""
        found = NAME.match(tail)
        return bool(found) and self.names.valid(found[1]) and not self.names.of_line(tail)

    def name_is_labelled(self, block: str, name: str) -> bool:
        """The name stands behind a role or a label on its line."""
        low = norm_python(name)
        return any(
            low in norm_python((self.names.role_start(x) or ("", ""))[1]) or low in norm_python(x) and re.search(r"\b(?:nome\s*[:\-]|secretari[oa](?:\s*\(a\))?\s*[:\-])", folded(x)) is not None
            for x in full_lines(block)
        )

    @staticmethod
    def from_name(block: str, name: str) -> str:
        """The block from the line of the name to the next section."""
        lines, low = full_lines(block), norm_python(name)
        start = next((i for i, x in enumerate(lines) if low in norm_python(x)), None)
        if start is None:
            return block
        end = next((i for i in range(start + 1, len(lines)) if opens_data(lines[i]) or opens_subunit(lines[i]) or opens_noise(lines[i])), len(lines))
        return "\n".join(lines[start:end])

    def block_records(self, block: str, url: str, found: list[Record]) -> list[Record]:
        """Records of a block, beside those that the profiles gave."""
        low, base = norm_python(block), with_contacts(Record(GENERAL), block)
        roles = self.lex.roles(low)
        if "Vice-prefeito" in roles and not any(re.match(r"prefeit[oa]\s*($|[:\-–—])", norm_python(x)) for x in full_lines(block)):
            roles = [r for r in roles if r != "Prefeito"]
        if len(base.emails) + len(base.phones) + len(base.mobiles) > 2:
            roles = []
        strong = [r for r in found if r.strong()]
        covers = lambda r: bool(base.keys()) and base.keys() <= r.keys()
        known = {r.role for r in strong if r.role in EXECUTIVE}
        repeats = any(covers(r) for r in strong if r.role in EXECUTIVE)
        named = bool(roles)
        roles = [r for r in roles if r not in EXECUTIVE or not (r in known or repeats)]
        name = self.names.near(block) if roles else ""
        if name and (only_in_addresses(block, name) or any(r not in EXECUTIVE for r in roles) and not self.name_is_labelled(block, name)):
            name = ""
        if not name and any(r in EXECUTIVE for r in roles):
            subordinate = "responsavel" in low and any(t in low for t in ("departamento", "superintendencia", "diretoria", "divisao", "chefia", "conselho", "unidade"))
            none = subordinate or self.contact_before_role(block, roles)
            if none:
                roles = [r for r in roles if r not in EXECUTIVE]
            else:
                roles = [r for r in roles if r not in EXECUTIVE or self.names_executive(block, r)]
                named = bool(roles)
        if name and not has_contact(self.from_name(block, name)):
            base = base.without_contacts()
        if strong and roles and not name:
            return []
        if roles:
            roles = [r for r in roles if r not in EXECUTIVE or name or not self.headline(block, r)]
            named = bool(roles)
        if not roles:
            if named or not base.contacts() or any(covers(r) for r in strong):
                return []
            roles = [GENERAL]
        return [r for r in (self._of_block(replace(base, role=role, name=name), block, url) for role in roles) if r] if name or base.contacts() else []

    def _of_block(self, record: Record, block: str, url: str) -> Record | None:
        record = capped(for_role(record, block), url)
        role = record.role
        if record.mobiles or role != GENERAL and not record.name and not record.emails:
            record = replace(record, phones=())
        if is_agency(role):
            if record.name and not any(t in norm_python(record.name) for t in AGENCY_NAMES):
                record = replace(record, name="")
            if not record.name:
                record = replace(record, phones=(), mobiles=())
                if not record.emails:
                    return None
        return None if out_of_place(role, url, bool(record.contacts())) else record

    def records(self, text: str | None, url: str | None = "") -> list[Record]:
        url, text = url or "", without_noise(text)
        named = self.lex.named(norm_python(text))
        units = distinct([*self.presentations(text, url), *self.unit_list(text, url)]) if named else []
        if units:
            return units
        out = found = self.profiles(text, url) if named else []
        for block in blocks(text):
            out = [*out, *self.block_records(block, url, found)]
        out = distinct(merged(out, url))
        path = re.sub(r"^[a-z]+://[^/?#]*", "", url.lower()).split("?")[0].split("#")[0].rstrip("/") + "/"
        if re.search("/(secretarias?|secretarias-especiais|contatos?|fale[-_]conosco)/", path):
            return [r for r in out if r.role == GENERAL]
        return out


@functools.lru_cache(maxsize=8)
def _extraction(lex: Lexicon) -> Extraction:
    return Extraction(lex)


def extraction(config: dict[str, list[str]] | None = None, words: Iterable[str] | None = None, phrases: Iterable[str] | None = None) -> Extraction:
    """The readings with the lexicon of a configuration, made once a worker."""
    return _extraction(lexicon(config, words, phrases))


def contacts_of_text(text: str | None, url: str | None = "", config: dict[str, list[str]] | None = None) -> list[tuple]:
    """All records of a text as rows of ``FIELDS``. No text, no records."""
    return [r.row() for r in extraction(config).records(text, url)]


def may_hold_records(text: Column, config: dict[str, list[str]] | None = None) -> Column:
    """Whether a text has a mark of a contact or may name a role: without either it has no record.

    Of ASCII texts that is told by substring searches in lower case. Texts with other characters may have to be folded, which workers do faster.
    """
    named = let(F.lower(text), lambda low: functools.reduce(Column.__or__, (low.contains(s) for s in role_stems(config or ROLES))))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return text.contains("@") | text.rlike(r"[0-9]{4}[\s.\-]?[0-9]{4}") | ~ascii_only | named


_NUMBER = re.compile(r"\d{4}[\s.\-]?\d{4}")


def extract_contacts(pages: DataFrame, keys: list[str], text_col: str = "text", url_col: str | None = None, config: dict[str, list[str]] | None = None, words: Iterable[str] | None = None, phrases: Iterable[str] | None = None) -> DataFrame:
    """One row per record of each text, in order (``pos``), with the key columns. Nulls have no records.

    ``config``: roles with the words that name them; ``words``, ``phrases``: what no name holds (``rules.name_rules`` reads both from a table).
    """
    schema = ", ".join(f"{k} {dict(pages.dtypes)[k]}" for k in keys) + ", pos int, " + SCHEMA
    words, phrases = None if words is None else frozenset(words), None if phrases is None else tuple(phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = extraction(config, words, phrases)
        for batch in batches:
            at, rows = [], []
            for i, (t, u) in enumerate(zip(batch.column("_text").to_pylist(), batch.column("_url").to_pylist(), strict=True)):
                if "@" in t or _NUMBER.search(t) or own.lex.may_name(t):
                    found = own.records(t, u)
                    at += [i] * len(found)
                    rows += [(pos, *r.row()) for pos, r in enumerate(found)]
            cols = [batch.column(k).take(pa.array(at, pa.int64())) for k in keys]
            parts = list(zip(*rows, strict=True)) if rows else [[] for _ in range(len(FIELDS) + 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(parts[0], pa.int32()), *(pa.array(p, pa.string()) for p in parts[1:])], [*keys, "pos", *FIELDS])

    text = F.col(text_col)
    base = spread(pages).where(may_hold_records(text, config)).select(*keys, text.alias("_text"), (F.col(url_col) if url_col else F.lit("")).alias("_url"))
    return base.mapInArrow(run, schema)


def role_mentions(pages: DataFrame, keys: list[str], text_col: str = "text", config: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per mention of a role: the key columns, ``start`` and ``size`` in the folded text with single spaces, ``role``; nulls have none.

    No mention is left out: ``of_others`` marks a chief of staff of anyone but the executive, which ``Lexicon.roles`` doesn't count.
    """
    schema = ", ".join(f"{k} {dict(pages.dtypes)[k]}" for k in keys) + ", start int, size int, role string, of_others boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = lexicon(config)
        for batch in batches:
            at, rows = [], []
            for i, t in enumerate(batch.column("_text").to_pylist()):
                for start, end, role, of_others in lex.phrases_of_roles(norm_python(t)) if lex.may_name(t) else ():
                    at.append(i)
                    rows.append((start, end - start, role, of_others))
            cols = [batch.column(k).take(pa.array(at, pa.int64())) for k in keys]
            start, size, role, of_others = zip(*rows, strict=True) if rows else ((), (), (), ())
            found = [pa.array(start, pa.int32()), pa.array(size, pa.int32()), pa.array(role, pa.string()), pa.array(of_others, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*cols, *found], [*keys, "start", "size", "role", "of_others"])

    text = F.col(text_col)
    named = let(F.lower(text), lambda low: functools.reduce(Column.__or__, (low.contains(s) for s in role_stems(config or ROLES))))
    some = named | (F.octet_length(text) != F.char_length(text))
    return pages.where(some).select(*keys, text.alias("_text")).mapInArrow(run, schema)


def register(spark: SparkSession, config: dict[str, list[str]] | None = None) -> None:
    """The extraction for SQL, by Arrow batches: the table function ``extract_contacts(text, url)`` and scalar helpers."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="pos int, " + SCHEMA, useArrow=True)
    class ExtractContacts:
        def eval(self, text: str, url: str):
            yield from ((pos, *row) for pos, row in enumerate(contacts_of_text(text, url, config)))

    def scalar(name: str, kind: str, of: Callable[[str], object]) -> None:
        def column(values: pd.Series) -> pd.Series:
            return values.map(lambda v: of(v or ""))

        spark.udf.register(name, F.pandas_udf(column, kind))

    spark.udtf.register("extract_contacts", ExtractContacts)
    scalar("extract_emails", "array<string>", emails)
    scalar("extract_phones", "array<string>", phones)
    scalar("detect_roles", "array<string>", lambda text: lexicon(config).roles(norm_python(text)))
    scalar("nearest_name", "string", lambda text: extraction(config).names.near(text))
    scalar("valid_name", "boolean", lambda name: Names(lexicon(config)).valid(name))
