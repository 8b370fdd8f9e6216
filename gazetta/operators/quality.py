"""Audits, roll-ups, samples and verification of contact records."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.functions import names
from gazetta.functions.contacts import digits as phone_digits
from gazetta.functions.lexicon import lexicon
from gazetta.functions.text import STATUSES, blank, norm_python, norm_search, split_list
from gazetta.functions.urls import has_any
from gazetta.operators.records import IDENTITY, labels
from gazetta.operators.scope import scope_filter

# States that need a note, and states that count as without data.
NOTED = [s for s in STATUSES if s != "Encontrado"]
WITHOUT_DATA = ["Não encontrado", "Não publicado", "Página sem informação pública"]


def issues(df: DataFrame, rules: dict[str, Column], keys: Sequence[str]) -> DataFrame:
    """One row for each rule that a row breaks, in one pass."""
    broken = F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules.items())))
    return df.select(*keys, F.explode(broken).alias("issue"))


def row_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return issues(
        df,
        {
            "status": ~F.coalesce(F.col("status").isin(STATUSES), F.lit(False)),
            "source": F.col("status").isin("Encontrado", "Parcial") & blank(F.col("source_url")),
            "date": blank(F.col("collected_on")),
            "note": F.col("status").isin(NOTED) & blank(F.col("notes")),
        },
        keys,
    )


def scope_audit(expected: DataFrame, processed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected targets that are missing, and processed ones that nobody expected."""
    a, b = expected.select(*keys).distinct(), processed.select(*keys).distinct()
    return a.join(b, list(keys), "left_anti").withColumn("issue", F.lit("missing")).unionByName(b.join(a, list(keys), "left_anti").withColumn("issue", F.lit("unexpected")))


def rollups(df: DataFrame, sets: Sequence[Sequence[str]], names: Sequence[str]) -> DataFrame:
    """Counts of rows for several groupings in one aggregation; null stands for a column not grouped by."""
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *(F.col(n) for n in names)).agg(F.grouping_id().alias("grouping"), F.count(F.lit(1)).alias("n"))


#: Sections of the summary over targets and over rows, by what they group by beside the state.
TARGET_SECTIONS = {"Por UF": ["state"], "Por Município/Capital": ["state", "target", "sphere"], "Por Esfera": ["sphere"]}
ROW_SECTIONS = {"Por Cargo/Área": ["role"], "Por Status": []}
INDICATORS = "Indicadores gerais"


def _sections(df: DataFrame, status: str, sections: dict[str, list[str]], columns: Sequence[str]) -> DataFrame:
    """Counts by each section's columns and the status in one aggregation; a table without rows gives one row a section that says so."""
    base = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns), F.coalesce(F.col(status).cast("string"), F.lit("")).alias("status"))
    sets = [[*(F.col(c) for c in by), F.col("status")] for by in sections.values()]
    names = [*columns, "status"]
    grouped = base.groupingSets(sets, *(F.col(c) for c in names)).agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"))
    section = F.when(F.lit(False), "")
    for name, by in sections.items():
        gid = sum(1 << (len(names) - 1 - k) for k, c in enumerate(names) if c not in (*by, "status"))
        section = section.when(F.col("gid") == gid, name)
    full = grouped.select(section.alias("section"), *names, "n")
    none = df.sparkSession.createDataFrame([(name,) for name in sections], "section string").join(full.limit(1).select(F.lit(1).alias("some")), F.lit(True), "left").where("some IS NULL")
    return full.unionByName(none.select("section", F.lit("Sem dados").alias("indicator"), F.lit("0").alias("value")), allowMissingColumns=True)


def indicators(data: DataFrame, targets: DataFrame, pending: DataFrame, at: str) -> DataFrame:
    """The general figures of a run: one row each. ``targets``: status; ``data`` and ``pending``: status, and places in ``data``."""
    place = F.struct("state", "municipality")
    found = data.where(F.col("role") != IDENTITY).agg(
        F.countDistinct(F.when(F.col("status") == "Encontrado", place)).alias("found"), F.countDistinct(F.when(F.col("status") == "Parcial", place)).alias("partial")
    )
    states = {"no_site": "Site não localizado", "down": "Site fora do ar", "blocked": "Bloqueio técnico"}
    count = lambda s: F.count_if(F.coalesce(F.col("status") == s, F.lit(False)))
    t = targets.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.coalesce(F.col("status").isin(WITHOUT_DATA), F.lit(False))).alias("without"), *(count(s).alias(f"t_{k}") for k, s in states.items()))
    p = pending.agg(*(count(s).alias(f"p_{k}") for k, s in states.items()))
    one = found.join(t).join(p)  # three rows of one
    shown = [
        ("Total de municípios no escopo", F.col("total")),
        ("Total de municípios com algum dado encontrado", F.col("found")),
        ("Total de municípios com dados parciais", F.col("partial")),
        ("Total de municípios sem dados encontrados", F.col("without")),
        ("Total de sites não localizados", or_else(F.col("t_no_site"), F.col("p_no_site"))),
        ("Total de sites fora do ar", or_else(F.col("t_down"), F.col("p_down"))),
        ("Total de bloqueios técnicos", or_else(F.col("t_blocked"), F.col("p_blocked"))),
        ("Data/hora da execução", F.lit(at)),
    ]
    rows = F.array(*(F.struct(F.lit(INDICATORS).alias("section"), F.lit(k).alias("indicator"), v.cast("string").alias("value")) for k, v in shown))
    return one.select(F.inline(rows))


def summary(data: DataFrame, targets: DataFrame, pending: DataFrame, at: str) -> DataFrame:
    """Section, indicator, value, state, target, sphere, role, status, n: the figures and the grouped counts."""
    parts = [indicators(data, targets, pending, at), _sections(targets, "status", TARGET_SECTIONS, ["state", "target", "sphere"]), _sections(data, "status", ROW_SECTIONS, ["role"])]
    out = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return out.select("section", "indicator", "value", "state", "target", "sphere", "role", "status", "n")


def or_else(a: Column, b: Column) -> Column:
    """The first number unless it is 0."""
    return F.coalesce(F.nullif(a, F.lit(0)), b)


#: Hexadecimal digits of a draw by which rows are counted: 4,096 bins a stratum.
DRAW_DIGITS = 3


def stratified_sample(df: DataFrame, stratum: str, key: Column, per_stratum: int) -> DataFrame:
    """The same rows for the same keys: the first of each stratum by a hash of the key; rows of one key count one by one.

    A stratum's draws are counted by their first bits, a row a task and bin, and only rows up to the bin in which the last one wanted
    lies are ranked: about ``per_stratum`` of them, however many rows the stratum has.
    """
    if not per_stratum:
        return df
    draw = F.md5(key.cast("string").cast("binary"))
    drawn = df.withColumns({"_draw": draw, "_bin": F.substring(draw, 1, DRAW_DIGITS)})
    bins = drawn.groupBy(F.col(stratum).alias("_stratum"), "_bin").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("_stratum").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = bins.withColumn("_before", before).where(F.col("_before") < per_stratum).groupBy("_stratum").agg(F.max("_bin").alias("_last"))
    near = drawn.join(last, F.col(stratum).eqNullSafe(F.col("_stratum"))).where(F.col("_bin") <= F.col("_last"))
    nth = F.row_number().over(Window.partitionBy(stratum).orderBy("_draw", key))
    return near.withColumn("_nth", nth).where(F.col("_nth") <= per_stratum).select(df.columns)


def chunks(df: DataFrame, within: Sequence[str], order: Sequence[str], size: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
    return df.withColumn("chunk", F.floor((nth - 1) / size) + 1)


def verify(records: DataFrame, pages: DataFrame, values: Sequence[str], digits: Sequence[str] = ()) -> DataFrame:
    """Check the values of records against the text of their source.

    ``pages``: url, text, status. Adds ``checked`` (values looked at), ``absent`` (names of
    values that the text lacks) and ``verdict``.
    """
    usable = pages.where(F.col("status").isin("Encontrado", "Parcial") & ~blank(F.col("text"))).groupBy("url").agg(F.min("text").alias("text"))
    joined = records.join(usable, records["source_url"] == usable["url"], "left")
    seen, numbers = norm_search(F.col("text")), F.regexp_replace("text", r"\D", "")

    def missing(c: str) -> Column:
        held = numbers.contains(F.regexp_replace(F.col(c), r"\D", "")) if c in digits else seen.contains(norm_search(F.col(c)))
        return F.when(~blank(F.col(c)) & ~held, F.lit(c))

    count = sum(((~blank(F.col(c))).cast("int") for c in values), F.lit(0))
    absent = F.array_compact(F.array(*(missing(c) for c in values)))
    verdict = F.when(blank(F.col("source_url")), "Divergente").when(F.col("text").isNull(), "Não validado").when(F.size("absent") > 0, "Divergente").otherwise("Validado")
    return joined.withColumn("checked", count).withColumn("absent", absent).withColumn("verdict", verdict).drop("url", "text")


def near_lines(lines: DataFrame, value: Column, term: Column, reach: int = 12) -> DataFrame:
    """Lines with a value that have a line with a term at most ``reach`` lines away in the same document.

    ``lines``: doc, pos, line. A window of marks instead of a self-join: linear in the lines.
    """
    around = Window.partitionBy("doc").orderBy("pos").rangeBetween(-reach, reach)
    near = F.max(F.coalesce(term, F.lit(False)).cast("int")).over(around)
    return lines.withColumn("_near", near).withColumn("_value", F.coalesce(value, F.lit(False))).where("_value AND _near = 1").drop("_near", "_value")


# --- audits of a delivery ----------------------------------------------------------------

ISSUE = ["kind", "severity", "description", "state", "target", "category", "line"]


def _issue(df: DataFrame, kind: str, description: Column, category: Column | None = None, line: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(kind).alias("kind"),
        F.lit("Erro").alias("severity"),
        description.alias("description"),
        "state",
        "target",
        (category if category is not None else F.lit("")).alias("category"),
        (line if line is not None else F.lit(None)).cast("long").alias("line"),
    )


def numbered(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Rows with the line that they have in a sheet with a header, counted in ranges, so that no task holds all of them."""
    from gazetta.scratch import materialise

    ranged = materialise(df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a partition
    return ranged.withColumn("_nth", nth).join(sizes.select("_part", before.alias("_before")), "_part").withColumn("line", F.col("_nth") + F.col("_before") + 1).drop("_part", "_nth", "_before")


def line_issues(data: DataFrame) -> DataFrame:
    """What rows of results break: state, source, date, note. ``data`` has ``line``."""
    rules = {
        "Status": (~F.coalesce(F.col("status").isin(STATUSES), F.lit(False)), "Status inválido ou ausente"),
        "Fonte": (blank(F.col("source_url")) & blank(F.col("page_url")), "Linha sem URL de fonte."),
        "Data": (blank(F.col("collected_on")), "Linha sem data de coleta."),
        "Observação": (F.col("status").isin(NOTED) & blank(F.col("notes")), "Status de ausência/parcial sem observação."),
    }
    broken = F.array_compact(F.array(*(F.when(bad, F.struct(F.lit(kind).alias("kind"), F.lit(text).alias("text"))) for kind, (bad, text) in rules.items())))
    out = data.withColumn("_b", F.explode(broken))
    return out.select(F.col("_b.kind").alias("kind"), F.lit("Erro").alias("severity"), F.col("_b.text").alias("description"), "state", "target", F.col("role").alias("category"), F.col("line").cast("long").alias("line"))


def coverage_issues(data: DataFrame, targets: DataFrame) -> DataFrame:
    """Municipal targets and the categories, the identification among them, that the results lack."""
    wanted = targets.where(F.coalesce("sphere", F.lit("Municipal")) == "Municipal").select("state", "target", "sphere", F.explode(F.array(*(F.lit(c) for c in labels()))).alias("role"))
    lacking = wanted.distinct().join(data.select("state", "target", "sphere", "role").distinct(), ["state", "target", "sphere", "role"], "left_anti")
    return _issue(lacking, "Cobertura", F.concat(F.lit("Categoria obrigatória ausente na aba Dados: "), "role", F.lit(".")), F.col("role"))


def scope_issues(sources: dict[str, DataFrame], expected: DataFrame, state_expected: DataFrame | None = None) -> DataFrame:
    """Expected targets that a source lacks and targets of the states that nobody configured, for every source.

    Without ``state_expected`` any target that isn't municipal is out of scope. All tables are read once and meet in one shuffle: a target
    has a bit for each of them that holds it, and the issues of all sources are read off the bits.
    """
    key = ["state", "target", "sphere"]
    wanted, configured, first = 1, 2, 4
    marked = [(wanted, expected), *([(configured, state_expected)] if state_expected is not None else []), *((first << i, df) for i, df in enumerate(sources.values()))]
    bits = None
    for bit, df in marked:
        own = df.select(F.upper("state").alias("state"), "target", F.coalesce("sphere", F.lit("Municipal")).alias("sphere"), F.lit(bit).cast("long").alias("bit"))
        bits = own if bits is None else bits.unionByName(own)
    held = bits.groupBy(*key).agg(F.bit_or("bit").alias("bits"))
    has = lambda bit: F.col("bits").bitwiseAND(F.lit(bit)) != 0
    other = F.col("sphere") != "Municipal"
    said = []
    for i, name in enumerate(sources):
        here = has(first << i)
        said.append(F.when(has(wanted) & ~here, F.lit(f"Município/capital esperado ausente em {name}.")))
        if state_expected is None:
            said.append(F.when(here & other, F.concat(F.lit(f"Alvo fora do escopo municipal em {name}: Esfera="), "sphere", F.lit("."))))
        else:
            said.append(F.when(here & other & ~has(configured), F.concat(F.lit(f"Alvo estadual não configurado em {name}: "), "target", F.lit("."))))
            said.append(F.when(has(configured) & ~(here & other), F.lit(f"Alvo estadual configurado ausente em {name}.")))
    return _issue(held.select(*key, F.explode(F.array_compact(F.array(*said))).alias("said")), "Escopo", F.col("said"))


def expected_municipal(places: DataFrame, rules: DataFrame) -> DataFrame:
    """The targets that a list of places gives under the rules of the scope."""
    kept = scope_filter(places, rules)
    return kept.select("state", F.col("name").alias("target"), F.col("name").alias("municipality"), F.lit("Municipal").alias("sphere")).distinct()


def expected_state(config: DataFrame) -> DataFrame:
    """The governments with a site and their organs with a name and a site. ``config`` as in ``scope.state_targets``."""
    own = config.where(~blank(F.col("site")))
    name = F.when(blank(F.col("government")), F.concat(F.lit("Governo Estadual "), "state")).otherwise(F.col("government"))
    organs = own.select("state", F.inline("organs")).where(~blank(F.col("name")) & ~blank(F.col("site"))).select("state", "name", "site")
    out = own.select("state", name.alias("name"), "site").unionByName(organs)
    return out.select(F.upper("state").alias("state"), F.col("name").alias("target"), F.col("name").alias("municipality"), F.lit("Estadual").alias("sphere"), "site")


REQUIRED_TABLES = ("data", "consolidated", "targets", "pending", "summary", "sources", "configuration")


def audit(tables: dict[str, DataFrame], order: Sequence[Column | str], expected: DataFrame | None = None, state_expected: DataFrame | None = None) -> DataFrame:
    """The full audit of a delivery: missing tables, lines, coverage and, with ``expected``, scope."""
    spark = next(iter(tables.values())).sparkSession
    missing = spark.createDataFrame([(name,) for name in REQUIRED_TABLES if name not in tables], "name string").select(F.lit("").alias("state"), F.lit("").alias("target"), "name")
    out = _issue(missing, "Aba", F.concat(F.lit("Aba ausente: "), "name"))
    if "data" in tables:
        out = out.unionByName(line_issues(numbered(tables["data"], order)))
        if "targets" in tables:
            out = out.unionByName(coverage_issues(tables["data"], tables["targets"]))
    if expected is not None:
        out = out.unionByName(scope_issues({n: tables[n] for n in ("targets", "data") if n in tables}, expected, state_expected))
    return out.select(*ISSUE)


# --- verification ------------------------------------------------------------------------

#: The fields that a source is held against, and how many lines around a value count as its place.
CHECKED, REACH, TOGETHER = ["email", "phone", "mobile"], 12, 8


def verification_sample(data: DataFrame, most: int, seed: int = 42, order: Column | str = "ordinal", statuses: Sequence[str] = ("Encontrado", "Parcial")) -> DataFrame:
    """The rows to verify: those that claim something and have a field to check, the first of each state before all, then by a seeded hash, up to ``most`` (0: all).

    ``order`` tells the rows of a state apart; rows that share the least of it are all first.
    """
    some = F.exists(F.array(*CHECKED, "name"), lambda x: ~blank(x))
    eligible = data.where(F.col("status").isin(*statuses) & (F.col("role") != IDENTITY) & some)
    if not most:
        return eligible
    # The first of each state by a partial aggregate, the rest by the least of their draws in each task: no state's rows come together.
    place = F.col(order) if isinstance(order, str) else order
    first = eligible.groupBy("state").agg(F.min(place).alias("_least"))
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), "state", "target").cast("binary"))
    begun = eligible.join(first, eligible["state"].eqNullSafe(first["state"])).drop(first["state"]).withColumn("_first", place.eqNullSafe(F.col("_least")))
    return begun.orderBy(F.desc("_first"), F.when(~F.col("_first"), draw), "state", order).limit(most).drop("_first", "_least")


def category_terms(role: Column, unit: Column) -> Column:
    """The words that stand near what belongs to a category."""
    low = norm_search(F.concat_ws(" ", role, unit))
    vice, economic = low.contains("vice"), low.contains("desenvolvimento economico")
    groups = [
        (vice, ["vice prefeito", "vice prefeita", "vice-prefeito", "vice-prefeita"]),
        (~vice & has_any(low, ["prefeito", "prefeita"]), ["prefeito", "prefeita", "gabinete"]),
        (low.contains("chefe de gabinete"), ["chefe de gabinete", "gabinete"]),
        (economic, ["desenvolvimento", "industria", "comercio"]),
        (~economic & low.contains("desenvolvimento"), ["desenvolvimento"]),
        (has_any(low, ["financas", "fazenda"]), ["financas", "fazenda"]),
        (low.contains("planejamento"), ["planejamento"]),
        (has_any(low, ["agencia", "sala"]), ["agencia de desenvolvimento", "sala do empreendedor", "casa do empreendedor", "banco do povo"]),
    ]
    none = F.array().cast("array<string>")
    listed = F.flatten(F.array(*(F.when(holds, F.array(*map(F.lit, words))).otherwise(none) for holds, words in groups), F.array(norm_search(role), norm_search(unit))))
    return F.array_distinct(F.filter(listed, lambda t: t != ""))


def associated(text: str, value: str, name: str, terms: list[str]) -> bool:
    """Whether a value stands near a term: within ``REACH`` lines, or near the person's name that does, or on some lines taken together that do."""
    low = norm_python(value)
    if not low or not terms:
        return True
    lines = [norm_python(x) for x in re.split(r"\r\n?|\n", text) if x.strip()]
    numbers = {n for n in (re.sub(r"\D", "", value), phone_digits(value)) if n}
    termed = [any(t in x for t in terms) for x in lines]

    def near(lo: int, hi: int) -> bool:
        # A term may also stand across line ends.
        return any(termed[max(0, lo - REACH) : hi + REACH + 1]) or any(t in " ".join(lines[max(0, lo - REACH) : hi + REACH + 1]) for t in terms)

    holders = [i for i, x in enumerate(lines) if low in x or any(n in re.sub(r"\D", "", x) for n in numbers)]
    person = norm_python(name)
    named = [i for i, x in enumerate(lines) if person and person != low and person in x]
    for i in holders:
        beside = person and person != low and person in " ".join(lines[max(0, i - REACH) : i + REACH + 1])
        if near(i, i) or beside and any(near(k, k) for k in named):
            return True
    if low in " ".join(lines):
        for i in range(len(lines)):
            end = next((k for k in range(i, min(len(lines), i + TOGETHER)) if low in " ".join(lines[i : k + 1])), None)
            if end is not None and near(i, end):
                return True
    return False


def verify_records(data: DataFrame, pages: DataFrame) -> DataFrame:
    """Hold rows of results against the text of their sources.

    ``pages``: url, text, status; of several recordings of a source one counts, the usable before others, the least text among equals. Adds ``checked`` (number of
    values looked at), ``differences`` (what is absent, no person, or not near its category) and ``verdict``: Divergente without
    a source or with differences, Não validado where the source can't be read, else Validado. Rows of states are held to presence only.
    """
    usable = F.col("status").isin("Encontrado", "Parcial") & ~blank(F.col("text"))
    sources = pages.groupBy("url").agg(F.min(F.struct((~usable).alias("bad"), "text", "status")).alias("s"))
    sources = sources.select("url", F.when(~F.col("s.bad"), F.col("s.text")).alias("_text"))
    url = F.coalesce(F.nullif(F.trim("source_url"), F.lit("")), F.trim("page_url"))
    person = ~norm_search(F.col("role")).isin("municipio/capital e uf", "agencias municipais de desenvolvimento") & ~blank(F.col("name"))
    near = F.lower(F.trim(F.coalesce("sphere", F.lit("Municipal")))) != "estadual"

    def listed(c: str) -> Column:
        return F.transform(split_list(F.col(c)), lambda v: F.struct(F.lit(c).alias("field"), v.alias("value")))

    values = F.flatten(F.array(*map(listed, CHECKED)))
    joined = data.withColumns({"_url": url, "_terms": category_terms(F.col("role"), F.col("unit")), "_values": values, "_person": person, "_near": near})
    joined = joined.join(sources, F.col("_url") == F.col("url"), "left").drop("url")

    @F.pandas_udf("array<string>")
    def differences(text: pd.Series, name: pd.Series, fields: pd.Series, given: pd.Series, terms: pd.Series, is_person: pd.Series, held: pd.Series) -> pd.Series:
        out = []
        for t, n, fs, vs, ts, p, h in zip(text, name, fields, given, terms, is_person, held, strict=True):
            out.append(None if t is None else list(_differences(t, n or "", list(zip(fs, vs, strict=True)), list(ts), bool(p), bool(h))))
        return pd.Series(out)

    found = differences(F.col("_text"), F.col("name"), F.col("_values.field"), F.col("_values.value"), F.col("_terms"), F.col("_person"), F.col("_near"))
    out = joined.withColumn("differences", found).withColumn("checked", F.size("_values"))
    verdict = F.when(blank(F.col("_url")), "Divergente").when(F.col("_text").isNull(), "Não validado").when(F.size("differences") > 0, "Divergente").otherwise("Validado")
    return out.withColumn("verdict", verdict).drop("_url", "_terms", "_values", "_person", "_near", "_text")


def _differences(text: str, name: str, values: list[tuple[str, str]], terms: list[str], person: bool, held: bool) -> Iterator[str]:
    if person:
        if not names.Names(lexicon()).valid(name):
            yield f"Nome não parece pessoa publicada: {name}"
        elif names.only_in_addresses(text, name):
            yield f"Nome aparece apenas em linha de endereço: {name}"
        elif names.only_credited(text, name):
            yield f"Nome aparece apenas em linha de crédito: {name}"
        elif held and not associated(text, name, name, terms):
            yield f"Nome sem associação com a categoria: {name}"
    digits = re.sub(r"\D", "", text)
    for column, value in values:
        numbers = [n for n in (re.sub(r"\D", "", value), phone_digits(value)) if n]
        there = value.lower() in text.lower() if column == "email" else any(n in digits for n in numbers)
        if not there:
            yield f"{column} não localizado na fonte: {value}"
        elif held and not associated(text, value, name, terms):
            yield f"{column} sem associação com a categoria: {value}"
