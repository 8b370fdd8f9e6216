"""Contact records: categories, ranking, coverage, normalisation, deduplication, merging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.functions.names import valid_name
from gazetta.functions.text import add_note, blank, norm_emails, norm_phones, norm_role, norm_search, norm_status, title_name, unit_of_role
from gazetta.functions.urls import clean_url, has_any, reference_url
from gazetta.operators.scope import names_a_place
from gazetta.scratch import materialise

# The categories that every municipality needs, each with its unit.
IDENTITY = "Município/Capital e UF"
CATEGORIES = {
    "Prefeito": "Gabinete/Prefeitura",
    "Vice-prefeito": "Gabinete/Prefeitura",
    "Chefe de gabinete": "Gabinete/Prefeitura",
    "Desenvolvimento econômico": "Secretaria de Desenvolvimento Econômico",
    "Desenvolvimento": "Secretaria de Desenvolvimento",
    "Finanças/Fazenda": "Secretaria de Finanças/Fazenda",
    "Planejamento": "Secretaria de Planejamento",
    "Agências municipais de desenvolvimento": "Agência municipal de desenvolvimento",
}
CONTACT = ["email", "phone", "mobile"]
IDENTITY_KEY = ["state", "target", "sphere", "role", "name", "email", "phone", "mobile", "source_url"]


TERRITORY_URL = "https://servicodados.ibge.gov.br/api/v1/localidades/municipios"
IDENTITY_NOTE = "Localidade e UF carregadas da base territorial do escopo."


def category(*fields: Column) -> Column:
    """The category that a record's role, unit and addresses speak of; the first rule that holds, else empty."""
    text = norm_search(F.concat_ws(" ", *fields))
    plain = F.translate(text, "-", " ")
    agency = (text.contains("agencia") & text.contains("desenvolvimento")) | has_any(text, ["sala do empreendedor", "casa do empreendedor", "banco do povo"])
    economic = plain.contains("desenvolvimento economico") | (plain.contains("desenvolvimento") & has_any(plain, ["industria", "comercio", "servicos", "trabalho", "empreendedorismo"]))
    return (
        F.when(text.contains("municipio/capital") | plain.contains("municipio capital"), IDENTITY)
        .when(plain.rlike("vice prefeit[oa]"), "Vice-prefeito")
        .when(plain.rlike("chef[ea] de gabinete"), "Chefe de gabinete")
        .when(economic, "Desenvolvimento econômico")
        .when(agency, "Agências municipais de desenvolvimento")
        .when(has_any(text, ["financas", "fazenda"]), "Finanças/Fazenda")
        .when(text.contains("planejamento"), "Planejamento")
        .when(plain.contains("secretaria de desenvolvimento") | (text == "desenvolvimento"), "Desenvolvimento")
        .when(text.rlike("prefeit[oa]"), "Prefeito")
        .otherwise("")
    )


def score(status: Column, contacts: Column, name: Column, url: Column) -> list[Column]:
    """What candidates of a category are ordered by, all descending."""
    low = F.lower(F.coalesce(url, F.lit("")))
    source = (
        F.when(has_any(low, ["equipe_governo", "equipe-governo", "equipe-de-governo"]), 3).otherwise(0)
        + F.when(has_any(low, ["estrutura", "gabinete", "secretaria"]), 1).otherwise(0)
        - F.when(has_any(low, ["default.aspx", "consulta_publica", "fundosocial"]), 2).otherwise(0)
    )
    state = F.when(status == "Encontrado", 4).when(status == "Parcial", 2).otherwise(0)
    return [state, (~blank(contacts)).cast("int"), (~blank(name)).cast("int"), source, low]


def rank_candidates(df: DataFrame, within: Sequence[str], keys: Sequence[Column], ordinal: str) -> DataFrame:
    """Rank from 1 within a group by descending keys, earlier rows first among equals."""
    order = [k.desc() for k in keys] + [F.col(ordinal).asc()]
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*within).orderBy(*order)))


def coverage(targets: DataFrame, present: DataFrame, required: DataFrame, keys: Sequence[str], category_col: str = "category") -> DataFrame:
    """Required (target, category) pairs that ``present`` lacks. ``required`` is a small dimension."""
    # Each target meets every category of the dimension: the pairs are what is asked for. Spark broadcasts the dimension while its size allows.
    wanted = targets.select(*keys).distinct().crossJoin(required.select(category_col))
    return wanted.join(present.select(*keys, category_col), [*keys, category_col], "left_anti")


def fill_coverage(records: DataFrame, targets: DataFrame, required: DataFrame, keys: Sequence[str], status: str, note: str) -> DataFrame:
    """Records with one filler row for every required category that a target lacks."""
    filler = coverage(targets, records, required, keys).withColumns({"status": F.lit(status), "notes": F.lit(note)})
    return records.unionByName(filler, allowMissingColumns=True)


def labels() -> dict[str, str]:
    """All categories in their order, the identification first, with the unit of each."""
    return {IDENTITY: "Município/Capital", **CATEGORIES}


def with_category(records: DataFrame) -> DataFrame:
    """Records with their category as role and what follows from it.

    Records: role, unit, source_url, page_url, site, sphere, categories (of the target). A record that no rule knows
    takes the category of its target where that isn't municipal and has only one. Sources fall back to the page and to the target's reference.
    """
    found = category(F.col("role"), F.col("unit"), F.col("source_url"), F.col("page_url"))
    only = F.when((F.coalesce("sphere", F.lit("Municipal")) != "Municipal") & (F.size("categories") == 1), F.col("categories")[0])
    out = records.withColumn("category", F.when(found != "", found).otherwise(F.coalesce(only, F.lit(""))))
    unit = F.create_map(*(F.lit(x) for pair in labels().items() for x in pair))[F.col("category")]
    source = clean_url(F.col("source_url"))
    out = out.withColumn("source_url", F.when(source != "", source).otherwise(reference_url(F.col("site"), TERRITORY_URL)))
    page = clean_url(F.col("page_url"))
    return out.withColumns(
        {
            "page_url": F.when(page != "", page).otherwise(F.col("source_url")),
            "role_title": F.when(blank(F.col("role")), F.col("category")).otherwise(F.col("role")),
            "unit": F.when(blank(F.col("unit")), F.coalesce(unit, F.lit(""))).otherwise(F.col("unit")),
            "role": F.when(F.col("category") != "", F.col("category")).otherwise(F.col("role")),
        }
    )


TARGET_KEY = ["state", "target", "sphere"]
TARGET_COLUMNS = ["state", "state_name", "target", "municipality", "population", "reason", "sphere", "site"]
#: The columns of the table of results.
DATA_COLUMNS = [*TARGET_COLUMNS, "unit", "role", "role_title", "name", "email", "phone", "mobile", "source_url", "page_url", "collected_on", "status", "notes"]


def required_categories(targets: DataFrame) -> DataFrame:
    """The categories that each target is to have: all of them for a municipality, its own for a state's government and organs."""
    every = F.array(*(F.lit(c) for c in CATEGORIES))
    wanted = F.when(F.col("sphere") == "Municipal", every).otherwise(F.coalesce("categories", F.array().cast("array<string>")))
    return targets.select(*TARGET_KEY, F.explode(wanted).alias("category"))


def cover(targets: DataFrame, contacts: DataFrame, collected_on: str) -> DataFrame:
    """The rows of each target: who it is, per category the candidates by rank, and a filler where a required category has none.

    ``targets``: TARGET_COLUMNS, categories, filler_status, filler_note. ``contacts``: TARGET_KEY, role, unit, name, email, phone,
    mobile, source_url, page_url, status, notes, ordinal. Adds ``ordinal`` (category, then rank). Contacts of no category go, and
    so do names that are the place itself, with their rows where nothing else is in them.
    """
    about = targets.select(*TARGET_COLUMNS, "categories")
    known = with_category(contacts.join(about, TARGET_KEY)).where((F.col("category") != "") & (F.col("category") != IDENTITY))
    place = names_a_place(F.col("name"), F.col("target"), F.col("state")) | names_a_place(F.col("name"), F.col("target"), F.col("state_name"))
    some = F.exists(F.array(*CONTACT), lambda x: ~blank(x))
    known = known.where(~place | some).withColumn("name", F.when(place, "").otherwise(F.col("name")))
    keys = score(F.col("status"), F.concat_ws("", *CONTACT), F.col("name"), F.col("source_url"))
    # Read twice below: classified and ranked once, and the plan ends here.
    ranked = materialise(rank_candidates(known, [*TARGET_KEY, "category"], keys, "ordinal").drop("ordinal"))
    empty = {c: F.lit("") for c in ("name", *CONTACT)}
    units = F.create_map(*(F.lit(x) for pair in labels().items() for x in pair))
    lacking = required_categories(targets).join(ranked.select(*TARGET_KEY, "category").distinct(), [*TARGET_KEY, "category"], "left_anti").join(targets, TARGET_KEY)
    reference = reference_url(F.col("site"), TERRITORY_URL)
    fillers = lacking.withColumns({**empty, "unit": units[F.col("category")], "role": F.col("category"), "role_title": F.col("category"), "source_url": reference, "page_url": reference, "status": F.col("filler_status"), "notes": F.col("filler_note"), "rank": F.lit(1)})
    own = {"unit": F.lit(labels()[IDENTITY]), "role": F.lit(IDENTITY), "role_title": F.lit(IDENTITY), "category": F.lit(IDENTITY), "name": F.concat_ws("/", "target", "state")}
    identity_rows = targets.withColumns({**empty, **own, "source_url": F.lit(TERRITORY_URL), "page_url": F.lit(TERRITORY_URL), "status": F.lit("Encontrado"), "notes": F.lit(IDENTITY_NOTE), "rank": F.lit(1)})
    place_of = F.create_map(*(F.lit(x) for n, c in enumerate(labels()) for x in (c, n)))
    columns = [*(c for c in DATA_COLUMNS if c != "collected_on"), "category", "rank"]
    rows = identity_rows.select(columns).unionByName(ranked.select(columns)).unionByName(fillers.select(columns))
    return rows.withColumns({"collected_on": F.lit(collected_on), "ordinal": F.struct(place_of[F.col("category")].alias("category"), "rank")}).drop("category", "rank")


def municipal_targets(places: DataFrame) -> DataFrame:
    """Places of the scope as targets of the municipal sphere: a target is named as its place."""
    return places.withColumns({"sphere": F.lit("Municipal"), "target": F.col("name"), "municipality": F.col("name"), "categories": F.array().cast("array<string>")}).drop("name")


def all_targets(municipal: DataFrame, state: DataFrame) -> DataFrame:
    """Municipal targets, then those of the states; columns that one side lacks are null."""
    return municipal.unionByName(state, allowMissingColumns=True)


def dedupe_extraction(df: DataFrame, ordinal: str = "pos") -> DataFrame:
    """Weak records of a source and role go where a strong one is; equal ones stand once, the first."""
    some = F.exists(F.array(*CONTACT), lambda x: ~blank(x))
    strong = (F.col("status") == "Encontrado") & ~blank(F.col("name")) & some
    return keep_first(drop_weak(df, ["source_url", "role"], strong), ["role", "name", *CONTACT, "source_url", "status"], ordinal)


def keep_first(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """One row of each key: the first by ordinal. Keys that the table lacks don't count."""
    have = [k for k in keys if k in df.columns]
    nth = F.row_number().over(Window.partitionBy(*have).orderBy(ordinal))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def ensure(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exactly the named columns, in order; absent ones are empty text."""
    return df.select(*(F.col(n) if n in df.columns else F.lit("").alias(n) for n in names))


def normalise(df: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Normal forms of all fields of contact records, then the first of each identity."""
    full = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c != ordinal else F.col(c) for c in df.columns))
    for c in ("state", "target", "sphere", "unit", "role", "name", "email", "phone", "mobile", "source_url", "page_url", "status", "notes"):
        if c not in full.columns:
            full = full.withColumn(c, F.lit(""))
    out = full.withColumns(
        {
            "state": F.upper(F.trim("state")),
            "target": title_name(F.col("target")),
            "sphere": F.when(blank(F.col("sphere")), "Municipal").otherwise(F.col("sphere")),
            "role": norm_role(F.col("role")),
            "unit": F.when(blank(F.col("unit")), unit_of_role(F.col("role"))).otherwise(F.col("unit")),
            "email": norm_emails(F.col("email")),
            "phone": norm_phones(F.col("phone")),
            "mobile": norm_phones(F.col("mobile")),
            "page_url": clean_url(F.col("page_url")),
            "source_url": clean_url(F.when(blank(F.col("source_url")), F.col("page_url")).otherwise(F.col("source_url"))),
            "status": norm_status(F.col("status")),
        }
    )
    return keep_first(out, IDENTITY_KEY, ordinal)


def unavailable(url: Column, tokens: Sequence[str]) -> Column:
    """Sources that are known to be down when records are checked."""
    return has_any(F.lower(F.coalesce(url, F.lit(""))), tokens) if tokens else F.lit(False)


def downgrade(df: DataFrame, unavailable: Column | None = None, wrong_name: Column | None = None) -> DataFrame:
    """Found or partial records without any published value say so; those of sources that are down are emptied, and names that are none go.

    ``wrong_name``: names that a table of rules speaks against, beside those that the shape of names or the default words do.
    """
    fields = ["name", *CONTACT]
    claims = F.col("status").isin("Encontrado", "Parcial") & (F.col("role") != IDENTITY)
    down = claims & (unavailable if unavailable is not None else F.lit(False))
    listed = F.coalesce(wrong_name, F.lit(False)) if wrong_name is not None else F.lit(False)
    wrong = claims & ~down & ~blank(F.col("name")) & (listed | ~valid_name(F.col("name")))
    out = df.withColumns({"_claims": claims, "_down": down, "_wrong": wrong})
    out = out.withColumns({f: F.when(F.col("_down") | (F.col("_wrong") if f == "name" else F.lit(False)), "").otherwise(F.col(f)) for f in fields})
    out = out.withColumn("_empty", F.col("_claims") & ~F.col("_down") & F.forall(F.array(*fields), lambda x: blank(x)))
    noted = F.when(F.col("_wrong"), add_note(F.col("notes"), "Nome descartado por parecer rótulo institucional.")).otherwise(F.col("notes"))
    notes = F.when(F.col("_down"), add_note(noted, "Fonte indisponível na validação.")).when(F.col("_empty"), add_note(noted, "Sem dado publicado.")).otherwise(noted)
    status = F.when(F.col("_down"), "Site fora do ar").when(F.col("_empty"), "Não publicado").otherwise(F.col("status"))
    return out.withColumns({"notes": notes, "status": status}).drop("_claims", "_down", "_wrong", "_empty")


def replace_part(base: DataFrame, fresh: DataFrame, keep: Column, take: Column) -> DataFrame:
    """The rows of ``base`` that stay, and the fresh rows that take the place of the others."""
    return base.where(keep).unionByName(fresh.where(take), allowMissingColumns=True)


def drop_weak(df: DataFrame, within: Sequence[str], strong: Column) -> DataFrame:
    """Weak records go where a strong one shares their key."""
    best = F.max(strong.cast("int")).over(Window.partitionBy(*within))
    return df.withColumn("_best", best).where(strong | (F.col("_best") == 0)).drop("_best")
