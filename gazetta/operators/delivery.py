"""What stands around a run: overrides, official sites, target states, invalid rows, selection for a rerun, the gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions import urls
from gazetta.functions.lexicon import AGAINST, GENERAL
from gazetta.functions.names import valid_name
from gazetta.functions.text import blank, identity, norm_search
from gazetta.functions.urls import FALLBACK_PATHS, clean_url, has_any, host, ignore_reason, let, root_url
from gazetta.operators.records import CATEGORIES, IDENTITY
from gazetta.operators.scope import CONNECTORS, names_a_place, slugs

# Hosts of search results that are never official, and tokens of directory hosts.
SEARCH_HOSTS = ["wikipedia.org", "facebook.com", "instagram.com", "youtube.com", "linkedin.com", "ibge.gov.br"]
HOST_TOKENS = ["camara", "camaramunicipal", "tribunal", "guia", "noticias", "turismo"]
# Parts of addresses of which a record is run again where the source speaks against its role.
RERUN_TOKENS = [".pdf", "carta servicos", "download type txt", "educacao", "departamento index", "departamento view", "leis municipais", "mobilidade", "pdu", "unidades", "/prefeitos", "cidade/prefeitos"]


def apply_overrides(targets: DataFrame, overrides: DataFrame) -> DataFrame:
    """Known facts of targets, by state, name and sphere without regard to accents. ``overrides`` is a small table with the same three columns."""
    keys = ["state", "name", "sphere"]
    left = targets.select("*", *(identity(F.col(k)).alias(f"_{k}") for k in keys))
    right = overrides.select(*(identity(F.col(k)).alias(f"_{k}") for k in keys), *(c for c in overrides.columns if c not in keys))
    return left.join(right, [f"_{k}" for k in keys]).drop(*(f"_{k}" for k in keys))


def unwrap_result(href: Column) -> Column:
    """The target of a search result that wraps it in a parameter."""
    inner = F.regexp_extract(href, r"[?&]uddg=([^&#]+)", 1)
    return F.when(inner != "", F.try_url_decode(inner)).otherwise(F.when(href.rlike("^https?://"), href).otherwise(""))


def official_site(url: Column, name: Column, state: Column, snippet: Column) -> Column:
    """Whether a result is the official site: a government host that holds the name's short form, or names the town hall."""
    h = host(clean_url(url))
    tight, government = F.regexp_replace(h, "[^a-z0-9]", ""), h.endswith(".gov.br")
    blocked = has_any(h, SEARCH_HOSTS) | has_any(tight, HOST_TOKENS)
    words = F.filter(F.split(norm_search(name), "[^a-z0-9]+"), lambda w: (w != "") & ~w.isin(CONNECTORS))
    seen = norm_search(F.concat_ws(" ", snippet, h))
    named = has_any(seen, ["prefeitura", "municipio"]) & (F.size(words) > 0) & F.forall(F.slice(words, 1, 2), lambda w: seen.contains(w))
    return F.coalesce(~blocked & government & (F.exists(slugs(name), lambda s: tight.contains(s)) | named), F.lit(False))


def official_roots(results: DataFrame) -> DataFrame:
    """Distinct official roots of each target among its search results, best rank first. Columns: id, name, state, rank, href, snippet."""
    r = results.withColumn("url", unwrap_result(F.col("href"))).where(official_site(F.col("url"), F.col("name"), F.col("state"), F.col("snippet")))
    return r.groupBy("id", root_url(clean_url(F.col("url"))).alias("root")).agg(F.min("rank").alias("rank"))


def search_sites(results: DataFrame, live: DataFrame) -> DataFrame:
    """``id``, ``root``, ``rank``: the first official root of each target's search results that ``live`` (url, ok) names as up."""
    up = official_roots(results).join(live.where("ok").select(F.col("url").alias("root")).distinct(), "root", "left_semi")
    return up.groupBy("id").agg(F.min(F.struct("rank", "root")).alias("best")).select("id", "best.root", "best.rank")


def fallback_urls(site: Column) -> Column:
    """Standard paths to try where a site's home is blocked."""
    return let(root_url(clean_url(site)), lambda root: F.filter(F.array(*(F.concat(root, F.lit(p)) for p in FALLBACK_PATHS)), lambda u: ignore_reason(u).isNull()))


# Keys of a configuration that stand for a category whose label they aren't a form of.
CATEGORY_KEYS = {"identificacao": IDENTITY, "municipio_capital_uf": IDENTITY, "agencia_desenvolvimento": "Agências municipais de desenvolvimento"}


def parse_categories(listed: Column) -> Column:
    """The known categories of a ``;`` or ``,`` list, in order, by label or by key, without regard to accents, case and what joins their words."""
    labels = [IDENTITY, *CATEGORIES]
    parts = F.transform(F.split(F.coalesce(listed, F.lit("")), "[;,]"), lambda x: identity(x))

    def label(p: Column) -> Column:
        out = F.when(F.lit(False), "")
        for name in labels:
            out = out.when(p == identity(F.lit(name)), name)
        for key, name in CATEGORY_KEYS.items():
            out = out.when(p == key.replace("_", " "), name)
        return out

    return F.array_distinct(F.array_compact(F.transform(parts, label)))


def target_status(targets: DataFrame, crawl: DataFrame, contacts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of each target from its crawl and its contacts: found if any is, partial if any is, else what the crawl says."""
    best = contacts.groupBy(*keys).agg(F.bool_or(F.col("status") == "Encontrado").alias("found"), F.bool_or(F.col("status") == "Parcial").alias("partial"))
    out = targets.join(crawl.select(*keys, F.col("status").alias("crawled")), list(keys), "left").join(best, list(keys), "left")
    status = (
        F.when(blank(F.col("site")), "Site não localizado")
        .when(F.col("found"), "Encontrado")
        .when(F.col("partial"), "Parcial")
        .when(F.coalesce("crawled", F.lit("")).isin("", "Encontrado"), "Não publicado")
        .otherwise(F.col("crawled"))
    )
    return out.withColumn("target_status", status).drop("crawled", "found", "partial")


def against_role(role: Column, url: Column) -> Column:
    """Whether a source speaks against a role, by the same table as ``lexicon.against``."""
    path = F.translate(F.translate(norm_search(urls.path(url)), "_", "-"), "/", " ")
    whole, out = norm_search(url), F.lit(False)
    for rule in AGAINST:
        roles = role.isin(*rule.roles) if rule.roles else role != GENERAL
        holds = F.lit(False)
        holds = holds | has_any(path, rule.path) if rule.path else holds
        holds = holds | has_any(whole, rule.url) if rule.url else holds
        out = out | (roles & holds & ~has_any(path, rule.unless) if rule.unless else roles & holds)
    return F.coalesce(out, F.lit(False))


def strong(record_status: Column, name: Column, *contacts: Column) -> Column:
    """Found, with a person and a contact."""
    return F.coalesce((record_status == "Encontrado") & ~blank(name) & F.exists(F.array(*contacts), lambda x: ~blank(x)), F.lit(False))


def invalid_rows(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows to run again with their reasons: no data, no person or a place for a name, a source that speaks against the role.

    A source alone counts only where its address holds one of ``RERUN_TOKENS``.
    """
    claims = F.col("status").isin("Encontrado", "Parcial") & (F.col("role") != IDENTITY)
    no_data = F.forall(F.array("name", "email", "phone", "mobile"), lambda x: blank(x))
    named = ~blank(F.col("name"))
    plain = F.array_compact(
        F.array(
            F.when(no_data, "no data"), F.when(named & ~valid_name(F.col("name")), "no person"), F.when(named & names_a_place(F.col("name"), F.col("target"), F.col("state")), "place")
        )
    )
    hard = has_any(norm_search(F.col("source_url")), RERUN_TOKENS)
    out = records.where(claims).withColumn("_reasons", plain)
    source = against_role(F.col("role"), F.col("source_url")) & ((F.size("_reasons") > 0) | hard)
    return out.select(*keys, F.when(source, F.array_append("_reasons", F.lit("source"))).otherwise(F.col("_reasons")).alias("reasons")).where(F.size("reasons") > 0)


def to_rerun(inputs: DataFrame, invalid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The inputs of targets that have an invalid row."""
    return inputs.join(invalid.select(*keys).distinct(), list(keys), "left_semi")


def gate(audit: DataFrame, verified: DataFrame) -> tuple[bool, list[str]]:
    """Whether a delivery may be published: an empty audit, and no verified row that differs or could not be checked."""
    problems = []
    if not audit.isEmpty():
        problems.append("audit")
    if not verified.where(F.col("verdict") != "Validado").isEmpty():
        problems.append("verification")
    return not problems, problems


def best_attempt(attempts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of several recordings of a page the best: found before others, then that with most text, the first among equals.

    Attempts: keys, status, text, attempt (its number).
    """
    rest = [c for c in attempts.columns if c not in keys]
    worth = F.struct((F.col("status") == "Encontrado").alias("ok"), F.length(F.coalesce("text", F.lit(""))).alias("n"), (-F.col("attempt")).alias("first"))
    return attempts.groupBy(*keys).agg(F.max_by(F.struct(*rest), worth).alias("row")).select(*keys, "row.*")
