"""The whole run as a plan: targets and recorded pages in, the tables of a delivery out.

What Python workers make (texts, contacts) and the results are written to scratch tables, as several of the tables draw on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.functions.contacts import extract_contacts
from gazetta.functions.html import html_text
from gazetta.functions.text import STATUSES, blank
from gazetta.functions.urls import block_page, clean_url, fetch_status, moved, redirected_off
from gazetta.operators import delivery, quality, records
from gazetta.operators.rules import down_sources, judge_urls, name_rules, wrong_names
from gazetta.scratch import materialise, spread
from gazetta.sources.tables import config_table

#: What pages may say about how they were fetched; absent columns are null.
FETCH = {"http_status": "int", "content_type": "string", "error": "string", "final_url": "string"}
MISSING, SILENT = "Páginas oficiais consultadas, mas sem dado oficial claro para esta categoria.", "Páginas coletadas, mas sem contatos associados aos cargos configurados."
NO_SITE = "Site oficial não informado."


def attempts(pages: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Every recorded fetch with its text and state: blocked, redirected off, down, without text, or found.

    ``pages``: page_id, target, url, html and any of ``FETCH``. ``rules``: a table of rules in place of the library's lists.
    """
    pages = spread(pages)
    full = pages.select("page_id", "target", "url", "html", *(F.col(c).cast(t) if c in pages.columns else F.lit(None).cast(t).alias(c) for c, t in FETCH.items()))
    full = full.withColumn("state", fetch_status(F.col("http_status"), F.col("content_type"), F.col("error")))
    read = full.withColumn("text", F.when(F.col("state") == "Encontrado", html_text(F.col("html"))))
    off = redirected_off(F.col("url"), F.col("final_url"))
    if rules is not None:
        # What is left of the redirects are addresses that a rule speaks against: few, and read from the narrow columns alone.
        bad = judge_urls(pages.where(moved(F.col("url"), F.col("final_url"))), "final_url", rules).where("reason IS NOT NULL") if "final_url" in pages.columns else None
        read = read.join(bad.withColumnRenamed("url", "final_url"), "final_url", "left") if bad is not None else read.withColumn("reason", F.lit(None).cast("string"))
        off = redirected_off(F.col("url"), F.col("final_url"), F.col("reason"))
    state = (
        F.when(F.col("state") != "Encontrado", F.col("state"))
        .when(off, "Página sem informação pública")
        .when(block_page(F.col("text"), F.col("html")), "Bloqueio técnico")
        .otherwise("Encontrado")
    )
    out = read.withColumn("status", state).withColumn("final_url", F.when(blank(F.col("final_url")), clean_url(F.col("url"))).otherwise(clean_url(F.col("final_url"))))
    kept = (F.col("status") == "Encontrado") & ~blank(F.col("text"))
    return out.select("page_id", "target", "url", "final_url", "http_status", "content_type", "status", F.when(kept, F.col("text")).alias("text"), kept.alias("has_text"))


def target_states(targets: DataFrame, log: DataFrame, contacts: DataFrame) -> DataFrame:
    """Targets with ``status``, ``notes`` and what stands in for a missing category: ``filler_status``, ``filler_note``."""
    first = F.min(F.struct(F.coalesce("page_id", F.lit(1 << 62)), "status")).alias("first")
    crawl = log.groupBy("target").agg(F.bool_or("has_text").alias("any_text"), first).select("target", "any_text", F.col("first.status").alias("crawled"))
    found = contacts.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("status") == "Encontrado").alias("found"))
    out = targets.join(crawl, "target", "left").join(found, "target", "left")
    lost, none = blank(F.col("site")), F.coalesce("n", F.lit(0)) == 0
    unread = none & ~F.coalesce("any_text", F.lit(False))
    crawled = F.coalesce("crawled", F.lit("Não encontrado"))
    status = F.when(lost, "Site não localizado").when(unread, crawled).when(none, "Não publicado").when(F.coalesce("found", F.lit(False)), "Encontrado").otherwise("Parcial")
    note = F.when(lost, NO_SITE).when(unread, F.lit("Nenhuma página com texto.")).when(none, SILENT).otherwise(F.concat(F.col("n").cast("string"), F.lit(" registro(s) de contato extraído(s).")))
    filler = F.when(lost, "Site não localizado").when(unread, crawled).otherwise("Não publicado")
    filler_note = F.when(lost | unread | none, F.col("notes")).otherwise(MISSING)
    return out.withColumns({"status": status, "notes": note}).withColumns({"filler_status": filler, "filler_note": filler_note}).drop("any_text", "crawled", "n", "found")


def pending_rows(states: DataFrame, data: DataFrame) -> DataFrame:
    """What is left to do: targets without a site, pages or contacts, rows that break a rule, categories that are absent."""
    kind = F.when(F.col("status") == "Site não localizado", "Site").when(F.col("status") == "Não publicado", "Contato").otherwise("Coleta")
    open_ = states.where(~F.col("status").isin("Encontrado", "Parcial")).select("state", "target", "sphere", kind.alias("kind"), F.col("notes").alias("description"), F.col("site").alias("url"), "status")
    bad_status = ~F.coalesce(F.col("status").isin(STATUSES), F.lit(False))
    no_url = F.col("status").isin("Encontrado", "Parcial") & blank(F.col("source_url")) & blank(F.col("page_url"))
    broken = F.array_compact(F.array(F.when(bad_status, F.lit("Status inválido")), F.when(no_url, F.lit("URL ausente"))))
    unsure = F.lit("Necessita validação manual").alias("status")
    rows = data.withColumn("kind", F.explode(broken)).select("state", "target", "sphere", "kind", F.col("role").alias("description"), F.col("source_url").alias("url"), unsure)
    lacking = quality.coverage_issues(data, states).select("state", "target", F.lit("Municipal").alias("sphere"), F.lit("Cobertura de categoria").alias("kind"), "description", F.lit("").alias("url"), unsure)
    return open_.unionByName(rows).unionByName(lacking)


def build(targets: DataFrame, pages: DataFrame, collected_on: str, overrides: DataFrame | None = None, unavailable: Sequence[str] = (), configuration: dict[str, object] | None = None, rules: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of a delivery: ``data``, ``consolidated`` (the same rows), ``targets``, ``pending``, ``summary``, ``sources``, ``texts`` (what was read of the sources, for verification), ``configuration``, and ``audit``.

    ``targets``: target, state, sphere, site and any of the other target columns and ``categories``. ``pages``: see ``attempts``.
    ``rules``: a table of rules (``operators.rules``) on addresses, names and sources in place of the library's lists. ``overrides``: known contacts: state, name (of the target), sphere and the columns of a record. A target is known by its name.
    """
    given = {"state_name": "string", "municipality": "string", "population": "long", "reason": "string", "categories": "array<string>"}
    for c, kind in given.items():
        if c not in targets.columns:
            targets = targets.withColumn(c, F.col("target") if c == "municipality" else F.lit(None).cast(kind))
    words, phrases = name_rules(rules) if rules is not None else (None, None)
    log = materialise(attempts(pages, rules))
    texts = log.where("has_text").select("page_id", "target", F.col("final_url").alias("source_url"), "text")
    found = records.dedupe_extraction(extract_contacts(texts, ["page_id", "target", "source_url"], url_col="source_url", words=words, phrases=phrases), "pos")
    found = found.join(targets.select(*records.TARGET_KEY), "target").withColumns({"unit": F.lit(""), "page_url": F.col("source_url"), "ordinal": F.struct(F.lit(1).alias("late"), F.coalesce("page_id", F.lit(1 << 62)).alias("page"), "pos")})
    columns = [*records.TARGET_KEY, "role", "unit", "name", "email", "phone", "mobile", "source_url", "page_url", "status", "notes", "ordinal"]
    contacts = found.select(columns)
    if overrides is not None:
        # What a known contact brings under the names of its own table; its "name" is that of the target.
        known = delivery.apply_overrides(targets.select("state", "sphere", "target", F.col("target").alias("name")), overrides.withColumnRenamed("person", "_person")).drop("name").withColumnRenamed("_person", "name")
        known = records.ensure(known, [*records.TARGET_KEY, "role", "unit", "name", "email", "phone", "mobile", "source_url", "page_url", "status", "notes"])
        contacts = contacts.unionByName(known.withColumn("ordinal", F.struct(F.lit(0).alias("late"), F.xxhash64("role", "name", "email").alias("page"), F.lit(0).alias("pos"))))
    contacts = materialise(contacts)
    states = materialise(target_states(targets, log, contacts))
    covered = records.cover(states, contacts, collected_on)
    down = records.unavailable(F.col("source_url"), unavailable) if unavailable else None
    normal = records.normalise(covered)
    if rules is None:
        data = materialise(records.downgrade(normal, down))
    else:
        normal = materialise(normal)
        lost = down_sources(normal, "source_url", rules).select(F.col("url").alias("source_url"), F.lit(True).alias("_lost"))
        wrong = wrong_names(normal, "name", rules).withColumn("_wrong_name", F.lit(True))
        judged = normal.join(lost, "source_url", "left").join(wrong, "name", "left")
        is_down = F.coalesce("_lost", F.lit(False)) | (down if down is not None else F.lit(False))
        data = materialise(records.downgrade(judged, is_down, F.col("_wrong_name")).drop("_lost", "_wrong_name").select(normal.columns))
    pending = pending_rows(states, data)
    status = states.select(*records.TARGET_COLUMNS, "status", "notes")
    ordered = data.select(*records.DATA_COLUMNS, "ordinal")
    tables = {
        "data": ordered,
        "consolidated": ordered,
        "targets": status,
        "pending": pending,
        "summary": quality.summary(data, status, pending, collected_on),
        "sources": log.drop("text"),
        "texts": log.select("page_id", "target", "final_url", "text", "status"),
        "configuration": config_table(targets.sparkSession, configuration or {"run": {"collected_on": collected_on}}),
    }
    tables["audit"] = quality.audit(tables, ["state", "target", "sphere", "ordinal"])
    return tables
