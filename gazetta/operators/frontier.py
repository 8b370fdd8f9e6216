"""A crawl frontier over a corpus of pages: rounds of joins, no network."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazetta.functions.html import html_links
from gazetta.functions.urls import KEYWORDS, clean_url, ignore_reason, link_priority, relevant_link, resolve, same_domain, url_key
from gazetta.operators.delivery import fallback_urls
from gazetta.operators.rules import judge_urls
from gazetta.scratch import materialise, spread
from gazetta.sources.tables import exists

#: Partitions of a store of visits, by a hash of the target.
BUCKETS = 64
LINK_COLUMNS = ("priority", "to_key")


def judged(addresses: DataFrame, url: str, rules: DataFrame | None = None) -> DataFrame:
    """The distinct addresses of a column (``to_url``) that no rule leaves out, with their ``priority`` and key (``to_key``): each is judged once, however many links name it."""
    if rules is not None:
        each = judge_urls(addresses, url, rules)
    else:
        each = addresses.select(F.col(url).alias("url")).distinct().withColumn("reason", ignore_reason(F.col("url")))
    return each.where("reason IS NULL").select(F.col("url").alias("to_url"), link_priority(F.col("url")).alias("priority"), url_key(F.col("url")).alias("to_key"))


def page_links(pages: DataFrame, keywords: Iterable[str] | None = KEYWORDS, rules: DataFrame | None = None) -> DataFrame:
    """The links of pages that lead on within their site: ``from_url``, ``to_url``, ``pos``, ``priority``, ``to_key``, best first by (priority, pos).

    ``pages``: url, html. Links are resolved against their page and defragmented; of a page's links to one address the first
    counts; mail, telephone and script links, other sites, addresses that a rule ignores and, with ``keywords``, links without a keyword go.
    ``rules``: a table of rules in place of the library's own lists. The HTML is read once: the links lie in a scratch table.
    """
    each = spread(pages.select("url", "html")).select(F.col("url").alias("from_url"), F.posexplode(html_links(F.col("html"))).alias("pos", "link"))
    each = each.select("from_url", "pos", F.col("link.anchor").alias("anchor"), resolve(F.col("from_url"), F.col("link.href")).alias("to_url")).where("to_url <> ''")
    each = each.where(same_domain(F.col("to_url"), F.col("from_url")))
    if keywords is not None:
        each = each.where(relevant_link(F.col("anchor"), F.col("to_url"), keywords))
    first = materialise(each.groupBy("from_url", "to_url").agg(F.min("pos").alias("pos")))
    return first.join(judged(first, "to_url", rules).hint("rebalance"), "to_url").select("from_url", "to_url", "pos", *LINK_COLUMNS)


def _edges(links: DataFrame, rules: DataFrame | None) -> DataFrame:
    """``key`` of the page, ``url`` and ``next_key`` of what it leads to, ``priority`` and ``pos``; links that ``page_links`` has judged aren't judged again."""
    if not set(LINK_COLUMNS) <= set(links.columns):
        plain = links.select("from_url", clean_url(F.col("to_url")).alias("to_url"), "pos").where("to_url <> ''")
        links = plain.join(judged(plain, "to_url", rules).hint("rebalance"), "to_url")
    return materialise(links.select(url_key(clean_url(F.col("from_url"))).alias("key"), F.col("to_url").alias("url"), F.col("to_key").alias("next_key"), "priority", "pos"))


def _begun(start: DataFrame, most_pages: int, known: DataFrame | None) -> DataFrame:
    """The state of round 0: for each target its ``site``, the keys of all pages visited (``seen``) and the new ones (``fresh``)."""
    keyed = start.withColumn("key", url_key(F.col("url"))).groupBy("target", "key").agg(F.min(F.struct("nth", "url")).alias("first"))
    keyed = keyed.select("target", "key", "first.nth", "first.url")
    if known is not None:
        held = known.select("target", F.col("seen").alias("_seen"), F.col("last").alias("_last"))
        keyed = keyed.join(held, "target", "left").where(F.col("_seen").isNull() | ~F.array_contains("_seen", F.col("key"))).drop("_seen")
    else:
        keyed = keyed.withColumn("_last", F.lit(0))
    last = F.coalesce("_last", F.lit(0))
    ranked = keyed.withColumn("rank", last + F.row_number().over(Window.partitionBy("target").orderBy("nth", "url"))).where(F.col("rank") <= most_pages)
    return ranked.groupBy("target").agg(F.collect_list(F.struct("rank", "url", "key", F.col("url").alias("site"))).alias("fresh"))


def visited(spark: SparkSession, store: str) -> DataFrame | None:
    """The visits that a store holds, or None: ``target``, ``url``, ``key``, ``site``, ``round``, ``rank``, ``bucket``."""
    return spark.read.parquet(f"{store}/visits") if exists(spark, f"{store}/visits") else None


def crawl(seeds: DataFrame, links: DataFrame, most_pages: int = 60, rounds: int | None = None, blocked: DataFrame | None = None, rules: DataFrame | None = None, store: str | None = None) -> DataFrame:
    """Breadth-first visits of each target: ``target``, ``url``, ``round``, ``rank``.

    ``seeds``: target, url. ``links``: from_url, to_url, pos, as ``page_links`` gives them. A URL is visited once for each target, whatever its
    scheme; at most ``most_pages`` for each. Links within the target's site are taken best kind first. Targets in ``blocked``
    (target), whose home turns robots away, begin with the standard paths of their site as well.

    Each round draws on the round before and nothing else: a target is one row with the pages that the last round found
    and the keys of all its visits, which are ``most_pages`` at most, so that what is visited travels with the target and no table of visits is read again.
    Targets that found nothing new have no row any more. Every round is written to a shared table.
    Rounds go on until one finds nothing new (at most ``most_pages`` of them, as each adds a page to some target), or for ``rounds``.

    With ``store``, a folder, every round is also appended to a table of visits there, partitioned by a hash of the target, and what it
    holds isn't visited again: seeds that are new are begun, and pages visited before are followed where ``links`` has links of theirs. So
    a crawl goes on when pages are added, whose links alone need be given, and one that was killed goes on with the links it had. Only the buckets of
    targets that have something to do are read. The new visits alone are returned; their rounds count from 0 again.
    """
    spark = seeds.sparkSession
    start = seeds.select("target", clean_url(F.col("url")).alias("url")).where("url <> ''").withColumn("nth", F.lit(0))
    if blocked is not None:
        homes = start.groupBy("target").agg(F.min("url").alias("url")).join(blocked.select("target").distinct(), "target", "left_semi")
        start = start.unionByName(homes.select("target", F.posexplode(fallback_urls(F.col("url"))).alias("nth", "url")).withColumn("nth", F.col("nth") + 1))
    edges = _edges(links, rules)
    bucket = F.pmod(F.xxhash64(F.col("target").cast("string")), F.lit(BUCKETS)).cast("int")
    known, again = None, None
    before = visited(spark, store) if store else None
    if before is not None:
        asked = [r["bucket"] for r in start.select(bucket.alias("bucket")).distinct().collect()]
        again = materialise(before.join(edges.select("key").distinct(), "key", "left_semi"))
        asked += [r["bucket"] for r in again.select("bucket").distinct().collect()]
        held = before.where(F.col("bucket").isin(*set(asked)))  # at most BUCKETS numbers
        known = materialise(held.groupBy("target").agg(F.collect_set("key").alias("seen"), F.max("rank").alias("last")))
    begun = _begun(start, most_pages, known)
    empty = F.array().cast("array<struct<rank:int,url:string,key:string,site:string>>")
    if known is None:
        state = begun.withColumn("seen", F.transform("fresh", lambda x: x["key"])).withColumn("open", F.col("fresh"))
    else:
        reopened = again.groupBy("target").agg(F.collect_list(F.struct("rank", "url", "key", "site")).alias("reopened"))
        state = begun.join(reopened, "target", "full_outer").join(known, "target", "left")
        state = state.withColumns({"fresh": F.coalesce("fresh", empty), "seen": F.concat(F.coalesce("seen", F.array().cast("array<string>")), F.transform(F.coalesce("fresh", empty), lambda x: x["key"]))})
        state = state.withColumn("open", F.concat("fresh", F.coalesce("reopened", empty)))
    newest = materialise(state.select("target", "seen", "fresh", "open"))
    tables, number = [], 0
    while not newest.isEmpty():
        pages = newest.select("target", F.lit(number).alias("round"), F.inline("fresh"))
        tables.append(pages)
        if store:
            pages.withColumn("bucket", bucket).repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{store}/visits")
        if rounds is not None and number >= rounds:
            break
        number += 1
        out = newest.select("target", F.inline("open")).select("target", "site", "key", F.col("rank").alias("parent")).join(edges.withColumnRenamed("url", "next"), "key")
        best = F.min(F.struct("parent", "priority", "pos", F.col("next").alias("url"), "site")).alias("best")
        found = out.where(same_domain(F.col("next"), F.col("site"))).groupBy("target", F.col("next_key").alias("key")).agg(best)
        met = found.join(newest.select("target", "seen"), "target").where(~F.array_contains("seen", F.col("key")))
        nth = F.row_number().over(Window.partitionBy("target").orderBy("best"))
        taken = met.withColumn("rank", F.size("seen") + nth).where(F.col("rank") <= most_pages)
        pages = taken.groupBy("target").agg(F.first("seen").alias("seen"), F.array_sort(F.collect_list(F.struct("rank", "best.url", "key", "best.site"))).alias("fresh"))
        newest = materialise(pages.select("target", F.concat("seen", F.transform("fresh", lambda x: x["key"])).alias("seen"), "fresh", F.col("fresh").alias("open")))
    if not tables:
        return newest.select("target", F.lit(0).alias("round"), F.inline("fresh")).select("target", "url", "round", "rank")
    return reduce(DataFrame.unionByName, tables).select("target", "url", "round", "rank")
