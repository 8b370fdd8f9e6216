"""Rules as data: what addresses, names and sources are left out, as rows of a table that texts are joined with.

A rule is a literal with the place that it is looked for in. Each is filed under one short piece of itself (a gram); a text is
cut into its grams once, whatever the number of rules, and meets the rules by an equi-join on place and gram, which Spark
broadcasts or shuffles by the size of the table. What meets is then compared in full, so that hits are those of a scan of all rules.
Texts are made distinct before they are cut, as links and sources repeat.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.functions import lexicon, urls
from gazetta.functions.text import norm_search
from gazetta.sources.tables import column_like, read_any

GRAM = 3
#: What a rule's ``kind`` looks at, and how: anywhere in it, at its beginning, at its end, or as a whole word.
KINDS = {
    "host": ("raw", "anywhere"), "subdomain": ("raw", "anywhere"), "network": ("raw", "anywhere"), "file": ("path", "end"), "prefix": ("path", "beginning"), "segment": ("path", "anywhere"), "query": ("query", "anywhere"),
    "name_word": ("name", "word"), "name_phrase": ("name", "anywhere"), "unavailable": ("source", "anywhere"),
}
URL_KINDS, NAME_KINDS = ("host", "subdomain", "network", "file", "prefix", "segment", "query"), ("name_word", "name_phrase")
#: Text of rules for names that workers hold beside their lexicon.
MOST_NAME_BYTES = 32 << 20
SCHEMA = "kind string, pattern string"


def default_rules(spark: SparkSession) -> DataFrame:
    """The lists that the library brings, as a table."""
    listed = {
        "host": ["resource.faces"], "subdomain": urls.SUBDOMAINS, "network": urls.NETWORKS, "file": urls.FILES, "prefix": urls.PREFIXES, "segment": urls.SEGMENTS, "query": urls.QUERIES,
        "name_word": sorted(lexicon.NOT_NAMES), "name_phrase": lexicon.NOT_NAME_PHRASES,
    }
    return spark.createDataFrame([(kind, pattern) for kind, patterns in listed.items() for pattern in patterns], SCHEMA)


def rule_table(df: DataFrame) -> DataFrame:
    """``kind`` and ``pattern`` of a table of rules, folded as the texts are; headers may have other case and spacing.

    Rows without a pattern are passed over, repeated ones count once. Raises ValueError for a column that is absent or a kind that isn't known.
    """
    found = {c: column_like(df, c) for c in ("kind", "pattern")}
    lacking = [c for c, own in found.items() if own is None]
    if lacking:
        raise ValueError(f"rules without {' and '.join(lacking)}")
    kind = F.lower(F.trim(F.col(f"`{found['kind']}`")))
    out = df.select(kind.alias("kind"), F.col(f"`{found['pattern']}`").alias("pattern"))
    unknown = [str(r["kind"]) for r in out.where(~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False))).select("kind").distinct().limit(5).collect()]
    if unknown:
        raise ValueError(f"no such kind of rule: {', '.join(sorted(unknown))}")
    folded = F.when(F.col("kind").isin("path", "segment", "prefix", "file", *NAME_KINDS), norm_search(F.col("pattern"))).otherwise(F.lower(F.trim("pattern")))
    return out.select("kind", folded.alias("pattern")).where("pattern <> ''").distinct()


def read_rules(spark: SparkSession, path: str, extend: bool = True) -> DataFrame:
    """Rules from a file that ``read_any`` reads; with ``extend`` the library's own beside them, else only those of kinds that the file doesn't name."""
    given = rule_table(read_any(spark, path))
    own = default_rules(spark)
    return (own if extend else own.join(given.select("kind").distinct(), "kind", "left_anti")).unionByName(given).distinct()


def _grams(text: Column, size: int) -> Column:
    """All pieces of ``size`` characters, each once."""
    each = F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substr(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, F.array_distinct(each)).otherwise(F.array().cast("array<string>"))


def _at(grams: Column, place: str) -> Column:
    return F.transform(grams, lambda g: F.struct(F.lit(place).alias("place"), g.alias("gram")))


def filed(rules: DataFrame) -> DataFrame:
    """Rules with the ``place`` and the ``gram`` that they are filed under: the first of a beginning, the last of an end, else one that a hash picks."""
    place = F.lit(None).cast("string")
    how = F.lit(None).cast("string")
    for kind, (at, way) in KINDS.items():
        place, how = F.when(F.col("kind") == kind, at).otherwise(place), F.when(F.col("kind") == kind, way).otherwise(how)
    size = F.least(F.length("pattern"), F.lit(GRAM))
    pieces = F.transform(F.sequence(F.lit(1), F.length("pattern") - F.col("size") + 1), lambda i: F.substr("pattern", i, F.col("size")))
    gram = (
        F.when(F.col("how") == "beginning", F.concat(F.lit("^"), F.substr("pattern", F.lit(1), F.col("size"))))
        .when(F.col("how") == "end", F.concat(F.lit("$"), F.substr("pattern", F.length("pattern") - F.col("size") + 1)))
        .when(F.col("how") == "word", F.concat(F.lit(" "), F.col("pattern")))
        .otherwise(F.concat(F.lit("."), F.element_at(F.array_sort(F.transform(pieces, lambda p: F.struct(F.xxhash64(p).alias("h"), p.alias("p")))), 1)["p"]))
    )
    return rules.withColumns({"place": place, "how": how, "size": size}).withColumn("gram", gram)


def matches(texts: DataFrame, key: str, places: dict[str, str], rules: DataFrame) -> DataFrame:
    """``key``, ``kind``, ``pattern``: every rule that holds for a text, once.

    ``places``: for each place of ``KINDS`` the column of ``texts`` (key distinct, texts folded as rules are) that is looked at; other rules rest. Null texts match nothing.
    """
    index = filed(rules).where(F.col("place").isin(*places))
    # Which sizes of pieces the rules need: a few small numbers, whatever the number of rules.
    sizes = {(r["place"], r["how"], r["size"]) for r in index.select("place", "how", "size").distinct().collect()}
    pieces = []
    for place, how, size in sorted(sizes):
        text = F.coalesce(F.col(places[place]), F.lit(""))
        if how == "beginning":
            own = F.array(F.concat(F.lit("^"), F.substr(text, F.lit(1), F.lit(size))))
        elif how == "end":
            own = F.array(F.concat(F.lit("$"), F.right(text, F.lit(size))))
        elif how == "word":
            own = F.transform(F.split(text, " "), lambda w: F.concat(F.lit(" "), F.btrim(w, F.lit(".,:;"))))
        else:
            own = F.transform(_grams(text, size), lambda g: F.concat(F.lit("."), g))
        pieces.append(_at(own, place))
    if not pieces:
        return texts.select(key, F.lit("").alias("kind"), F.lit("").alias("pattern")).where("false")
    each = texts.select(key, *dict.fromkeys(places.values()), F.explode(F.array_distinct(F.concat(*pieces))).alias("_piece"))
    each = each.withColumns({"place": F.col("_piece.place"), "gram": F.col("_piece.gram")}).drop("_piece")
    seen = F.lit("")
    for place, column in places.items():
        seen = F.when(F.col("place") == place, F.coalesce(F.col(column), F.lit(""))).otherwise(seen)
    met = each.withColumn("_seen", seen).join(index, ["place", "gram"])
    holds = (
        F.when(F.col("how") == "beginning", F.startswith("_seen", "pattern"))
        .when(F.col("how") == "end", F.endswith("_seen", "pattern"))
        .when(F.col("how") == "word", F.lit(True))
        .otherwise(F.contains("_seen", "pattern"))
    )
    return met.where(holds).select(key, "kind", "pattern").distinct()


def judge_urls(addresses: DataFrame, url: str, rules: DataFrame) -> DataFrame:
    """The distinct addresses of a column with the first rule by which each is no page of interest (``reason``; null: none)."""
    distinct = addresses.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct()
    parts = distinct.withColumns({"raw": F.lower(urls.unquoted(F.col("url"))), "path": norm_search(urls.unquoted(urls.path(F.col("url")))), "query": F.lower(urls.query(F.col("url")))})
    hits = matches(parts, "url", {"raw": "raw", "path": "path", "query": "query"}, rules.where(F.col("kind").isin(*URL_KINDS)))
    kinds = hits.groupBy("url").agg(F.collect_set("kind").alias("_hits"))
    joined = distinct.join(kinds, "url", "left").withColumn("_hits", F.coalesce("_hits", F.array().cast("array<string>")))
    return joined.select("url", urls.ignore_reason(F.col("url"), hits=F.col("_hits")).alias("reason"))


def wrong_names(names: DataFrame, name: str, rules: DataFrame) -> DataFrame:
    """The distinct values of a column (``name``) that hold a word or phrase which no name has."""
    distinct = names.select(F.col(name).alias("name")).where("name <> ''").distinct().withColumn("low", norm_search(F.btrim("name", F.lit(" \t\r\n:-|,.;"))))
    return matches(distinct, "name", {"name": "low"}, rules.where(F.col("kind").isin(*NAME_KINDS))).select("name").distinct()


def down_sources(records: DataFrame, url: str, rules: DataFrame) -> DataFrame:
    """The distinct addresses of a column (``url``) that a rule names as unavailable."""
    distinct = records.select(F.col(url).alias("url")).where("url <> ''").distinct().withColumn("low", F.lower("url"))
    return matches(distinct, "url", {"source": "low"}, rules.where("kind = 'unavailable'")).select("url").distinct()


def name_rules(rules: DataFrame, most_bytes: int = MOST_NAME_BYTES) -> tuple[frozenset[str], tuple[str, ...]]:
    """Words and phrases that no name holds, for the workers that read texts. Raises ValueError beyond ``most_bytes``: they are held by every worker."""
    own = rules.where(F.col("kind").isin(*NAME_KINDS))
    size = own.agg(F.sum(F.octet_length("pattern"))).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"{size} bytes of rules for names; at most {most_bytes} are held by a worker")
    rows = own.collect()
    return frozenset(r["pattern"] for r in rows if r["kind"] == "name_word"), tuple(sorted(r["pattern"] for r in rows if r["kind"] == "name_phrase"))


def rules_of(spark: SparkSession, listed: Iterable[tuple[str, str]]) -> DataFrame:
    return rule_table(spark.createDataFrame(list(listed), SCHEMA))


def holds_any(hits: Column, kinds: Sequence[str]) -> Column:
    return F.arrays_overlap(hits, F.array(*map(F.lit, kinds)))
