"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Tokens are summed per cell of source, language and topic, the table is raked: each
step scales the cells so that one of the three marginals meets its target, round by
round. What comes out is a weight for each cell, its target share of the tokens of
the mixture. Documents are then kept with the calibrated probability of their cell,
by a hash of their id, so that the same documents stay in every run.

Every source has a target of its own, and there may be any number of sources. The table
that is raked has one row a source with its tokens for each language and topic: the
factor of a source follows from its row, so a round is one sum over the rows. What the
driver sees is a number for each pair of language and topic. Spark broadcasts the weights back to the
documents while their size allows, and shuffles beyond.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import column, materialise

#: Production parameters: rounds, the power that tempers the shares of sources.
ROUNDS, TEMPER = 12, 0.5
LANGUAGES = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}
TOPICS = {"short": 0.03, "medium": 0.55, "long": 0.42}
REST = "(rest)"


def topic(n_tokens: Column) -> Column:
    """The tables name no topics; the kind of text by its length stands in for one."""
    return F.when(n_tokens < 100, "short").when(n_tokens < 1000, "medium").otherwise("long")


def count_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(key: Column) -> Column:
    """A number in [0, 1) that only the key decides."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def rake_rows(cells: DataFrame, targets: tuple[dict[str, float] | None, ...], temper: float, rounds: int) -> DataFrame:
    """Cells (source, lang_class, topic, w, p) raked to all sources: a row a source, a sum over the rows each round."""
    sums = {(r["lang_class"], r["topic"]): float(r["t"]) for r in cells.groupBy("lang_class", "topic").agg(F.sum("tokens").alias("t")).collect()}
    pairs, total = sorted(sums), sum(sums.values())
    if not pairs:
        return cells.select("source", "lang_class", "topic", F.lit(0.0).alias("w"), F.lit(1.0).alias("p"))
    wanted, factor = [], []
    for i, given in enumerate(targets):
        own: dict[str, float] = {}
        for pair, t in sums.items():
            own[pair[i]] = own.get(pair[i], 0.0) + t
        share = {k: (given or {}).get(k, t / total) for k, t in own.items()}
        wanted.append({k: v / sum(share.values()) for k, v in share.items()})
        factor.append(dict.fromkeys(own, 1.0))
    cell = [F.coalesce(F.sum(F.when((F.col("lang_class") == x) & (F.col("topic") == y), F.col("tokens"))), F.lit(0)).cast("double").alias(f"m{i}") for i, (x, y) in enumerate(pairs)]
    table = cells.groupBy("source").agg(F.pow(F.sum("tokens").cast("double"), F.lit(temper)).alias("t"), *cell)
    table = materialise(table)
    scale = table.agg(F.sum("t")).first()[0]
    own_factor = F.lit(1.0)
    for _ in range(rounds):
        product = [F.col(f"m{i}") * F.lit(factor[0][x] * factor[1][y]) for i, (x, y) in enumerate(pairs)]
        own_factor = F.col("t") / F.lit(scale) / sum(product[1:], product[0])
        found = table.select(*((c * own_factor).alias(f"s{i}") for i, c in enumerate(product))).agg(*(F.sum(f"s{i}") for i in range(len(pairs)))).first()
        marginal = dict(zip(pairs, found, strict=True))
        for i in (0, 1):
            for k in factor[i]:
                step = wanted[i][k] / sum(v for pair, v in marginal.items() if pair[i] == k)
                factor[i][k] *= step
                marginal = {pair: v * step if pair[i] == k else v for pair, v in marginal.items()}
    each = F.array(*(F.struct(F.lit(x).alias("lang_class"), F.lit(y).alias("topic"), F.col(f"m{i}").alias("tokens"), (F.col("own") * F.lit(factor[0][x] * factor[1][y])).alias("ratio")) for i, (x, y) in enumerate(pairs)))
    base = F.lit(1.0 / total) if not rounds else own_factor
    told = materialise(table.withColumn("own", base).select("source", F.explode(each).alias("c")).select("source", "c.*").where("tokens > 0"))
    most = told.agg(F.max("ratio")).first()[0]
    return told.select("source", "lang_class", "topic", (F.col("ratio") * F.col("tokens")).alias("w"), (F.col("ratio") / F.lit(most)).alias("p"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    languages: dict[str, float] | None = None,
    topics: dict[str, float] | None = None,
    temper: float = TEMPER,
    rounds: int = ROUNDS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Calibrated probabilities and a sample of the documents.

    Returns one row per input row: id, ``source``, ``lang``, ``topic``, ``n_tokens``,
    ``weight`` (target share of the cell), ``probability`` (of the document) and ``sampled``.

    The cell that is most wanted, against what there is of it, keeps all its documents;
    every other cell keeps the part that gives it its share. Every source has a target;
    null sources are one source ``(rest)``. Null languages, and those without a target, form a class
    ``(rest)`` that keeps its natural share. Cells without tokens (empty texts) have probability 1: they weigh nothing.
    Rows without an id share one draw. No rows, no result; extra columns are ignored but
    for those named in ``carry``, which follow as a struct ``row``.
    """
    languages, topics = languages or LANGUAGES, topics or TOPICS
    n = count_tokens(column(docs, text_col))
    row = F.struct(*(column(docs, c) for c in carry)) if carry else F.lit(0)
    base = docs.select(column(docs, id_col).cast("long").alias("id"), F.coalesce(column(docs, source_col), F.lit(REST)).alias("source"), F.coalesce(column(docs, lang_col), F.lit(REST)).alias("lang"), n.alias("n_tokens"), row.alias("row"))
    lang_class = F.when(F.col("lang").isin(list(languages)), F.col("lang")).otherwise(REST)
    base = base.withColumns({"lang_class": lang_class, "topic": topic(F.col("n_tokens"))})
    if not carry:  # without the texts the table is narrow: words are counted once
        base = materialise(base)
    names = ["source", "lang_class", "topic"]
    cells = materialise(base.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"))
    told = base.join(rake_rows(cells, (languages, topics), temper, rounds), names, "left")
    p = F.round(F.coalesce("p", F.lit(1.0)), 9)
    return told.select(
        F.col("id").alias(id_col),
        "source",
        "lang",
        "topic",
        "n_tokens",
        F.round(F.coalesce("w", F.lit(0.0)), 9).alias("weight"),
        p.alias("probability"),
        (uniform(F.coalesce("id", F.lit(-1))) < p).alias("sampled"),
        *(["row"] if carry else []),
    )


def oracle(rounds: int = ROUNDS) -> str:
    """The same in DuckDB's SQL, for a table whose languages and sources all have targets or none."""
    names = ("source", "lang_class", "topic")
    cases = [f"CASE {n} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in t.items()) + " ELSE s / total END" for n, t in (("lang_class", LANGUAGES), ("topic", TOPICS))]
    listed = ", ".join(f"'{k}'" for k in LANGUAGES)
    parts = [
        "b AS MATERIALIZED (SELECT doc_id, coalesce(source, '(rest)') AS source, coalesce(lang, '(rest)') AS lang, "
        "len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents)",
        f"d AS MATERIALIZED (SELECT *, CASE WHEN lang IN ({listed}) THEN lang ELSE '(rest)' END AS lang_class, "
        "CASE WHEN n_tokens < 100 THEN 'short' WHEN n_tokens < 1000 THEN 'medium' ELSE 'long' END AS topic FROM b)",
        "c AS MATERIALIZED (SELECT source, lang_class, topic, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY ALL HAVING sum(n_tokens) > 0)",
    ]
    for name, wanted in zip(names, (f"pow(s, {TEMPER})", *cases), strict=True):
        parts.append(f"r_{name} AS MATERIALIZED (SELECT {name}, {wanted} AS t FROM (SELECT {name}, sum(tokens) AS s, (SELECT sum(tokens) FROM c) AS total FROM c GROUP BY {name}))")
        parts.append(f"t_{name} AS MATERIALIZED (SELECT {name}, t / (SELECT sum(t) FROM r_{name}) AS t FROM r_{name})")
    parts.append("w0 AS MATERIALIZED (SELECT *, tokens / (SELECT sum(tokens) FROM c) AS w FROM c)")
    k = 0
    for _ in range(rounds):
        for name in names:
            parts.append(f"w{k + 1} AS MATERIALIZED (SELECT v.* REPLACE (v.w * t.t / sum(v.w) OVER (PARTITION BY v.{name}) AS w) FROM w{k} v JOIN t_{name} t USING ({name}))")
            k += 1
    parts.append(f"f AS (SELECT *, (w / tokens) / (SELECT max(w / tokens) FROM w{k}) AS p FROM w{k})")
    return (
        "WITH " + ", ".join(parts) + " SELECT doc_id, source, lang, topic, n_tokens, round(coalesce(w, 0), 9) AS weight, round(coalesce(p, 1), 9) AS probability, "
        "('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < round(coalesce(p, 1), 9) AS sampled FROM d LEFT JOIN f USING (source, lang_class, topic)"
    )
