"""Line dedup with DataFrame functions only.

Lines are exploded with their positions, keyed (stripped, A-Z lower-cased) and
hashed to 128 bits. Documents are counted per hash after a map-side distinct, so
a line that a third of the corpus holds arrives as one row per map task. The
frequent hashes meet their occurrences in a sort-merge join whose two sides are
plain exchanges, which adaptive execution may split where a hash is hot. What
goes back to a document is the list of positions to drop, never text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import NO_ID, SPACE, ascii_lower, column, materialise, wide_key


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """Drop lines whose key at least ``min_docs`` documents hold, except in the smallest id.

    Returns one row per input row: id, ``n_lines``, ``n_dropped``, ``kept_text``.

    A null or empty text is one empty line. Keys under ``min_chars`` code points
    are never dropped. Rows that share an id count as one document and each gets
    its own result; rows without an id count as one document behind all others.
    An empty table gives an empty result; other columns are ignored.
    """
    base = docs.select(
        column(docs, id_col).cast("long").alias("id"), F.coalesce(column(docs, text_col), F.lit("")).alias("text")
    ).withColumns({"owner": F.coalesce("id", F.lit(NO_ID)), "th": F.xxhash64("text")})
    lines = base.select("owner", "th", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = lines.select("owner", "th", "pos", F.btrim("line", F.lit(SPACE)).alias("key"))
    keyed = keyed.where(F.char_length("key") >= min_chars).withColumn("key", ascii_lower(F.col("key")))
    h1, h2 = wide_key(F.col("key"))
    found = materialise(keyed.select(h1.alias("h1"), h2.alias("h2"), "owner", "th", "pos"))

    holders = found.groupBy("h1", "h2", "owner").agg(F.lit(1).alias("one"))
    frequent = holders.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("owner").alias("first"))
    frequent = frequent.where(F.col("n") >= min_docs).select("h1", "h2", "first").hint("rebalance")
    drops = (
        found.join(frequent, ["h1", "h2"])
        .where(F.col("owner") != F.col("first"))
        .groupBy("owner", "th")
        .agg(F.collect_set("pos").alias("gone"))
    )
    lines = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    return (
        base.join(drops, ["owner", "th"], "left")
        .withColumn("lines", lines)
        .withColumn("n_lines", F.size("lines"))
        .withColumn("kept", kept)
        .select(
            F.col("id").alias(id_col),
            F.col("n_lines").cast("long").alias("n_lines"),
            (F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"),
            F.when(F.col("gone").isNull(), F.col("text"))
            .otherwise(F.array_join(F.transform("kept", lambda i: F.col("lines")[i]), "\n"))
            .alias("kept_text"),
        )
    )


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.doc_id, k.pos, k.line, coalesce(f.first <> k.doc_id, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
