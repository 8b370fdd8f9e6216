"""How filters act on each other: what each removes in every order of the five.

Four filters judge a text alone. The fifth asks whether a smaller id holds the same text, anywhere in the
table: rows are routed by the xxhash of their text, and where fingerprints meet, chains of
(full text, smallest id) tell equal texts from collisions. Each task first settles the copies
that it holds itself, so that a text goes out once a task however many rows hold it, and
whatever is not the smallest leaves the chains at once as a small row without text.

Small rows meet the labels by id. A part's rows become one vector of counts by
mask of failed filters and label (``combineByKey``), and all orders and steps are sums over that vector.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from gazetta.llm.common import column, spread

LETTERS = "ABCDE"
#: Bytes of text in a routed partition, and those that a task holds before it hands its chains on.
PART_BYTES, HELD_BYTES = 24 << 20, 24 << 20
_UPPER, _MARKS = bytes(range(65, 91)), b"#$%&*|"
COPY = 1 << LETTERS.index("E")


def failures(text: str) -> int:
    """Which of the filters A to D a text fails, as bits 0 to 3."""
    data = text.encode()
    words = data.split()
    mask = int(len(words) < 200) | int(100 * len(set(words)) < 50 * len(words)) << 1
    mask |= int(100 * (len(data) - len(data.translate(None, _UPPER))) > 3 * len(text)) << 2
    return mask | int(len(data.translate(None, _MARKS)) < len(data)) << 3


def _after(a: int | None, b: int | None) -> bool:
    """Ids in order; rows without one come last and are no smaller than each other."""
    return b is not None and (a is None or a > b)


class Chains:
    """For each fingerprint a chain of ``[text, smallest id, mask, {part: rows with that id}]``.

    ``add`` gives back the rows that turn out not to be the smallest of their text as
    ``(id, part, mask, rows)``; rows without an id are counted up and given back by ``rest``.
    """

    def __init__(self) -> None:
        self.chains: dict[int, list[list]] = {}
        self.nameless: dict[tuple[str, int], int] = defaultdict(int)
        self.bytes = 0

    def _lost(self, own: int | None, mask: int, parts: dict[str, int]) -> Iterator[tuple]:
        for part, n in parts.items():
            if own is None:
                self.nameless[part, mask | COPY] += n
            else:
                yield own, part, mask | COPY, n

    def add(self, fingerprint: int, text: bytes, own: int | None, mask: int, parts: dict[str, int]) -> Iterator[tuple]:
        chain = self.chains.setdefault(fingerprint, [])
        entry = next((e for e in chain if e[0] == text), None)
        if entry is None:
            chain.append([text, own, mask, parts])
            self.bytes += len(text) + 400
        elif _after(own, entry[1]):
            yield from self._lost(own, mask, parts)
        elif _after(entry[1], own):
            yield from self._lost(entry[1], mask, entry[3])
            entry[1], entry[3] = own, parts
        else:
            for part, n in parts.items():
                entry[3][part] = entry[3].get(part, 0) + n

    def rest(self) -> Iterator[tuple]:
        for (part, mask), n in self.nameless.items():
            yield None, part, mask, n
        self.nameless.clear()

    def least(self) -> Iterator[tuple]:
        for fingerprint, chain in self.chains.items():
            for text, own, mask, parts in chain:
                yield fingerprint, text, own, mask, parts
        self.chains, self.bytes = {}, 0


def _local(rows: Iterator[Row]) -> Iterator[tuple[int, tuple]]:
    """Key and value of what goes out: ``(text, id, mask, parts)`` by fingerprint, settled rows by a hash of their id."""
    chains = Chains()
    for own, part, fingerprint, text in rows:
        for lost in chains.add(fingerprint, text.encode(), own, failures(text), {part: 1}):
            yield hash(lost[0]), (None, *lost)
        if chains.bytes > HELD_BYTES:
            for fp, *value in chains.least():
                yield fp, tuple(value)
    for fp, *value in chains.least():
        yield fp, tuple(value)
    for n, row in enumerate(chains.rest()):
        yield n, (None, *row)


def _settled(routed: Iterator[tuple[int, tuple]]) -> Iterator[tuple]:
    chains = Chains()
    for key, value in routed:
        if value[0] is None:
            yield value[1:]
        else:
            yield from chains.add(key, *value)
    for _, _, own, mask, parts in chains.least():
        for part, n in parts.items():
            if own is None:
                chains.nameless[part, mask] += n
            else:
                yield own, part, mask, n
    yield from chains.rest()


def failed_filters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", bits: int = 64) -> DataFrame:
    """``id``, ``part``, ``mask`` of failed filters and ``n`` rows that are alike in them; ``bits`` of the fingerprint are used."""
    text = F.coalesce(column(docs, text_col), F.lit(""))
    base = docs.select(
        column(docs, id_col).cast("long").alias("id"),
        F.coalesce(column(docs, part_col).cast("string"), F.lit("")).alias("part"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - bits).alias("fingerprint"),
        text.alias("text"),
    )
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    routed = spread(base).rdd.mapPartitions(_local).partitionBy(n, lambda fingerprint: fingerprint)
    return docs.sparkSession.createDataFrame(routed.mapPartitions(_settled), "id long, part string, mask int, n long", verifySchema=False)


def _steps() -> tuple[list[tuple[str, int, int]], np.ndarray, np.ndarray, np.ndarray]:
    """Each order's steps, and which masks are kept, removed and redundant at it."""
    masks, names, kept, removed, redundant = np.arange(32), [], [], [], []
    for order in itertools.permutations(range(5)):
        before = 0
        for step, f in enumerate(order, 1):
            fails, gone = masks >> f & 1 == 1, masks & before > 0
            before |= 1 << f
            names.append(("".join(LETTERS[i] for i in order), step, f))
            kept.append(masks & before == 0)
            removed.append(fails & ~gone)
            redundant.append(fails & gone)
    return names, np.array(kept, np.int64), np.array(removed, np.int64), np.array(redundant, np.int64)


def interactions(part: str, counts: np.ndarray) -> list[tuple]:
    """The 600 rows of a part from its counts by mask, quality and toxicity (32 x 2 x 2)."""
    names, kept, removed, redundant = _steps()
    counts = counts.reshape(32, 2, 2)
    total, good, toxic = counts.sum(axis=(1, 2)), counts[:, 1].sum(axis=1), counts[:, :, 1].sum(axis=1)
    here = removed @ total
    shapley = [int(sum(here[i] for i, name in enumerate(names) if name[2] == f)) for f in range(5)]
    columns = [kept @ total, here, redundant @ total, [total[1 << f] for _, _, f in names], removed @ good, removed @ toxic, [shapley[f] for _, _, f in names]]
    return [(part, order, step, *(int(c[i]) for c in columns)) for i, (order, step, _) in enumerate(names)]


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", bits: int = 64) -> DataFrame:
    """One row a part, order of the filters and step.

    A: under 200 words; B: fewer than half of the words are distinct; C: over 3 % of the code points are A-Z;
    D: holds one of ``#$%&*|``; E: a smaller id holds the same text, whatever its part, removed or not.
    Columns: ``part``, ``filter_order``, ``step`` and the counts ``kept``, ``removed``, ``redundant``,
    ``unique_fails``, ``good_lost``, ``toxic_lost``, ``shapley``.

    A null text is the empty one, a null part the empty string. Rows without an id are behind all ids and no copies of each
    other; rows with one id and text are no copies of each other either, and all are counted. An id counts as good or toxic where any of its
    labels says so; null labels and ids say nothing. Parts without rows have no rows; an empty table gives none. Other columns are ignored.
    """
    rows = failed_filters(docs, id_col, text_col, part_col, bits)
    told = lambda c: F.max(F.coalesce(column(labels, c) == 1, F.lit(False)).cast("int"))
    known = labels.where(column(labels, id_col).isNotNull()).groupBy(column(labels, id_col).cast("long").alias("label_id")).agg(told("quality").alias("good"), told("toxic").alias("toxic")).hint("rebalance")
    cell = F.col("mask") * 4 + F.coalesce("good", F.lit(0)) * 2 + F.coalesce("toxic", F.lit(0))
    met = rows.join(known, F.col("id") == F.col("label_id"), "left").select("part", cell.cast("int").alias("cell"), "n")

    def put(counts: np.ndarray, value: tuple[int, int]) -> np.ndarray:
        counts[value[0]] += value[1]
        return counts

    vectors = met.rdd.map(lambda r: (r[0], (r[1], r[2]))).combineByKey(lambda v: put(np.zeros(128, np.int64), v), put, np.add)
    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return docs.sparkSession.createDataFrame(vectors.flatMap(lambda kv: interactions(*kv)), schema, verifySchema=False)


ORACLE = r"""
WITH t AS (
  SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * (min(t.doc_id) OVER (PARTITION BY text) < t.doc_id)::INT AS mask
  FROM t LEFT JOIN l ON l.doc_id = t.doc_id),
g AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
x AS (SELECT unnest([0, 1, 2, 3, 4]) AS f),
o AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS fs FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (
  SELECT array_to_string(list_transform(fs, lambda i: chr(65 + i)), '') AS filter_order, step, fs[step] AS f,
    coalesce(list_sum(list_transform(fs[1:step - 1], lambda i: 1 << i)), 0)::INT AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (
  SELECT part, filter_order, step::INT AS step, f,
    coalesce(sum(n) FILTER (WHERE (mask & (before | (1 << f))) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE ((mask >> f) & 1) = 1 AND (mask & before) = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE ((mask >> f) & 1) = 1 AND (mask & before) > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE mask = (1 << f)), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE ((mask >> f) & 1) = 1 AND (mask & before) = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE ((mask >> f) & 1) = 1 AND (mask & before) = 0), 0)::BIGINT AS toxic_lost
  FROM g, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley
FROM r
"""
