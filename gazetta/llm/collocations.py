"""Phrases that occur together more often than their parts explain: PCY and DHP passes, then exact counts.

Pass 1 counts words exactly and all two-word phrases by bucket. Pass k counts the phrases of k words
exactly whose bucket reached the least count and whose two parts of k-1 words are frequent (Apriori), and counts by bucket
the phrases of one word more that can still be frequent. What is broadcast are bitmaps of bounded size: buckets that reached the
count, and hashes of the frequent phrases of the pass before. Either lets through too much at worst, never too little, and
what comes through is counted as text, so that results are exact.

Tasks add up their own counts before anything is shuffled: one row for each phrase that a stretch of text
holds, and the cells of the buckets as packed deltas. All frequent phrases lie in one table of
counts; cuts of a candidate meet it by joins of plain exchanges, which adaptive execution may split.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazetta.llm.common import column, find_words, lowered, materialise, mix, spread, text_bytes

#: Bytes that end a piece, beside the end of a text.
_BREAK = np.isin(np.arange(256), [ord(c) for c in ".,;:!?\n\x0b\x0c\r"])
#: Bytes of text counted at a time, phrases held before they are handed on, cells of a sketch held before that.
STEP, HELD, FLUSH = 1 << 19, 200_000, 1_000_000
#: Slices of a bitmap, the bounds of log2 of its bits, and bytes of text for a bit.
SLICE_BITS, LEAST_BITS, MOST_BITS, BYTES_A_BIT = 6, 16, 28, 8
#: Counts of buckets stop here where ``least`` is higher: more comes through to the exact count.
MOST_COUNT = 30_000
#: Salts of the first of two rankings: the second one ranks at most so many times the rows wanted.
SALTS = 32


def bitmap_bits(text_size: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, (max(1, text_size // BYTES_A_BIT) - 1).bit_length()))


def extend(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase and one word more."""
    with np.errstate(over="ignore"):
        return mix(phrase * np.uint64(0x9E3779B97F4A7C15) + word)


def cells_of(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def has(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    cells = cells_of(h, bits)
    return bitmap[cells >> 3] >> (cells & 7).astype(np.uint8) & 1 == 1


def pack_counts(cells: np.ndarray, counts: np.ndarray, least: int) -> bytes:
    """Sorted cells as deltas of the least width, and after them the counts up to ``least``."""
    delta = np.diff(cells, prepend=0)
    wide = 2 if len(delta) == 0 or delta.max() < 1 << 16 else 4
    return bytes([wide]) + delta.astype(f"<u{wide}").tobytes() + np.minimum(counts, least).astype("<u2").tobytes()


def unpack_counts(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = (len(blob) - 1) // (blob[0] + 2)
    return np.cumsum(np.frombuffer(blob, f"<u{blob[0]}", n, 1).astype(np.int64)), np.frombuffer(blob, "<u2", n, 1 + n * blob[0])


def _slices(hashes: list[np.ndarray], bits: int, least: int) -> Iterator[tuple[int, bytes]]:
    local = bits - SLICE_BITS
    cells, counts = np.unique(cells_of(np.concatenate(hashes), bits), return_counts=True)
    edges = np.searchsorted(cells, np.arange(0, (1 << SLICE_BITS) + 1) << local)
    for s, (lo, hi) in enumerate(itertools.pairwise(edges)):
        if hi > lo:
            yield s, pack_counts(cells[lo:hi] - (s << local), counts[lo:hi], least)


def stretches(data: np.ndarray, bounds: np.ndarray, step: int) -> Iterator[tuple[int, int]]:
    """Parts of about ``step`` bytes that begin and end where a piece or a text does, so that no phrase is cut."""
    start, end = 0, len(data)
    while start < end:
        stop = start + step
        if stop < end:
            text = bounds[np.searchsorted(bounds, stop)]
            ahead = end
            for at in range(stop, int(text), step):
                found = np.flatnonzero(_BREAK[data[at : at + step]])
                if len(found):
                    ahead = at + int(found[0]) + 1
                    break
            stop = min(int(text), ahead)
        yield start, min(stop, end)
        start = min(stop, end)


class Counter:
    """Sums by (lang, phrase) over some stretches of text, added up by Arrow whenever enough rows have come together."""

    def __init__(self) -> None:
        self.parts: list[pa.Table] = []
        self.rows = 0

    def add(self, lang: pa.Array, phrases: pa.Array, counts: np.ndarray) -> None:
        self.parts.append(pa.table({"lang": lang, "phrase": phrases, "n": pa.array(counts.astype(np.int64))}))
        self.rows += len(counts)

    def added(self) -> None:
        if len(self.parts) > 1:
            whole = pa.concat_tables(self.parts).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
            self.parts = [whole.select(["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "n"])]
        self.rows = sum(p.num_rows for p in self.parts)

    def batches(self) -> Iterator[pa.RecordBatch]:
        self.added()
        for part in self.parts:
            for batch in part.to_batches(max_chunksize=50_000):
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), *batch.columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], NAMES)
        self.parts, self.rows = [], 0


NAMES = ["kind", "lang", "phrase", "n", "slice", "cells"]
SCHEMA = "kind int, lang string, phrase string, n long, slice int, cells binary"


def _cell_batch(found: list[np.ndarray], bits: int, least: int) -> Iterator[pa.RecordBatch]:
    parts = list(_slices(found, bits, least))
    n = len(parts)
    yield pa.RecordBatch.from_arrays([pa.array([1] * n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.array([s for s, _ in parts], pa.int32()), pa.array([b for _, b in parts], pa.binary())], NAMES)


def lang_salts(langs: list[str]) -> np.ndarray:
    """A hash of each language, the same in all tasks."""
    words = find_words(pa.array([lang.encode().hex() or "-" for lang in langs], pa.string()))
    return mix(words.hashes[0])


def phrase_hashes(langs: pa.Array, phrases: pa.Array) -> np.ndarray:
    """The hash that pass k gives to each phrase: the words' own hashes, extended from the left; all phrases have as many words."""
    words = find_words(phrases, breaks=_BREAK)
    n = len(phrases)
    if not n:
        return np.zeros(0, np.uint64)
    each = words.hashes[0].reshape(n, -1)
    names = langs.dictionary_encode()
    h = extend(lang_salts(names.dictionary.to_pylist())[names.indices.to_numpy(zero_copy_only=False)], each[:, 0])
    for k in range(1, each.shape[1]):
        h = extend(h, each[:, k])
    return h


def _count(size: int, longest: int, least: int, bits: int, buckets, frequent):
    """Pass ``size``: rows of exact counts (kind 0) and of bucket counts for one word more (kind 1)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(buckets.value, np.uint8) if buckets is not None else None
        known = np.frombuffer(frequent.value, np.uint8) if frequent is not None else None
        counter, cells, held = Counter(), [], 0
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            names = batch.column("lang").dictionary_encode()
            langs, of_row = names.dictionary.to_pylist(), names.indices.to_numpy(zero_copy_only=False)
            salts = lang_salts(langs)
            for lo, hi in stretches(data, bounds, STEP):
                part = lowered(data[lo:hi])
                own = np.clip(bounds, lo, hi) - lo
                first, last = np.searchsorted(bounds, lo, "right") - 1, np.searchsorted(bounds, hi)
                texts = pa.Array.from_buffers(pa.string(), int(last - first), [None, pa.py_buffer(own[first : last + 1].astype(np.int32)), pa.py_buffer(part)])
                words = find_words(texts, breaks=_BREAK)
                many = len(words.starts)
                if not many:
                    continue
                doc = np.repeat(np.arange(last - first), np.diff(words.offsets)) + first
                lang = of_row[doc].astype(np.int64)
                # Words as numbers: equal numbers are equal words, not just equal hashes.
                inside = np.zeros(len(part) + 1, np.int8)
                inside[words.starts] += 1
                inside[words.ends] -= 1
                packed = part[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
                ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int32)
                coded = pa.Array.from_buffers(pa.string(), many, [None, pa.py_buffer(ends), pa.py_buffer(packed)]).dictionary_encode()
                vocabulary, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                piece = np.cumsum(_BREAK[part])[words.starts] + doc
                # Piece numbers grow with every break and every text, so equal numbers are one piece.
                h = words.hashes[0]
                joined = [np.ones(many, bool)]
                for k in range(1, longest):
                    joined.append(np.concatenate([piece[k:] == piece[:-k], np.zeros(min(k, many), bool)])[:many] if many > k else np.zeros(many, bool))
                hashes = [extend(salts[lang], h)]
                for k in range(1, size + 1):
                    if k < longest:
                        hashes.append(extend(hashes[k - 1], np.concatenate([h[k:], np.zeros(min(k, many), np.uint64)])[:many]))
                ok = joined[size - 1].copy()
                if known is not None:
                    # Both parts of one word less must be frequent; the right part's hash starts one word on.
                    frequent_at = joined[size - 2] & has(known, hashes[size - 2], bits)
                    ok &= frequent_at & np.concatenate([frequent_at[1:], [False]])
                if seen is not None:
                    ok &= has(seen, hashes[size - 1], bits)
                if size < longest:
                    # One word more can only be frequent if both of its parts came through.
                    alone = np.flatnonzero(joined[size] & ok & np.concatenate([ok[1:], [False]]))
                    if len(alone):
                        cells.append(hashes[size][alone])
                        held += len(alone)
                at = np.flatnonzero(ok)
                if len(at):
                    # (lang, words) as one number, made distinct word by word.
                    key = lang[at] * len(vocabulary) + code[at]
                    for k in range(1, size):
                        key = np.unique(key, return_inverse=True)[1] * len(vocabulary) + code[at + k]
                    _, index, counts = np.unique(key, return_index=True, return_counts=True)
                    where = at[index]
                    phrase = vocabulary.take(pa.array(code[where]))
                    for k in range(1, size):
                        phrase = pc.binary_join_element_wise(phrase, vocabulary.take(pa.array(code[where + k])), " ")
                    counter.add(names.dictionary.take(pa.array(lang[where])), phrase, counts)
                if held > FLUSH:
                    yield from _cell_batch(cells, bits, least)
                    cells, held = [], 0
                if counter.rows > 2 * HELD:
                    counter.added()
                    if counter.rows > HELD:
                        yield from counter.batches()
        if cells:
            yield from _cell_batch(cells, bits, least)
        yield from counter.batches()

    return work


def _merge(bits: int, least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, blob in zip(batch.column("slice").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                own = counts.setdefault(s, np.zeros(1 << (bits - SLICE_BITS), np.uint16))
                cells, many = unpack_counts(blob)
                own[cells] = np.minimum(least, own[cells] + many)
        for s, own in counts.items():
            blob = np.packbits(own >= least, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([blob], pa.binary())], ["slice", "bits"])

    return work


def _bitmap(parts: DataFrame, bits: int, least: int):
    """The broadcast bits of the cells that reach ``least``: at most 2^MOST_BITS of them."""
    spark = parts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = np.zeros((1 << SLICE_BITS, (1 << (bits - SLICE_BITS)) // 8), np.uint8)
    for r in parts.select("slice", "cells").repartition(n, "slice").mapInArrow(_merge(bits, least), "slice int, bits binary").collect():
        out[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return spark.sparkContext.broadcast(out.tobytes())


def _frequent_bits(counts: DataFrame, bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(_slices([phrase_hashes(batch.column("lang"), batch.column("phrase"))], bits, 1))
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in parts], pa.int32()), pa.array([b for _, b in parts], pa.binary())], ["slice", "cells"])

    return _bitmap(counts.select("lang", "phrase").mapInArrow(work, "slice int, cells binary"), bits, 1)


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of 1 to ``longest`` words (``lang``, ``size``, ``phrase``, ``f``), and all words a language (``lang``, ``n``)."""
    base = docs.select(F.coalesce(column(docs, lang_col).cast("string"), F.lit("und")).alias("lang"), column(docs, text_col).alias("text")).where("text <> ''")
    bits = bitmap_bits(base.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    base = spread(base)
    tables, buckets, frequent, totals, mark = [], None, None, None, min(least, MOST_COUNT)
    for size in range(1, longest + 1):
        found = materialise(base.mapInArrow(_count(size, longest, mark, bits, buckets, frequent), SCHEMA))
        counts = found.where("kind = 0")
        if size == 1:
            totals = materialise(counts.groupBy("lang").agg(F.sum("n").alias("n")))
        counts = materialise(counts.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least).select("lang", F.lit(size).alias("size"), "phrase", "f"))
        tables.append(counts)
        if size < longest:
            buckets, frequent = _bitmap(found.where("kind = 1"), bits, mark), _frequent_bits(counts, bits)
    table = tables[0]
    for more in tables[1:]:
        table = table.unionByName(more)
    return table, totals


def _words(a: int, n: int) -> F.Column:
    """Words ``a`` to ``a + n - 1`` of a phrase, space-joined."""
    return F.array_join(F.slice(F.split("phrase", " "), a + 1, n), " ")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10, covered: int = 50, most: int = 2000) -> DataFrame:
    """The best phrases of 2 to ``longest`` words in each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A-Z are lower-cased, texts end pieces as ``[.,;:!?\\x0A-\\x0D]`` do, and words are ``[^\\x20\\x09]+``. Candidates occur at
    least ``least`` times. Their score is that of the cut with the least one (ties: the leftmost), 1,000,000 a a / (l r) rounded down.
    A candidate inside a longer one with at least ``covered`` percent of its count is left out. Order: score, count, then the phrase's bytes.

    Null texts are empty, a null language is ``und``; repeated rows count as often as they come. A language without
    candidates has no rows, an empty table none. Other columns are ignored. Arithmetic is on decimals of 38 digits: exact for counts below 10^15.
    """
    table, totals = phrase_counts(docs, text_col, lang_col, longest, least)
    candidates = table.where("size > 1")
    inner = None
    for size in range(3, longest + 1):
        for own in range(2, size):
            for at in range(size - own + 1):
                part = candidates.where(F.col("size") == size).select("lang", _words(at, own).alias("inside"), F.col("f").alias("longer"))
                inner = part if inner is None else inner.unionByName(part)
    if inner is not None:
        longer = inner.groupBy("lang", "inside").agg(F.max("longer").alias("longer")).hint("rebalance")
        hidden = candidates.join(longer.withColumnRenamed("inside", "phrase"), ["lang", "phrase"], "left")
        candidates = hidden.where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("f"))).select("lang", "size", "phrase", "f")
    cuts = None
    for size in range(2, longest + 1):
        for k in range(1, size):
            part = candidates.where(F.col("size") == size).select("lang", "phrase", F.col("f").alias("a"), F.lit(k).alias("k"), _words(0, k).alias("left"), _words(k, size - k).alias("right"))
            cuts = part if cuts is None else cuts.unionByName(part)
    cuts = materialise(cuts)
    left = table.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = table.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.expr("(CAST(1000000 AS DECIMAL(7,0)) * (w * w)) div (wl * wr)").cast("long")
    met = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumns({"w": wide("a"), "wl": wide("l"), "wr": wide("r")}).withColumn("score", score)
    best = met.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt")
    first = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("rank") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM d),
g AS (
  SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM p, (SELECT unnest([1, 2, 3]) AS size))),
c AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE size = 1 GROUP BY lang),
q AS (SELECT lang, size, phrase, f, string_split(phrase, ' ') AS ws FROM c WHERE size > 1 AND f >= 10),
i AS (
  SELECT lang, inside, max(f) AS longer
  FROM (SELECT lang, f, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS inside FROM q WHERE size = 3) GROUP BY ALL),
v AS (SELECT q.* FROM q LEFT JOIN i ON i.lang = q.lang AND i.inside = q.phrase WHERE longer IS NULL OR 100 * longer < 50 * f),
k AS (SELECT *, unnest(range(1, size)) AS k FROM v),
s AS (
  SELECT k.lang, k.phrase, k.f AS a, k.k, x.f AS l, y.f AS r,
    (1000000::HUGEINT * k.f * k.f // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM k JOIN c x ON x.lang = k.lang AND x.phrase = array_to_string(ws[1:k.k], ' ')
  JOIN c y ON y.lang = k.lang AND y.phrase = array_to_string(ws[k.k + 1:k.size], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
FROM b JOIN n USING (lang) QUALIFY rank <= 2000
"""
