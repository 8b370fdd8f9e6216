"""Substring dedup: a count-min prefilter over windows, then exact groups of what it lets through.

Every window of ``window`` words is counted under its anchor, the least-hashed run
of ``run`` words inside it. Equal windows have equal anchors at different places,
so an anchor's count is at least its windows' count, and about one place in
twelve is an anchor: the sketch is that much smaller than one over all windows.

Texts that occur more than once are taken once: all their windows repeat anyway, and
one of them stands for all where other texts share windows. Rows whose text may occur
again are told by a bitmap over text hashes (counted as below, bounded in size); only
those rows, about as many as there are copies, are shuffled with their texts.

1. Each task sketches its own part: the cells of its anchors, two rows of a
   count-min sketch, as sorted deltas per slice of the sketch. Tasks that own a
   slice add up the parts, count by count up to 2, and return the cells that
   reach 2 as bits. The sketch has about eight cells an anchor and at most
   ``2**MOST_BITS`` a row: what is broadcast has a fixed bound (two rows of bits).
   A full sketch lets more through and loses nothing.
2. Only windows whose anchor may repeat are written out with a 96-bit hash. Their
   counts come from a partial aggregate; the hashes that occur twice meet their
   windows in a sort-merge join of plain exchanges, which may be split where one
   window is hot. Starts come back as 64-bit masks, pre-aggregated.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import chunks, column, find_words, materialise, mix, run_hashes, run_starts, wide_key

RUN = 12
BASES = (0xA24BAED4963EE407, 0x9FB21C651E98DF25)
#: Rows of the sketch, its slices, and the bounds of log2 of a row's cells.
ROWS, SLICE_BITS, LEAST_BITS, MOST_BITS = 2, 6, 16, 28
#: Bytes of text for which a sketch has about eight cells an anchor.
BYTES_PER_CELL = 10
#: Anchors that a task sketches before it hands its cells on.
FLUSH = 2_000_000


def _anchors(h: np.ndarray, starts: np.ndarray, window: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start the position and hash of the leftmost least run in it."""
    g = run_hashes(h, run, BASES[0])
    need = window - run + 1
    value, at, span = g, np.arange(len(g)), 1
    while span < need:
        shift = min(span, need - span)
        a, b = value[: len(value) - shift], value[shift:]
        left = a <= b
        at = np.where(left, at[: len(at) - shift], at[shift:])
        value = np.where(left, a, b)
        span += shift
    return at[starts], value[starts]


def _cells(anchor: np.ndarray, row: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(anchor + np.uint64(0x632BE59BD9B4E019 * (row + 1) & (1 << 64) - 1)) >> np.uint64(64 - bits)).astype(np.int64)


def pack_cells(cells: np.ndarray, twice: np.ndarray) -> bytes:
    """Sorted cells as deltas of the least width, each with a bit for a count of two or more."""
    delta = np.diff(cells, prepend=0) * 2 + twice
    wide = 2 if len(delta) == 0 or delta.max() < 1 << 16 else 4
    return bytes([wide]) + delta.astype(f"<u{wide}").tobytes()


def unpack_cells(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    delta = np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int64)
    return np.cumsum(delta >> 1), (delta & 1).astype(np.uint8)


def _single(batch: pa.RecordBatch, texts: bytes, bits: int) -> np.ndarray:
    """Rows that are the only one of their text, or stand for all of them."""
    return _surely_once(batch, texts, bits) | batch.column("rep").to_numpy(zero_copy_only=False)


def _surely_once(batch: pa.RecordBatch, texts: bytes, bits: int) -> np.ndarray:
    cells = batch.column("t1").to_numpy().view(np.uint64) >> np.uint64(64 - bits)
    again = np.frombuffer(texts, np.uint8)[(cells >> np.uint64(3)).astype(np.int64)]
    return again >> (cells & np.uint64(7)).astype(np.uint8) & 1 == 0


def _copies(bits: int, texts):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~_surely_once(batch, texts.value, bits)))

    return work


def _text_cells(bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = bits - SLICE_BITS
        for batch in batches:
            cells, counts = np.unique((batch.column("t1").to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
            edges = np.searchsorted(cells, np.arange(0, (1 << SLICE_BITS) + 1) << local)
            for s, (lo, hi) in enumerate(itertools.pairwise(edges)):
                if hi > lo:
                    blob = pack_cells(cells[lo:hi] - (s << local), counts[lo:hi] > 1)
                    yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([blob], pa.binary())], ["slice", "cells"])

    return work


def _sketch(window: int, run: int, bits: int, text_bits: int, texts):
    local = bits - SLICE_BITS

    def parts(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        anchor = np.concatenate(found)
        for row in range(ROWS):
            cells, counts = np.unique(_cells(anchor, row, bits), return_counts=True)
            edges = np.searchsorted(cells, np.arange(0, (1 << SLICE_BITS) + 1) << local)
            for s, (lo, hi) in enumerate(itertools.pairwise(edges)):
                if hi > lo:
                    blob = pack_cells(cells[lo:hi] - (s << local), counts[lo:hi] > 1)
                    yield pa.RecordBatch.from_arrays([pa.array([row << SLICE_BITS | s], pa.int32()), pa.array([blob], pa.binary())], ["slice", "cells"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in chunks(batches):
            batch = batch.filter(pa.array(_single(batch, texts.value, text_bits)))
            words = find_words(batch.column("text"))
            starts = run_starts(words.offsets, window)
            if not len(starts):
                continue
            at, value = _anchors(words.hashes[0], starts, window, run)
            new = np.concatenate([[True], at[1:] != at[:-1]])
            found.append(value[new])
            held += len(found[-1])
            if held > FLUSH:
                yield from parts(found)
                found, held = [], 0
        if found:
            yield from parts(found)

    return work


def _merge(bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, blob in zip(batch.column("slice").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                own = counts.setdefault(s, np.zeros(1 << (bits - SLICE_BITS), np.uint8))
                cells, twice = unpack_cells(blob)
                own[cells] = np.minimum(2, own[cells] + 1 + twice)
        for s, own in counts.items():
            blob = np.packbits(own > 1, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([blob], pa.binary())], ["slice", "bits"])

    return work


def _suspects(window: int, run: int, bits: int, sketch, text_bits: int, texts):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = np.frombuffer(sketch.value, np.uint8).reshape(ROWS, -1)
        for batch in chunks(batches):
            batch = batch.filter(pa.array(_single(batch, texts.value, text_bits)))
            words = find_words(batch.column("text"), hashes=2)
            starts = run_starts(words.offsets, window)
            if not len(starts):
                continue
            at, value = _anchors(words.hashes[0], starts, window, run)
            new = np.concatenate([[True], at[1:] != at[:-1]])
            hit = np.ones(int(new.sum()), bool)
            for row in range(ROWS):
                cells = _cells(value[new], row, bits)
                hit &= (repeated[row][cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)
            starts = starts[hit[np.cumsum(new) - 1]]
            if not len(starts):
                continue
            doc = np.searchsorted(words.offsets, starts, "right") - 1
            second = run_hashes(words.hashes[1], window, BASES[1])[starts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("t1").take(pa.array(doc)),
                    batch.column("t2").take(pa.array(doc)),
                    pa.array(run_hashes(words.hashes[0], window, BASES[1])[starts].view(np.int64)),
                    # The second half of the hash above the start: one field less in every shuffled row.
                    pa.array(second.view(np.int64) & ~np.int64(0xFFFFFFFF) | (starts - words.offsets[doc])),
                ],
                ["t1", "t2", "w1", "w2_start"],
            )

    return work


def covered(blocks: list[int], masks: list[int], n: int, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at a set bit (64 starts a block)."""
    edge = np.zeros(n + 1, np.int64)
    bits = np.unpackbits(np.array(masks, "<i8").view(np.uint8).reshape(len(masks), 8), axis=1, bitorder="little")
    which, offset = np.nonzero(bits)
    starts = np.array(blocks, np.int64)[which] * 64 + offset
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge)[:n] > 0


def _rebuild(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            out = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("text", "whole", "blocks", "masks")), strict=True)
            for text, whole, blocks, masks in rows:
                words = (text or "").encode().split()
                if whole:
                    kept = words if len(words) < window else []
                elif blocks:
                    gone = covered(blocks, masks, len(words), window)
                    kept = list(itertools.compress(words, (~gone).tolist()))
                else:
                    kept = words
                out.append((len(words), len(words) - len(kept), b" ".join(kept)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([x[0] for x in out], pa.int64()),
                    pa.array([x[1] for x in out], pa.int64()),
                    pa.array([x[2] for x in out], pa.binary()).cast(pa.string()),
                ],
                ["id", "n_words", "n_removed", "kept_text"],
            )

    return work


def sketch_bits(text_bytes: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, (max(1, text_bytes // BYTES_PER_CELL) - 1).bit_length()))


def _repeated(parts: DataFrame, bits: int, rows: int) -> bytes:
    """Merge partition sketches into one bit for each cell that reaches a count of two."""
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = parts.repartition(n, "slice").mapInArrow(_merge(bits), "slice int, bits binary")
    out = np.zeros((rows << SLICE_BITS, (1 << (bits - SLICE_BITS)) // 8), np.uint8)
    for r in merged.collect():  # at most rows * 2**bits bits
        out[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes()


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, run: int = RUN) -> DataFrame:
    """Remove every word that a repeated window of ``window`` words covers.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A window repeats when its word
    sequence starts anywhere else, in the same document too; all windows are judged
    on the input. Returns one row per input row: id, ``n_words``, ``n_removed``,
    ``kept_text`` (kept words joined by one space).

    Null and empty texts have no words. Each row is a document of its own, also
    where rows share an id or have none, so repeated rows remove each other's
    windows. An empty table gives an empty result; other columns are ignored.
    """
    spark, cells = docs.sparkSession, "slice int, cells binary"
    base = docs.select(column(docs, id_col).cast("long").alias("id"), column(docs, text_col).alias("text"))
    t1, t2 = wide_key(F.coalesce("text", F.lit("")))
    base = base.withColumns({"t1": t1, "t2": t2})
    size, count = base.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    bits, text_bits = sketch_bits(size or 0), sketch_bits(BYTES_PER_CELL * 8 * count)
    again = spark.sparkContext.broadcast(_repeated(base.select("t1").mapInArrow(_text_cells(text_bits), cells), text_bits, 1))

    keyed = base.select("t1", "t2", "text")
    copies = keyed.mapInArrow(_copies(text_bits, again), "t1 long, t2 long, text string")
    copies = materialise(copies.groupBy("t1", "t2").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("k")))
    once = keyed.withColumn("rep", F.lit(False)).unionByName(copies.select("t1", "t2", "text", F.lit(True).alias("rep")))

    parts = once.select("t1", "text", "rep").mapInArrow(_sketch(window, run, bits, text_bits, again), cells)
    sketch = spark.sparkContext.broadcast(_repeated(parts, bits, ROWS))
    suspects = materialise(once.mapInArrow(_suspects(window, run, bits, sketch, text_bits, again), "t1 long, t2 long, w1 long, w2_start long"))
    w2, start = F.shiftright("w2_start", 32).cast("int"), F.col("w2_start").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
    frequent = suspects.groupBy("w1", w2.alias("w2")).agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("w1", "w2").hint("rebalance")
    marks = (
        suspects.join(frequent, (suspects["w1"] == frequent["w1"]) & (w2 == F.col("w2")))
        .groupBy("t1", "t2", F.shiftright(start, 6).alias("block"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), start % 64)).alias("mask"))
        .groupBy("t1", "t2")
        .agg(F.collect_list(F.struct("block", "mask")).alias("marks"))
        .select("t1", "t2", F.lit(False).alias("whole"), F.col("marks.block").alias("blocks"), F.col("marks.mask").alias("masks"))
    )
    whole = copies.where("k > 1").select("t1", "t2", F.lit(True).alias("whole"), F.lit(None).cast("array<int>").alias("blocks"), F.lit(None).cast("array<bigint>").alias("masks"))
    told = whole.unionByName(marks).groupBy("t1", "t2").agg(F.max(F.struct("whole", "blocks", "masks")).alias("told")).select("t1", "t2", "told.*").hint("rebalance")
    joined = base.join(told, ["t1", "t2"], "left").select("id", "text", F.coalesce("whole", F.lit(False)).alias("whole"), "blocks", "masks")
    out = joined.mapInArrow(_rebuild(window), "id long, n_words long, n_removed long, kept_text string")
    return out.withColumnRenamed("id", id_col)


ORACLE = r"""
WITH w AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)),
g AS (
  SELECT doc_id, pos, list(word) OVER o AS run FROM w
  WINDOW o AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
h AS (SELECT doc_id, pos, md5(array_to_string(run, ' ')) AS k FROM g WHERE len(run) = 35),
r AS (SELECT doc_id, pos FROM h WHERE k IN (SELECT k FROM h GROUP BY k HAVING count(*) > 1)),
c AS (
  SELECT w.doc_id, w.pos, w.word, max(r.pos) OVER (PARTITION BY w.doc_id ORDER BY w.pos) AS last
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id AND r.pos = w.pos),
m AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE pos - last < 35) AS n_removed,
    string_agg(word, ' ' ORDER BY pos) FILTER (WHERE last IS NULL OR pos - last >= 35) AS kept
  FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN m ON m.doc_id = d.doc_id
"""
