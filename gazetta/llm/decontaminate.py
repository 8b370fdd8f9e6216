"""Benchmark decontamination by spaced-seed hashing.

A seed is the hash of the tokens that a fixed mask selects; the positions that it
ignores may differ. Each class of item lengths has a family of masks that misses no
overlap: whichever tokens the rule lets differ, some mask lies somewhere with all its
selected tokens on equal ones (the families were searched for and are checked case by case
in the tests). Hashes of the test items are joined with those of the training documents, a
hit names a diagonal (document, item, shift), and along each diagonal, once, equal tokens are counted,
ungapped, with substitutions allowed.

Where the items' text is at most ``BROADCAST_BYTES``, the join is a broadcast join:
the table of item hashes goes to the workers, which look up and verify on the spot, so
that the corpus never shuffles. Beyond that size it is a join of Spark tables: workers
emit the hashes of their documents that pass a bitmap of the item hashes (of a bounded size),
these meet the item hashes by shuffle, and the diagonals found meet the texts again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gazetta.llm.common import chunks, column, find_words, materialise, unpacked, wide_key

#: Masks by the least item length of their class; with 80 % equal tokens none of these families misses an overlap.
#: An overlap in items of 20 tokens and more holds a run of 20 to 39 tokens of which 80 % are equal.
MASKS = {
    1: ("1",),
    2: ("11",),
    3: ("111",),
    4: ("1111",),
    5: ("1111", "11101", "11011", "10111"),
    10: ("110111", "11010011", "101001011"),
    15: ("1101000111", "111000100101", "1101111"),
    20: ("10010101011", "111011001", "11001111"),
}
LEAST, SHARE = 20, 0.8
#: Tokens of a mask at most where other parameters than these two ask for masks of equal runs.
MOST_SEED = 8
#: Hits listed, and tokens compared, at a time.
STEP_HITS, STEP_TOKENS = 1 << 18, 1 << 21
#: Bytes of item text whose hashes are broadcast.
BROADCAST_BYTES = 8 << 20
#: Bits of the screen over item hashes, as powers of two: per hash, at most, and of a slice.
SCREEN_BITS, MOST_BITS, SLICE_BITS = 5, 28, 6
#: Bytes that end a token besides white space: ASCII punctuation.
PUNCTUATION = np.isin(np.arange(256), [c for c in range(33, 127) if not chr(c).isalnum()])
#: Odd factors for the places of a mask, and a start for each mask.
_FACTORS = np.random.default_rng(21).integers(1, 1 << 62, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the tokens (A-Z lower-cased, split at white space and ASCII punctuation), and offsets."""
    words = find_words(texts, lower=True, breaks=PUNCTUATION)
    return words.hashes[0], words.offsets


class Seeds:
    """Hashes of masks over a run of tokens; what masks share is computed once."""

    def __init__(self, h: np.ndarray):
        self.h, self.terms = h, {}

    def hashes(self, mask: str) -> np.ndarray:
        """The hash of ``mask`` at each place where it fits."""
        n = len(self.h) - len(mask) + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = np.full(n, int(mask, 2) * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64)
        with np.errstate(over="ignore"):
            for i, bit in enumerate(mask):
                if bit == "1":
                    if i not in self.terms:
                        self.terms[i] = self.h * _FACTORS[i]
                    out += self.terms[i][i : i + n]
            return out ^ (out >> np.uint64(32))


def unequal(size: int, share: float) -> int:
    """Tokens of ``size`` that may differ where ``share`` of them are equal."""
    return size - math.ceil(share * size - 1e-9)


def masks_of(size: int, least: int, share: float) -> tuple[str, ...]:
    """The masks for an item of ``size`` tokens: every overlap holds one of them."""
    if not size:
        return ()
    if share >= SHARE and least >= LEAST:
        return MASKS[max(k for k in MASKS if k <= size)]
    # Other rules: so many equal tokens in a row as each overlap is bound to hold (pigeonhole). A
    # run of twice ``least`` or more holds a shorter one of that share, so these lengths stand for all.
    sizes = [size, *range(least, min(size, 2 * least) + 1)]
    return ("1" * max(1, min(MOST_SEED, *(-(-(n - unequal(n, share)) // (unequal(n, share) + 1)) for n in sizes))),)


def seed_places(h: np.ndarray, offsets: np.ndarray, least: int, share: float) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The masks in use for the items given by ``offsets``; key and place of every seed of every item."""
    sizes = np.diff(offsets)
    family = {int(n): masks_of(int(n), least, share) for n in np.unique(sizes)}
    used = sorted({m for masks in family.values() for m in masks}, key=lambda m: (len(m), m))
    seeds, item = Seeds(h), np.repeat(np.arange(len(sizes)), sizes)
    keys, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for mask in used:
        k = seeds.hashes(mask)
        takes = np.array([mask in family[int(n)] for n in sizes], bool)
        at = np.arange(len(k))
        at = at[(item[: len(k)] == item[at + len(mask) - 1]) & takes[item[: len(k)]]]
        keys.append(k[at])
        places.append(at)
    return used, np.concatenate(keys), np.concatenate(places)


class Items:
    """The tokens of some items and the places of their seeds, sorted by hash."""

    def __init__(self, ids: list[int], texts: list[str], least: int, share: float):
        self.h, self.offsets = tokens(pa.array(texts, pa.string()))
        self.ids = np.array(ids, np.int64)
        self.item = np.repeat(np.arange(len(ids)), np.diff(self.offsets))
        self.masks, keys, places = seed_places(self.h, self.offsets, least, share)
        order = np.argsort(keys, kind="stable")
        self.keys, self.places = keys[order], places[order]
        self.screen = np.zeros(1 << 22, bool)
        self.screen[(self.keys >> np.uint64(42)).astype(np.int64)] = True


def steps(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Stretches whose sizes sum to about ``most`` (one entry at least)."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield slice(start, end)
        start = end


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, end to end."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def overlaps(h: np.ndarray, offsets: np.ndarray, items: Items, least: int, share: float) -> list[tuple[int, int, int, int]]:
    """(document, item, matched tokens, length) of the best verified overlap of each pair.

    Around a hit, equal tokens are counted along the hit's diagonal over the whole
    item, clipped to the document. An overlap counts when at least ``share`` of the
    item's tokens are equal, or when some run on the diagonal of at least
    ``least`` tokens has that share.
    """
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    best: dict[tuple[int, int], tuple[int, int]] = {}
    seeds, places, keys = Seeds(h), [], []
    for mask in items.masks:
        k = seeds.hashes(mask)
        at = np.flatnonzero(items.screen[(k >> np.uint64(42)).astype(np.int64)])
        at = at[doc[at] == doc[at + len(mask) - 1]]
        places.append(at)
        keys.append(k[at])
    if not places:
        return []
    at, key = np.concatenate(places), np.concatenate(keys)
    lo, hi = np.searchsorted(items.keys, key, "left"), np.searchsorted(items.keys, key, "right")
    at, lo, many = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
    order = np.argsort(at, kind="stable")
    at, lo, many = at[order], lo[order], many[order]
    for step in steps(many, STEP_HITS):
        a, place = np.repeat(at[step], many[step]), items.places[ranges(lo[step], many[step])]
        # Each diagonal once, however many seeds lie on it.
        found = np.unique(np.stack([doc[a], items.item[place], a - place]), axis=1)
        _verify(h, offsets, items, found, least, share, best)
    return [(d, item, *x) for (d, item), x in best.items()]


def _verify(h: np.ndarray, offsets: np.ndarray, items: Items, found: np.ndarray, least: int, share: float, best: dict[tuple[int, int], tuple[int, int]]) -> None:
    """Count equal tokens on each diagonal (document, item, shift) of ``found`` and keep what the rule takes in ``best``."""
    doc, item, shift = found
    first, last = items.offsets[item], items.offsets[item + 1]
    size = last - first
    start = np.maximum(first, offsets[doc] - shift)
    length = np.minimum(last, offsets[doc + 1] - shift) - start
    for step in steps(length, STEP_TOKENS):
        at = ranges(start[step], length[step])
        same = items.h[at] == h[at + np.repeat(shift[step], length[step])]
        begins = np.cumsum(length[step]) - length[step]
        equal = np.add.reduceat(same.astype(np.int64), begins)
        for i in np.flatnonzero((equal >= share * size[step]) | (equal >= share * least - 1e-9)).tolist():
            j = step.start + i
            got, of = int(equal[i]), int(size[j])
            if got < share * of:
                got, of = longest_share(same[begins[i] : begins[i] + length[j]], least, share)
            key = int(doc[j]), int(item[j])
            if got and got > best.get(key, (0, 0))[0]:
                best[key] = (got, of)


def longest_share(same: np.ndarray, least: int, share: float) -> tuple[int, int]:
    """Matches and length of the longest run, of ``least`` tokens or more, with ``share`` equal ones."""
    score = np.concatenate([[0.0], np.cumsum(same - share)])
    low = np.minimum.accumulate(score)
    best = (0, 0)
    for end in range(least, len(score)):
        start = int(np.searchsorted(-low[: end - least + 1], -(score[end] + 1e-9), "left"))
        if start <= end - least and end - start > best[1]:
            best = (int(same[start:end].sum()), end - start)
    return best


def _hits_here(shared, least: int, share: float, text_col: str | None):
    """The broadcast join: look up and verify in the worker that reads the documents."""
    hit = pa.struct([("matched", pa.int64()), ("item", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in chunks(unpacked(batches, text_col)):
            h, offsets = tokens(batch.column("text"))
            hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for d, item, matched, _ in overlaps(h, offsets, items, least, share):
                hits[d].append({"matched": matched, "item": int(items.ids[item])})
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), pa.array(np.diff(offsets), pa.int64()), pa.array(hits, pa.list_(hit))], ["id", "row", "n_tokens", "items"])

    return run


def _item_seeds(least: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            h, offsets = tokens(batch.column("text"))
            _, keys, places = seed_places(h, offsets, least, share)
            own = np.repeat(np.arange(batch.num_rows), np.diff(offsets))[places]
            cols = [pa.array(keys.view(np.int64)), batch.column("item").take(pa.array(own)), batch.column("ih").take(pa.array(own)), pa.array(places - offsets[own])]
            yield pa.RecordBatch.from_arrays(cols, ["key", "item", "ih", "place"])

    return run


def _screen(keys: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of ``2**bits`` cells over the high bits of the hashes, put together in slices."""
    local = bits - SLICE_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            cells = (batch.column("key").to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
            for s in np.unique(cells >> local).tolist():
                held.setdefault(s, np.zeros(1 << local, bool))[cells[cells >> local == s] & ((1 << local) - 1)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([np.packbits(x).tobytes() for x in held.values()], pa.binary())], ["slice", "bits"])

    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.select("key").repartition(n, F.shiftrightunsigned("key", 64 - SLICE_BITS))
    out = np.zeros((1 << SLICE_BITS, (1 << local) // 8), np.uint8)
    for r in dealt.mapInArrow(run, "slice long, bits binary").collect():  # 2**MOST_BITS bits at most
        out[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def _probes(screen, bits: int, masks: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = screen.value
        for batch in chunks(batches):
            h, offsets = tokens(batch.column("text"))
            doc, seeds = np.repeat(np.arange(batch.num_rows), np.diff(offsets)), Seeds(h)
            for mask in masks:
                k = seeds.hashes(mask)
                cell = (k >> np.uint64(64 - bits)).astype(np.int64)
                at = np.flatnonzero(held[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1)
                at = at[doc[at] == doc[at + len(mask) - 1]]
                own = pa.array(doc[at])
                yield pa.RecordBatch.from_arrays([batch.column("t1").take(own), batch.column("t2").take(own), pa.array(k[at].view(np.int64)), pa.array(at - offsets[doc[at]])], ["t1", "t2", "key", "pos"])

    return run


def _verified(least: int, share: float):
    """Rows of a text, an item's text and their diagonals to equal tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            h, offsets = tokens(batch.column("text"))
            items = Items.__new__(Items)
            items.h, items.offsets = tokens(batch.column("item_text"))
            many = pc.list_value_length(batch.column("shifts")).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), many)
            shifts = batch.column("shifts").flatten().to_numpy() + offsets[row] - items.offsets[row]
            best: dict[tuple[int, int], tuple[int, int]] = {}
            _verify(h, offsets, items, np.stack([row, row, shifts]), least, share, best)
            found = pa.array([r for r, _ in best], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(found) for c in ("t1", "t2", "item")), pa.array([x for x, _ in best.values()], pa.int64())], ["t1", "t2", "item", "matched"])

    return run


def _joined(docs: DataFrame, items: DataFrame, least: int, share: float) -> DataFrame:
    """``t1``, ``t2``, ``items`` of every text of ``docs`` that overlaps an item, by joins of tables."""
    spark = docs.sparkSession
    items = materialise(items.withColumn("ih", F.xxhash64("text")))
    seeds = materialise(items.mapInArrow(_item_seeds(least, share), "key long, item long, ih long, place long"))
    masks = tuple(sorted({m for size in range(1, 2 * least + 1) for m in masks_of(size, least, share)}))
    bits = max(SLICE_BITS + 3, min(MOST_BITS, seeds.count().bit_length() + SCREEN_BITS))
    screen = spark.sparkContext.broadcast(_screen(seeds, bits))
    texts = docs.select("t1", "t2", "text")
    probes = texts.mapInArrow(_probes(screen, bits, masks), "t1 long, t2 long, key long, pos long").distinct()
    hits = probes.join(seeds, "key").groupBy("t1", "t2", "item", "ih").agg(F.collect_set(F.col("pos") - F.col("place")).alias("shifts"))
    met = hits.join(items.select("item", "ih", F.col("text").alias("item_text")), ["item", "ih"])
    one = texts.groupBy("t1", "t2").agg(F.first("text").alias("text"))
    pairs = met.join(one, ["t1", "t2"]).mapInArrow(_verified(least, share), "t1 long, t2 long, item long, matched long")
    return pairs.groupBy("t1", "t2").agg(F.collect_set(F.struct("matched", "item")).alias("items")).hint("rebalance")


def decontaminate(
    docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: int = LEAST, share: float = SHARE, carry: Sequence[str] = ()
) -> DataFrame:
    """Documents with the benchmark items that they overlap.

    Returns one row per input row: id, ``n_tokens``, ``n_items`` (items it overlaps),
    ``item_id`` (that with most equal tokens, the smallest among equals; null for
    none), ``n_matched`` (its equal tokens, 0 for none), ``contaminated``.

    An overlap has at least ``share`` equal tokens on one diagonal, over the whole
    item or over a run of ``least`` tokens or more; none is missed. Items of
    a few tokens are hit wherever all their tokens stand in a row (fewer than five tokens: no
    substitution). Items without tokens can't be hit. Null and
    empty texts are clean; null items are ignored; repeated items count once each
    id; repeated rows each get their result. Empty tables give clean or no rows. Extra columns
    are ignored but for those named in ``carry``, which follow as a struct ``row``.
    """
    spark = docs.sparkSession
    items = bench.select(column(bench, item_col).cast("long").alias("item"), column(bench, item_text_col).alias("text")).where("text IS NOT NULL AND item IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    row = F.struct(*(column(docs, c) for c in carry)) if carry else F.lit(0)
    base = docs.select(column(docs, id_col).cast("long").alias("id"), column(docs, text_col).alias("text"), row.alias("row"))
    if size <= BROADCAST_BYTES:
        held = items.orderBy("item", "text").collect()
        shared = spark.sparkContext.broadcast(Items([r["item"] for r in held], [r["text"] for r in held], least, share))
        inside = text_col if text_col in carry else None
        hit = F.expr("cast(array() as array<struct<matched: long, item: long>>)")
        schema = StructType([*base.select("id", "row").schema, StructField("n_tokens", LongType()), base.select(hit.alias("items")).schema["items"]])
        result = (base.drop("text") if inside else base).mapInArrow(_hits_here(shared, least, share, inside), schema)
    else:
        t1, t2 = wide_key(F.coalesce("text", F.lit("")))
        keyed = base.withColumns({"t1": t1, "t2": t2})
        told = _joined(keyed, items, least, share)
        n = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D!-/:-@\[-`{-~]+")), F.lit(0)).cast("long")
        none = F.expr("cast(array() as array<struct<matched: long, item: long>>)")
        result = keyed.join(told, ["t1", "t2"], "left").select("id", "row", n.alias("n_tokens"), F.coalesce("items", none).alias("items"))
    order = F.array_max(F.transform("items", lambda x: F.struct(x["matched"].alias("matched"), (-x["item"]).alias("item"))))
    return result.withColumn("best", order).select(
        F.col("id").alias(id_col),
        "n_tokens",
        F.size(F.array_distinct(F.transform("items", lambda x: x["item"]))).cast("long").alias("n_items"),
        (-F.col("best.item")).alias("item_id"),
        F.coalesce("best.matched", F.lit(0)).cast("long").alias("n_matched"),
        (F.size("items") > 0).alias("contaminated"),
        *(["row"] if carry else []),
    )
