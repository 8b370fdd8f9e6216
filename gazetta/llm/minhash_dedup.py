"""MinHash near-dedup: SuperMinHash signatures, banding, exact confirmation, components.

1. One pass over the texts gives each document's shingle-set size, a 128-bit
   digest of its set and its band keys; no set leaves the worker.
2. Documents of equal sets are one class, stood for by their smallest id, so
   thousands of copies cost one row from here on.
3. The hub of a band key is the smallest class that has it. Every class is tied to
   the least of its hubs, and that one to its other hubs, each tie once. A key's
   rows are never gathered: the smallest comes from a partial aggregate, and a class has
   as many hubs as bands at most. The components of these ties hold every pair that shares a band.
4. The shingle sets of each such component are cut into blocks of bounded size,
   and each pair of blocks is one group: an exact incidence product confirms
   links and returns a spanning forest, never all pairs. A component of several
   blocks first sheds the classes that cannot link with anything, because more of
   their shingles than the threshold allows occur nowhere else in the component.
5. The components of the confirmed links give the groups.

A pair at similarity s is in one component unless all its bands differ; for 16
bands of 4 rows and s = 0.85 that chance is under 1e-5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import NO_ID, chunks, column, materialise, may_be_among
from gazetta.llm.components import connected_components
from gazetta.llm.shingles import band_keys, shingle_sets, superminhash

#: Set elements and classes that a block of a component holds, about.
BLOCK_ELEMENTS, BLOCK_CLASSES = 400_000, 1_500


def _describe(width: int, m: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            sets = shingle_sets(batch.column("text"), width)
            keys = band_keys(superminhash(sets, m), bands).view(np.int64)
            digests = [np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<i8") for s in sets]
            some = np.array([len(s) > 0 for s in sets], bool)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("owner"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([int(d[0]) for d in digests], pa.int64()),
                    pa.array([int(d[1]) for d in digests], pa.int64()),
                    pa.array([list(k) if x else [] for k, x in zip(keys.tolist(), some, strict=True)], pa.list_(pa.int64())),
                ],
                ["owner", "n", "d1", "d2", "keys"],
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            sets = shingle_sets(batch.column("text"), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column("owner"), batch.column("cc"), pa.array([s.tobytes() for s in sets], pa.binary())], ["owner", "cc", "elements"]
            )

    return run


def _find(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def block_links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links inside ``left``, or between ``left`` and ``right``, as positions.

    Intersection sizes come from products of 0/1 matrices over the shingles that at
    least two sets hold, some thousand shingles at a time.
    """
    sets = left + (right or [])
    n, k = len(sets), len(left)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    code = np.cumsum(new) - 1
    count = np.bincount(code)
    code, owner = code[count[code] > 1], owner[count[code] > 1]
    wide = slice(k, n) if right is not None else slice(0, n)
    common = np.zeros((k, wide.stop - wide.start), np.float32)
    _, code = np.unique(code, return_inverse=True)
    step = 2048
    edges = np.searchsorted(code, np.arange(0, (code[-1] if len(code) else -1) + 1 + step, step))
    for c, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        part = np.zeros((n, step), np.float32)
        part[owner[lo:hi], code[lo:hi] - c * step] = 1
        common += part[:k] @ part[wide].T
    union = sizes[:k, None] + sizes[wide][None, :] - common
    rows, cols = np.nonzero((100 * common >= percent * union) & (union > 0))
    parent, out = np.arange(n), []
    for r, c in zip(rows.tolist(), (cols + wide.start).tolist(), strict=True):
        x, y = _find(parent, r), _find(parent, c)
        if x != y:
            parent[x] = y
            out.append((r, c))
    return out


def _confirm(percent: int):
    """Rows sorted by (cc, lo, hi); each such group is two blocks or one."""

    def solve(rows: list[tuple[int, int, bytes]], lo: int, hi: int) -> list[tuple[int, int]]:
        sides: dict[int, list[tuple[int, np.ndarray]]] = {lo: [], hi: []}
        for owner, block, elements in rows:
            sides[block].append((owner, np.frombuffer(elements, np.uint64)))
        ids = [x for x, _ in sides[lo]] + ([x for x, _ in sides[hi]] if hi != lo else [])
        left, right = [s for _, s in sides[lo]], [s for _, s in sides[hi]] if hi != lo else None
        if len(ids) < 2 or not left or right == []:
            return []
        return [(ids[a], ids[b]) for a, b in block_links(left, right, percent)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("cc", "lo", "hi", "owner", "block", "elements")]
            for cc, lo, hi, owner, block, elements in zip(*cols, strict=True):
                if key != (cc, lo, hi):
                    if rows:
                        out += solve(rows, key[1], key[2])
                    key, rows = (cc, lo, hi), []
                rows.append((owner, block, elements))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])
                out = []
        if rows:
            out = solve(rows, key[1], key[2])
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

    return run


def _blocked(sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) within each ``cc`` of ``sets`` (owner, cc, elements)."""
    size = F.octet_length("elements") / 8
    load = sets.groupBy("cc").agg(F.greatest(F.ceil(F.sum(size) / BLOCK_ELEMENTS), F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES)).cast("int").alias("blocks"))
    placed = sets.join(load.hint("rebalance"), "cc").withColumn("block", F.pmod(F.xxhash64("owner"), F.col("blocks")).cast("int"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = other.select("cc", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "owner", "block", "elements")
    n = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartition(4 * n, "cc", "lo", "hi").sortWithinPartitions("cc", "lo", "hi", "owner")
    return dealt.mapInArrow(_confirm(percent), "a long, b long")


def _supported(sets: DataFrame, percent: int) -> DataFrame:
    """Drop, from components of several blocks, the classes that cannot link with any other.

    A link needs ``percent`` of a set's shingles in the other set, so in some other set.
    """
    size = F.octet_length("elements") / 8
    load = sets.groupBy("cc").agg(F.sum(size).alias("elements"), F.count(F.lit(1)).alias("classes"))
    large = load.where((F.col("elements") > BLOCK_ELEMENTS) | (F.col("classes") > BLOCK_CLASSES)).select("cc").hint("rebalance")
    hot = sets.join(large, "cc")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "elements"):
            parts = [np.frombuffer(x, np.int64) for x in batch.column("elements").to_pylist()]
            n = [len(x) for x in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column("cc").to_numpy(), n), pa.int64()),
                    pa.array(np.repeat(batch.column("owner").to_numpy(), n), pa.int64()),
                    pa.array(np.concatenate(parts), pa.int64()),
                ],
                ["cc", "owner", "x"],
            )

    each = materialise(hot.mapInArrow(spread, "cc long, owner long, x long"))
    shared = each.groupBy("cc", "x").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("cc", "x").hint("rebalance")
    n_shared = each.join(shared, ["cc", "x"]).groupBy("cc", "owner").agg(F.count(F.lit(1)).alias("n_shared"))
    n_all = each.groupBy("cc", "owner").agg(F.count(F.lit(1)).alias("n_all"))
    weak = n_all.join(n_shared, ["cc", "owner"], "left").where(100 * F.coalesce("n_shared", F.lit(0)) < percent * F.col("n_all")).select("owner")
    return sets.join(weak, "owner", "left_anti")


def minhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, width: int = 5, m: int = 64, bands: int = 16
) -> DataFrame:
    """Groups of documents whose shingle sets have ``100 * intersection >= percent * union``.

    Returns one row per input row: id, ``n_shingles``, ``component_id`` (smallest id
    reachable by links, its own at least) and ``kept`` (whether that is its own id).

    Null and empty texts, and texts of white space, have no shingles and link with
    nothing. Rows that share an id are one vertex. Rows without an id act as one
    vertex behind all others; their ``component_id`` is null where no id is reachable, and they
    are kept only then. An empty table gives an empty result; other columns are ignored.
    """
    base = docs.select(F.coalesce(column(docs, id_col).cast("long"), F.lit(NO_ID)).alias("owner"), column(docs, text_col).alias("text"))
    facts = materialise(base.mapInArrow(_describe(width, m, bands), "owner long, n long, d1 long, d2 long, keys array<long>"))
    classes = facts.where("n > 0").groupBy("d1", "d2").agg(F.min("owner").alias("rep"), F.first("keys").alias("keys"))
    keyed = materialise(classes.select("rep", F.posexplode("keys").alias("band", "key")))
    hubs = keyed.groupBy("band", "key").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("k")).where("k > 1")
    # One tie a class, to its least hub, and ties between hubs that share a class: hubs are few beside classes.
    own = keyed.join(hubs.select("band", "key", "hub").hint("rebalance"), ["band", "key"]).groupBy("rep").agg(F.collect_set("hub").alias("hubs"))
    own = own.select(F.array_min("hubs").alias("hub"), F.explode(F.array_append("hubs", F.col("rep"))).alias("rep"))
    ties = own.where("rep != hub").distinct()
    groups = connected_components(ties, "hub", "rep").select(F.col("v").alias("owner"), F.col("label").alias("cc"))
    # A vertex may stand for several texts where rows share an id: all of them count.
    # Most texts are in no component: a bitmap keeps them out of the shuffle of this join.
    sets = materialise(may_be_among(base, groups, "owner").join(groups, "owner").mapInArrow(_sets(width), "owner long, cc long, elements binary").where(F.octet_length("elements") > 0).distinct())
    links = _blocked(_supported(sets, percent), percent)
    found = connected_components(links).select(F.col("v").alias("rep"), "label")

    reps = facts.where("n > 0").groupBy("d1", "d2").agg(F.min("owner").alias("rep"))
    own = reps.join(found, "rep", "left").select("d1", "d2", F.coalesce("label", "rep").alias("label")).hint("rebalance")
    named = facts.select("owner", "n", "d1", "d2").join(own, ["d1", "d2"], "left")
    component = F.when(F.col("n") > 0, F.col("label")).otherwise(F.col("owner"))
    return named.select(
        F.nullif("owner", F.lit(NO_ID)).alias(id_col),
        F.col("n").alias("n_shingles"),
        F.nullif(component, F.lit(NO_ID)).alias("component_id"),
        (F.col("owner") == component).alias("kept"),
    )
