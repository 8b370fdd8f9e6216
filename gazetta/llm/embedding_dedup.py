"""Embedding near-dedup by NN-descent over labelled vectors.

1. Equal vectors of one label are one class with a count, so copies cost one row.
2. First lists: random hyperplanes cut each label into leaves of a few classes, some
   times over; a leaf that stays large (many nearly equal vectors) is cut by a hash of the id.
   Every class takes its nearest of each leaf.
3. NN-descent: each class meets its neighbours and the classes that name it, and all of
   these are compared with each other in one place; lists keep the nearest. Reverse
   names are limited by rank before they are shuffled, so a class that everybody names is no hot key.
4. Lists whose entries all pass the threshold are saturated: they can't hold all
   links. While there are such lists, every class also takes the nearest classes of
   other components from its leaves, until no leaf holds a link between two components.
   Then a list is enlarged to its whole component of links: blocks of a
   component's vectors are multiplied block by block, which gives every class the
   exact number of its links without listing them.
5. Recall is audited against brute force for a sample of classes of fixed size, over
   all links and as the mean over the classes; below the goal, more rounds follow, and
   after the last of them all blocks of a label are multiplied, which misses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazetta.llm.common import NO_ID, column, materialise
from gazetta.llm.components import connected_components

#: Neighbours a list, hyperplane tables, classes a leaf, bits of a leaf key at most, rounds.
K, TABLES, LEAF, MOST_BITS, ROUNDS, MOST_ROUNDS = 6, 6, 24, 30, 2, 5
#: Classes of a block, sample size of the audit and its goal.
BLOCK, AUDIT, GOAL = 1024, 256, 0.98
#: The columns that name a leaf.
PLACE = ["label", "dim", "tab", "leaf"]


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Groups of rows that stand together, one at a time; the rows are sorted by ``keys``."""
    key, held = None, None
    for batch in batches:
        cols = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        marks = list(zip(*(cols[k] for k in keys), strict=True))
        start = 0
        for i in range(1, len(marks) + 1):
            if i < len(marks) and marks[i] == marks[start]:
                continue
            part = {n: v[start:i] for n, v in cols.items()}
            if marks[start] == key:
                for n in held:
                    held[n] += part[n]
            else:
                if held is not None:
                    yield key, held
                key, held = marks[start], part
            start = i
    if held is not None:
        yield key, held


def unit(vectors: list[bytes], kind: str) -> np.ndarray:
    v = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    # By a power of two to components of about 1, which is exact: squares of huge or tiny ones would overflow or vanish.
    v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _leaves(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            bits, dims = batch.column("bits").to_numpy(), batch.column("dim").to_numpy()
            vectors = batch.column("vec").to_pylist()
            leaf = np.zeros((batch.num_rows, TABLES), np.int64)
            for d in np.unique(dims):
                if d not in planes:
                    planes[d] = np.random.default_rng(int(d)).normal(size=(TABLES * MOST_BITS, d))
                rows = np.flatnonzero(dims == d)
                side = (unit([vectors[r] for r in rows], kind) @ planes[d].T > 0).reshape(len(rows), TABLES, MOST_BITS)
                use = np.arange(MOST_BITS)[None, :] < bits[rows][:, None]
                leaf[rows] = (side & use[:, None, :]) @ (1 << np.arange(MOST_BITS, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column("rep").to_numpy(), TABLES), pa.int64()),
                    batch.column("label").take(pa.array(np.repeat(np.arange(batch.num_rows), TABLES))),
                    pa.array(np.repeat(dims, TABLES), pa.int32()),
                    pa.array(np.tile(np.arange(TABLES), batch.num_rows), pa.int32()),
                    pa.array(leaf.ravel(), pa.int64()),
                    batch.column("vec").take(pa.array(np.repeat(np.arange(batch.num_rows), TABLES))),
                ],
                ["rep", "label", "dim", "tab", "leaf", "vec"],
            )

    return run


def _nearest(keys: list[str], kind: str, most: int, least: float = -2.0):
    """For each member of a group its ``most`` nearest in the group, from ``least`` on: (a, b, sim).

    Where the rows have a column ``cc``, members of one component are not compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[np.ndarray] = []

        def rows() -> pa.RecordBatch:
            a, b, s = (np.concatenate([o[i] for o in out]) if out else np.zeros(0) for i in range(3))
            return pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(s.astype(np.float64))], ["a", "b", "sim"])

        for _, group in sorted_groups(batches, keys):
            if len(group["rep"]) < 2:
                continue
            ids, v = np.array(group["rep"], np.int64), unit(group["vec"], kind)
            sims = v @ v.T
            np.fill_diagonal(sims, -3)
            if "cc" in group:
                cc = np.array(group["cc"], np.int64)
                sims[cc[:, None] == cc[None, :]] = -3
            n = min(most, len(ids) - 1)
            near = np.argpartition(-sims, n - 1, axis=1)[:, :n]
            a, b, s = np.repeat(ids, n), ids[near].ravel(), np.take_along_axis(sims, near, 1).ravel()
            out.append((a[s >= least], b[s >= least], s[s >= least]))
            if len(out) > 500:
                yield rows()
                out = []
        yield rows()

    return run


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric 0/1 matrix of links."""
    new, out = np.ones(len(linked), bool), []
    for start in range(len(linked)):
        todo = [start] if new[start] else []
        new[start] = False
        while todo:
            x = todo.pop()
            found = np.flatnonzero(linked[x] & new).tolist()
            new[found] = False
            out += [(x, y) for y in found]
            todo += found
    return out


def _counts(kind: str, threshold: float, forest: bool = False):
    """Exact links within a pair of blocks of a component: (rep, other, links).

    ``other`` is null in counts; with ``forest``, rows with a rep and an ``other``
    follow that are a spanning forest of the links.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[int, int] = {}
        ends: list[tuple[int, int]] = []

        def rows() -> pa.RecordBatch:
            reps, others = list(out) + [a for a, _ in ends], [None] * len(out) + [b for _, b in ends]
            return pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(others, pa.int64()), pa.array(list(out.values()) + [0] * len(ends), pa.int64())], ["rep", "other", "links"])

        for (_, lo, hi), group in sorted_groups(batches, ["cc", "lo", "hi"]):
            ids, copies, block = np.array(group["rep"], np.int64), np.array(group["copies"], np.int64), np.array(group["block"])
            v = unit(group["vec"], kind)
            left = np.flatnonzero(block == lo)
            right = np.flatnonzero(block == hi)
            linked = v[left] @ v[right].T >= threshold
            if lo == hi:
                np.fill_diagonal(linked, False)
            for own, number in ((left, linked @ copies[right]),) + (((right, linked.T @ copies[left]),) if lo != hi else ()):
                for i, n in zip(ids[own].tolist(), number.tolist(), strict=True):
                    out[i] = out.get(i, 0) + n
            if forest:
                whole = np.zeros((len(ids), len(ids)), bool)
                whole[np.ix_(left, right)] = linked
                whole |= whole.T
                ends += [(int(ids[x]), int(ids[y])) for x, y in spanning(whole)]
            if len(out) + len(ends) > 50_000:
                yield rows()
                out, ends = {}, []
        yield rows()

    return run


def _lists(pairs: DataFrame) -> DataFrame:
    """The ``K`` nearest of each class; ranks are limited before the shuffle."""
    best = pairs.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return materialise(best.withColumn("rank", rank).where(F.col("rank") <= K).drop("rank"))


def _descend(lists: DataFrame, reps: DataFrame, kind: str, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("b").orderBy(F.xxhash64("a", "b")))
    named = lists.withColumn("rank", rank).where(F.col("rank") <= K).select(F.col("b").alias("centre"), F.col("a").alias("rep"))
    around = lists.select(F.col("a").alias("centre"), F.col("b").alias("rep")).union(named).union(lists.select(F.col("a").alias("centre"), F.col("a").alias("rep"))).distinct()
    met = around.join(reps.select("rep", "vec").hint("rebalance"), "rep").repartition(n, "centre").sortWithinPartitions("centre")
    found = met.mapInArrow(_nearest(["centre"], kind, K // 2), "a long, b long, sim double")
    return _lists(lists.unionByName(found))


def _components(links: DataFrame) -> DataFrame:
    return connected_components(links).select(F.col("v").alias("rep"), F.col("label").alias("cc"))


def _joined(lists: DataFrame, cut: DataFrame, kind: str, threshold: float, n: int) -> DataFrame:
    """``rep``, ``cc`` of every linked class, after links between components are looked for in the leaves ``cut``."""
    links = lists.where(F.col("sim") >= threshold).select("a", "b")
    components = _components(links)
    if lists.where(F.col("sim") >= threshold).groupBy("a").count().where(F.col("count") >= K).isEmpty():
        return components
    while True:
        owned = cut.join(components.hint("rebalance"), "rep", "left").withColumn("cc", F.coalesce("cc", "rep"))
        dealt = owned.repartition(n, *PLACE, "cut").sortWithinPartitions(*PLACE, "cut")
        found = materialise(dealt.mapInArrow(_nearest([*PLACE, "cut"], kind, K, threshold), "a long, b long, sim double"))
        if found.isEmpty():
            return components
        links = links.unionByName(found.select("a", "b"))
        components = _components(links)


def _pairs(members: DataFrame, n: int) -> DataFrame:
    """Rows of each pair of blocks of each ``cc``, together and in order."""
    sizes = members.groupBy("cc").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = members.join(sizes.hint("rebalance"), "cc").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = other.select("cc", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "rep", "block", "copies", "vec")
    return pairs.repartition(4 * n, "cc", "lo", "hi").sortWithinPartitions("cc", "lo", "hi", "rep")


COUNTED = "rep long, other long, links long"


def _exact(components: DataFrame, reps: DataFrame, kind: str, threshold: float, n: int) -> DataFrame:
    """``rep``, ``cc`` and ``links`` (to other classes' vectors) of every linked class."""
    members = materialise(reps.select("rep", "copies", "vec").join(components, "rep"))
    counts = _pairs(members, n).mapInArrow(_counts(kind, threshold), COUNTED).groupBy("rep").agg(F.sum("links").alias("links"))
    return materialise(members.select("rep", "cc").join(counts, "rep"))


def _everything(reps: DataFrame, kind: str, threshold: float, n: int) -> DataFrame:
    """The same by all pairs of vectors of a label: it misses nothing, and its work grows with the square of a label."""
    members = reps.select("rep", "copies", "vec", F.concat_ws(" ", "dim", "label").alias("cc"))
    counted = materialise(_pairs(members, n).mapInArrow(_counts(kind, threshold, forest=True), COUNTED))
    counts = counted.where("other IS NULL").groupBy("rep").agg(F.sum("links").alias("links"))
    return materialise(_components(counted.where("other IS NOT NULL").select(F.col("rep").alias("a"), F.col("other").alias("b"))).join(counts, "rep"))


def audit(reps: DataFrame, exact: DataFrame, kind: str, threshold: float, size: int = AUDIT) -> float:
    """Recall of the links of ``size`` classes, against all classes by brute force: over all links or as the mean of the classes, whichever is less."""
    asked = reps.orderBy(F.xxhash64("rep")).limit(size).select("rep", "label", "dim", "copies", "vec").collect()
    by: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    for key in {(r["label"], r["dim"]) for r in asked}:
        own = [r for r in asked if (r["label"], r["dim"]) == key]
        by[key] = np.array([r["rep"] for r in own], np.int64), unit([bytes(r["vec"]) for r in own], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            groups: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True)):
                groups.setdefault(key, []).append(i)
            ids, copies, vectors = batch.column("rep").to_numpy(), batch.column("copies").to_numpy(), batch.column("vec").to_pylist()
            for key, rows in groups.items():
                if key in by:
                    asked_ids, asked_v = by[key]
                    linked = (asked_v @ unit([vectors[r] for r in rows], kind).T >= threshold) & (asked_ids[:, None] != ids[rows][None, :])
                    for q, k in zip(asked_ids.tolist(), (linked @ copies[rows]).tolist(), strict=True):
                        total[q] = total.get(q, 0) + k
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["rep", "true"])

    true = reps.select("rep", "label", "dim", "copies", "vec").mapInArrow(run, "rep long, true long").groupBy("rep").agg(F.sum("true").alias("true"))
    found = F.least(F.coalesce("links", F.lit(0)), "true")
    whole, each = true.where(F.col("true") > 0).join(exact, "rep", "left").agg(F.sum(found) / F.sum("true"), F.avg(found / F.col("true"))).first()
    return 1.0 if whole is None else min(whole, each)


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98) -> DataFrame:
    """Near-duplicate groups of vectors of one label, by cosine of at least ``threshold``.

    Returns one row per input row: id, ``n_links`` (other vectors linked directly),
    ``component_id`` (smallest id reachable, its own at least), ``kept``.

    Null, empty and zero vectors, vectors with null or non-finite components, and rows
    without a label link with nothing; vectors of different lengths don't link. Rows that
    share an id are linked through it; rows without an id act as one behind all others.
    An empty table gives an empty result; extra columns are ignored.
    """
    spark = vectors.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    element = dict(vectors.select(column(vectors, vector_col).alias("v")).dtypes)["v"]
    kind = "<f4" if element == "array<float>" else "<f8"
    v = column(vectors, vector_col) if element == "array<float>" else column(vectors, vector_col).cast("array<double>")
    base = vectors.select(F.coalesce(column(vectors, id_col).cast("long"), F.lit(NO_ID)).alias("owner"), column(vectors, label_col).cast("string").alias("label"), v.alias("v"))
    sound = F.col("label").isNotNull() & (F.size("v") > 0) & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    base = base.withColumn("ok", F.coalesce(sound, F.lit(False))).withColumns({"v1": F.xxhash64("v"), "v2": F.xxhash64(F.lit("second"), "v"), "dim": F.size("v")})
    keys = ["label", "dim", "v1", "v2"]
    classes = base.where("ok").groupBy(*keys).agg(F.min("owner").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v").to_pylist()
            vec = pa.array([np.array(x, kind).tobytes() for x in lists], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*keys, "rep", "copies")), vec], [*keys, "rep", "copies", "vec"])

    reps = materialise(classes.mapInArrow(packed, "label string, dim int, v1 long, v2 long, rep long, copies long, vec binary"))
    of_label = reps.groupBy("label", "dim").agg(F.greatest(F.lit(0), F.least(F.lit(MOST_BITS), F.ceil(F.log2(F.count(F.lit(1)) / LEAF)))).cast("int").alias("bits"))
    leaves = materialise(reps.join(of_label.hint("rebalance"), ["label", "dim"]).select("rep", "label", "dim", "bits", "vec").mapInArrow(_leaves(kind), "rep long, label string, dim int, tab int, leaf long, vec binary"))
    cuts = leaves.groupBy(*PLACE).agg(F.ceil(F.count(F.lit(1)) / (2 * LEAF)).cast("int").alias("cuts")).where("cuts > 1").hint("rebalance")
    cut = leaves.join(cuts, PLACE, "left").withColumn("cut", F.pmod(F.xxhash64("rep", "tab"), F.coalesce("cuts", F.lit(1))))
    cut = materialise(cut.select(*PLACE, "cut", "rep", "vec"))
    dealt = cut.repartition(n, *PLACE, "cut").sortWithinPartitions(*PLACE, "cut")
    lists = _lists(dealt.mapInArrow(_nearest([*PLACE, "cut"], kind, K), "a long, b long, sim double"))
    for number in range(MOST_ROUNDS):
        lists = _descend(lists, reps, kind, n)
        if number + 1 >= ROUNDS:
            exact = _exact(_joined(lists, cut, kind, threshold, n), reps, kind, threshold, n)
            if audit(reps, exact, kind, threshold) >= GOAL:
                break
    else:
        exact = _everything(reps, kind, threshold, n)
    own = reps.select(*keys, "rep", "copies").join(exact, "rep", "left")
    told = own.select(*keys, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("cc", "rep").alias("cc")).hint("rebalance")
    named = base.select("owner", "ok", *keys).join(told, keys, "left")
    linked = F.col("ok") & F.col("cc").isNotNull()
    component = F.when(linked, F.col("cc")).otherwise(F.col("owner"))
    return named.select(
        F.nullif("owner", F.lit(NO_ID)).alias(id_col),
        F.when(linked, F.col("links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.nullif(component, F.lit(NO_ID)).alias("component_id"),
        (F.col("owner") == component).alias("kept"),
    )
