"""Sharding by balanced label propagation, with DataFrame functions only.

Documents are linked when their texts are equal; shards are the labels. Documents of
one group that sit in one shard are alike, so the state is a table of cells (group,
shard, number of documents): a group of a third of the corpus is at most one cell a
shard, and no links are listed. Documents without a link fill what room is left.

1. Linked documents are dealt out one by one in group order: exactly even.
2. Each round joins every cell with the shard that holds most of its group (ties turn
   by a hash of the group). The wishes are summed to one number for each pair of
   shards; quotas are the largest flows, in proportion, that keep every shard within
   its capacity, moves in and out together. Within a pair of shards the wishes with
   the most gain move first, by gain and hash classes; a class that meets the end of
   the quota moves in part. So no shard is ever over its capacity.
3. Where a group that fits a shard is still in several, all groups are packed anew,
   largest first, each whole into the first shard that it fits. Groups of one size are
   alike, so the packing is over sizes, of which there are at most about the root of
   twice the documents. Groups larger than a shard fill whole shards, and what is left of them is
   packed as a group. The result with fewer split groups stands.
4. Documents take the places of their cells, by ranks within salted parts of their
   group; the rest fill the shards exactly. The law is ``rows``: counts at most one apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.llm.common import NO_ID, column, materialise, unsigned_crc32, wide_key

#: Parts into which ranks are cut at least, documents of a part about, hash classes of equal gain, and rounds at most.
PARTS, PART_ROWS, CLASSES, ROUNDS = 1024, 1_000_000, 16, 8


def ranked(df: DataFrame, within: list[str], by: Column, order: list[Column], name: str, parts: int) -> DataFrame:
    """A gapless rank from 0 within ``within``, in ``parts`` salted parts: no window holds a whole group."""
    cut = df.withColumn("part", F.pmod(by, F.lit(parts)).cast("int"))
    counts = cut.groupBy(*within, "part").agg(F.count(F.lit(1)).alias("many"))
    before = F.coalesce(F.sum("many").over(Window.partitionBy(*within).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.withColumn("offset", before).drop("many")
    place = F.row_number().over(Window.partitionBy(*within, "part").orderBy(*order))
    keys = [*within, "part"]
    return cut.withColumn("place", place - 1).join(offsets, keys).withColumn(name, F.col("offset") + F.col("place")).drop("part", "place", "offset")


def quotas(wish: dict[tuple[int, int], int], load: list[int], room: list[int], rounds: int = 200) -> dict[tuple[int, int], int]:
    """The part of each wished flow between shards that keeps every load within its room.

    Flows into a shard that would overflow shrink in proportion, until none does;
    smaller inflows make smaller outflows elsewhere, hence the rounds.
    """
    flow = {k: float(v) for k, v in wish.items()}
    n = len(load)

    def over(f: dict[tuple[int, int], float]) -> list[float]:
        into, out = [0.0] * n, [0.0] * n
        for (a, b), v in f.items():
            into[b] += v
            out[a] += v
        return [into[s] - (room[s] - load[s] + out[s]) for s in range(n)]

    for _ in range(rounds):
        excess = over(flow)
        if max(excess, default=0) <= 0:
            break
        into = [0.0] * n
        for (_, b), v in flow.items():
            into[b] += v
        flow = {(a, b): v * (max(0.0, 1 - excess[b] / into[b]) if excess[b] > 0 and into[b] else 1) for (a, b), v in flow.items()}
    whole = {k: int(v) for k, v in flow.items()}
    # Whole numbers can be off by a few; a shard that is over its room without an inflow has none to give back.
    while fed := [k for k in whole if whole[k] > 0 and over(whole)[k[1]] > 0]:
        excess = over(whole)
        s = max((k[1] for k in fed), key=lambda i: excess[i])
        (a, b) = max((k for k in fed if k[1] == s), key=lambda k: whole[k])
        whole[a, b] -= min(whole[a, b], max(1, int(excess[s])))
    # What proportion and rounding left over goes to the largest wishes that still fit.
    for _ in range(2):
        for (a, b), wished in sorted(wish.items(), key=lambda x: (-x[1], x[0])):
            spare = -over(whole)[b]
            more = min(wished - whole[a, b], int(spare))
            if more > 0:
                whole[a, b] += more
    return {k: v for k, v in whole.items() if v > 0}


def _propagate(cells: DataFrame, room: list[int], rounds: int) -> DataFrame:
    """Cells (g1, g2, shard, n) after the rounds; loads stay within ``room``."""
    shards, spark = len(room), cells.sparkSession
    for _ in range(rounds):
        load = [0] * shards
        for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect():
            load[r["shard"]] = r["n"]
        full = [s for s in range(shards) if load[s] >= room[s]]
        if len(full) == shards:
            full = []
        turn = F.pmod(F.col("shard") - F.col("g1"), F.lit(shards))
        open_ = F.when(~F.col("shard").isin(full), F.struct("n", turn.alias("turn"), "shard")) if full else F.struct("n", turn.alias("turn"), "shard")
        best = cells.groupBy("g1", "g2").agg(F.max(open_).alias("best")).where("best IS NOT NULL")
        wish = cells.join(best.hint("rebalance"), ["g1", "g2"], "left")
        # A cell moves to its group's fullest open shard unless it is fuller itself.
        moving = (F.col("shard") != F.col("best.shard")) & (F.struct("n", turn.alias("turn")) < F.struct("best.n", "best.turn"))
        wish = wish.select("g1", "g2", "shard", "n", F.when(moving, F.col("best.shard")).alias("to"), F.floor(F.log2("best.n")).cast("int").alias("gain"), F.pmod(F.xxhash64("g1", "g2", "shard"), F.lit(CLASSES)).cast("int").alias("class"))
        wish = materialise(wish)
        classes = wish.where("to IS NOT NULL").groupBy("shard", "to", "gain", "class").agg(F.sum("n").alias("wished"))
        classes = materialise(classes)  # at most shards^2 * 64 * CLASSES rows
        flows = {(r["shard"], r["to"]): r["n"] for r in classes.groupBy("shard", "to").agg(F.sum("wished").alias("n")).collect()}
        quota = quotas(flows, load, room)
        if not quota:
            break
        allowed = spark.createDataFrame([(a, b, q) for (a, b), q in quota.items()], "shard int, to int, quota long")
        first = Window.partitionBy("shard", "to").orderBy(F.desc("gain"), "class")
        done = F.coalesce(F.sum("wished").over(first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        part = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("quota") - done) / F.col("wished")))
        shares = classes.join(F.broadcast(allowed), ["shard", "to"]).select("shard", "to", "gain", "class", part.alias("share")).where("share > 0")
        moved = wish.join(F.broadcast(shares), ["shard", "to", "gain", "class"], "left").withColumn("go", F.floor(F.col("n") * F.coalesce("share", F.lit(0.0))))
        stay = moved.select("g1", "g2", "shard", (F.col("n") - F.col("go")).alias("n"))
        gone = moved.where("go > 0").select("g1", "g2", F.col("to").alias("shard"), F.col("go").alias("n"))
        cells = materialise(stay.unionByName(gone).where("n > 0").groupBy("g1", "g2", "shard").agg(F.sum("n").cast("long").alias("n")))
        if sum(quota.values()) * 1000 < sum(load):
            break
    return cells


def packed(sizes: list[tuple[int, int]], room: list[int]) -> tuple[dict[int, list[tuple[int, list[tuple[int, int]]]]], int]:
    """First fit of (size, number of groups), largest first: for each size (number, [(shard, rows), ...]) in turn; groups split though they fit.

    At most one group less than there are shards finds no shard for all of it in the end; such
    groups go to the shards with most room, in as few parts as that gives.
    """
    left, out = list(room), {}
    todo: list[tuple[int, int, list[tuple[int, int]], int]] = []

    def spread(n: int) -> list[tuple[int, int]]:
        pieces = []
        for s in sorted(range(len(left)), key=lambda i: (-left[i], i)):
            part = min(n, left[s])
            if part > 0:
                pieces.append((s, part))
                left[s] -= part
                n -= part
        return pieces

    for size, number in sorted(sizes, reverse=True):
        if size > max(room):
            for _ in range(number):
                # Shards that are still empty are filled; the rest waits for its turn by size.
                pieces, rest = [], size
                for s in range(len(left)):
                    if left[s] == room[s] and 0 < room[s] <= rest:
                        pieces.append((s, left[s]))
                        rest -= left[s]
                        left[s] = 0
                todo.append((rest, 1, pieces, size))
        else:
            todo.append((size, number, [], size))
    late, lost = [], 0
    for rest, number, pieces, size in sorted(todo, key=lambda x: (-x[0], -x[3])):
        for s in range(len(left)):
            fit = min(number, left[s] // rest) if rest else number
            if fit:
                out.setdefault(size, []).append((fit, [*pieces, (s, rest)] if rest else pieces))
                left[s] -= fit * rest
                number -= fit
        late += [(rest, pieces, size)] * number
    for rest, pieces, size in late:
        lost += size <= max(room)
        merged = dict(pieces)
        for s, part in spread(rest):
            merged[s] = merged.get(s, 0) + part
        out.setdefault(size, []).append((1, sorted(merged.items())))
    return out, lost


def split_groups(cells: DataFrame, most: int) -> int:
    """Groups in several shards that one of ``most`` rows would hold."""
    whole = cells.groupBy("g1", "g2").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    return whole.where((F.col("k") > 1) & (F.col("n") <= most)).count()


def _pack(many: DataFrame, room: list[int], parts: int) -> tuple[DataFrame, int]:
    """Cells (g1, g2, shard, n) of all groups (g1, g2, n), packed by size, and the number of groups split though they fit."""
    sizes = [(r["n"], r["k"]) for r in many.groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect()]
    plan, lost = packed(sizes, room)
    rows = []
    for size, runs in plan.items():
        end, steps = 0, []
        for number, pieces in runs:
            end += number
            steps.append((end, pieces))
        rows.append((size, steps))
    table = many.sparkSession.createDataFrame(rows, "n long, steps array<struct<end: long, pieces: array<struct<shard: int, n: long>>>>")
    placed = ranked(many.select("g1", "g2", "n"), ["n"], F.xxhash64("g1", "g2"), [F.col("g1"), F.col("g2")], "rank", parts).join(F.broadcast(table), "n")
    pieces = F.filter("steps", lambda x: x["end"] > F.col("rank"))[0]["pieces"]
    return placed.select("g1", "g2", F.explode(pieces).alias("piece")).select("g1", "g2", "piece.shard", "piece.n"), lost


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Put documents into shards of even counts, with equal texts together where they fit.

    Returns one row per input row: id, ``size`` (UTF-8 bytes of the text plus 1),
    ``text_crc32``, ``law`` (``rows``), ``shard``, ``slot`` (gapless from 0 in each
    shard), ``grown_shard`` (null under this law).

    A null text counts as empty and is equal to empty texts. Rows that share an id, or
    have none, are placed one by one; whole repeated rows are interchangeable. With
    fewer rows than shards some shards stay empty. Extra columns are ignored.
    """
    text = F.coalesce(column(docs, text_col), F.lit(""))
    g1, g2 = wide_key(F.col("text"))
    base = docs.select(F.coalesce(column(docs, id_col).cast("long"), F.lit(NO_ID)).alias("owner"), text.alias("text"))
    base = materialise(base.select("owner", (F.octet_length("text") + 1).cast("long").alias("size"), unsigned_crc32(F.col("text")).alias("crc"), g1.alias("g1"), g2.alias("g2")))
    groups = materialise(base.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("n")))
    total, linked, linked_groups = groups.agg(F.sum("n"), F.sum(F.when(F.col("n") > 1, F.col("n"))), F.count_if(F.col("n") > 1)).first()
    total, linked = total or 0, linked or 0
    room = [total // shards + (s < total % shards) for s in range(shards)]

    # Linked documents in group order, dealt one by one: rank r goes to shard r mod shards.
    parts = max(PARTS, -(-total // PART_ROWS))
    many = groups.where("n > 1").withColumn("part", F.pmod("g1", F.lit(parts)).cast("int"))
    whole = many.groupBy("part").agg(F.sum("n").alias("many"))
    whole = whole.withColumn("base", F.coalesce(F.sum("many").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("many")
    inner = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("g1", "g2").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = many.withColumn("inner", inner).join(F.broadcast(whole), "part").select("g1", "g2", "n", (F.col("base") + F.col("inner")).alias("r"))
    dealt = start.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    ahead = F.pmod(F.col("shard") - F.col("r"), F.lit(shards))
    dealt = dealt.withColumn("n", F.floor((F.col("n") - ahead + shards - 1) / shards).cast("long")).where("n > 0")
    cells = _propagate(materialise(dealt.select("g1", "g2", F.col("shard").cast("int").alias("shard"), "n")), room, rounds) if linked else None
    if cells is not None:
        # Moves in part are rounded down, so a shard can give less than it was to and end over its room.
        over = any(r["n"] > room[r["shard"]] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect())
        split = split_groups(cells, max(room))
        if over or split:
            again, lost = _pack(groups.where("n > 1"), room, parts)
            if over or lost < split:
                cells = materialise(again)

    # Documents of a group take its cells by rank; the others fill what room is left, in order of a hash.
    load = [0] * shards
    if cells is not None:
        for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect():
            load[r["shard"]] = r["n"]
    filled, edges = 0, []
    for s in range(shards):
        filled += room[s] - load[s]
        edges.append(filled)
    salt, order = F.xxhash64("owner", "size", "crc"), [F.col("owner"), F.col("size"), F.col("crc")]
    single = base.join(groups.where("n = 1").select("g1", "g2").hint("rebalance"), ["g1", "g2"], "left_semi")
    single = ranked(single.withColumn("all", F.lit(0)), ["all"], F.xxhash64("g1", "g2"), order, "rank", parts)
    to = F.lit(0)
    for s in range(shards - 1):
        to = to + (F.col("rank") >= edges[s]).cast("int")
    placed = single.select("owner", "size", "crc", to.alias("shard"))
    if cells is not None:
        # Ranks in salted parts of the groups; each part meets its group's cells, at most one a shard.
        joined = base.join(groups.where("n > 1").select("g1", "g2").hint("rebalance"), ["g1", "g2"], "left_semi")
        joined = joined.withColumn("part", F.pmod(salt, F.lit(parts)).cast("int"))
        # Dealt by the part too: a partitioning by group alone would serve the window, with a hot group in one task.
        joined = joined.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "g1", "g2", "part")
        counts = joined.groupBy("g1", "g2", "part").agg(F.count(F.lit(1)).alias("many"))
        before = F.coalesce(F.sum("many").over(Window.partitionBy("g1", "g2").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ends = F.sum("n").over(Window.partitionBy("g1", "g2").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))
        steps = cells.withColumn("end", ends).groupBy("g1", "g2").agg(F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("steps"))
        offsets = counts.withColumn("offset", before).join(steps, ["g1", "g2"]).select("g1", "g2", "part", "offset", "steps")
        place = F.row_number().over(Window.partitionBy("g1", "g2", "part").orderBy(*order)) - 1
        joined = joined.withColumn("place", place).join(offsets, ["g1", "g2", "part"])
        joined = joined.withColumn("rank", F.col("offset") + F.col("place"))
        joined = joined.withColumn("shard", F.filter("steps", lambda x: x["end"] > F.col("rank"))[0]["shard"])
        placed = placed.unionByName(joined.select("owner", "size", "crc", "shard"))
    placed = materialise(placed)
    out = ranked(placed, ["shard"], F.xxhash64("owner", "size", "crc"), order, "slot", parts)
    return out.select(
        F.nullif("owner", F.lit(NO_ID)).alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
