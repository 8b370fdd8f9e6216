"""Each operator against brute force on small tables, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import base64
import collections
import gzip
import hashlib
import itertools
import re
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gazetta.llm import common, decontaminate, embedding_dedup, line_dedup, minhash_dedup, mixing, patched_blocks, sharding, shingles, substring_dedup, token_files, toxicity, warc
from gazetta.llm.common import find_words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i:03d}" for i in range(400)]


def texts(seed: int = 3) -> list[tuple]:
    rng = np.random.default_rng(seed)
    sentence = lambda n: " ".join(rng.choice(WORDS, n))
    passage, base = sentence(60), sentence(200).split()
    rows = [(i, sentence(int(rng.integers(1, 120)))) for i in range(20)]
    rows += [(20 + i, f"{sentence(20)}\n{passage}\n{sentence(10)}") for i in range(4)]
    for i in range(4):
        near = list(base)
        near[i * 3] = "changed"
        rows.append((30 + i, " ".join(near)))
    rows += [(40, rows[5][1]), (41, rows[5][1].upper()), (42, None), (43, ""), (44, " \t\x0b\n "), (45, "One Shared line\nx\n\n"), (46, "  one shared LINE \nshort\nshort")]
    rows += [(47, sentence(4000)), (48, "same same " * 60), (49, "é\xa0É ß 日本 \x1c z"), (None, "no id at all"), (45, "repeated id"), (46, "  one shared LINE \nshort\nshort")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if n % 3 else None, f"s{n % 4}" if n % 5 else None, 1) for n, (i, t) in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA).withColumns({"n_lines": F.lit("clash"), "kept": F.lit(1), "label": F.lit(None).cast("string"), "h1": F.lit(2)})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


def test_words_are_those_of_the_pattern():
    given = [t for _, t in texts()] + ["\ta\x0b\x0cb\r\n", "a"]
    found = find_words(pa.array(given, pa.string()))
    data = found.data.tobytes()
    for i, t in enumerate(given):
        own = [data[a:b].decode() for a, b in zip(found.starts[found.offsets[i] : found.offsets[i + 1]], found.ends[found.offsets[i] : found.offsets[i + 1]], strict=True)]
        assert own == words(t)


def test_line_dedup(docs, none):
    key = lambda x: low(x.strip(" \t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    big = 1 << 62
    for i, t in texts():
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                holders[key(x)].add(big if i is None else i)
    want = []
    for i, t in texts():
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= 2 and min(holders[key(x)]) != (big if i is None else i))]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    out = line_dedup.line_dedup(docs)
    assert bag(out.collect()) == bag(want)
    assert line_dedup.line_dedup(none).count() == 0


def test_substring_dedup(docs, none):
    seen = collections.Counter()
    for _, t in texts():
        w = words(t)
        seen.update(tuple(w[k : k + 35]) for k in range(len(w) - 34))
    want = []
    for i, t in texts():
        w = words(t)
        gone = set()
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone.update(range(k, k + 35))
        want.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert bag(substring_dedup.substring_dedup(docs).collect()) == bag(want)
    assert substring_dedup.substring_dedup(none).count() == 0


def test_count_min_cells_round_trip():
    for cells in ([], [0], [5, 6, 70_000, 1 << 21]):
        twice = np.array([n % 2 for n in range(len(cells))], np.int64)
        got, flags = substring_dedup.unpack_cells(substring_dedup.pack_cells(np.array(cells, np.int64), twice))
        assert got.tolist() == cells and flags.tolist() == twice.tolist()


def slow_superminhash(elements, m):
    from gazetta.llm.common import mix

    sig = [1 << 70] * m
    for e in elements:
        perm = list(range(m))
        for level in range(m):
            with np.errstate(over="ignore"):
                draw = int(mix(np.array([e], np.uint64) + shingles.GOLD * np.uint64(level + 1))[0])
            pick = level + ((draw >> 32) * (m - level) >> 32)
            slot = perm[pick]
            perm[level], perm[pick] = slot, perm[level]
            sig[slot] = min(sig[slot], level << 32 | draw & 0xFFFFFFFF)
    return sig


def test_superminhash_is_that_of_the_definition():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (1, 2, 7, 40, 300)]
    fast = shingles.superminhash([*sets, np.zeros(0, np.uint64)], 16)
    for s, row in zip(sets, fast, strict=False):
        assert row.tolist() == slow_superminhash(s.tolist(), 16)


@pytest.mark.parametrize("percent", [80, 85])
def test_minhash_dedup(docs, none, percent):
    def shingle_set(t):
        w = words(low(t or ""))
        return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()

    rows = [(1 << 62 if i is None else i, shingle_set(t)) for i, t in texts()]
    comp = {i: i for i, _ in rows}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for (a, x), (b, y) in itertools.combinations(rows, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((find(a), find(b)))
            comp[q] = p
    want = []
    for i, s in rows:
        c = find(i)
        want.append((None if i == 1 << 62 else i, len(s), None if c == 1 << 62 else c, c == i))
    assert bag(minhash_dedup.minhash_dedup(docs, percent=percent).collect()) == bag(want)
    assert minhash_dedup.minhash_dedup(none).count() == 0


def test_minhash_blocks_of_large_components(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK_CLASSES", 8)
    rng = np.random.default_rng(5)
    base = list(rng.choice(WORDS, 120))
    rows = []
    for i in range(60):
        w = list(base)
        for k in rng.choice(120, int(rng.integers(0, 12)), replace=False):
            w[k] = f"edit{i}x{k}"
        rows.append((i, " ".join(w)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(116)} for i, t in rows}
    comp = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(sets, 2):
            if comp[a] != comp[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                comp[a] = comp[b] = min(comp[a], comp[b])
                changed = True
    out = minhash_dedup.minhash_dedup(spark.createDataFrame(rows, "doc_id long, text string"), percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == comp


def test_decontaminate(spark, docs, none):
    rng = np.random.default_rng(9)
    item = list(rng.choice(WORDS, 40))
    swapped = [w if k % 9 != 4 else "other" for k, w in enumerate(item)]
    part = item[5:30]
    rows = [(1, "intro " + " ".join(item)), (2, " ".join(swapped) + " tail"), (3, "x y " + " ".join(part)), (4, " ".join(rng.permutation(item))), (5, None), (6, ""), (None, " ".join(item).upper() + "!"), (7, " ".join(item[:7]) + " z"), (1, "clean")]
    bench = spark.createDataFrame([(10, " ".join(item)), (11, None), (12, ""), (13, "too short")], "item_id long, text string")
    out = decontaminate.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    got = sorted(((r["doc_id"] or -1, r["n_tokens"]), r["contaminated"], r["item_id"]) for r in out.collect())
    flagged = {k[0] for k, c, _ in got if c}
    assert flagged == {-1, 1, 2, 3} and len(got) == len(rows)
    assert all(item_id == 10 for _, c, item_id in got if c)
    assert decontaminate.decontaminate(none, bench).count() == 0
    empty = bench.where("false")
    assert decontaminate.decontaminate(docs, empty).where("contaminated").count() == 0
    carried = decontaminate.decontaminate(docs, bench, carry=["doc_id", "text", "n_lines"])
    assert carried.select("row.*").columns == ["doc_id", "text", "n_lines"] and carried.count() == docs.count()


def test_decontaminate_misses_no_overlap():
    rng = np.random.default_rng(12)
    for size in [1, 2, 3, 4, 5, 6, 7, 8, 10, 11, 12, 14, 15, 16, 18, 20, 25, 30, 60]:
        for trial in range(60):
            item = [f"i{k}" for k in range(size)]
            run = min(size, 20) if trial % 2 else size
            lo = int(rng.integers(0, size - run + 1))
            copy = item[lo : lo + run]
            for k in rng.choice(run, run // 5, replace=False):
                copy[k] = "other"
            text = ["x"] * int(rng.integers(0, 5)) + copy + ["y"] * int(rng.integers(0, 5))
            h, offsets = decontaminate.tokens(pa.array(["a b", " ".join(text)]))
            found = decontaminate.overlaps(h, offsets, decontaminate.Items([7], [" ".join(item)], 20, 0.8), 20, 0.8)
            assert [(d, n) for d, n, _, _ in found] == [(1, 0)], (size, run, copy)


def test_decontaminate_short_items(spark):
    bench = spark.createDataFrame([(1, "only five short words here"), (2, " ".join(f"k{i}" for i in range(12)))], "item_id long, text string")
    swapped = [f"k{i}" if i not in (4, 8) else "other" for i in range(12)]
    docs = spark.createDataFrame([(1, "so, only five short words here."), (2, " ".join(swapped)), (3, "only five long lines there")], "doc_id long, text string")
    got = {r["doc_id"]: (r["item_id"], r["n_matched"]) for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == {1: (1, 5), 2: (2, 10), 3: (None, 0)}


def test_decontaminate_by_joins(spark, docs, none, monkeypatch):
    """Beyond the broadcast bound the result is the same."""
    bench = docs.where("doc_id IN (1, 2, 3, 20, 45)").select(F.col("doc_id").alias("item_id"), "text")
    whole = bag(decontaminate.decontaminate(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 10)
    assert bag(decontaminate.decontaminate(docs, bench).collect()) == whole
    assert decontaminate.decontaminate(none, bench).count() == 0


def cut(t):
    return [x for x in re.split(r"[\x20\x09-\x0D!-/:-@\[-`{-~]+", low(t or "")) if x]


def slow_overlap(doc, item, least=20, share=0.8):
    """Most equal tokens of an overlap, by every diagonal and every run of it."""
    best = 0
    for shift in range(-len(item) + 1, len(doc)):
        same = [0 <= k + shift < len(doc) and doc[k + shift] == item[k] for k in range(len(item))]
        if sum(same) >= share * len(item) - 1e-9:
            best = max(best, sum(same))
            continue
        inside = [k for k in range(len(item)) if 0 <= k + shift < len(doc)]
        for lo in inside:
            for hi in range(lo + least, inside[-1] + 2):
                if sum(same[lo:hi]) >= share * (hi - lo) - 1e-9:
                    best = max(best, 1)
    return best


@pytest.mark.parametrize("most", [1 << 23, 10])
def test_decontaminate_against_brute_force(spark, monkeypatch, most):
    """Every document against every item: ties, repeated items and rows, long texts, items of all classes of lengths."""
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", most)
    rng = np.random.default_rng(31)
    few = WORDS[:60]
    items = [list(rng.choice(few, n)) for n in (1, 2, 4, 5, 8, 11, 14, 17, 19, 20, 23, 35, 50)]
    items += [items[7], items[11][:25] + list(rng.choice(few, 10))]
    docs = [list(rng.choice(few, int(rng.integers(0, 60)))) for _ in range(40)] + [list(rng.choice(few, 3000))]
    for n in range(60):
        copy = list(items[n % len(items)])
        for k in rng.choice(len(copy), int(rng.integers(0, max(1, len(copy) // 3) + 1)), replace=False):
            copy[k] = str(rng.choice(few))
        at = int(rng.integers(0, 10))
        docs.append(list(rng.choice(few, at)) + copy[int(rng.integers(0, 3)) :] + list(rng.choice(few, 10 - at)))
    docs += [docs[50], docs[50]]
    bench = spark.createDataFrame([(i % 14, ", ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"]): r for r in decontaminate.decontaminate(spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(docs)], "doc_id long, text string"), bench).collect()}
    for i, d in enumerate(docs):
        found = {}
        for k, item in enumerate(items):
            m = slow_overlap(d, item)
            if m:
                found[k % 14] = max(found.get(k % 14, 0), m)
        r = got[i]
        assert (r["n_tokens"], r["n_items"], r["contaminated"]) == (len(d), len(found), bool(found)), (i, found)


def lossless(masks, size, wrong):
    """Whether each choice of ``wrong`` unequal tokens of ``size`` leaves some mask on equal ones."""
    spots = [sum(1 << at + k for k, bit in enumerate(m) if bit == "1") for m in masks for at in range(size - len(m) + 1)]

    def spoilt(hit, left):
        rest = next((p for p in spots if not p & hit), None)
        if rest is None:
            return True
        return left > 0 and any(spoilt(hit | 1 << k, left - 1) for k in range(size) if rest >> k & 1)

    return not spoilt(0, wrong)


@pytest.mark.parametrize("size", range(1, 40))
def test_masks_miss_no_overlap(size):
    assert lossless(decontaminate.masks_of(size, 20, 0.8), size, decontaminate.unequal(size, 0.8))


def test_embedding_dedup(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(120):
        v = rng.normal(size=16)
        rows.append((i, v.tolist(), i % 3))
    for c in range(6):
        for k in range(5 + 10 * (c == 0)):
            rows.append((1000 + 20 * c + k, (np.array(rows[c][1]) + rng.normal(size=16) * 0.08).tolist(), rows[c][2]))
    rows += [(2000, rows[7][1], rows[7][2]), (2001, rows[7][1], rows[7][2]), (2002, rows[7][1], 99), (2003, None, 1), (2004, [0.0] * 16, 1), (2005, [float("nan")] * 16, 1), (2006, [None] * 16, 1), (2007, rows[8][1], None), (2008, [], 1), (2009, rows[8][1][:8], rows[8][2]), (None, rows[9][1], rows[9][2]), (2010, [float("inf")] + [1.0] * 15, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("dim", F.lit("clash"))
    keys = [1 << 62 if r[0] is None else r[0] for r in rows]

    def unit(r):
        v = r[1]
        if not v or r[2] is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        return np.array(v) / np.linalg.norm(v)

    units = [unit(r) for r in rows]
    links, comp = collections.Counter(), {k: k for k in keys}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.98:
            links[a] += 1
            links[b] += 1
            p, q = sorted((find(keys[a]), find(keys[b])))
            comp[q] = p
    big = 1 << 62
    want = [(r[0], links[n], None if find(keys[n]) == big else find(keys[n]), find(keys[n]) == keys[n]) for n, r in enumerate(rows)]
    assert bag(embedding_dedup.embedding_dedup(df).collect()) == bag(want)
    assert embedding_dedup.embedding_dedup(df.where("false")).count() == 0


def two_balls() -> list[tuple]:
    rng = np.random.default_rng(4)
    centres = np.eye(16)[0], np.eye(16)[0] + 0.1 * np.eye(16)[1]
    return [(8 * c + k, (centre + rng.normal(size=16) * 0.004).tolist(), 0) for c, centre in enumerate(centres) for k in range(8)]


def test_embedding_dedup_links_past_saturated_lists(spark):
    df = spark.createDataFrame(two_balls(), "vec_id long, embedding array<double>, label int")
    out = embedding_dedup.embedding_dedup(df).collect()
    assert {(r["n_links"], r["component_id"]) for r in out} == {(15, 0)}


def test_embedding_dedup_below_the_goal_compares_all(spark, monkeypatch):
    rows = two_balls() + [(100 + i, v, 1) for i, v, _ in two_balls()[:9]] + [(200, [0.0] * 15 + [1.0], 1)]
    monkeypatch.setattr(embedding_dedup, "audit", lambda *_: 0.5)
    monkeypatch.setattr(embedding_dedup, "MOST_ROUNDS", 2)
    monkeypatch.setattr(embedding_dedup, "_joined", lambda lists, *_: embedding_dedup._components(lists.where("sim > 2")))
    monkeypatch.setattr(embedding_dedup, "BLOCK", 5)
    out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert out == {i: (15, 0) for i in range(16)} | {100 + i: (8, 100) for i in range(9)} | {200: (0, 200)}


def test_sharding(spark, docs, none):
    rows = [(i, "copy") for i in range(40)] + [(100 + i, f"pair {i // 2}") for i in range(30)] + [(200 + i, f"alone {i}") for i in range(27)] + [(None, None), (None, ""), (7, "copy")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("clash"))
    out = sharding.shard_documents(df).collect()
    counts = collections.Counter(r["shard"] for r in out)
    assert len(out) == len(rows) and set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(counts[s]))
    assert bag((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == bag((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    pairs = collections.defaultdict(set)
    for r in out:
        if r["doc_id"] is not None and 100 <= r["doc_id"] < 200:
            pairs[(r["doc_id"] - 100) // 2].add(r["shard"])
    assert sum(len(p) > 1 for p in pairs.values()) <= 2
    assert len({r["shard"] for r in out if r["text_crc32"] == zlib.crc32(b"copy")}) <= 9
    assert sharding.shard_documents(none).count() == 0
    few = sharding.shard_documents(docs.where("doc_id < 3")).collect()
    assert sorted(r["slot"] for r in few) == [0, 0, 0]


def test_packed_keeps_groups_whole():
    rng = np.random.default_rng(8)
    cases = [([(1200, 20), (300, 40), (2, 3000)], 62_000), ([(20_000, 1), (4, 500), (3, 500), (2, 1500)], 60_000), ([(7, 5)], 35), ([(40, 3), (2, 10)], 140)]
    cases += [([(int(n), int(rng.integers(1, 9))) for n in rng.choice(np.arange(2, 90), 12, replace=False)], 0) for _ in range(20)]
    for sizes, total in cases:
        total = max(total, sum(n * k for n, k in sizes))
        room = [total // 16 + (s < total % 16) for s in range(16)]
        plan, lost = sharding.packed(sizes, room)
        load = collections.Counter()
        for n, k in sizes:
            assert sum(number for number, _ in plan[n]) == k
            for number, pieces in plan[n]:
                assert sum(part for _, part in pieces) == n and len({s for s, _ in pieces}) == len(pieces)
                for s, part in pieces:
                    load[s] += number * part
        assert all(load[s] <= room[s] for s in range(16))
        assert lost == sum(number for n in plan for number, pieces in plan[n] if len(pieces) > 1 and n <= max(room)) < 16
    assert sharding.packed(*[cases[0][0], [3875] * 16])[1] == 0


def test_sharding_keeps_groups_that_fit_whole(spark):
    sizes = [60] * 8 + [15] * 16 + [2] * 300
    rows = [f"group {g}" for g, n in enumerate(sizes) for _ in range(n)] + [f"alone {i}" for i in range(400)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = sharding.shard_documents(df).collect()
    counts, shards = collections.Counter(r["shard"] for r in out), collections.defaultdict(set)
    for r in out:
        shards[rows[r["doc_id"]]].add(r["shard"])
    assert len(out) == len(rows) and max(counts.values()) - min(counts.values()) <= 1
    assert not [t for t, s in shards.items() if len(s) > 1]


def fewest_split(sizes, room):
    """Fewest groups that any placement splits, by trying all of them; documents alone fill what is left."""
    best = len(sizes)

    def place(k, left, split):
        nonlocal best
        if split >= best:
            return
        if k == len(sizes):
            best = split
            return
        for s in {left[i]: i for i in range(len(left)) if left[i] >= sizes[k]}.values():
            place(k + 1, [x - sizes[k] * (i == s) for i, x in enumerate(left)], split)
        rest, after = sizes[k], list(left)
        for i in sorted(range(len(after)), key=lambda i: after[i]):  # the fullest first: what a split leaves is in few shards
            part = min(rest, after[i])
            after[i] -= part
            rest -= part
        place(k + 1, after, split + 1)

    place(0, list(room), 0)
    return best


@pytest.mark.parametrize("sizes", [[5, 5, 5, 5], [6, 6, 3, 3, 2], [9, 4, 4, 4, 2, 2], [3] * 7, [8, 7, 2, 2, 2, 2]])
def test_sharding_splits_as_few_groups_as_any_placement(spark, sizes):
    total = sum(sizes) + 4
    rows = [f"group {g}" for g, n in enumerate(sizes) for _ in range(n)] + [f"alone {i}" for i in range(4)]
    out = sharding.shard_documents(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), shards=3).collect()
    shards = collections.defaultdict(set)
    for r in out:
        shards[rows[r["doc_id"]]].add(r["shard"])
    room = [total // 3 + (s < total % 3) for s in range(3)]
    assert sum(len(s) > 1 for s in shards.values()) <= fewest_split(sorted(sizes, reverse=True), room) + 1


def test_quotas_keep_rooms():
    wish = {(0, 1): 10, (1, 0): 4, (2, 1): 10, (1, 2): 1}
    got = sharding.quotas(wish, [5, 5, 10], [9, 8, 10])
    for s, load in enumerate([5, 5, 10]):
        assert load + sum(v for (a, b), v in got.items() if b == s) - sum(v for (a, b), v in got.items() if a == s) <= [9, 8, 10][s]
    assert got[0, 1] >= 1


def test_patched_blocks_round_trip():
    rng = np.random.default_rng(4)
    for values in ([], [7], [0] * 600, list(rng.integers(0, 50_000, 2000)), [1] * 500 + [2**32 - 1] * 30 + [5] * 700, list(rng.integers(0, 2**32, 513))):
        v = np.array(values, np.uint32)
        ids, counts, back = patched_blocks.decode_file(patched_blocks.encode_file([1, -2], [len(v), 0], v))
        assert back.tolist() == v.tolist() and ids.tolist() == [1, -2] and counts.tolist() == [len(v), 0]


def test_token_files(spark, docs, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_files.default_tokenizer())
    rows = sorted(((1 << 62 if i is None else i, x or "") for i, x in texts()))
    start, want = 0, []
    for i, x in rows:
        ids = t.encode(x, add_special_tokens=False).ids + [0]
        want.append((None if i == 1 << 62 else i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert bag(token_files.token_round_trip(docs).collect()) == bag(want)
    assert token_files.token_round_trip(none).count() == 0


def test_token_files_of_one_id(spark, monkeypatch):
    """Rows of one id, or of none, fill several files; starts go on from file to file."""
    monkeypatch.setattr(token_files, "FILE_IDS", 10)
    monkeypatch.setattr(token_files, "CHUNK_BITS", 1)
    rows = [(None if n % 2 else 3, " ".join(["word"] * (n % 7)) or None) for n in range(60)]
    out = token_files.token_round_trip(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    spans = sorted((r["start"], r["start"] + r["n_tokens"], r["doc_id"]) for r in out)
    assert spans[0][0] == 0 and all(x[1] == y[0] for x, y in itertools.pairwise(spans)) and len(spans) == 60
    assert [s[2] for s in spans] == [3] * 30 + [None] * 30


@pytest.mark.parametrize("text", ["", " ", "  a  b", "a\n\n b\t c ", " x", "x ", "a  b 's don't    z\x1c y", "\x1c \x85 é<|endoftext|> 12ab 's", "日本 語 😀 a", "a\xa0 b \xa0c", "9 9a a9 ' 's", "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>\n", "<|endoftext", "one,\ntwo.\n\nthree\n", "a\nb c\nd,\te", "tab\t x", " \n", "\n x\n", "(a) b(c d) \"e\" f's g' h!?\ni...", "\ta\tb c", "n\r\nm o\x85p q", "x\u3000 y\u2028z w\x1f v", "é. ß,, ñ\nÑ! 5é é5, é5"])
def test_encoder_is_the_tokenizer(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_files.default_tokenizer())
    assert token_files.encoder_of(token_files.default_tokenizer()).encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_mixing(spark, docs, none):
    out = mixing.mix(docs)
    rows = out.collect()
    assert len(rows) == docs.count()
    assert bag((r["doc_id"], r["n_tokens"]) for r in rows) == bag((i, len(words(t))) for i, t in texts())
    assert all(0 <= r["probability"] <= 1 for r in rows) and any(r["probability"] == 1 for r in rows)
    assert mixing.mix(none).count() == 0


def test_mixing_meets_targets(spark):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(["w"] * int(rng.integers(20, 1500))), ["en", "de", "fr", "es"][int(rng.integers(0, 4))], "abc"[min(2, int(rng.integers(0, 6)))]) for i in range(400)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), rounds=25)
    cells = out.select("source", "lang", "topic", "weight").distinct().toPandas()
    assert abs(cells.weight.sum() - 1) < 1e-6
    for lang, share in mixing.LANGUAGES.items():
        assert abs(cells[cells.lang == lang].weight.sum() - share) < 1e-3
    tokens = out.groupBy("source").agg(F.sum("n_tokens").alias("t")).toPandas().set_index("source").t ** 0.5
    assert (cells.groupby("source").weight.sum() - tokens / tokens.sum()).abs().max() < 1e-3


def test_mixing_residual_with_production_rounds(spark):
    """After the production number of rounds every marginal is within a thousandth of its target."""
    rng = np.random.default_rng(16)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 1500))), ["en", "de", "fr", "es"][int(rng.integers(0, 4))], f"s{int(rng.integers(0, 20))}") for i in range(1500)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    cells = out.select("source", "lang", "topic", "weight").distinct().toPandas()
    for name, targets in (("lang", mixing.LANGUAGES), ("topic", mixing.TOPICS)):
        assert (cells.groupby(name).weight.sum() - pd.Series(targets)).abs().max() < 1e-3
    tokens = out.groupBy("source").agg(F.sum("n_tokens").alias("t")).toPandas().set_index("source").t ** 0.5
    assert (cells.groupby("source").weight.sum() - tokens / tokens.sum()).abs().max() < 1e-3


@pytest.mark.parametrize("sources", [9, 200])
def test_mixing_against_plain_raking(spark, sources):
    """Every cell against iterative proportional fitting in numpy, with nulls, languages without a target and empty texts."""
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 1500))), ["en", "de", "fr", "es", "it", None][int(rng.integers(0, 6))], [f"s{i % sources}", None][i % 31 == 0]) for i in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    kind = lambda n: "short" if n < 100 else "medium" if n < 1000 else "long"
    cell = {i: (s or "(rest)", g if g in mixing.LANGUAGES else "(rest)", kind(len(t.split()))) for i, t, g, s in rows}
    axes = [sorted({c[k] for c in cell.values()}) for k in range(3)]
    tokens = np.zeros([len(a) for a in axes])
    for i, t, _, _ in rows:
        tokens[tuple(a.index(v) for a, v in zip(axes, cell[i], strict=True))] += len(t.split())
    w, targets = tokens / tokens.sum(), []
    for k, given in enumerate((None, mixing.LANGUAGES, mixing.TOPICS)):
        own = tokens.sum(axis=tuple({0, 1, 2} - {k}))
        want = own**mixing.TEMPER if given is None else np.array([given.get(v, own[n] / own.sum()) for n, v in enumerate(axes[k])])
        targets.append(np.where(own > 0, want, 0) / np.where(own > 0, want, 0).sum())
    for _ in range(mixing.ROUNDS):
        for k in range(3):
            own = w.sum(axis=tuple({0, 1, 2} - {k}), keepdims=True)
            w = w * np.divide(np.reshape(targets[k], own.shape), own, out=np.zeros_like(own), where=own > 0)
    p = np.divide(w, tokens, out=np.zeros_like(w), where=tokens > 0)
    p = np.where(tokens > 0, p / p.max(), 1.0)
    assert len(got) == len(rows)
    for r in got:
        at = tuple(a.index(v) for a, v in zip(axes, cell[r["doc_id"]], strict=True))
        assert abs(r["weight"] - w[at]) < 2e-9 and abs(r["probability"] - p[at]) < 2e-9


def test_warc(spark):
    big, other = "<p>" + "x" * 2000, "y" * 1000
    rows = [(1, "http://a.example/1", big), (2, "http://a.example/2\r\nEvil: 1", big), (3, None, big), (4, "http://b.example/?q=1", "small"), (5, "http://b.example/", "small"), (6, "", None), (7, "http://c.example/", other), (8, "http://c.example/é", other), (8, "http://c.example/é", other), (-5, "u", "neg\r\n\r\nWARC/1.1"), (None, "v", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    last = {h: max((p if p is not None else 1 << 62) for p, _, x in rows if (x or "") == h) for h in {x or "" for _, _, x in rows}}
    want = []
    for p, _, h in rows:
        h = h or ""
        revisit = len(h) >= 1000 and last[h] != (p if p is not None else 1 << 62)
        want.append((p, len(h.encode()), hashlib.sha1(h.encode()).hexdigest(), "revisit" if revisit else "response", None if not revisit or last[h] == 1 << 62 else last[h]))
    assert bag(warc.archive_round_trip(pages).collect()) == bag(want)
    assert warc.archive_round_trip(pages.where("false")).count() == 0


def test_warc_captures_are_nested(spark, tmp_path):
    pages = spark.createDataFrame([(3, "http://a.example/x", "body"), (4, "http://a.example/y", "z" * 1500)], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    assert warc.write_archives(pages, folder) == 2
    rows = {r["page_id"]: r for r in warc.assemble(warc.read_records(spark, folder)).collect()}
    assert bytes(rows[3]["response"]["payload"]) == b"body" and rows[3]["metadata"]["length"] == 4
    assert rows[4]["request"]["url"] == "http://a.example/y" and rows[4]["response"]["kind"] == "response"


def member(kind, block, **headers):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", *(f"WARC-{k.replace('_', '-')}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def test_warc_archives_of_others():
    body = b"<p>" + b"long " * 30_000
    base32 = base64.b32encode(hashlib.sha1(body).digest()).decode()
    data = member("warcinfo", b"software: x", Record_ID="<urn:uuid:0>") + member("response", b"HTTP/1.1 200 OK\r\n\r\n" + body, Record_ID="<urn:uuid:12345678-1234-4234-9234-123456789012>", Target_URI="http://x/", Payload_Digest=f"sha1:{base32}")
    data += member("response", b"HTTP/1.1 200 OK\r\n\r\nz", Record_ID="<urn:x:1>", Payload_Digest="sha256:ab") + member("metadata", b"via: x", Record_ID="<urn:x:2>", Concurrent_To="<urn:x:1>") + member("revisit", b"", Record_ID="<urn:x:3>")
    rows = list(warc.parse_records(data))
    assert [(r[0], r[7], r[8], r[9]) for r in rows] == [("response", hashlib.sha1(body).hexdigest(), len(body), None), ("response", "sha256:ab", 1, None), ("metadata", None, None, None), ("revisit", None, None, None)]
    with pytest.raises(ValueError, match="damaged"):
        list(warc.parse_records(member("response", b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\nshort", Record_ID="<urn:x:1>")))
    with pytest.raises(ValueError, match="ends within"):
        list(warc.parse_records(data[:-9]))


def test_warc_long_pages(spark):
    pages = spark.createDataFrame([(1, "u", "é" * 400_000), (2, "v", "é" * 400_000)], "page_id long, url string, html string")
    got = sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive_round_trip(pages).collect())
    assert got == [(1, 800_000, "revisit", 2), (2, 800_000, "response", None)]


def test_warc_pages_without_id(spark, tmp_path):
    rows = [(None, f"u{n % 7}", "z" * 1200 if n % 2 else "short") for n in range(90)] + [(1, "v", "z" * 1200), (1, "w", "other"), (1, "w", "other")]
    folder = f"file://{tmp_path}/w"
    assert warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), folder) == 93
    got = warc.read_records(spark, folder).collect()
    assert len({r["record_id"] for r in got}) == len(got) == 3 * 93
    assert collections.Counter(r["kind"] for r in got) == {"request": 93, "metadata": 93, "response": 92, "revisit": 1}


@pytest.mark.parametrize(("page", "copy", "kind"), [(0, 0, "request"), (-1, 3, "response"), ((1 << 63) - 1, 9, "metadata"), (-(1 << 63), 0, "request"), (123456789, 1 << 40, "response")])
def test_record_ids_hold_the_page(page, copy, kind):
    assert warc.page_of(warc.record_id(page, copy, kind)) == page


def toxic_rows(n=300, seed=8):
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        w = list(rng.choice(WORDS, int(rng.integers(10, 200))))
        bad = i % 4 == 0
        if bad:
            w[int(rng.integers(0, len(w)))] = rng.choice(["scoundrel", "scoundrels", "nincompoop"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity(spark, docs, none):
    rows, labels = toxic_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    given = spark.createDataFrame([*labels, (None, 1), (5, None), (5, 0)], "doc_id long, toxic int")
    model = toxicity.fit(df, given)
    out = {r["doc_id"]: r for r in toxicity.score_toxicity(df, model).collect()}
    assert all(r["held_out"] == toxicity.is_held_out(i) for i, r in out.items())
    held = [i for i in out if out[i]["held_out"]]
    right = sum(out[i]["predicted"] == labels[i][1] for i in held)
    assert right >= 0.9 * len(held)
    assert model.score(pa.array(["a scoundrell here"]))[0] > model.score(pa.array(["a quiet here"]))[0]
    scored = toxicity.score_toxicity(docs, model, carry=["doc_id", "lang"])
    assert scored.count() == docs.count() and scored.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxicity.score_toxicity(none, toxicity.fit(none, given)).count() == 0


def test_toxicity_sample_passes_over_long_texts(spark):
    first = [r["id"] for r in spark.range(200).orderBy(F.xxhash64("id")).collect() if not toxicity.is_held_out(r["id"])]
    labels = [(i, n % 2) for n, i in enumerate(first)]
    rows = [(i, ("bad " if y else "good ") * (1000 if n < 2 else 3)) for n, (i, y) in enumerate(labels)]
    df, given = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got, ys = toxicity.sample(df, given, "doc_id", "text", "toxic", 1500, 2000)
    assert sorted(ys) == sorted(y for _, y in labels[2:]) and max(map(len, got)) < 2000
    assert toxicity.score_toxicity(df, toxicity.fit(df, given), carry=["doc_id", "text"]).select("row.text").count() == df.count()
    many = df.unionByName(spark.range(50).selectExpr(f"{first[1]} as doc_id", "concat('bad ', id) as text"))
    assert sum(t.startswith("bad ") for t in toxicity.sample(many, given, "doc_id", "text", "toxic", 1500, 1 << 20)[0]) <= sum(y for _, y in labels) + 3
    got, ys = toxicity.sample(df, given, "doc_id", "text", "toxic", 1500, 5)
    assert sorted(ys) == [0, 1] and max(map(len, got)) < 20


def test_toxicity_fit_holds_little_at_once():
    """The fit runs on the driver: 1,680,000 n-grams of 40,000 words that come once take less than 60 bytes each."""
    letters = np.random.default_rng(3).integers(97, 123, (40_000, 12), np.uint8)
    words = [w.tobytes().decode() for w in letters]
    texts = [" ".join(words[i : i + 100]) for i in range(0, len(words), 100)]
    owner, bucket = toxicity.word_grams([w.encode() for w in words])
    _, owners, buckets = toxicity.grams(pa.array(words))
    order = np.argsort(owners, kind="stable")
    assert (owner == owners[order]).all() and (bucket == buckets[order]).all()
    tracemalloc.start()
    toxicity.train(texts, [i % 2 for i in range(len(texts))], rounds=())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * len(owner)


def test_toxicity_scores_whole_texts_alike(spark):
    rows, labels = toxic_rows()
    model = toxicity.train([t for _, t in rows], [y for _, y in labels])
    clean = " ".join(WORDS * 50)
    assert model.score(pa.array([clean + " scoundrel"]))[0] > model.score(pa.array([clean]))[0]
    together = model.score(pa.array([t for _, t in rows[:20]]))
    assert np.allclose(together, [model.score(pa.array([t]))[0] for _, t in rows[:20]])


def test_rows_without_a_partner_stay_out_of_the_shuffle(spark):
    """No row with a partner is lost, few others pass, and the texts of minhash_dedup go through the bitmap first."""
    rows = spark.range(-20000, 20000).select(F.when(F.col("id") != 7, F.col("id")).alias("k"), F.col("id").alias("n"))
    keys = spark.range(-20000, 20000, 40).select(F.col("id").alias("k"))
    passed = {r.k for r in common.may_be_among(rows, keys, "k").select("k").collect()}
    assert passed >= set(range(-20000, 20000, 40)) and len(passed) < 1100 and None not in passed
    assert common.may_be_among(rows, keys.where("false"), "k").isEmpty() and common.may_be_among(rows, keys, "k").columns == ["k", "n"]
    assert common.may_be_among(rows.where("n > 0").limit(0), keys, "k").isEmpty()
