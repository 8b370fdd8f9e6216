"""Collocations, quality and the filter audit against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import itertools
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gazetta.llm import collocations, filter_audit, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(900, None), (901, ""), (902, " \t\x0b\n "), (903, "..;!?"), (904, "é\xa0É ß 日本 \x1c z"), (None, "no id at all, none"), (None, "no id at all, none"), (905, "Same row twice: the same."), (905, "Same row twice: the same.")]


def clashing(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({"phrase": F.lit("clash"), "n": F.lit(1), "part": F.lit(2), "x": F.lit("y"), "id": F.lit(7), "kind": F.lit(0), "score": F.lit(0.5), "mask": F.lit(3)})


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


# Collocations


def phrase_rows():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(12)] + ["New", "york", "CITY", "été"]
    rows = []
    for i in range(60):
        n = int(rng.integers(1, 80))
        parts = [str(rng.choice(words)) + str(rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b", ": "], p=[0.6, 0.1, 0.1, 0.05, 0.05, 0.04, 0.03, 0.03])) for _ in range(n)]
        rows.append((i, "".join(parts) + "new york city " * int(rng.integers(0, 3)), "en" if i % 3 else None))
    rows.append((100, "a a a a a a a a a a a a a", "aa"))
    rows.append((101, "long piece without a break " * 40_000, "zz"))
    return rows + [(i, t, "en") for i, t in ODD]


def slow_collocations(rows, longest=3, least=10, covered=50, most=2000):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text or "")):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(ws)
            for size in range(1, longest + 1):
                for i in range(len(ws) - size + 1):
                    f[lang or "und", tuple(ws[i : i + size])] += 1
    good = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    found = collections.defaultdict(list)
    for (lang, p), a in good.items():
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
        if any(g == lang and len(q) > len(p) and inside(q) and 100 * b >= covered * a for (g, q), b in good.items()):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out = []
    for lang, own in found.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(own)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return out


@pytest.mark.parametrize("longest,least,most", [(3, 10, 2000), (4, 3, 17), (2, 1, 50)])
def test_collocations(spark, longest, least, most):
    rows = [r for r in phrase_rows() if longest == 3 or r[0] != 101]
    out = collocations.collocations(clashing(spark, [(i, t, lang, "s", 1) for i, t, lang in rows]), longest=longest, least=least, most=most)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = slow_collocations(rows, longest, least, 50, most)
    assert want and sorted(map(tuple, out.collect())) == sorted(want)


def test_collocations_in_small_steps_and_full_buckets(spark, monkeypatch):
    """Stretches of a few bytes, sums and cells that are handed on at once, and bitmaps too small to tell anything apart: the result stays."""
    rows = [r for r in phrase_rows() if r[0] != 101]
    docs = spark.createDataFrame([(i, t, lang, "s", 1) for i, t, lang in rows], SCHEMA)
    want = sorted(slow_collocations(rows))
    monkeypatch.setattr(collocations, "bitmap_bits", lambda size: 9)
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == want
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] or "und" for r in rows]), pa.array([r[1] for r in rows], pa.string())], ["lang", "text"])
    monkeypatch.setattr(collocations, "STEP", 40)
    monkeypatch.setattr(collocations, "HELD", 20)
    monkeypatch.setattr(collocations, "FLUSH", 50)
    sums = collections.Counter()
    for got in collocations._count(1, 3, 10, 12, None, None)(iter([batch])):
        for kind, lang, phrase, n, *_ in zip(*(c.to_pylist() for c in got.columns), strict=True):
            if kind == 0:
                sums[lang, phrase] += n
    words = collections.Counter((lang or "und", w) for _, t, lang in rows for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(t or "")) for w in re.findall(r"[^\x20\x09]+", piece))
    assert sums == words


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, None, None, None), (2, "one", "en", "s", 1)], SCHEMA)).count() == 0


def test_scores_past_64_bits(spark):
    """The arithmetic of the score on counts whose products pass 64 bits, against whole numbers."""
    counts = [(10**14 + 7, 10**14 + 9, 10**14 + 11), (3 * 10**13, 10**14, 9 * 10**13 + 1), (10, 10**15, 10**15)]
    row = spark.createDataFrame(counts, "a long, l long, r long").selectExpr(*(f"CAST({c} AS DECIMAL(19,0)) AS {n}" for c, n in (("a", "w"), ("l", "wl"), ("r", "wr"))))
    got = [r[0] for r in row.selectExpr("(CAST(1000000 AS DECIMAL(7,0)) * (w * w)) div (wl * wr)").collect()]
    assert got == [1_000_000 * a * a // (left * right) for a, left, right in counts]


def test_counts_of_buckets_round_trip():
    for cells in ([], [0], [5, 6, 70_000, 1 << 21]):
        blob = collocations.pack_counts(np.array(cells, np.int64), np.arange(len(cells)) + 9, 10)
        got, counts = collocations.unpack_counts(blob)
        assert got.tolist() == cells and counts.tolist() == [min(10, 9 + i) for i in range(len(cells))]


# Quality


def prose(rng, n):
    return " ".join("".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 9)))) + ("." if rng.random() < 0.1 else "") for _ in range(n))


def quality_rows(n=500):
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(n):
        text = prose(rng, int(rng.integers(5, 200)))
        bad = i % 4 == 0
        if bad:
            text = [text.upper() + "!!", " ".join(w + "$$$" for w in text.split()), " ".join(w for w in text.split() for _ in range(7)), text.replace(" ", " | ")][i // 4 % 4]
        rows.append((i, text, "en", "s", 1))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_quality_learns_and_holds_out(spark):
    rows, labels = quality_rows()
    odd = [(i, t, None, None, None) for i, t in ODD] + [(906, "word " * 300_000, "en", "s", 1)]
    docs = clashing(spark, rows + odd)
    known = spark.createDataFrame(labels + [(None, 1, 1), (905, None, None), (3, 1, None)], "doc_id long, quality int, toxic int").withColumns({"x": F.lit(1), "id": F.lit("clash")})
    out = quality.score_quality(docs, known)
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    got = out.collect()
    assert len(got) == len(rows) + len(odd)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.doc_id in truth and r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    # Held-out labels teach nothing: turned round, they change no score. Repeated rows have one score; so has a null text and an empty one.
    turned = spark.createDataFrame([(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 0) for i, q, _ in labels], "doc_id long, quality int, toxic int")
    again = {r.doc_id: r.score for r in quality.score_quality(docs, turned).collect() if r.doc_id is not None}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in got if r.doc_id is not None)
    of = collections.defaultdict(set)
    for r in got:
        of[r.doc_id].add(r.score)
    assert all(len(s) == 1 for s in of.values()) and of[900] == of[901]


def test_quality_is_the_discriminant_of_its_definition(spark):
    """Moments by tasks and folds against numpy over all rows at once, densities against explicit inverses and determinants."""
    rows, labels = quality_rows(300)
    docs, known = spark.createDataFrame(rows, SCHEMA).repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.fit(quality.text_statistics(docs), known)
    taught = [(t, q) for (i, t, *_), (_, q, _) in zip(rows, labels, strict=True) if zlib.crc32(str(i).encode()) % 5]
    x, y = quality.statistics(pa.array([t for t, _ in taught])), np.array([q for _, q in taught])
    d = x.shape[1]
    n = np.array([(y == c).sum() for c in (0, 1)])
    shift = x.mean(axis=0)
    own = [np.cov(x[y == c].T, bias=True) for c in (0, 1)]
    means = [x[y == c].mean(axis=0) - shift for c in (0, 1)]
    total = sum(n[c] * (own[c] + np.outer(means[c], means[c])) for c in (0, 1)) / n.sum()
    scale = np.sqrt(np.diag(total))
    own = [s / np.outer(scale, scale) for s in own]
    pooled = (n[0] * own[0] + n[1] * own[1]) / n.sum()
    z = (x - shift) / scale
    logs = []
    for c in (0, 1):
        share = d / (d + n[c])
        s = (1 - share) * own[c] + share * pooled
        s = (1 - quality.DIAGONAL) * s + quality.DIAGONAL * (np.diag(np.diag(s)) + np.eye(d)) / 2 + 1e-4 * np.eye(d)
        off = z - means[c] / scale
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(s), off) - 0.5 * np.linalg.slogdet(s)[1] + np.log(n[c] / n.sum()))
    assert np.allclose(model.difference(x), np.arcsinh(logs[1] - logs[0]), rtol=1e-5, atol=1e-5)


def test_statistics_by_hand():
    x = dict(zip(quality.STATISTICS, quality.statistics(pa.array(["Ab ab ab 1!\nab ab ab", None], pa.string())).T.tolist(), strict=True))
    assert np.allclose(x["words"], np.log1p([7, 0]))
    share = lambda part, whole: np.log((part + 0.5) / (whole - part + 0.5 + 0.01 * whole))
    assert np.allclose(x["repeated_next"], [share(3, 7), share(0, 0)])
    assert np.allclose(x["repeated_threes"], [share(0, 5), share(0, 0)])
    assert np.allclose(x["upper"], [share(1, 12), share(0, 0)]) and np.allclose(x["distinct"], [np.log(4 / 8), 0])
    assert np.allclose(x["lines"], [np.log(2 / 8), 0])


@pytest.mark.parametrize("labels,level", [([], 0.5), ([(0, 1, 0), (1, 1, 0), (2, 1, 0), (3, 1, 0)], 1.0), ([(0, 0, 0), (1, 0, 0), (2, 0, 0), (3, 0, 0)], 0.0)])
def test_quality_of_one_class_or_none(spark, labels, level):
    rows, _ = quality_rows(4)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score_quality(spark.createDataFrame(rows, SCHEMA), known).collect()} == {level}
    assert quality.score_quality(spark.createDataFrame([], SCHEMA), known).count() == 0


def test_statistics_of_long_texts_are_those_of_the_whole():
    parts = [prose(np.random.default_rng(k), 3000) for k in range(30)]
    both = quality.statistics(pa.array([" ".join(parts), "short", " ".join(parts)]))
    assert (both[0] == both[2]).all() and np.isclose(both[0][0], np.log1p(90_000))


# Filter audit


def audit_rows():
    rng = np.random.default_rng(6)
    long = " ".join(f"w{i}" for i in range(210))
    rows = [(i, [prose(rng, 30), long + f" {i}", "same words " * 120, "UPPER " * 50, "a | b", long][i % 6], ["en", "de", None, ""][i % 4]) for i in range(80)]
    rows += [(i, "the one hot text", "en" if i % 2 else "de") for i in range(200, 300)]
    rows += [(200, "the one hot text", "fr"), (150, "x" * 400_000, "en")]
    return rows + [(i, t, "en") for i, t in ODD]


def slow_audit(rows, labels):
    none = 1 << 62
    good, toxic = collections.defaultdict(int), collections.defaultdict(int)
    for i, q, t in labels:
        good[i] |= int(q == 1)
        toxic[i] |= int(t == 1)
    least = {}
    for i, t, _ in rows:
        own = none if i is None else i
        least[t or ""] = min(own, least.get(t or "", none))
    by = collections.defaultdict(list)
    for i, t, part in rows:
        t = t or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(ws) < 200, "B": 100 * len(set(ws)) < 50 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": least[t] < (none if i is None else i)}
        by[part or ""].append(({k for k, v in fails.items() if v}, good[i] if i is not None else 0, toxic[i] if i is not None else 0))
    out = []
    for part, docs in by.items():
        here, shapley = [], collections.Counter()
        for order in itertools.permutations("ABCDE"):
            for step in range(1, 6):
                f, before = order[step - 1], set(order[: step - 1])
                removed = [d for d in docs if f in d[0] and not d[0] & before]
                shapley[f] += len(removed)
                here.append((part, "".join(order), step, sum(not d[0] & (before | {f}) for d in docs), len(removed), sum(f in d[0] and bool(d[0] & before) for d in docs), sum(d[0] == {f} for d in docs), sum(d[1] for d in removed), sum(d[2] for d in removed)))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in here]
    return out


@pytest.mark.parametrize("bits", [64, 2])
def test_filter_audit(spark, bits, monkeypatch):
    """Two bits of fingerprint leave four chains, in which nearly all texts collide."""
    rows = audit_rows()
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 290, 3)] + [(3, 0, 1), (None, 1, 1), (9, None, None)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    docs = clashing(spark, [(i, t, part, "s", 1) for i, t, part in rows]).withColumns({"good": F.lit("z"), "label_id": F.lit(4)}).repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumns({"id": F.lit(1), "n": F.lit(2), "part": F.lit("p"), "mask": F.lit(9)})
    out = filter_audit.filter_audit(docs, known, bits=bits)
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, out.collect())) == sorted(slow_audit(rows, labels))


def test_filter_audit_by_sql(spark):
    rows = [r for r in audit_rows() if r[0] is not None]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 290, 3)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR); CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    assert sorted(con.execute(filter_audit.ORACLE).fetchall()) == sorted(slow_audit(rows, labels))


def test_filter_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_chains_hand_on_when_full(monkeypatch):
    monkeypatch.setattr(filter_audit, "HELD_BYTES", 1)
    rows = [(i, "p", i % 3, f"text {i % 5}") for i in range(40)]
    out = list(filter_audit._local(iter(rows)))
    assert len([v for _, v in out if v[0] is not None]) == 40
    settled = list(filter_audit._settled(iter(out)))
    assert sorted(i for i, _, mask, _ in settled if not mask & filter_audit.COPY) == list(range(15))


# Numbers and archives at their edges


def test_vectors_of_huge_and_tiny_components(spark):
    """Squares that overflow or vanish change nothing: the links are those of the same vectors at an ordinary size."""
    from gazetta.llm import embedding_dedup

    base = [[1.0, 1.0, 0.5], [1.0, 1.01, 0.5], [-1.0, 0.2, 3.0], [2.0, 2.0, 1.0]]
    rows = [(100 * k + i, [x * s for x in v], k) for k, s in enumerate((1.0, 1e200, 1e-200, 1e307, 5e-322)) for i, v in enumerate(base)] + [(900, [0.0, 0.0, 0.0], 1), (901, [-0.0, 0.0, 0.0], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    for k in range(4):
        assert [got[100 * k + i] for i in range(4)] == [(2, 100 * k), (2, 100 * k), (0, 100 * k + 2), (2, 100 * k)]
    assert got[900] == (0, 900) and got[901] == (0, 901) and got[400][0] == 2


def test_warc_headers_of_others():
    import gzip

    from gazetta.llm import warc

    odd = gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/\xff\xfe\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n")
    short = gzip.compress(b"WARC/1.0\r\nContent-Length: nothing\r\n\r\n\r\n\r\n")
    rows = list(warc.parse_records(odd + short))
    assert [(r[0], r[1], r[8], r[10]) for r in rows] == [("response", "", 4, b"body")] and rows[0][5].startswith("http://x/")
    with pytest.raises(ValueError, match="not a WARC record"):
        list(warc.parse_records(gzip.compress(b"no archive")))
