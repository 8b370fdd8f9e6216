"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its byte n-grams (with its borders), so an unseen misspelling
shares vectors with the word it was made from. A span of a few words is the average
of its n-gram vectors, and a linear softmax over that average gives its odds. A
document is as toxic as its worst span: one slur in a novel isn't averaged away.
Vectors and softmax are trained jointly in numpy, on spans; only documents have
labels, so after a first fit the spans of toxic documents that carry the label are
picked by the model itself and the rest of those documents is left out.

The fit runs on a bounded sample of labelled rows (``most_docs`` rows a class,
``most_bytes`` of text a class), taken in an order given by a hash of the id. As
the model is linear in the n-grams, what goes to the workers is one number for
each bucket: a fixed 1 MB. Every text is scored whole, with no shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from gazetta.llm.common import chunks, column, text_bytes, unpacked

BUCKET_BITS, DIM, SPAN, GRAMS, FEWEST = 18, 8, 3, (3, 4, 5, 6), 4
THRESHOLD = 0.3
#: Bytes of text scored at a time: a byte takes part in four n-grams, each with some 8-byte numbers.
STEP = 1 << 17
#: ASCII letters go to lower case; white space and ASCII punctuation go to a space.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[[c for c in range(128) if not chr(c).isalnum()]] = 32


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words a text (as offsets), and of each n-gram its word and its bucket."""
    data, bounds = text_bytes(pc.binary_join_element_wise(" ", pc.fill_null(texts, ""), " ", ""))
    data = FOLD[data]
    inside = data != 32
    begin = inside & ~np.concatenate([[False], inside[:-1]])
    word = np.cumsum(begin) - 1
    offsets = np.concatenate([[0], np.cumsum(begin)])[bounds]
    blanks = np.concatenate([[0], np.cumsum(~inside)])
    owners, buckets = [], []
    value = data.astype(np.uint32)
    with np.errstate(over="ignore"):
        run = value[:-2] * np.uint32(0x9E3779B1) + value[1:-1] * np.uint32(0x85EBCA77) if len(data) > 2 else value[:0]
        for n in GRAMS:
            if len(data) < n:
                break
            run = (run[: len(data) - n + 1] ^ (run[: len(data) - n + 1] >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + value[n - 1 :] * np.uint32(0xC2B2AE3D)
            at = np.flatnonzero(blanks[n - 1 : len(data)] == blanks[1 : len(data) - n + 2])
            key = run[at] * np.uint32(0x297A2D39) + np.uint32(n)
            buckets.append(((key ^ (key >> np.uint32(13))) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS))
            owners.append(word[at + 1])
    if not owners:
        return offsets, np.zeros(0, np.int64), np.zeros(0, np.int64)
    return offsets, np.concatenate(owners), np.concatenate(buckets).astype(np.int64)


def worst_spans(offsets: np.ndarray, worth: np.ndarray, count: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """For each text the largest average worth of ``SPAN`` words in a row (all, if fewer); -inf without words.

    ``worth`` and ``count`` are the sum over a word's n-grams and their number. Texts of about ``step`` words are taken at a time.
    """
    total, many = np.concatenate([[0.0], np.cumsum(worth)]), np.concatenate([[0], np.cumsum(count)])
    sizes = np.diff(offsets)
    out = np.full(len(sizes), -np.inf)
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + step, "right")) - 1)
        own, some = slice(i, j), np.flatnonzero(sizes[i:j] > 0) + i
        ends = np.minimum(np.arange(offsets[i], offsets[j]) + SPAN, np.repeat(offsets[1:][own], sizes[own]))
        starts = np.maximum(np.repeat(offsets[own], sizes[own]), ends - SPAN)
        mean = (total[ends] - total[starts]) / np.maximum(1, many[ends] - many[starts])
        if len(some):
            out[some] = np.maximum.reduceat(mean, offsets[some] - offsets[i])
        i = j
    return out


def summed(rows: np.ndarray, which: np.ndarray, begins: np.ndarray, step: int = 4_000) -> np.ndarray:
    """Sums of ``rows[which]`` over the stretches that start at ``begins``, some stretches at a time."""
    out = np.empty((len(begins), rows.shape[1]), rows.dtype)
    for i in range(0, len(begins), step):
        part = begins[i : i + step]
        end = begins[i + step] if i + step < len(begins) else len(which)
        np.add.reduceat(rows[which[part[0] : end]], part - part[0], axis=0, out=out[i : i + step])
    return out


def _adam(params: list[np.ndarray], state: list, grads: list[np.ndarray], t: int, rate: float, step: int = 1 << 14) -> None:
    for whole in zip(params, *zip(*state, strict=True), grads, strict=True):
        for i in range(0, len(whole[0]), step):
            p, first, second, g = (x[i : i + step] for x in whole)
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            p -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)


def word_grams(words: list[bytes], step: int = 4_096) -> tuple[np.ndarray, np.ndarray]:
    """Of each n-gram its word and its bucket, word after word; some words at a time, as ``grams`` holds several wide numbers a byte."""
    owners, buckets = [], []
    for i in range(0, len(words), step):
        _, owner, bucket = grams(pa.array(words[i : i + step], pa.binary()).cast(pa.string()))
        order = np.argsort(owner, kind="stable")
        owners.append((owner[order] + i).astype(np.int32))
        buckets.append(bucket[order].astype(np.int32))
    return np.concatenate(owners), np.concatenate(buckets)


class Model:
    """Worth of each n-gram bucket, and how a document's worst span becomes a score."""

    def __init__(self, worth: np.ndarray, slope: float, bias: float, empty: float):
        self.worth, self.slope, self.bias, self.empty = worth.astype(np.float32), slope, bias, empty

    def score(self, texts: pa.Array) -> np.ndarray:
        offsets, owner, bucket = grams(texts)
        n = int(offsets[-1])
        worst = worst_spans(offsets, np.bincount(owner, self.worth[bucket], n), np.bincount(owner, minlength=n))
        some = np.isfinite(worst)
        z = np.where(some, self.slope * np.where(some, worst, 0) + self.bias, self.empty)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(texts: list[str], labels: list[int], rounds: tuple[int, ...] = (8, 7, 7), seed: int = 5) -> Model:
    """Fit the vectors and the softmax jointly; a class that is absent gives a constant score.

    Repeated texts weigh as often as they come, also with labels that contradict each other; texts without words teach nothing.
    """
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        level = 25.0 * (1 if len(y) and y[0] else -1)
        return Model(np.zeros(1 << BUCKET_BITS), 0.0, level, level)
    # The texts as numbers of distinct words, and the distinct words as n-grams.
    vocabulary: dict[bytes, int] = {}
    docs = [[vocabulary.setdefault(w, len(vocabulary)) for w in FOLD[np.frombuffer(t.encode(), np.uint8)].tobytes().split()] for t in texts]
    n_words = np.array([len(d) for d in docs])
    offsets = np.concatenate([[0], np.cumsum(n_words)])
    words = np.concatenate([np.array(d, np.int32) for d in docs])
    del docs
    if not len(words):
        return Model(np.zeros(1 << BUCKET_BITS), 0.0, -25.0, -25.0)
    owner, bucket = word_grams(list(vocabulary))
    # A bucket that few texts hold teaches chance: it stays at no worth.
    taught = np.arange(len(y)) % 4 != 3
    seen = np.zeros(len(vocabulary), np.int32)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        seen[np.unique(words[a:b])] += 1
    spread = np.zeros(1 << BUCKET_BITS, np.int64)
    np.add.at(spread, bucket, seen[owner])
    whole = np.bincount(owner, minlength=len(vocabulary))
    held = spread >= FEWEST
    often = held[bucket]
    owner, bucket = owner[often], bucket[often]
    used, gram = np.flatnonzero(held), (np.cumsum(held, dtype=np.int32) - 1)[bucket]
    del bucket, often, spread
    if not len(used):
        return Model(np.zeros(1 << BUCKET_BITS), 0.0, -25.0, -25.0)
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    word_begins = np.flatnonzero(first)
    known, owner = owner[word_begins], np.cumsum(first, dtype=np.int32) - 1
    del first
    place = np.full(len(vocabulary), len(known), np.int32)
    place[known] = np.arange(len(known))
    vocabulary.clear()
    # Spans one after another; the last of a text may be shorter.
    doc_spans = -(-n_words // SPAN)
    span_doc = np.repeat(np.arange(len(y)), doc_spans)
    in_doc = np.arange(len(span_doc)) - np.repeat(np.cumsum(doc_spans) - doc_spans, doc_spans)
    begins = offsets[span_doc] + SPAN * in_doc
    span_words = np.diff(np.concatenate([begins, [len(words)]]))
    n_spans, length = len(span_doc), np.add.reduceat(whole[words], begins)[:, None].astype(np.float32)
    place = place[words]
    by_word = np.argsort(place, kind="stable")
    occurrences = np.searchsorted(place[by_word], np.arange(len(known)))
    by_word = by_word[: int((place < len(known)).sum())]
    span_by_word = np.repeat(np.arange(n_spans, dtype=np.int32), span_words)[by_word]
    del by_word
    by_gram = np.argsort(gram, kind="stable")
    gram_begins = np.searchsorted(gram[by_gram], np.arange(len(used)))
    word_by_gram = owner[by_gram]
    del by_gram
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (len(used), DIM)).astype(np.float32)
    softmax, bias = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    params = [vectors, softmax, bias]
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    target, t = y[span_doc].astype(np.int64), 0
    weight = taught[span_doc].astype(np.float32)

    def forward() -> tuple[np.ndarray, np.ndarray]:
        of_word = np.concatenate([summed(vectors, gram, word_begins), np.zeros((1, DIM), np.float32)])
        mean = summed(of_word, place, begins) / length
        return mean, mean @ softmax + bias

    for number, epochs in enumerate(rounds):
        if number:
            gap = np.diff(forward()[1], axis=1)[:, 0]
            worst = np.full(len(y), -np.inf)
            np.maximum.at(worst, span_doc, gap)
            chosen = (gap >= worst[span_doc] - 1e-6) | (gap > 0)
            weight = (taught[span_doc] & (chosen | (target == 0))).astype(np.float32)
        for c in (0, 1):
            weight[target == c] *= 0.5 / max(1e-9, float(weight[target == c].sum()))
        for _ in range(epochs):
            t += 1
            mean, logits = forward()
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n_spans), target] -= 1
            p *= weight[:, None]
            back = (p @ softmax.T) / length
            word_back = summed(back, span_by_word, occurrences)
            grad = summed(word_back, word_by_gram, gram_begins)
            _adam(params, state, [grad, mean.T @ p, p.sum(axis=0)], t, 0.1)
    worth = np.zeros(1 << BUCKET_BITS)
    worth[used] = vectors @ (softmax[:, 1] - softmax[:, 0])
    # The score: a logistic curve over the worst span, set on texts that taught nothing; a clean text lost weighs twice a toxic one kept.
    word_worth = np.zeros(len(known) + 1)
    for i in range(0, len(known), 1 << 14):
        own = slice(word_begins[i], word_begins[i + (1 << 14)] if i + (1 << 14) < len(known) else len(owner))
        word_worth[i : owner[own][-1] + 1] = np.bincount(owner[own] - i, worth[used[gram[own]]])
    del params, state, vectors, owner, gram, word_by_gram, span_by_word
    worst = worst_spans(offsets, word_worth[place], whole[words])
    some = np.isfinite(worst) & ~taught
    if len(np.unique(y[some])) < 2:
        some = np.isfinite(worst)
    z, target = worst[some], y[some]
    low, high = z.min(), z.max()
    cuts = np.linspace(low, high, 513)
    wrong = np.array([2 * (target[z >= c] == 0).sum() / max(1, (target == 0).sum()) + (target[z < c] == 1).sum() / max(1, (target == 1).sum()) for c in cuts])
    best = cuts[wrong <= wrong.min() + 1e-9]
    slope = 12.0 / max(1e-6, high - low)
    return Model(worth, slope, -slope * float(best.mean()) + float(np.log(THRESHOLD / (1 - THRESHOLD))), -25.0)


def held_out(id_text):
    """Rows that never teach: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_text) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most_docs: int, most_bytes: int, most_rows: int = 4) -> tuple[list[str], list[int]]:
    """Labelled texts to learn from: for either class at most ``most_docs`` rows and ``most_bytes`` bytes.

    A text that no longer fits is passed over and those after it are taken; where none of a class fits, its shortest is taken.
    Null labels, ids and texts are passed over; an id with both labels counts as 1. Of the rows that share an id, the
    ``most_rows`` first by hash of the text count, equal texts once, so that what the driver holds is bounded.
    """
    known = labels.select(column(labels, id_col).cast("long").alias("id"), column(labels, label_col).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y")).where(~held_out(F.col("id").cast("string")))
    order = F.xxhash64("id")
    base = docs.select(column(docs, id_col).cast("long").alias("id"), column(docs, text_col).alias("text")).where("text IS NOT NULL")
    texts, ys = [], []
    for y in (0, 1):
        ids = known.where(F.col("y") == y).orderBy(order, "id").limit(most_docs)
        # At most most_docs ids, so the broadcast is bounded.
        sized = base.join(F.broadcast(ids), "id").select("id", F.octet_length("text").alias("size"), F.xxhash64("text").alias("th"))
        chosen, held = [], 0
        rank = F.row_number().over(Window.partitionBy("id").orderBy("th"))
        rows = sized.distinct().withColumn("rank", rank).where(F.col("rank") <= most_rows).orderBy(order, "id", "size", "th").collect()
        for row in rows:
            if held + row["size"] <= most_bytes:
                held += row["size"]
                chosen.append((row["id"], row["th"]))
        if rows and not chosen:
            least = min(rows, key=lambda row: row["size"])
            chosen.append((least["id"], least["th"]))
        if chosen:
            picked = docs.sparkSession.createDataFrame(chosen, "id long, th long").distinct()
            rows = base.join(F.broadcast(picked), (base["id"] == picked["id"]) & (F.xxhash64(base["text"]) == picked["th"])).select(base["id"], "text").distinct().orderBy(F.xxhash64(base["id"]), base["id"], "text")
            found = [r["text"] for r in rows.collect()]
            texts += found
            ys += [y] * len(found)
    return texts, ys


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_docs: int = 1500, most_bytes: int = 3 << 19) -> Model:
    return train(*sample(docs, labels, id_col, text_col, label_col, most_docs, most_bytes))


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, carry: Sequence[str] = ()) -> DataFrame:
    """Score every whole text.

    Returns one row per input row: id, ``held_out``, ``score`` (0 to 1) and
    ``predicted`` (1 from ``threshold`` on). Texts that are null, empty or without
    words score near 0; rows without an id are scored too and never held out.
    Only the text enters a score. No rows, no rows. Extra columns are ignored but for
    those named in ``carry``, which follow as the columns of a struct ``row``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inside = text_col if text_col in carry else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(unpacked(batches, inside), most=STEP):
            score = pa.array(shared.value.score(batch.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), score], ["id", "row", "score"])

    row = F.struct(*(column(docs, c) for c in carry)) if carry else F.lit(0)
    base = docs.select(column(docs, id_col).cast("long").alias("id"), *([] if inside else [column(docs, text_col).alias("text")]), row.alias("row"))
    out = base.mapInArrow(run, StructType([base.schema["id"], base.schema["row"], StructField("score", DoubleType())]))
    held = held_out(F.col("id").cast("string")).alias("held_out")
    return out.select(F.col("id").alias(id_col), held, "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *(["row"] if carry else []))


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
