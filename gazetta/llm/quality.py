"""Quality by a regularised quadratic discriminant over statistics of whole texts.

Each text becomes a short vector of transformed statistics (lengths, shares of kinds of
characters, repetition), which is written once. Counts, sums and products of the labelled
vectors are all that the fit needs: partial sums a task, added up by Spark a class and fold, a fixed
number of rows for the driver whatever the corpus. Class covariances are shrunk towards
the pooled one and its diagonal, and factored once (Cholesky). The difference of the two log densities,
by Mahalanobis distances from triangular solves, goes through a logistic curve set on differences that
each fold gets from the sums of the other folds, counted in bins. All labelled rows teach; there is no sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import chunks, column, find_words, materialise, run_hashes, spread

THRESHOLD = 0.3
#: Folds of the labelled rows, and the share of the pooled covariance and of its diagonal in a class's own.
FOLDS, DIAGONAL = 4, 0.05
#: Differences of log densities are counted in this many bins of their inverse hyperbolic sine, up to this bound.
BINS, MOST = 2048, 16.0

_BYTES = np.arange(256)
_KINDS = np.stack(
    [
        (_BYTES >= 65) & (_BYTES <= 90),
        (_BYTES >= 97) & (_BYTES <= 122) | (_BYTES >= 128),
        (_BYTES >= 48) & (_BYTES <= 57),
        np.isin(_BYTES, [ord(c) for c in "#$%&*|@~^<>{}[]=_\\/+"]),
        np.isin(_BYTES, [ord(c) for c in "!?"]),
        np.isin(_BYTES, [ord(c) for c in ".,;:"]),
        _BYTES == 10,
        (_BYTES & 0xC0) != 0x80,
    ],
    axis=1,
).astype(np.float64)
STATISTICS = ("words", "letters_a_word", "spread_of_lengths", "short_words", "distinct", "repeated_next", "repeated_threes", "upper", "digits", "symbols", "cries", "stops", "lines", "entropy")


def _histograms(data: np.ndarray, bounds: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    out = np.zeros((len(bounds) - 1, 256), np.int64)
    for i in range(len(out)):
        for at in range(int(bounds[i]), int(bounds[i + 1]), step):
            out[i] += np.bincount(data[at : min(at + step, int(bounds[i + 1]))], minlength=256)
    return out


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The log odds of a share, smoothed: a share of nothing is even odds, and rare things in short texts count little."""
    return np.log((part + 0.5) / (whole - part + 0.5 + 0.01 * whole))


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` a text, all finite. Words are ``[^\\x20\\x09-\\x0D]+``; null is as empty."""
    words = find_words(texts)
    n, sizes = len(texts), np.diff(words.offsets)
    hist = _histograms(words.data, words.bounds)
    upper, lower, digits, symbols, cries, stops, lines, chars = (hist @ _KINDS).T
    total = np.maximum(1, hist.sum(axis=1))
    p = hist / total[:, None]
    entropy = -(p * np.log(np.where(p > 0, p, 1))).sum(axis=1)
    doc = np.repeat(np.arange(n), sizes)
    lengths = (words.ends - words.starts).astype(np.float64)
    of = lambda values: np.bincount(doc, values, n)
    many = np.maximum(1, sizes)
    mean = of(lengths) / many
    spread = np.sqrt(np.maximum(0, of(lengths**2) / many - mean**2))

    def distinct(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
        order = np.lexsort((keys, owner))
        k, o = keys[order], owner[order]
        return np.bincount(o[np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])])], minlength=n) if len(k) else np.zeros(n)

    h = words.hashes[0]
    next_same = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    threes = run_hashes(h, 3, 0xB5297A4D3F84D5B5)
    within = doc[2:] == doc[:-2] if len(doc) > 2 else np.zeros(0, bool)
    threes, of_three = threes[within], doc[:-2][within] if len(doc) > 2 else doc[:0]
    n_threes = np.bincount(of_three, minlength=n)
    kinds = np.stack(
        [
            np.log1p(sizes),
            np.log1p(mean),
            np.log1p(spread),
            _share(of(lengths <= 3), sizes),
            np.log((distinct(h, doc) + 1) / (sizes + 1)),
            _share(np.bincount(doc[1:][next_same], minlength=n), sizes),
            _share(n_threes - distinct(threes, of_three), n_threes),
            _share(upper, upper + lower),
            _share(digits, chars),
            _share(symbols, chars),
            _share(cries, chars),
            _share(stops, chars),
            np.log((lines + 1) / (sizes + 1)),
            entropy,
        ],
        axis=1,
    )
    return np.nan_to_num(kinds.astype(np.float64))


@dataclass
class Model:
    """Class means, inverse Cholesky factors, half log determinants and log priors of standardised statistics, and a logistic curve."""

    shift: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray
    slope: float = 1.0
    bias: float = 0.0
    level: float | None = None

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, in inverse hyperbolic sine."""
        if self.level is not None:
            return np.zeros(len(x))
        x = (x - self.shift) / self.scale
        of = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        return np.arcsinh(of[1] - of[0])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.level is not None:
            return np.full(len(x), self.level)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.bias, -30, 30)))


def discriminant(n: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Model:
    """A model from count, sum and sum of outer products of either class; with one class or none its score is constant.

    The share of the pooled covariance in a class's own is d / (d + n), so that few rows lean on it and many don't.
    """
    d = sums.shape[1]
    if n.min() < 1:
        return Model(np.zeros(d), np.ones(d), np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), level=0.5 if n.max() < 1 else float(n[1] > 0))
    shift = sums.sum(axis=0) / n.sum()
    # Moments about the common mean: the rest is free of large offsets.
    means = sums / n[:, None] - shift
    outer = np.stack([squares[c] / n[c] - np.outer(shift, sums[c] / n[c]) - np.outer(sums[c] / n[c], shift) + np.outer(shift, shift) for c in (0, 1)])
    own = np.stack([outer[c] - np.outer(means[c], means[c]) for c in (0, 1)])
    pooled = (n[0] * own[0] + n[1] * own[1]) / n.sum()
    scale = np.sqrt(np.maximum(1e-6, np.diag((n[0] * outer[0] + n[1] * outer[1]) / n.sum())))
    grid = np.outer(scale, scale)
    own, pooled, means = own / grid, pooled / grid, means / scale
    factors, constants = [], []
    for c in (0, 1):
        share = d / (d + n[c])
        s = (1 - share) * own[c] + share * pooled
        s = (1 - DIAGONAL) * s + DIAGONAL * (np.diag(np.diag(s)) + np.eye(d)) / 2 + 1e-4 * np.eye(d)
        low = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(low))
        constants.append(-np.log(np.diag(low)).sum() + np.log(n[c] / n.sum()))
    return Model(shift, scale, means, np.stack(factors), np.array(constants))


def logistic(z: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and bias of a logistic curve by Newton's method, with a little pull so that classes apart from each other give finite ones."""
    a = np.stack([z, np.ones(len(z))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + 1e-2 * (w - [1.0, 0.0])
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return max(1e-3, float(w[0])), float(w[1])


def held_out(id_text: Column) -> Column:
    """Rows that never teach: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id_text) % 5 == 0, F.lit(False))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``x``, the vector of ``STATISTICS``, of every row; no shuffle but of an input that is small for the number of cores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            x = statistics(batch.column("text"))
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], ["id", "x"])

    return spread(docs.select(column(docs, id_col).cast("long").alias("id"), column(docs, text_col).alias("text"))).mapInArrow(run, "id long, x array<double>")


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _moments(taught: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, sums and products by fold and class: partial sums a task, then one row for each number."""
    d = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((FOLDS, 2, 1 + d + d * d))
        for batch in batches:
            x = _vectors(batch)
            fold, y = batch.column("fold").to_numpy(), batch.column("y").to_numpy()
            for f in range(FOLDS):
                for c in (0, 1):
                    own = x[(fold == f) & (y == c)]
                    held[f, c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        at = np.flatnonzero(held.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(held.ravel()[at])], ["at", "value"])

    found = np.zeros(FOLDS * 2 * (1 + d + d * d))
    for row in taught.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():  # one row a number
        found[row["at"]] = row["value"]
    found = found.reshape(FOLDS, 2, -1)
    return found[:, :, 0], found[:, :, 1 : 1 + d], found[:, :, 1 + d :].reshape(FOLDS, 2, d, d)


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Fit on all labelled rows of ``stats`` (``id``, ``x``) that aren't held out.

    Null labels and ids are passed over, labels other than 0 and 1 too; an id with both counts as 1; rows that share an id teach
    one by one. With labels of one class every score is that class, without labels 0.5.
    """
    known = labels.select(column(labels, id_col).cast("long").alias("id"), column(labels, label_col).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y")).where(~held_out(F.col("id").cast("string"))).hint("rebalance")
    taught = materialise(stats.join(known, "id").select("x", "y", F.pmod(F.xxhash64("id"), F.lit(FOLDS)).cast("int").alias("fold")))
    n, sums, squares = _moments(taught)
    model = discriminant(n.sum(axis=0), sums.sum(axis=0), squares.sum(axis=0))
    if model.level is not None:
        return model
    others = [discriminant(n.sum(axis=0) - n[f], sums.sum(axis=0) - sums[f], squares.sum(axis=0) - squares[f]) for f in range(FOLDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, BINS), np.int64)
        for batch in batches:
            x, fold, y = _vectors(batch), batch.column("fold").to_numpy(), batch.column("y").to_numpy()
            for f, other in enumerate(others):
                if other.level is None:
                    z = other.difference(x[fold == f])
                    at = np.clip(((z + MOST) * (BINS / (2 * MOST))).astype(np.int64), 0, BINS - 1)
                    np.add.at(held, (y[fold == f], at), 1)
        at = np.flatnonzero(held.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(held.ravel()[at])], ["at", "many"])

    bins = taught.mapInArrow(run, "at long, many long").groupBy("at").agg(F.sum("many").alias("many")).collect()  # two rows a bin at most
    at = np.array([r["at"] for r in bins], np.int64)
    z, y, weight = (at % BINS + 0.5) * (2 * MOST / BINS) - MOST, at // BINS, np.array([r["many"] for r in bins], np.float64)
    if len(np.unique(y)) == 2:
        model.slope, model.bias = logistic(z, y, weight)
    return model


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """Score every whole text with a model that is fitted on the labelled ones.

    Returns one row per input row: id, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).
    A null text is scored as an empty one, which has statistics too; rows without an id are scored
    and never held out; repeated rows get one score. No rows, no rows. Only the text enters a score, and other columns are ignored.
    """
    stats = materialise(text_statistics(docs, id_col, text_col))
    shared = docs.sparkSession.sparkContext.broadcast(fit(stats, labels, id_col, label_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(shared.value.score(_vectors(batch)), pa.float64())], ["id", "score"])

    out = stats.mapInArrow(run, "id long, score double")
    held = held_out(F.col("id").cast("string")).alias("held_out")
    return out.select(F.col("id").alias(id_col), held, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
