"""Shared ground of the training-data operators: keys, batches, words, hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.scratch import clear_scratch, materialise, qualified, scratch_dir, scratch_root, spread  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The white space of every word and line rule here: \x20 and \x09-\x0D.
SPACE = " \t\n\x0b\x0c\r"
#: Stands for a null id in keys: such rows sort behind all documents.
NO_ID = (1 << 63) - 1
#: Text bytes that a Python worker turns into words at a time.
STEP_BYTES = 1 << 19


def column(df: DataFrame, name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else; pure ASCII takes the faster built-in."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def wide_key(c: Column) -> tuple[Column, Column]:
    """128 bits of hash as two columns."""
    return F.xxhash64(c), F.xxhash64(F.lit("second"), c)


def unsigned_crc32(c: Column) -> Column:
    return F.crc32(F.encode(c, "UTF-8"))


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``most`` bytes of text (one row at least)."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, before + most, "right")))
            yield batch.slice(start, end - start)
            start = end


def unpacked(batches: Iterator[pa.RecordBatch], name: str | None) -> Iterator[pa.RecordBatch]:
    """With ``name``, add a column ``text`` taken from the struct ``row``, so that a text which is carried along crosses once."""
    for batch in batches:
        yield batch if name is None else pa.RecordBatch.from_arrays([*batch.columns, pc.struct_field(batch.column("row"), name)], [*batch.schema.names, "text"])


@dataclass
class Words:
    """The words of a batch of texts: where they lie in the batch's bytes, and their hashes."""

    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    hashes: list[np.ndarray]


_SPACES = np.isin(np.arange(256), [ord(c) for c in SPACE])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: For each hash: an odd base and the values of the 256 bytes, drawn from fixed seeds.
_HASHES = [(0x9E3779B97F4A7C15, np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64)), (0xD6E8FEB86659FD93, np.random.default_rng(12).integers(1, 1 << 63, 256, np.uint64))]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, end to end (null: none), and where each text begins and the last ends."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, at, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    bounds = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return _LOWER[data]


def find_words(texts: pa.Array, lower: bool = False, hashes: int = 1, breaks: np.ndarray | None = None) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text and ``hashes`` 64-bit hashes of each, all by numpy.

    ``breaks`` marks other byte values that end a word.
    """
    data, bounds = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    space = (_SPACES if breaks is None else _SPACES | breaks)[data]
    first = np.ones(len(data) + 1, bool)
    first[1:-1] = space[:-1]
    first[bounds] = True
    starts = np.flatnonzero(first[:-1] & ~space)
    last = np.ones(len(data) + 1, bool)
    last[1:-1] = space[1:]
    last[bounds] = True
    ends = np.flatnonzero(last[1:] & ~space) + 1
    found = []
    for base, values in _HASHES[:hashes]:
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(values[data] * powers(base, len(data)), out=sums[1:])
            found.append(mix((sums[ends] - sums[starts]) * powers(pow(base, -1, 1 << 64), len(data) + 1)[starts] + (ends - starts).astype(np.uint64)))
    return Words(data, bounds, starts, ends, np.searchsorted(starts, bounds), found)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers modulo 2^64; the longest run so far is kept."""
    kept = _POWERS.get(base)
    if kept is None or len(kept) < n:
        with np.errstate(over="ignore"):
            kept = np.full(max(n, 1 << 16), base, np.uint64)
            kept[0] = 1
            _POWERS[base] = kept = np.cumprod(kept, dtype=np.uint64)
    return kept[:n]


def run_hashes(h: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of each run of ``width`` values: a polynomial in an odd base modulo 2^64, by prefix sums."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers(base, len(h)), dtype=np.uint64)])
        return mix((sums[width:] - sums[:-width]) * powers(pow(base, -1, 1 << 64), n))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_starts(offsets: np.ndarray, width: int) -> np.ndarray:
    """Flat starts of the runs of ``width`` words that stay within one document."""
    total = int(offsets[-1])
    if total < width:
        return np.zeros(0, np.int64)
    ok = np.ones(total - width + 1, bool)
    for edge in offsets[1:-1]:
        ok[max(0, edge - width + 1) : edge] = False
    return np.flatnonzero(ok)


#: Bits of the bitmap of ``may_be_among``: 2 MB to broadcast. What falls on a set bit by chance passes too, and is for the join behind it to drop.
AMONG_BITS = 1 << 24


def may_be_among(rows: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """The rows whose ``col`` may be among ``keys`` (none that is gets lost), told by a bitmap of hashes before anything is shuffled.

    For a join that follows, where the rows are wide and most of them have no partner. Null is among nothing.
    """
    at = F.pmod(F.xxhash64(col), F.lit(AMONG_BITS)) + 1
    bits = keys.select(at.alias("_at")).groupBy(F.bitmap_bucket_number("_at").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits"))
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, (place % 8).cast("int")) == 1
    return rows.where(F.col(col).isNotNull()).join(F.broadcast(bits), (F.bitmap_bucket_number(at) == F.col("_bucket")) & held).drop("_bucket", "_bits")
