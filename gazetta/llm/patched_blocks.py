"""Patched frame-of-reference blocks of unsigned 32-bit integers, and the file around them.

Block of up to ``BLOCK`` values: minimum and number of exceptions, then the values
less the minimum packed at one width, then the exceptions. The width is the number
of bits that holds ``PERCENTILE`` of the block's values; what needs more is an
exception, which keeps its low bits in place and lists position and whole value.

File: magic, counts of blocks, values and documents; the start of each block in the
file (so that any block is read without the others); the number of values and the id
of each document; the blocks. All integers are little-endian.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC, BLOCK, PERCENTILE = b"PFOR1\x00\x00\x00", 512, 90
HEAD, BLOCK_HEAD = struct.Struct("<8sQQQ"), struct.Struct("<IHBB")


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int8)


def encode_blocks(values: np.ndarray) -> list[bytes]:
    """All blocks of ``values``; blocks of one length and width are packed together."""
    out: list[bytes] = []
    whole = len(values) // BLOCK * BLOCK
    # Some hundred blocks at a time: bits take 16 or 32 bytes a value while they are packed.
    parts = [values[i : min(whole, i + 400 * BLOCK)].reshape(-1, BLOCK) for i in range(0, whole, 400 * BLOCK)]
    if len(values) > whole:
        parts.append(values[whole:].reshape(1, -1))
    for part in parts:
        n = part.shape[1]
        low = part.min(axis=1)
        rest = (part - low[:, None]).astype(np.uint32)
        need = _widths(rest)
        rank = -(-n * PERCENTILE // 100) - 1
        width = np.partition(need, rank, axis=1)[:, rank]
        packed: list[bytes] = [b""] * len(part)
        for w in np.unique(width):
            rows = np.flatnonzero(width == w)
            if w:
                size = 2 if w <= 16 else 4
                raw = rest[rows].astype(f"<u{size}").view(np.uint8).reshape(len(rows), n, size)
                bits = np.unpackbits(raw, axis=2, bitorder="little")[:, :, :w]
                data = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
                for r, d in zip(rows.tolist(), data, strict=True):
                    packed[r] = d.tobytes()
        over = need > width[:, None]
        counts = over.sum(axis=1)
        where = np.nonzero(over)
        positions, extra = where[1].astype("<u2"), rest[where].astype("<u4")
        ends = np.cumsum(counts)
        for r in range(len(part)):
            lo, hi = int(ends[r] - counts[r]), int(ends[r])
            head = BLOCK_HEAD.pack(int(low[r]), n, int(width[r]), 0) + struct.pack("<H", hi - lo)
            out.append(head + packed[r] + positions[lo:hi].tobytes() + extra[lo:hi].tobytes())
    return out


def decode_block(data: bytes, start: int) -> np.ndarray:
    low, n, width, _ = BLOCK_HEAD.unpack_from(data, start)
    start += BLOCK_HEAD.size
    (exceptions,) = struct.unpack_from("<H", data, start)
    start += 2
    size = -(-n * width // 8)
    if width:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, size, start), count=n * width, bitorder="little").reshape(n, width)
        padded = np.zeros((n, 32), np.uint8)
        padded[:, :width] = bits
        values = np.packbits(padded, axis=1, bitorder="little").view("<u4")[:, 0].astype(np.uint32)
    else:
        values = np.zeros(n, np.uint32)
    start += size
    at = np.frombuffer(data, "<u2", exceptions, start)
    values[at] = np.frombuffer(data, "<u4", exceptions, start + 2 * exceptions)
    return values + np.uint32(low)


def encode_file(ids: list[int], counts: list[int], values: np.ndarray) -> bytes:
    blocks = encode_blocks(values.astype(np.uint32))
    sizes = np.array([len(b) for b in blocks], np.uint64)
    first = HEAD.size + 8 * len(blocks) + 16 * len(ids)
    starts = first + np.concatenate([[0], np.cumsum(sizes)])[:-1] if len(blocks) else np.zeros(0)
    head = HEAD.pack(MAGIC, len(blocks), len(values), len(ids))
    return head + starts.astype("<u8").tobytes() + np.array(counts, "<u8").tobytes() + np.array(ids, "<i8").tobytes() + b"".join(blocks)


def decode_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, values a document, and all values."""
    magic, n_blocks, n_values, n_docs = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a file of patched blocks")
    starts = np.frombuffer(data, "<u8", n_blocks, HEAD.size)
    counts = np.frombuffer(data, "<u8", n_docs, HEAD.size + 8 * n_blocks)
    ids = np.frombuffer(data, "<i8", n_docs, HEAD.size + 8 * (n_blocks + n_docs))
    values = np.concatenate([decode_block(data, int(s)) for s in starts]) if n_blocks else np.zeros(0, np.uint32)
    if len(values) != n_values or int(counts.sum()) != n_values:
        raise ValueError("a file of patched blocks is damaged")
    return ids, counts.astype(np.int64), values
