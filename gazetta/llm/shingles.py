"""Word-shingle sets of documents and their SuperMinHash signatures, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from gazetta.llm.common import find_words, mix, run_hashes, run_starts

BASE = 0xB5297A4D3F84D5B5
GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles.

    A text with fewer than ``width`` words is one shingle, one without words has none.
    """
    words = find_words(texts, lower=True)
    offsets, h = words.offsets, words.hashes[0]
    runs = run_hashes(h, width, BASE)
    starts = run_starts(offsets, width)
    first, last = np.searchsorted(starts, offsets[:-1]), np.searchsorted(starts, offsets[1:])
    flat, out = runs[starts], []
    for i in range(len(texts)):
        if last[i] > first[i]:
            own = np.sort(flat[first[i] : last[i]])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        else:
            few = h[offsets[i] : offsets[i + 1]]
            out.append(run_hashes(few, len(few), BASE) ^ np.uint64(len(few)) if len(few) else few)
    return out


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures, one row of ``m`` values a set; an empty set has only the largest value.

    Each element draws, level after level, a rank in [level, level + 1) for one
    more slot of a random permutation of the slots, and a slot keeps its least
    rank. As the ranks of a level exceed those of all levels before it, a set
    stops as soon as every slot has a rank of the level just done. Levels run
    over all elements at once instead of element by element, with the same result.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    sig = np.full(len(sets) * m, np.iinfo(np.uint64).max, np.uint64)
    if not sizes.sum():
        return sig.reshape(-1, m)
    seed = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    perm = None
    for level in range(m):
        with np.errstate(over="ignore"):
            draw = mix(seed + GOLD * np.uint64(level + 1))
        pick = level + ((draw >> np.uint64(32)) * np.uint64(m - level) >> np.uint64(32)).astype(np.int64)
        rank = (np.uint64(level) << np.uint64(32)) | (draw & np.uint64(0xFFFFFFFF))
        if perm is None:
            slot = pick
        else:
            rows = np.arange(len(seed))
            slot = perm[rows, pick].astype(np.int64)
        np.minimum.at(sig, owner * m + slot, rank)
        open_ = (sig.reshape(-1, m) >= (np.uint64(level + 1) << np.uint64(32))).any(axis=1) & (sizes > 0)
        going = open_[owner]
        if not going.any():
            break
        if perm is None:
            perm = np.tile(np.arange(m, dtype=np.uint8), (int(going.sum()), 1))
            rows, pick = np.arange(len(perm)), pick[going]
            perm[rows, pick] = level
            perm[:, level] = pick
        else:
            perm[rows, pick] = perm[:, level]
            perm[:, level] = slot
            perm = perm[going]
        seed, owner = seed[going], owner[going]
    return sig.reshape(-1, m)


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key of each band of a signature, shape (n, bands)."""
    n, m = sig.shape
    rows = m // bands
    part = sig[:, : bands * rows].reshape(n, bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * GOLD, (n, 1))
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = mix(key * np.uint64(0x2545F4914F6CDD1D) + part[:, :, r])
    return key
