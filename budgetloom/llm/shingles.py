"""Word shingles of many texts at once, and what is drawn from them.

A word is a maximal run of letters and digits, in lower case.  A text's
shingles are its distinct runs of three (or ``n``) words; a text under
``min_words`` words has none.  Shingles are kept as 53-bit hashes.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

WORD = re.compile(r"[^\W_]+")
BITS = 53
MIN_WORDS, N = 20, 3
_STORE = 400_000
_hash = xxhash.xxh3_64_intdigest


def words_of(text: str) -> list[str]:
    """The words of a text, in order."""
    return WORD.findall(text.lower())


class _Hashes(dict):
    def __missing__(self, word):
        self[word] = h = _hash(word)
        return h


_hashes = _Hashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words one after another, number of words of each text)."""
    if len(_hashes) > _STORE:
        _hashes.clear()
    of, out, counts = _hashes.__getitem__, [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            words = WORD.findall(text.lower())
            counts[i] = len(words)
            out.extend(map(of, words))
    return np.array(out, np.uint64), counts


def hashes_of(words: list[list[str]]) -> np.ndarray:
    """Hashes of the words of all lists, one list after another."""
    if len(_hashes) > _STORE:
        _hashes.clear()
    of, out = _hashes.__getitem__, []
    for w in words:
        out.extend(map(of, w))
    return np.array(out, np.uint64)


def runs(hashes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the run of n words that starts at each word, and whether it stays within its text."""
    total = len(hashes)
    out = np.zeros(total, np.uint64)
    if total >= n:
        acc = hashes[: total - n + 1].copy()
        for k in range(1, n):
            acc = mix(acc) + hashes[k : total - n + 1 + k]
        out[: total - n + 1] = mix(acc)
    ends = np.repeat(np.cumsum(counts), counts)
    return out, np.arange(total) + n <= ends


def shingle_sets(texts: list[str | None], n: int = N, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingles of all texts one after another, number of each text)."""
    hashes, counts = word_hashes(texts)
    run, inside = runs(hashes, counts, n)
    inside &= np.repeat(counts >= max(min_words, n), counts)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)[inside]
    sizes = np.zeros(len(texts), np.int64)
    flat = []
    step = 1 << (64 - BITS)  # so many texts have room in front of a 53-bit hash
    for low in range(0, len(texts), step):
        lo, hi = np.searchsorted(owner, [low, low + step])
        key = np.unique((owner[lo:hi] - np.uint64(low)) << np.uint64(BITS) | run[inside][lo:hi] >> np.uint64(64 - BITS))
        sizes[low : low + step] = np.bincount((key >> np.uint64(BITS)).astype(np.int64), minlength=min(step, len(texts) - low))
        flat.append(key & np.uint64((1 << BITS) - 1))
    return np.concatenate(flat) if flat else np.zeros(0, np.uint64), sizes


def set_names(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One 64-bit name for each non-empty set; equal sets have equal names."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    return mix(np.add.reduceat(mix(flat), starts)).view(np.int64) if len(starts) else np.zeros(0, np.int64)


@lru_cache(maxsize=8)
def multipliers(count: int, seed: int) -> np.ndarray:
    """Odd multipliers, one for each permutation."""
    return np.random.default_rng(seed).integers(1 << 62, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_hashes(flat: np.ndarray, sizes: np.ndarray, count: int, seed: int) -> np.ndarray:
    """(non-empty sets x count): the least hash of each set under each permutation."""
    kept = sizes[sizes > 0]
    starts = np.cumsum(kept) - kept
    out = np.empty((len(kept), count), np.uint64)
    if len(kept):
        for k, m in enumerate(multipliers(count, seed)):
            out[:, k] = np.minimum.reduceat(flat * m, starts)
    return out


def list_column(values: np.ndarray) -> pa.ListArray:
    """A rows x k matrix as a list column of longs."""
    rows, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * k), pa.array(np.ascontiguousarray(values).view(np.int64).ravel()))
