"""Words, n-gram hashes and MinHash signatures of whole batches of texts, in NumPy.

A word is a maximal run of ASCII letters and digits and of characters beyond
ASCII, after lower-casing A-Z.  The batch is handled as one UTF-8 byte array, so
the work per character is a few vector operations and no Python loop runs over
words.  Hashes are 64-bit; a batch holds at most ``CHUNK_BYTES`` of text (or one
document, if that is longer), which bounds the memory of a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SEED = np.uint64(0xD6E8FEB86659FD93)


def _table() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    for c in range(128, 256):
        t[c] = c
    for c in b"0123456789abcdefghijklmnopqrstuvwxyz":
        t[c] = c
    for c in range(65, 91):
        t[c] = c + 32
    return t


#: byte -> lower-cased byte of a word, 0 for a separator
WORD_BYTE = _table()


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (all bits of the input reach all bits of the result)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column that hold about ``limit`` bytes each."""
    n = len(column)
    if n == 0:
        return
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes + 1)
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield start, stop
        start = stop


@dataclass
class Batch:
    """Words of consecutive documents: ``first[i]:first[i+1]`` are those of document i."""

    raw: np.ndarray  # bytes of all texts, a zero byte after each
    at: np.ndarray  # byte offset of each document in raw
    start: np.ndarray  # byte range of each word in raw
    end: np.ndarray
    first: np.ndarray  # word range of each document
    hash: np.ndarray  # 64-bit hash of each word


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    return raw, at


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    key = int(base)
    p = _POWERS.get(key)
    if p is None or len(p) < n:
        p = np.ones(max(n, 1 << 16), np.uint64)
        p[1:] = base
        with np.errstate(over="ignore"):
            p = np.cumprod(p, dtype=np.uint64)
        if len(p) <= 3 * CHUNK_BYTES:
            _POWERS[key] = p
    return p[:n]


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def word_batch(texts: list[bytes]) -> Batch:
    raw, at = joined(texts)
    low = WORD_BYTE[raw]
    inside = low != 0
    edge = np.flatnonzero(np.diff(inside.view(np.int8)))  # raw ends with a separator
    if len(inside) and inside[0]:
        edge = np.concatenate([[-1], edge])
    start, end = edge[0::2] + 1, edge[1::2] + 1
    # polynomial hash of a byte range from prefix sums: sum b[i]*B**(i-start)
    pre = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(mix_bytes(low) * powers(_BASE, len(raw)), out=pre[1:], dtype=np.uint64)
    h = (pre[end] - pre[start]) * powers(_INVERSE, len(raw))[start]
    h = mix(h + (end - start).astype(np.uint64) * _SEED)
    return Batch(raw, at, start, end, np.searchsorted(start, at), h)


_BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * _SEED)


def mix_bytes(low: np.ndarray) -> np.ndarray:
    return _BYTE_HASH[low]


def grams(b: Batch, n: int, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of words of each unit, and each unit's range of them.

    Units are the documents unless ``first`` gives other word ranges.  A unit of
    fewer than n words, but not none, has one n-gram of all its words.
    """
    first = b.first if first is None else first
    words = np.diff(first)
    count = np.where(words >= n, words - n + 1, (words > 0).astype(np.int64))
    at = np.zeros(len(words) + 1, np.int64)
    np.cumsum(count, out=at[1:])
    unit = np.repeat(np.arange(len(words)), count)
    begin = np.arange(at[-1]) - at[unit] + first[unit]
    length = np.minimum(words, n)[unit]
    h = np.zeros(len(begin), np.uint64)
    padded = np.concatenate([b.hash, np.zeros(n, np.uint64)])
    mult = np.uint64(0xC6A4A7935BD1E995)
    for k in range(n):
        step = h * mult + padded[begin + k]
        h = np.where(k < length, step, h) if (length < n).any() else step
    return mix(h + length.astype(np.uint64)), at


def rolled(b: Batch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of n words within a document, and each document's range of them;
    each is taken from prefix sums, so that its cost does not grow with n."""
    words = np.diff(b.first)
    count = np.maximum(words - n + 1, 0)
    at = np.zeros(len(words) + 1, np.int64)
    np.cumsum(count, out=at[1:])
    begin = np.arange(at[-1]) + np.repeat(b.first[:-1] - at[:-1], count)
    pre = np.zeros(len(b.hash) + 1, np.uint64)
    np.cumsum(b.hash * powers(_BASE, len(b.hash)), out=pre[1:], dtype=np.uint64)
    return mix((pre[begin + n] - pre[begin]) * powers(_INVERSE, len(b.hash))[begin]), at


def grams_of(texts: list[bytes], n: int, keys: Callable[[Batch, list[bytes]], list[bytes]]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """``keys`` and ``grams`` of texts of any total size, a part of about CHUNK_BYTES at a time:
    only the n-grams' hashes are held for all of them."""
    own, hashes, ends = [], [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for i, j in chunks(pa.array(texts, pa.binary())):
        part = texts[i:j]
        b = word_batch(part)
        h, at = grams(b, n)
        own += keys(b, part)
        hashes.append(h)
        ends.append(at[1:] + ends[-1][-1])
    return own, np.concatenate(hashes), np.concatenate(ends)


def unit_hash(values: np.ndarray, at: np.ndarray, seed: int) -> np.ndarray:
    """Order-dependent 64-bit hash of each unit's values."""
    base = np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 3)) & ((1 << 64) - 1) | 1)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    pre = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values + np.uint64(seed)) * powers(base, len(values)), out=pre[1:], dtype=np.uint64)
    scale = powers(inverse, len(values) + 1)
    size = np.diff(at).astype(np.uint64)
    return mix((pre[at[1:]] - pre[at[:-1]]) * scale[at[:-1]] + size * _SEED)


def choose_bands(threshold: float, recall: float, most: int = 80) -> tuple[int, int]:
    """(bands, rows): the most selective banding that finds a pair of similarity
    ``threshold`` with probability ``recall`` using at most ``most`` hashes; an error
    where no such banding exists."""
    best = None
    for rows in range(1, most + 1):
        p = threshold**rows
        bands = 1 if p >= 1 else int(np.ceil(np.log1p(-recall) / np.log1p(-p)))
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"no banding of {most} hashes finds pairs of similarity {threshold} with probability {recall}")
    return best


def minhash(h: np.ndarray, at: np.ndarray, bands: int, rows: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """64-bit band hashes (units x bands) of each unit's set of hashes, and one byte of each
    MinHash value (units x bands*rows); a unit without any hash gets zeros."""
    units = len(at) - 1
    out, sig = np.zeros((units, bands), np.uint64), np.zeros((units, bands * rows), np.uint8)
    some = np.flatnonzero(np.diff(at) > 0)
    if len(some) == 0:
        return out, sig
    starts = at[:-1][some]
    key = (h >> np.uint64(32)).astype(np.uint32)
    low = h.astype(np.uint32)
    rng = np.random.default_rng(seed)
    buf, more = np.empty(len(key), np.uint32), np.empty(len(key), np.uint32)
    for band in range(bands):
        acc = np.full(len(some), band + 1, np.uint64)
        for row in range(rows):
            a, c = (np.uint32(x) for x in rng.integers(0, 1 << 32, 2, dtype=np.uint64))
            np.multiply(key, a | np.uint32(1), out=buf)
            np.multiply(low, c | np.uint32(1), out=more)
            buf ^= more
            least = np.minimum.reduceat(buf, starts).astype(np.uint64)
            acc = mix(acc * _BASE + least)
            sig[some, band * rows + row] = (mix(least) >> np.uint64(56)).astype(np.uint8)
        out[some, band] = acc
    return out, sig
