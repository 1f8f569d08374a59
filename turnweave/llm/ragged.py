"""Vectorised work on a batch of texts held as one byte buffer with offsets.

Everything here runs inside Spark tasks on Arrow batches. Texts are UTF-8; a word is a maximal run of bytes outside
space and \\x09-\\x0d, so byte positions never split a character. Hashes are 64-bit polynomial hashes (wrap-around
arithmetic) with a final mix; they depend on the bytes alone, so executors agree on them.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 1 << 19
SEGMENT = 1 << 18
_MASK = (1 << 64) - 1

# The C library's names for the size from which memory is mapped by itself, and for how much may lie free at the heap's end.
_MAP_FROM, _TRIM_FROM = -3, -1
with contextlib.suppress(OSError, AttributeError):  # arrays go back to the system when they are freed: workers are many and outlive their tasks
    ctypes.CDLL(None).mallopt(_MAP_FROM, 1 << 22)
    ctypes.CDLL(None).mallopt(_TRIM_FROM, 1 << 23)


def _splitmix(n: int, seed: int) -> np.ndarray:
    x = (np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) + U64(seed)
    return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_CODE = _splitmix(256, 11)
_R = 0x9E3779B97F4A7C55 | 1
_RINV = pow(_R, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_R, SEGMENT)
_POWINV = _powers(_RINV, SEGMENT)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = texts.buffers()
    offs = np.frombuffer(raw[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw[2], np.uint8)[offs[0] : offs[-1]] if raw[2] is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that each holds about `limit` bytes of `column`; a longer text stands alone."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        yield from slices(batch, pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False), limit)
    pa.default_memory_pool().release_unused()  # a worker outlives its task


def slices(batch: pa.RecordBatch, sizes: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that a slice's sizes sum to about `limit`; a larger row stands alone."""
    ends = np.cumsum(sizes.astype(np.int64))
    start, base = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(start, stop - start)
        base, start = int(ends[stop - 1]), stop


def word_spans(data: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text index of each word, in order."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~space[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offs] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:-1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(offs, s, "right") - 1


def _prefix_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of code[b_j] * r**j over j < p, for ascending positions p."""
    out = np.zeros(len(at), U64)
    carry, scale = 0, 1
    step = pow(_R, SEGMENT, 1 << 64)
    for a in range(0, len(data), SEGMENT):
        b = min(a + SEGMENT, len(data))
        c = np.zeros(b - a + 1, U64)
        np.cumsum(BYTE_CODE[data[a:b]] * _POW[: b - a], out=c[1:])
        c = c * U64(scale) + U64(carry)
        lo, hi = np.searchsorted(at, [a, b + (b == len(data))], "left")
        out[lo:hi] = c[at[lo:hi] - a]
        carry, scale = int(c[-1]), scale * step & _MASK
    return out


def span_hash(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hash of each data[s:e]; s and e ascend."""
    h = _prefix_at(data, e) - _prefix_at(data, s)
    blocks = s // SEGMENT
    far = _powers(pow(_RINV, SEGMENT, 1 << 64), int(blocks[-1]) + 1) if len(s) else np.ones(1, U64)
    return mix(h * _POWINV[s % SEGMENT] * far[blocks] + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    return LOWER[data]


_GRAM = [pow(0xC2B2AE3D27D4EB4F, k, 1 << 64) for k in range(64)]


def rolling(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of n words and its first word's index; windows stay inside a text."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    g = h[:m].copy()
    for k in range(1, n):
        g += h[k : k + m] * U64(_GRAM[k])
    at = np.flatnonzero(doc[:m] == doc[n - 1 :])
    return mix(g[at] + U64(n)), at


def distinct_per_text(g: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash) pairs ordered by text, then hash."""
    if len(g) == 0:
        return doc, g
    order = np.lexsort((g, doc))
    d, g = doc[order], g[order]
    keep = np.ones(len(g), bool)
    keep[1:] = (d[1:] != d[:-1]) | (g[1:] != g[:-1])
    return d[keep], g[keep]


def shingles(texts: pa.Array, n: int, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each text: text index, hash (ordered within a text), and the texts' word counts.

    A text of fewer than n words, but at least one, has its whole sequence as its only shingle.
    """
    data, offs = buffer(texts)
    if fold:
        data = lowered(data)
    s, e, doc = word_spans(data, offs)
    words = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), np.int64)
    h = span_hash(data, s, e)
    g, at = rolling(h, doc, n)
    d = doc[at]
    short = np.flatnonzero((words > 0) & (words < n))
    if len(short):
        first = np.searchsorted(doc, short)
        sums = np.zeros(len(short), U64)
        for k in range(n - 1):
            has = words[short] > k
            sums[has] += h[first[has] + k] * U64(_GRAM[k])
        g = np.concatenate([g, mix(sums + words[short].astype(U64))])
        d = np.concatenate([d, short])
    return *distinct_per_text(g, d), words
