"""Texts as byte arrays: portions, words, hashes and shingles of Arrow batches in numpy.

A null text counts as empty everywhere. Texts are taken whole; a portion holds several texts, or one
that is longer than the limit.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PORTION = 2 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_RANDOM = np.random.default_rng(20240607)
BYTE_CODES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text starts (one more entry for the end)."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give freed memory back to the system: a Python worker outlives its task, beside others."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def portions(batches, column: str, limit: int = PORTION) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches of about ``limit`` bytes of text, with the text's bytes and bounds.

    At the end freed memory is released.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        data, bounds = raw(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            part = data[bounds[first] : bounds[last]]
            yield batch.slice(first, last - first), part, bounds[first : last + 1] - bounds[first]
            first = last
    release()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the hash base, or of its inverse, modulo 2**64."""
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        have = np.full(max(n, 1 << 16, min(n + n // 8, PORTION + 4096)), base, np.uint64)  # kept, so little more than asked for
        have[0] = 1
        np.cumprod(have, out=have)
        if n <= 4 * PORTION:
            _powers[inverse] = have
    return have[:n]


def sequence_hashes(codes: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hashes`` takes the hash of any span of 64-bit symbols."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(len(codes)), out=out[1:])
    return out


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """The same of bytes."""
    return sequence_hashes(BYTE_CODES[data])


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans: the same bytes give the same hash wherever they stand."""
    value = (prefix[ends] - prefix[starts]) * powers(len(prefix), True)[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def spans_of(inner: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes that do not cross a text's bounds."""
    n = len(inner)
    first, last = inner.copy(), inner.copy()
    first[1:] &= ~inner[:-1]
    last[:-1] &= ~inner[1:]
    at = bounds[:-1][bounds[:-1] < n]
    first[at] = inner[at]
    at = bounds[1:][bounds[1:] > 0] - 1
    last[at] = inner[at]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def owner(bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The text that each position belongs to."""
    return np.searchsorted(bounds, at, "right") - 1


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every word, ASCII letters lower-cased, split at the six ASCII blanks."""
    data = LOWER[data]
    starts, ends = spans_of(~SPACE[data], bounds)
    return span_hashes(prefix_hashes(data), starts, ends), owner(bounds, starts)


def shingles(words: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every k-word shingle; a text of fewer words gives its whole sequence."""

    def joined(first: np.ndarray, size: int) -> np.ndarray:
        value = np.full(len(first), size, np.uint64)
        for j in range(size):
            value = mix(value * np.uint64(0x9FB21C651E98DF25) + words[first + j])
        return value

    n = len(words)
    if not n:
        return words, text
    first = np.flatnonzero(text[: n - k + 1] == text[k - 1 :]) if n >= k else np.zeros(0, np.int64)
    hashes, owners = [joined(first, k)], [text[first]]
    at = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    size = np.diff(np.r_[at, n])
    for short in range(1, k):
        some = at[size == short]
        hashes.append(joined(some, short))
        owners.append(text[some])
    hashes, owners = np.concatenate(hashes), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return hashes[order], owners[order]


def distinct(values: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text; ``text`` is ascending."""
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return values[keep], text[keep]
