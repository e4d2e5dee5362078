"""Vectorised work on whole texts inside a task: words, their hashes, and windows of words.

Texts stay in the UTF-8 buffers that Arrow hands to Python.  Work runs over
chunks of about ``CHUNK_BYTES``; a longer text is a chunk of its own, so a
task's memory is bounded by one chunk or one text, never by a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _MULTIPLIER)

#: Byte tables: A-Z to a-z, and which bytes belong to words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array and the offsets of its texts in them; a null is empty."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    return raw, at - at[0]


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``limit`` bytes together."""
    column = batch.column(batch.schema.get_field_index(text))
    _, at = buffers(column)
    start = 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(at, at[start] + limit, side="right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def word_spans(raw: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes marked in ``table``; no run crosses a text's edge."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = table[raw]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = at[1:-1]
    first = edges[edges < len(raw)]
    begins[first] = inside[first]
    last = edges[edges > 0] - 1
    ends[last] = inside[last]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, at least ``n`` of each; kept for the worker's next chunk."""
    global _powers
    if len(_powers[0]) < n:
        grown = []
        for base in (_MULTIPLIER, _INVERSE):
            x = np.full(max(n, CHUNK_BYTES), base, np.uint64)
            x[0] = 1
            grown.append(np.multiply.accumulate(x))
        _powers = (grown[0], grown[1])
    return _powers


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span: differences of one running polynomial over all bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _powers_to(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[raw] * power[: len(raw)], out=total[1:])
    sums = (total[ends] - total[starts]) * inverse[starts]
    return mix(sums ^ ((ends - starts).astype(np.uint64) * _MULTIPLIER))


def windows(hashes: np.ndarray, text_of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` neighbours in the same text, and the index of its first element."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += mix(hashes[k : k + n] + np.uint64((k + 1) * int(_MULTIPLIER) % (1 << 64)))
    whole = text_of[:n] == text_of[size - 1 :]
    return mix(total[whole]), np.flatnonzero(whole)


def text_of(starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Index of the text in which each position stands."""
    return np.searchsorted(at[1:], starts, side="right")


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's longs."""
    return x.view(np.int64)
