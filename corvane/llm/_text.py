"""Vectorised word, hash and window kernels shared by the text operators.

A word is a maximal run of bytes other than space and \\t..\\r, which in UTF-8 is the
same as the pattern ``[^\\x20\\x09-\\x0D]+``. Every function works on a whole Arrow
chunk at once; a null text counts as an empty one.

Hashes are 64 bits and not linear: every eight bytes of a word, and every word of a window, go through
a mixing function together with their place before they are put together, so no two
patterns of letters or words meet by construction, whatever the seed.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_R_WORD = 0xAF251AF3B0F025B5
#: Bytes of text that a kernel takes at a time; it needs some ten times as much memory.
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words(NamedTuple):
    """Words of a chunk of documents; ``ends`` are exclusive byte places in ``buf``."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    #: words before each document, and after the last
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and byte offsets of a string column, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2] if len(column) else None
    buf = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return buf, off - off[0]


def split_words(column: pa.Array, lower: bool = False) -> Words:
    buf, off = text_bytes(column)
    word = ~_SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(_LOWER[buf] if lower else buf, starts, ends, np.searchsorted(starts, off))


def _reduce(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first) if len(first) else values[:0]


def hash_words(w: Words, *seeds: int) -> np.ndarray:
    """A 64-bit hash of each word's bytes; a word has at least one. With several seeds a row for each, of independent hashes."""
    size = w.ends - w.starts
    parts = (size + 7) // 8
    first = np.cumsum(parts) - parts
    at = np.arange(int(parts.sum())) - np.repeat(first, parts)
    left = np.repeat(size, parts) - 8 * at
    padded = np.concatenate([w.buf, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    value = eight[np.repeat(w.starts, parts) + 8 * at]
    short = left < 8
    value[short] &= (_U(1) << (left[short].astype(np.uint64) * _U(8))) - _U(1)
    at, last, out = at.astype(np.uint64) * _U(_STEP), size.astype(np.uint64) * _U(_STEP), []
    for seed in seeds or (0,):
        salt = mix(at + _U(seed * 7919 + 1))
        out.append(mix(_reduce(mix(value ^ salt) * _U(_R_WORD) + mix(value + salt), first) + last))
    return np.stack(out) if len(seeds) > 1 else out[0]


def hash_windows(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` words from each place on; the last ``k - 1`` places have none."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    n, out, done, part, size = len(h) - k + 1, None, 0, h, 1
    while True:  # windows of a power of two words each, put together by the bits of k
        if k & size:
            piece = part[done : done + n]
            out = piece if out is None else mix(out * _U(_R_WORD) + piece + _U(size))
            done += size
        if done == k:
            return mix(out + _U(k))
        part = mix(part[: len(part) - size] * _U(_R_WORD) + (part[size:] ^ _U(_STEP)) + _U(size))
        size *= 2


def hash_spans(h: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of the ``length`` words, at least one, from each ``start``."""
    first = np.cumsum(length) - length
    at = np.arange(int(length.sum())) - np.repeat(first, length)
    value = h[np.repeat(start, length) + at]
    salt = mix(at.astype(np.uint64) * _U(_STEP) + _U(3))
    return mix(_reduce(mix(value ^ salt) * _U(_R_WORD) + mix(value + salt), first) + length.astype(np.uint64))


def window_min(x: np.ndarray, k: int) -> np.ndarray:
    """The least of the ``k`` values from each place on."""
    n, size = len(x) - k + 1, 1
    if n <= 0:
        return x[:0]
    while size * 2 <= k:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    return np.minimum(x[:n], x[k - size : k - size + n])


def inside(w: Words, k: int) -> np.ndarray:
    """The places whose window of ``k`` words ends in the same document."""
    doc = w.doc
    return np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :]) if len(doc) >= k else np.zeros(0, np.int64)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES):
    """Row slices of about ``most`` bytes of text each; a longer text stands alone."""
    _, off = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
