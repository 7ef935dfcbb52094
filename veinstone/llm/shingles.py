"""Word hashes and word shingles of whole texts, on numpy arrays (runs inside Arrow-batched tasks).

A slice of a batch is hashed as one array of bytes: a word's hash is a polynomial of its bytes, so that there is no
Python object for a word and no dictionary of words.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Odd multipliers of the 64-bit mixing steps (fixed values).
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: Bytes of text that are worked on at a time; a longer text alone is one slice.
SLICE_BYTES, PART_BYTES = 1 << 20, 1 << 18


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary column; a null is empty."""
    if column.null_count:
        column = column.fill_null(b"")
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if at and at.size else np.zeros(len(column) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches in parts of a few rows and of about ``SLICE_BYTES`` of text: what Python makes of a part is gone before the next."""
    for batch in batches:
        size = None
        if text in batch.schema.names and (pa.types.is_binary(batch.column(text).type) or pa.types.is_string(batch.column(text).type)):
            size = np.cumsum(np.asarray(batch.column(text).is_valid()) * np.diff(np.frombuffer(batch.column(text).buffers()[1], np.int32)[batch.column(text).offset :][: batch.num_rows + 1].astype(np.int64)))
        at = 0
        while at < batch.num_rows:
            end = min(at + rows, batch.num_rows)
            if size is not None:
                end = min(end, max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_BYTES, "right"))))
            yield batch.slice(at, end - at)
            at = end


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_B
    return x ^ (x >> np.uint64(31))


def kept(name: str, make: Callable[[], object]) -> object:
    """What ``make`` returned first in this Python worker. Functions travel to the workers by their code, so that a cache of a module's own would be looked for in a package that executors do not have."""
    store = sys.modules.setdefault("_veinstone_kept", types.ModuleType("_veinstone_kept")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def _byte_values(kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(whether a byte stands between words, its value): A-Z count as a-z, what is between words as 0.

    Of ``spaced`` words only white space is between them; of ``alphanumeric`` ones all that is neither a letter, a digit nor beyond ASCII.
    """
    b = np.arange(256)
    small = np.where((b >= 65) & (b <= 90), b + 32, b)
    if kind == "spaced":
        space = np.isin(b, [0x20, *range(0x09, 0x0E)])
    else:
        space = (small < 0x30) | (small > 0x39) & (small < 0x61) | (small > 0x7A) & (small < 0x80)
    values = mixed(mixed((small + 1).astype(np.uint64) * MIX_A) * MIX_A + MIX_B)
    values[space] = 0
    return space, values


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier modulo 2 ** 64, and those of its inverse."""
    inverse = np.array([pow(int(MIX_A), -1, 1 << 64)], np.uint64)
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, x, np.uint64)])) for x in (MIX_A, inverse[0]))


class Words:
    """Hashes of the words of a slice of texts, one after another; ``at[k]`` to ``at[k + 1]`` are those of text k."""

    def __init__(self, column: pa.Array, kind: str = "spaced") -> None:
        data, offsets = text_bytes(column)
        is_space, values = kept(f"{kind} bytes", lambda: _byte_values(kind))
        space = is_space[data]
        before = np.ones(len(data) + 1, bool)
        before[1:] = space
        before[offsets] = True
        starts = np.flatnonzero(~space & before[:-1])
        self.at = np.searchsorted(starts, offsets)
        self.hashes = np.empty(len(starts), np.uint64)
        ends = np.append(starts[1:], len(data))
        k = 0
        while k < len(starts):
            first = starts[k]
            stop = max(k + 1, int(np.searchsorted(ends, first + PART_BYTES, "right")))
            last = ends[stop - 1]
            power, inverse = kept("powers", lambda: _powers(PART_BYTES)) if last - first <= PART_BYTES else _powers(int(last - first))
            place = starts[k:stop] - first
            self.hashes[k:stop] = mixed(np.add.reduceat(values[data[first:last]] * power[: last - first], place) * inverse[place])
            k = stop

    def __len__(self) -> int:
        return len(self.at) - 1

    def of(self, k: int) -> np.ndarray:
        return self.hashes[self.at[k] : self.at[k + 1]]


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of every k-word window; of the whole sequence if it has fewer words; none without words."""
    n = len(hashes)
    if not n:
        return np.empty(0, np.uint64)
    k = min(k, n)
    m = n - k + 1
    out = np.full(m, k, np.uint64)
    for i in range(k):
        out *= MIX_A
        out += hashes[i : i + m]
    return mixed(mixed(out) * MIX_A)


def gram_sets(words: Words, k: int) -> list[np.ndarray]:
    """The sorted distinct k-word windows of every text."""
    grams = windows(words.hashes, k)
    sizes = np.diff(words.at)
    return [np.unique(grams[a : a + n - k + 1]) if n >= k else windows(words.hashes[a : a + n], k) for a, n in zip(words.at[:-1].tolist(), sizes.tolist(), strict=True)]


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of ``width`` neighbours, one for each place where so many begin."""
    if len(x) < width:
        return x[:0]
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x
