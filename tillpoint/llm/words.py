"""Words of many texts at once: word bounds and 64-bit word hashes straight from Arrow's byte buffers.

A chunk of texts is one byte array.  A word is a run of bytes that are no
separators, inside one text.  The hash of a run of bytes (or of word hashes) is
a polynomial modulo 2^64 taken from prefix sums, so all words, and all windows
of k words, come from a few array passes and no Python loop runs per word.
Separators are ASCII, so bytes of multi-byte characters never match them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20
#: Odd, and 5 modulo 8: powers of it return as late as they can modulo 2^64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """The first n powers of the base ("up") or of its inverse ("down")."""
    if len(_powers[kind]) < n:
        base = int(_BASE) if kind == "up" else pow(int(_BASE), -1, 1 << 64)
        step = np.full(max(n, 1 << 16), base, np.uint64)
        step[0] = 1
        _powers[kind] = np.multiply.accumulate(step)
    return _powers[kind][:n]


def byte_table(seed: int) -> np.ndarray:
    """A random 64-bit value for every byte value."""
    return np.random.default_rng(seed).integers(0, 1 << 64, 256, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes whose every bit depends on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of values[start:end] for every pair of bounds."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power("up", len(values)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power("down", len(values) + 1)[starts])


def window_hashes(values: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """The hash of values[start:start + k] for every start."""
    return run_hashes(values, starts, starts + k)


def separators(chars: str) -> np.ndarray:
    """Which byte values separate words."""
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


class Words:
    """The words of a chunk: ``data`` (bytes), ``starts``, ``ends`` (bounds in it), ``first`` (per text its
    first word's number, and the number of words at the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, sep: np.ndarray):
        self.data = data
        inside = ~sep[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]   # texts lie side by side: a word never passes an edge
        begins[edges] |= inside[edges]
        stops[edges - 1] |= inside[edges - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self, table: np.ndarray) -> np.ndarray:
        return run_hashes(table[self.data], self.starts, self.ends)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def strings(self, which: np.ndarray) -> pa.Array:
        """The words of the given numbers, as binary strings."""
        a, b = self.starts[which], self.ends[which]
        bounds = np.zeros(len(which) + 1, np.int64)
        np.cumsum(b - a, out=bounds[1:])
        take = np.arange(bounds[-1]) + np.repeat(a - bounds[:-1], b - a)
        return pa.Array.from_buffers(pa.large_binary(), len(which), [None, pa.py_buffer(bounds), pa.py_buffer(self.data[take])])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the bounds of its texts (a null is an empty text)."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]] if len(offsets) else raw, offsets - offsets[0]


def chunks(batches, text_col: str, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, bounds): the batches cut into runs of whole texts of about ``chunk_bytes``; a longer text is a run of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        raw, offsets = text_bytes(batch.column(batch.schema.get_field_index(text_col)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + chunk_bytes, "right")) - 1)
            yield batch.slice(at, to - at), raw[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
            at = to
