"""Words of UTF-8 text batches as 64-bit hashes, whole batches at a time in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_CHAR, _WORD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd bases of two polynomial hashes
SLICE = 1 << 19

#: Separators of words: space and the control characters 9 to 13.
SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True
#: For terms: all ASCII that is no letter or digit.
NOT_ALNUM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i up to n at least."""
    if base not in _tables or len(_tables[base][0]) <= n:
        size = max(n + 1, 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            t = np.full(size, b, _U)
            t[0] = 1
            out.append(np.multiply.accumulate(t))
        _tables[base] = (out[0], out[1])
    return _tables[base]


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def spans(values: np.ndarray, base: int, a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Hash of values[a:z] for each pair, equal for equal content at any place."""
    up, down = _powers(base, len(values))
    s = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up[:len(values)], out=s[1:])
    return mix((s[z] - s[a]) * down[a] + (z - a).astype(_U) * _U(0xA24BAED4963EE407))


@dataclass
class Words:
    """Words of some texts: text i has the words of bounds[i] to bounds[i + 1]."""

    data: np.ndarray  # the bytes of the texts, one after another
    offsets: np.ndarray  # where each text starts
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all runs of k words in one text, their places, and the first of each text."""
        n = np.maximum(np.diff(self.bounds) - k + 1, 0)
        first = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(first[-1]) + np.repeat(self.bounds[:-1] - first[:-1], n)
        return spans(self.hash, _WORD, at, at + k), at, first

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each text's word sequence."""
        a, z = self.bounds[:-1], self.bounds[1:]
        return spans(self.hash, _WORD, a, z), spans(mix(self.hash + _U(1)), _CHAR, a, z)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, at, data = column.buffers()
    at = np.frombuffer(at, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, bytes, offsets) of runs of rows of about half a megabyte, or of one longer text."""
    data, at = utf8(column)
    a, n = 0, len(column)
    while a < n:
        z = max(a + 1, int(np.searchsorted(at, at[a] + SLICE, "right")) - 1)
        yield a, z, data[at[a]:at[z]], at[a:z + 1] - at[a]
        a = z


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES, lower: bool = False) -> Words:
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~separators[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | first))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | first))
    values = (LOWER[data] if lower else data).astype(_U) + _U(1)
    return Words(data, offsets, start, end, spans(values, _CHAR, start, end), np.searchsorted(start, offsets))
