"""Vectorised words over Arrow text columns, shared by the text operators.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. A word's hash adds a random 64-bit number for each (place, byte). Window hashes are
polynomial (Rabin-Karp) over word hashes, modulo the prime 2^31 - 1 to two bases: powers of an odd
number modulo 2^64 would let long regular sequences collide. Both are read off prefix sums, then
mixed. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_PLACES = 64
_PLACED = np.random.default_rng(0x5EED).integers(0, 1 << 64, _PLACES * 256, dtype=np.uint64)
_PRIME = _U((1 << 31) - 1)
#: Bases below the prime, and odd factors that give each base its own view of a hash.
_BASES = (0x4F1BBCDC, 0x2545F491, 0x1B873593)
_VIEWS = (_U(1), _U(0xD1342543DE82EF95), _U(0xA24BAED4963EE407))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Words(NamedTuple):
    data: np.ndarray  # UTF-8 bytes of the slice
    texts: np.ndarray  # byte offsets of the texts in data, one more than texts
    start: np.ndarray  # byte offset of each word
    end: np.ndarray
    first: np.ndarray  # index of each text's first word, one more than texts


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each piece holds at most ``max_bytes`` of text, or one row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    lo, held = 0, 0
    for i, size in enumerate(sizes):
        if i > lo and held + size > max_bytes:
            yield batch.slice(lo, i - lo)
            lo, held = i, 0
        held += int(size)
    if lo < len(sizes):
        yield batch.slice(lo)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offset at which each begins."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(texts: pa.Array, gaps: np.ndarray = _SPACE) -> Words:
    """Words of all texts; ``gaps`` tells for each byte whether it separates words."""
    data, at = text_bytes(texts)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~gaps[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return Words(data, at, start, end, np.searchsorted(start, at))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def string_totals(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Running sums of the numbers of all bytes, placed from the start before them (``start``
    ascends); ``string_hashes`` reads the hash of any piece that begins at a start off them."""
    place = np.arange(len(data)) - np.repeat(np.concatenate([[0], start]), np.diff(np.concatenate([[0], start, [len(data)]])))
    numbers = _PLACED[(place % _PLACES) << 8 | data]
    far = np.flatnonzero(place >= _PLACES)
    numbers[far] = mix(numbers[far] + mix((place[far] // _PLACES).astype(np.uint64)))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(numbers, out=total[1:])
    return total


def string_hashes(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix(total[end] - total[start] + mix((end - start).astype(np.uint64)))


def word_hashes(w: Words) -> np.ndarray:
    return string_hashes(string_totals(w.data, w.start), w.start, w.end)


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, but that the prime itself may stand for 0."""
    x = (x & _PRIME) + (x >> _U(31))
    return (x & _PRIME) + (x >> _U(31))


def powers(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base, and of its inverse, modulo the prime."""
    if k not in _powers or len(_powers[k][0]) < n:
        prime, both = int(_PRIME), []
        for base in (_BASES[k], pow(_BASES[k], -1, prime)):
            out = np.ones(1, np.uint64)
            while len(out) < max(n, 1 << 16):
                out = np.concatenate([out, _fold(out * _U(pow(base, len(out), prime)))])
            both.append(out)
        _powers[k] = (both[0], both[1])
    up, down = _powers[k]
    return up[:n], down[:n]


def _modular(values: np.ndarray, start: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
    up, down = powers(k, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(_fold(_fold(values * _VIEWS[k]) * up[: len(values)]), out=total[1:])
    return (_fold(total[end] - total[start]) * down[start]) % _PRIME


def spans(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of each span start..end of a sequence of word hashes."""
    both = _modular(hashes, start, end, 0) << _U(31) | _modular(hashes, start, end, 1)
    return mix(both + mix((end - start).astype(np.uint64)))


def checks(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A further Rabin-Karp hash of 31 bits, to another base."""
    return _modular(hashes, start, end, 2).astype(np.int32)


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words inside one text, and the index of their first word."""
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(hashes))
    at = np.flatnonzero(left >= width)
    return spans(hashes, at, at + width), at


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
