"""Texts of an Arrow batch as flat byte arrays: chunks, words, lines and rolling hashes, all vectorised.

Hashes are polynomials over 64-bit integers taken from prefix sums, so a string of any length costs one subtraction. Modulo a power of two, different strings of
1,024 and more bytes can be made to collide (Thue-Morse words), so strings of more than ``LONG`` bytes are hashed with xxh3 instead.
"""
from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 1 << 20
LONG = 512
BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end and the bounds of each text; NULL is empty."""
    column = pc.fill_null(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, content = column.buffers()
    bounds = np.frombuffer(places, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def give_back() -> None:
    """Return freed memory to the system: a Python worker stays between tasks, and what it keeps counts beside the heap of its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function of batches, which gives its memory back at the end of a task."""
    @functools.wraps(run)
    def task(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()
    return task


def chunks(bounds: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together; a longer text stands alone."""
    first, last = 0, len(bounds) - 1
    while first < last:
        end = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        yield first, min(end, last)
        first = end


def word_table(*separators: int, upto: int = 0) -> np.ndarray:
    """Byte table that is True for bytes of words."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    table[:upto] = False
    return table


NOT_SPACE = word_table(*SPACES)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data | 0x20, data)


def spans(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True, cut at the bounds of texts."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = bounds[:-1][bounds[:-1] < len(inside)]
    starts[edges] = inside[edges]
    before = bounds[1:][bounds[1:] > 0] - 1
    ends[before] = inside[before]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least ``count`` of each."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) < count:
        size = max(1 << 16, 1 << int(count - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        both = []
        for b in (base, inverse):
            out = np.full(size, b, np.uint64)
            out[0] = 1
            both.append(np.multiply.accumulate(out))
        known = _POWERS[base] = tuple(both)
    return known


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    up, _ = powers(base, len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def byte_prefix(data: np.ndarray) -> np.ndarray:
    return prefix(_BYTE_VALUES[data], BASE)


def taken(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of each string between the given places."""
    _, down = powers(base, len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts])


def strings(data: np.ndarray, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each string of ``data`` between the given places, ``sums`` being its ``byte_prefix``."""
    out = taken(sums, starts, ends)
    for k in np.flatnonzero(ends - starts > LONG):
        out[k] = xxhash.xxh3_64_intdigest(np.ascontiguousarray(data[starts[k]:ends[k]]).data)
    return out


def text_of(places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of the text that holds each place."""
    return np.searchsorted(bounds, places, "right") - 1


def windows(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of n words within one text."""
    if len(hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = prefix(hashes, WORD_BASE)
    first = np.flatnonzero(owner[:len(owner) - n + 1] == owner[n - 1:])
    return first, taken(sums, first, first + n, WORD_BASE)  # runs of a few words are far too short to collide by design


def per_text(values: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=count).astype(np.int64) if len(owner) else np.zeros(count, np.int64)


def repeated(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """True where the key occurs again in the same text (every occurrence, the first included)."""
    if not len(keys):
        return np.zeros(0, bool)
    joint = mixed(keys + owner.astype(np.uint64) * np.uint64(WORD_BASE))
    order = np.argsort(joint)
    ordered = joint[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def covered(first: np.ndarray, n: int, count: int) -> np.ndarray:
    """Marks of the items inside runs of n that begin at the given places."""
    steps = np.bincount(first, minlength=count + 1) - np.bincount(np.minimum(first + n, count), minlength=count + 1)
    return np.cumsum(steps[:-1]) > 0
