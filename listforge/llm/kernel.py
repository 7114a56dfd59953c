"""Vectorised text kernels: words, word hashes and rolling hashes over Arrow string columns.

Everything works on the UTF-8 bytes of whole texts. A batch is walked in chunks of whole documents of about
``CHUNK`` bytes (a longer document is a chunk of its own), so memory follows the chunk and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 2 << 20
U64 = np.uint64


def _splitmix(n: int, seed: int) -> np.ndarray:
    """n 64-bit values of the splitmix64 sequence."""
    with np.errstate(over="ignore"):
        z = (np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) + U64(seed)
        z = (z ^ (z >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> U64(27))) * U64(0x94D049BB133111EB)
        return z ^ (z >> U64(31))


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finaliser: spreads every input bit over the word."""
    with np.errstate(over="ignore"):
        z = h + U64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
        z = (z ^ (z >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> U64(27))) * U64(0x94D049BB133111EB)
        return z ^ (z >> U64(31))


BYTE = _splitmix(256, 7)
BASE = U64(0xD6E8FEB86659FD93)  # odd

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def powers(n: int) -> np.ndarray:
    """BASE ** 0 .. BASE ** (n-1) modulo 2**64."""
    out = np.full(max(n, 1), BASE, dtype=U64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, last + 1, bytes, offsets from 0) of runs of whole documents."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and, by document, the offsets into them."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of every span of bytes; spans must not overlap and must ascend. Empty spans hash alike."""
    out = np.zeros(len(starts), dtype=U64)
    lens = ends - starts
    full = lens > 0
    if full.any():
        s, n = starts[full], lens[full]
        first = np.cumsum(n) - n
        at = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(first, n)
        with np.errstate(over="ignore"):
            terms = BYTE[data[at + np.repeat(s, n)]] * powers(int(n.max()))[at]
            out[full] = np.add.reduceat(terms, first)
    with np.errstate(over="ignore"):
        return mix(out + lens.astype(U64) * U64(0xA24BAED4963EE407), salt)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of every k consecutive values of h, by doubling."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out, done, power, width = None, 0, h.copy(), 1
    base = int(BASE)
    with np.errstate(over="ignore"):
        bits = k
        while True:
            if bits & 1:  # append a block of `width` values behind the `done` values
                if out is None:
                    out = power.copy()
                else:
                    m = len(power) - done
                    out = out[:m] * U64(pow(base, width, 2**64)) + power[done : done + m]
                done += width
            bits >>= 1
            if not bits:
                return out[:n]
            power = power[:-width] * U64(pow(base, width, 2**64)) + power[width:]
            width *= 2
