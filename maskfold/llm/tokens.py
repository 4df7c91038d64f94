"""Array-at-a-time words and shingles for use inside Arrow tasks.

A batch of texts is worked on as one byte buffer. A word is a maximal run of bytes that a 256-entry
class table does not mark as separators; its hash is a polynomial over random 64-bit byte values,
taken from prefix sums, so no Python runs per word. Buffers are cut at document ends into pieces of
about ``PIECE`` bytes; one longer document makes one longer piece and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply); a bijection."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


LOWER = _lower()
#: Separators of words ``[^\x20\x09-\x0D]+``.
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Separators of letter runs: all ASCII but A-Z and a-z.
NOT_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
_BYTE = constants(256, 11)
_BASE = int(constants(1, 23)[0])
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(which: str, n: int) -> np.ndarray:
    """Powers of the base or of its inverse; tables for usual pieces are kept."""
    if len(_powers[which]) >= n:
        return _powers[which]
    steps = np.full(max(n, PIECE + PIECE // 4), _BASE if which == "up" else _INVERSE, np.uint64)
    steps[0] = 1
    table = np.cumprod(steps, dtype=np.uint64)
    if len(table) <= 8 * PIECE:
        _powers[which] = table
    return table


def buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type):
        col = col.cast(pa.string())
    if not (pa.types.is_string(col.type) or pa.types.is_large_string(col.type)):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def pieces(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, one past the last, bytes, offsets) of pieces of a string column."""
    data, off = buffers(col)
    at, n = 0, len(off) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + PIECE, "right")) - 1)
        yield at, to, data[off[at] : off[to]], off[at : to + 1] - off[at]
        at = to


def words(data: np.ndarray, off: np.ndarray, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each document the bounds of its words among them."""
    hashes, _, _, bounds = word_spans(data, off, sep)
    return hashes, bounds


def word_spans(data: np.ndarray, off: np.ndarray, sep: np.ndarray = SPACE):
    """Word hashes, byte starts and ends of the words, and the documents' bounds among the words."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(off), np.int64)
    inside = ~sep[data]
    edge = np.zeros(n + 1, bool)  # a document begins or ends here
    edge[off] = True
    starts = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | edge[:-1]))
    ends = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | edge[1:]))
    value = _BYTE[LOWER[data]] * _power("up", n)[:n]
    total = np.cumsum(value, dtype=np.uint64)
    hashes = total[ends] - total[starts] + value[starts]
    hashes *= _power("down", n)[:n][starts]
    return mix(hashes), starts, ends + 1, np.searchsorted(starts, off)


def prefix_hashes(data: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k bytes from each start, A-Z in lower case."""
    out = np.full(len(starts), k, np.uint64)
    for j, factor in enumerate(constants(k, 53)):
        out += _BYTE[LOWER[data[starts + j]]] * factor
    return mix(out)


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, in order and with repeats, and the documents' bounds
    among them. A document of fewer words (but one at least) has its whole sequence as one shingle."""
    count = np.diff(bounds)
    own = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    out_bounds = np.concatenate(([0], np.cumsum(own)))
    out = np.empty(out_bounds[-1], np.uint64)
    factors = constants(width + 1, 37)
    long = np.flatnonzero(count >= width)
    if len(long):
        rolled = hashes[: len(hashes) - width + 1] * factors[0]
        for j in range(1, width):
            rolled += hashes[j : len(hashes) - width + 1 + j] * factors[j]
        take = np.ones(len(rolled) + width, bool)
        # the last width - 1 words of a document begin no shingle of their own
        for j in range(1, width):
            last = bounds[1:] - j
            take[last[(last >= bounds[:-1])]] = False
        take = take[: len(rolled)]
        target = np.repeat(count >= width, own)
        out[target] = mix(rolled[take])
    for i in np.flatnonzero((count > 0) & (count < width)):
        w = hashes[bounds[i] : bounds[i + 1]]
        out[out_bounds[i]] = mix((w * factors[: len(w)]).sum(keepdims=True, dtype=np.uint64) + factors[width] * _U(len(w)))[0]
    return out, out_bounds


def sorted_sets(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct values in ascending order, and the new bounds."""
    values = values.copy()
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    starts = bounds[:-1][np.diff(bounds) > 0]
    keep[starts] = True
    before = np.concatenate(([0], np.cumsum(keep)))
    return values[keep], before[bounds]


def document_sets(col: pa.Array, width: int = 5) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, one past the last, distinct shingles, bounds) of pieces of a text column."""
    for at, to, data, off in pieces(col):
        yield at, to, *sorted_sets(*shingles(*words(data, off), width))
