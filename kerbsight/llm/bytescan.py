"""Vectorised scanning of UTF-8 text inside Arrow batches: words, their 64-bit hashes, shingles.

Everything works on the bytes of a batch at once, so Python touches documents, not characters. Hashes are 64-bit values
of a keyed polynomial over the bytes, mixed at the end; two different words share one with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are scanned in pieces of about so many bytes, so that the working arrays stay in the processor's cache.
CHUNK = 1 << 20

U = np.uint64
BASE = 0x9E3779B97F4A7C15
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**64, 256, dtype=U)
#: Each byte with A-Z as a-z.
FOLD = np.arange(256)
FOLD[65:91] += 32
#: Hash values by byte, with A-Z as a-z.
_FOLDED = _BYTE[FOLD]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words between ASCII white space.
NOT_SPACE = ~_SPACE
#: Bytes of words of letters and digits; bytes of non-ASCII characters count as letters.
ALNUM = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers.get("up", ())) < n:
        n = max(n, CHUNK + 1)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
            a = np.full(n, base, U)
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on all."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = (column.cast(pa.string()) if pa.types.is_null(column.type) else column).fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return bytes_, at - at[0]


def pieces(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: (first row, row after the last, bytes, offsets). A longer row comes alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and for each row the index of its first word (n + 1 values)."""
    return runs_of(letters[data], offsets)


def runs_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`words`, given for each byte whether it belongs to a word."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def folded_sums(data: np.ndarray, fold: bool = True) -> np.ndarray:
    """Sums of the hash polynomial up to each place, with A-Z as a-z if ``fold``."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((_FOLDED if fold else _BYTE)[data] * up[: len(data)], out=sums[1:])
    return sums


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """A hash of each word's bytes, with A-Z as a-z if ``fold``."""
    _, down = powers(len(data) + 1)
    sums = folded_sums(data, fold)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U) * U(BASE))


_STEPS = mix(np.arange(1, 65, dtype=U) * U(BASE)) | U(1)


def shingles(hashes: np.ndarray, first: np.ndarray, size: int = 5, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and each row's first one (n + 1 values).

    With ``short``, a row of fewer words, but at least one, has its whole sequence as one shingle.
    """
    m, counts = len(hashes), np.diff(first)
    total = np.zeros(max(m - size + 1, 0), U)
    for k in range(size):
        total += hashes[k : k + len(total)] * _STEPS[k]
    per_row = np.maximum(counts - size + 1, 0)
    keep = np.zeros(m + 1, np.int32)
    full = np.flatnonzero(per_row)
    np.add.at(keep, first[full], 1)
    np.add.at(keep, first[full] + per_row[full], -1)
    keep = np.cumsum(keep[:m]) > 0
    values = mix(total[keep[: len(total)]])
    if short and (few := np.flatnonzero((counts > 0) & (counts < size))).size:
        extra = np.zeros(len(few), U)
        for k in range(size - 1):
            has = counts[few] > k
            extra[has] += hashes[first[few[has]] + k] * _STEPS[k]
        extra = mix(extra ^ mix(counts[few].astype(U)))
        per_row[few] = 1
        at = np.concatenate([[0], np.cumsum(per_row)])
        merged = np.empty(at[-1], U)
        is_short = np.zeros(at[-1], bool)
        is_short[at[few]] = True
        merged[is_short], merged[~is_short] = extra, values
        return merged, at
    return values, np.concatenate([[0], np.cumsum(per_row)])
