"""NumPy kernels over Arrow string columns: words, hashes, n-grams, sliding minima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text worked on at once; documents are never cut, so one longer document is a slice alone.
SLICE_BYTES = 3 << 20
_SPAN = 1 << 18
_BASE = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTES = mix(np.arange(1, 257, dtype=U))


def _powers(base: int) -> np.ndarray:
    out = np.full(_SPAN + 1, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_BASE)
_UNPOWER = _powers(_INVERSE)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offs = offs.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most limit bytes, or of one row."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and the offsets of each row's words."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    white = WHITE[buf]
    start = ~white
    end = start.copy()
    full = offs[:-1] < offs[1:]
    first, last = offs[:-1][full], offs[1:][full] - 1
    at_first, at_last = start[first], end[last]
    start[1:] &= white[:-1]
    end[:-1] &= white[1:]
    start[first], end[last] = at_first, at_last
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offs)


def _one_hash(word: np.ndarray) -> int:
    total, scale = 0, 1
    for a in range(0, len(word), _SPAN):
        part = _BYTES[word[a : a + _SPAN]]
        total += int((part * _POWER[: len(part)]).sum(dtype=U)) * scale
        scale = scale * int(_POWER[_SPAN]) % (1 << 64)
    return total % (1 << 64)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each word, scrambled."""
    out = np.empty(len(starts), U)
    k, n = 0, len(starts)
    while k < n:
        a = int(starts[k])
        j = int(np.searchsorted(ends, a + _SPAN, side="right"))
        if j <= k:
            out[k] = _one_hash(buf[a : int(ends[k])])
            k += 1
            continue
        b = int(ends[j - 1])
        sums = np.zeros(b - a + 1, U)
        np.cumsum(_BYTES[buf[a:b]] * _POWER[: b - a], out=sums[1:])
        s = starts[k:j] - a
        out[k:j] = (sums[ends[k:j] - a] - sums[s]) * _UNPOWER[s]
        k = j
    return mix(out + (ends - starts).astype(U))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Rabin-Karp hashes of every run of k words, by doubling; not scrambled."""
    base = 0xD1342543DE82EF95
    done, size, have, width = None, 0, words, 1
    while True:
        if k & width:
            if done is None:
                done, size = have, width
            else:
                n = len(words) - size - width + 1
                if n <= 0:
                    return np.zeros(0, U)
                done = done[:n] * U(pow(base, width, 1 << 64)) + have[size : size + n]
                size += width
        if size == k:
            return done[: max(0, len(words) - k + 1)]
        n = len(words) - 2 * width + 1
        if n <= 0:
            return np.zeros(0, U)
        have = have[:n] * U(pow(base, width, 1 << 64)) + have[width : width + n]
        width *= 2


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """The leftmost place of the least value in every window of that width."""
    n = len(x) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)

    def least(v: np.ndarray, at: np.ndarray, step: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        later = v[step : step + n] < v[:n]
        return np.where(later, v[step : step + n], v[:n]), np.where(later, at[step : step + n], at[:n])

    v, at, have = x, np.arange(len(x), dtype=np.int32), 1
    while have * 2 <= width:
        v, at = least(v, at, have, len(v) - have)
        have *= 2
    if have < width:
        v, at = least(v, at, width - have, n)
    return at[:n].astype(np.int64)


def runs(x: np.ndarray) -> np.ndarray:
    """Offsets of the runs of equal neighbours, and the end."""
    if not len(x):
        return np.zeros(1, np.int64)
    return np.r_[0, np.flatnonzero(x[1:] != x[:-1]) + 1, len(x)].astype(np.int64)


def strings(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.string())


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())
