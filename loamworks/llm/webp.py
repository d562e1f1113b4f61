"""Lossless WebP: a decoder for the whole bitstream, and an encoder (operator 1).

The decoder reads prefix codes (simple and normal, with several groups chosen
by an entropy image), back-references, the colour cache, and inverts the
predictor, cross-colour, subtract-green and palette transforms. It returns
ARGB pixels as a 2-D uint32 array. Where one prefix code carries all the
information of a picture (the other three channels are constant), every bit
offset is looked up at once with NumPy and only the chain from code to code is
followed one by one.

The operator stores bytes as the green samples of pictures 64 pixels wide. A
long text is a row of pictures in one file, each at most ``ROWS`` high, so that
memory is bounded.

Cases: a null or empty text has a payload of 64 zero bytes; equal texts give
equal files; texts of any length are stored whole; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_pass, table, text_of

WIDTH = 64
ROWS = 2048
#: Fixed values of the format: order of the code length codes.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
#: Fixed values of the format: pixels left and up for the first 120 distance codes.
NEAR = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2),
    (0, 3), (3, 0), (1, 3), (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0),
    (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4),
    (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2),
    (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3),
    (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1), (4, 6), (-4, 6), (6, 4), (-6, 4),
    (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5),
    (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7),
    (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = 0, 1, 2, 3
_CACHE_FACTOR = 0x1E35A7BD
_BLACK = 0xFF000000


# --- bits -----------------------------------------------------------------


class Bits:
    """Reads little-endian bits."""

    def __init__(self, data: bytes):
        self.data = data
        self.at = 0

    def read(self, n: int) -> int:
        a = self.at
        self.at = a + n
        return (int.from_bytes(self.data[a >> 3 : (a + n + 7) >> 3], "little") >> (a & 7)) & ((1 << n) - 1)

    def peek(self, n: int) -> int:
        a = self.at
        return (int.from_bytes(self.data[a >> 3 : (a + n + 7) >> 3], "little") >> (a & 7)) & ((1 << n) - 1)


class Code:
    """A prefix code as a table over the next `width` bits."""

    __slots__ = ("length", "literal", "only", "symbol", "width")

    def __init__(self, lengths: np.ndarray):
        used = np.flatnonzero(lengths)
        self.only = None
        if len(used) == 1:
            self.only = int(used[0])
            self.width, self.length, self.symbol = 0, np.zeros(1, np.uint8), used.astype(np.uint16)
            self.literal = self.length
            return
        if not len(used):
            raise ValueError("a prefix code without symbols")
        size = lengths[used]
        self.width = width = int(size.max())
        order = np.argsort(size, kind="stable")
        used, size = used[order], size[order].astype(np.int64)
        if int((1 << (width - size)).sum()) != 1 << width:
            raise ValueError("a prefix code that is not complete")
        # In canonical order each symbol owns a run of the table over reversed bits.
        by_prefix = np.repeat(np.arange(len(used)), 1 << (width - size))
        place = reversed_bits(np.arange(1 << width), width)
        self.length = size[by_prefix][place].astype(np.uint8)
        self.symbol = used[by_prefix][place].astype(np.uint16)
        #: The length where the symbol is a literal, else 0.
        self.literal = np.where(self.symbol < 256, self.length, 0).astype(np.int32)

    def read(self, bits: Bits) -> int:
        if self.only is not None:
            return self.only
        w = bits.peek(self.width)
        bits.at += int(self.length[w])
        return int(self.symbol[w])


_REVERSED: dict[int, np.ndarray] = {}


def reversed_bits(x: np.ndarray, width: int) -> np.ndarray:
    if width not in _REVERSED:
        v, out = np.arange(1 << width), np.zeros(1 << width, np.int64)
        for _ in range(width):
            out = (out << 1) | (v & 1)
            v >>= 1
        _REVERSED[width] = out
    return _REVERSED[width][x]


# --- decoder --------------------------------------------------------------


@functools.cache
def _few(size: int, *symbols: int) -> Code:
    lengths = np.zeros(size, np.uint8)
    lengths[list(symbols)] = 1
    return Code(lengths)


def _read_code(bits: Bits, size: int) -> Code:
    if bits.read(1):
        two = bits.read(1)
        first = bits.read(8 if bits.read(1) else 1)
        return _few(size, first, bits.read(8)) if two else _few(size, first)
    lengths = np.zeros(size, np.uint8)
    own = np.zeros(19, np.uint8)
    for i in range(4 + bits.read(4)):
        own[LENGTH_ORDER[i]] = bits.read(3)
    code = Code(own)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else size
    width, length, symbol = code.width, code.length.tolist(), code.symbol.tolist()
    data, at, k, last, found = bits.data, bits.at, 0, 8, []
    mask = (1 << width) - 1
    while k < size and left:
        left -= 1
        # 8 bits of offset, 7 of the code and 7 of the repeat fit into four bytes.
        v = int.from_bytes(data[at >> 3 : (at >> 3) + 4], "little") >> (at & 7)
        w = v & mask
        s, n = symbol[w], length[w]
        v >>= n
        if s < 16:
            if s:
                last = s
            found.append(s)
            k += 1
        elif s == 16:
            r = 3 + (v & 3)
            n += 2
            found += [last] * r
            k += r
        elif s == 17:
            r = 3 + (v & 7)
            n += 3
            found += [0] * r
            k += r
        else:
            r = 11 + (v & 127)
            n += 7
            found += [0] * r
            k += r
        at += n
    bits.at = at
    if k > size:
        raise ValueError("more code lengths than symbols")
    lengths[:k] = found
    return Code(lengths)


def _value(bits: Bits, prefix: int) -> int:
    if prefix < 4:
        return prefix + 1
    extra = (prefix - 2) >> 1
    return ((2 + (prefix & 1)) << extra) + bits.read(extra) + 1


def _distance(code: int, width: int) -> int:
    if code > 120:
        return code - 120
    x, y = NEAR[code - 1]
    return max(1, x + y * width)


def _one_channel(bits: Bits, group: list[Code], width: int, total: int) -> np.ndarray:
    """Pixels of a picture whose red, blue and alpha are constant; no cache, one group."""
    green, base = group[0], (group[3].only << 24) | (group[1].only << 16) | group[2].only
    out = np.empty(total, np.uint32)
    if green.only is not None and green.only < 256:
        out[:] = base | (green.only << 8)
        return out
    first = bits.at >> 3
    raw = np.frombuffer(bits.data, np.uint8, offset=first)
    wide = np.zeros(len(raw) + 3, np.int64)
    wide[: len(raw)] = raw
    wide = wide[:-2] | (wide[1:-1] << 8) | (wide[2:] << 16)
    window = ((wide[:, None] >> np.arange(8)) & ((1 << green.width) - 1)).ravel()
    # From each bit offset to the next code's; a code that is no literal, and the end, lead to themselves.
    last = len(window) - 1
    jumps = [np.arange(last + 1) + green.literal.take(window)]
    np.minimum(jumps[0], last, out=jumps[0])
    for _ in range(4):
        jumps.append(jumps[-1].take(jumps[-1]))
    far, at, put = jumps[4], bits.at - 8 * first, 0
    while put < total:
        anchors, a, left = [], at, total - put
        while left > 0:
            anchors.append(a)
            b = int(far[a])
            if b == a:
                break
            a = b
            left -= 16
        chain = np.array(anchors)
        for jump in jumps[3::-1]:
            chain = np.stack([chain, jump.take(chain)], 1).ravel()
        chain = chain[: total - put]
        symbols = green.symbol[window[chain]]
        stop = np.flatnonzero(symbols >= 256)
        n = int(stop[0]) if len(stop) else len(chain)
        out[put : put + n] = base | (symbols[:n].astype(np.uint32) << 8)
        put += n
        if not len(stop):
            if put < total and (not n or int(chain[-1]) == last):
                raise ValueError("the picture ends early")
            at = int(jumps[0][chain[-1]])
            continue
        at, s = int(chain[n]), int(symbols[n])
        if s >= 280:
            raise ValueError("a colour cache that does not exist")
        bits.at = at + 8 * first + int(green.length[window[at]])
        length = _value(bits, s - 256)
        back = _distance(_value(bits, group[4].read(bits)), width)
        _copy(out, put, back, length)
        put += length
        at = bits.at - 8 * first
    bits.at = at + 8 * first
    return out


def _copy(out: np.ndarray, put: int, back: int, length: int) -> None:
    if back > put or put + length > len(out):
        raise ValueError("a back-reference leaves the picture")
    if back >= length:
        out[put : put + length] = out[put - back : put - back + length]
    else:
        out[put : put + length] = np.resize(out[put - back : put], length)


def _pixels(bits: Bits, width: int, height: int, main: bool) -> np.ndarray:
    """An entropy-coded picture, flat."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    groups, chosen, block = 1, None, 0
    if main and bits.read(1):
        block = bits.read(3) + 2
        across = -(-width >> block)
        chosen = (_pixels(bits, across, -(-height >> block), False) >> 8) & 0xFFFF
        groups = int(chosen.max()) + 1
    sizes = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    codes = [[_read_code(bits, n) for n in sizes] for _ in range(groups)]
    total = width * height
    if groups == 1 and not cache_bits and all(c.only is not None for c in codes[0][1:4]):
        return _one_channel(bits, codes[0], width, total)
    out = np.zeros(total, np.uint32)
    cache = [0] * (1 << cache_bits)
    shift = 32 - cache_bits
    put, cached = 0, 0

    def remember(upto: int) -> None:
        nonlocal cached
        if cache_bits:
            for v in out[cached:upto].tolist():
                cache[((v * _CACHE_FACTOR) & 0xFFFFFFFF) >> shift] = v
        cached = upto

    while put < total:
        g = codes[0]
        if chosen is not None:
            y, x = divmod(put, width)
            g = codes[int(chosen[(y >> block) * across + (x >> block)])]
        s = g[0].read(bits)
        if s < 256:
            r = g[1].read(bits)
            b = g[2].read(bits)
            a = g[3].read(bits)
            out[put] = (a << 24) | (r << 16) | (s << 8) | b
            put += 1
        elif s < 280:
            length = _value(bits, s - 256)
            back = _distance(_value(bits, g[4].read(bits)), width)
            _copy(out, put, back, length)
            put += length
        else:
            remember(put)
            out[put] = cache[s - 280]
            put += 1
        if bits.at > 8 * len(bits.data):
            raise ValueError("the picture ends early")
    return out


def _channels(pixels: np.ndarray) -> np.ndarray:
    """uint32 ARGB to int16 channels, last axis A R G B."""
    return np.stack([(pixels >> s) & 255 for s in (24, 16, 8, 0)], -1).astype(np.int16)


def _joined(c: np.ndarray) -> np.ndarray:
    c = (c & 255).astype(np.uint32)
    return (c[..., 0] << 24) | (c[..., 1] << 16) | (c[..., 2] << 8) | c[..., 3]


def _guess(mode: int, left, top, topleft, topright):  # noqa: ANN001, ANN202
    """A predictor over int16 channels, last axis A R G B; the arrays may hold one pixel or many."""
    if mode == 1:
        return left
    if mode == 2:
        return top
    if mode == 3:
        return topright
    if mode == 4:
        return topleft
    if mode == 5:
        return (((left + topright) >> 1) + top) >> 1
    if mode == 6:
        return (left + topleft) >> 1
    if mode == 7:
        return (left + top) >> 1
    if mode == 8:
        return (topleft + top) >> 1
    if mode == 9:
        return (top + topright) >> 1
    if mode == 10:
        return (((left + topleft) >> 1) + ((top + topright) >> 1)) >> 1
    if mode == 11:
        # Nearer to left + top - topleft, by the sum over the channels; a tie takes the top.
        to_left = np.abs(top - topleft).sum(-1, keepdims=True)
        to_top = np.abs(left - topleft).sum(-1, keepdims=True)
        return np.where(to_left < to_top, left, top)
    if mode == 12:
        return np.clip(left + top - topleft, 0, 255)
    if mode == 13:
        mean = (left + top) >> 1
        half = mean - topleft
        return np.clip(mean + np.where(half < 0, -((-half) >> 1), half >> 1), 0, 255)
    return np.broadcast_to(np.array([255, 0, 0, 0], np.int16), left.shape)


def _undo_predictor(pixels: np.ndarray, modes: np.ndarray, block: int) -> np.ndarray:
    height, width = pixels.shape
    c = _channels(pixels)
    for y in range(height):
        row = c[y]
        if y == 0:
            row[0] += (255, 0, 0, 0)
            row[:] = np.cumsum(row, 0, dtype=np.int64) & 255
            continue
        above = c[y - 1]
        row[0] = (row[0] + above[0]) & 255
        own = modes[y >> block]
        for start in range(0, width, 1 << block):
            mode = int(own[start >> block])
            a, b = max(start, 1), min(start + (1 << block), width)
            if a >= b:
                continue
            if mode in (0, 2, 4, 8, 14, 15) or mode in (3, 9) and b < width:
                after = above[a + 1 : b + 1] if mode in (3, 9) else above[a:b]
                row[a:b] = (row[a:b] + _guess(mode, above[a:b], above[a:b], above[a - 1 : b - 1], after)) & 255
            elif mode == 1:
                row[a:b] = (np.cumsum(row[a:b], 0, dtype=np.int64) + row[a - 1]) & 255
            else:
                for x in range(a, b):
                    after = above[x + 1] if x + 1 < width else row[0]
                    row[x] = (row[x] + _guess(mode, row[x - 1], above[x], above[x - 1], after)) & 255
    return _joined(c)


def _signed(x: np.ndarray) -> np.ndarray:
    return ((x & 255) ^ 128).astype(np.int32) - 128


def _cross(c: np.ndarray, elements: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pixel: green to red, green to blue, red to blue."""
    h, w = c.shape[:2]
    e = np.repeat(np.repeat(elements, 1 << block, 0)[:h], 1 << block, 1)[:, :w]
    return _signed(e), _signed(e >> 8), _signed(e >> 16)


def _undo_cross(pixels: np.ndarray, elements: np.ndarray, block: int) -> np.ndarray:
    c = _channels(pixels).astype(np.int32)
    green_red, green_blue, red_blue = _cross(c, elements, block)
    green = _signed(c[..., 2])
    c[..., 1] = (c[..., 1] + ((green_red * green) >> 5)) & 255
    c[..., 3] += ((green_blue * green) >> 5) + ((red_blue * _signed(c[..., 1])) >> 5)
    return _joined(c)


def _undo_palette(pixels: np.ndarray, colours: np.ndarray, width: int) -> np.ndarray:
    n = len(colours)
    per = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
    index = (pixels >> 8) & 255
    if per:
        bits = 8 >> per
        index = (index[:, :, None] >> (np.arange(1 << per, dtype=np.uint32) * bits)) & ((1 << bits) - 1)
        index = index.reshape(len(pixels), -1)[:, :width]
    full = np.zeros(256, np.uint32)
    full[:n] = colours
    return full[index]


def decode_picture(data: bytes) -> np.ndarray:
    """The ARGB pixels of a lossless bitstream (the content of a VP8L chunk)."""
    bits = Bits(data)
    if bits.read(8) != 0x2F:
        raise ValueError("not a lossless WebP bitstream")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("unknown version of the bitstream")
    undo, now = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            block = bits.read(3) + 2
            across, down = -(-now >> block), -(-height >> block)
            undo.append((kind, now, _pixels(bits, across, down, False).reshape(down, across), block))
        elif kind == SUBTRACT_GREEN:
            undo.append((kind, now, None, 0))
        else:
            n = bits.read(8) + 1
            steps = _channels(_pixels(bits, n, 1, False)).astype(np.int64)
            undo.append((kind, now, _joined(np.cumsum(steps, 0)), 0))
            now = -(-now >> (3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0))
    pixels = _pixels(bits, now, height, True).reshape(height, now)
    for kind, w, extra, block in reversed(undo):
        if kind == PREDICTOR:
            pixels = _undo_predictor(pixels, (extra >> 8) & 255, block)
        elif kind == CROSS_COLOUR:
            pixels = _undo_cross(pixels, extra, block)
        elif kind == SUBTRACT_GREEN:
            c = _channels(pixels)
            c[..., 1] += c[..., 2]
            c[..., 3] += c[..., 2]
            pixels = _joined(c)
        else:
            pixels = _undo_palette(pixels, extra, w)
    return pixels


def pictures(media: bytes) -> Iterator[np.ndarray]:
    """The pictures of a file, or of files in a row."""
    at = 0
    while at < len(media):
        if media[at : at + 4] != b"RIFF" or media[at + 8 : at + 12] != b"WEBP":
            raise ValueError("not a WebP file")
        end = at + 8 + struct.unpack("<I", media[at + 4 : at + 8])[0]
        at += 12
        while at < end:
            size = struct.unpack("<I", media[at + 4 : at + 8])[0]
            if media[at : at + 4] == b"VP8L":
                yield decode_picture(media[at + 8 : at + 8 + size])
            at += 8 + size + (size & 1)


# --- encoder --------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = 15) -> np.ndarray:
    """Huffman code lengths of at most limit bits."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    weight = counts[used].tolist()
    while True:
        n = len(weight)
        heap = [(w, i) for i, w in enumerate(weight)]
        heapq.heapify(heap)
        parent = [0] * (2 * n - 1)
        for new in range(n, 2 * n - 1):
            a = heapq.heappop(heap)
            b = heap[0]
            parent[a[1]] = parent[b[1]] = new
            heapq.heapreplace(heap, (a[0] + b[0], new))
        depth = [0] * (2 * n - 1)
        for i in range(2 * n - 3, -1, -1):
            depth[i] = depth[parent[i]] + 1
        if max(depth[:n]) <= limit:
            out[used] = depth[:n]
            return out
        weight = [(w + 1) // 2 for w in weight]


def codes_of(lengths: np.ndarray) -> np.ndarray:
    """The canonical codes, bits reversed for writing."""
    out = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    if len(used) < 2:
        return out
    order = used[np.argsort(lengths[used], kind="stable")]
    size = lengths[order].astype(np.int64)
    width = int(size[-1])
    start = np.cumsum(np.r_[0, 1 << (width - size[:-1])]) >> (width - size)
    out[order] = reversed_bits(start << (width - size), width)
    return out


class Writer:
    """Collects (value, bits) pairs and packs them at once."""

    def __init__(self) -> None:
        self.values: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self._v: list[int] = []
        self._n: list[int] = []

    def put(self, value: int, bits: int) -> None:
        self._v.append(value)
        self._n.append(bits)

    def flush(self) -> None:
        if self._v:
            self.values.append(np.array(self._v, np.uint32))
            self.sizes.append(np.array(self._n, np.uint8))
            self._v, self._n = [], []

    def many(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.flush()
        self.values.append(values)
        self.sizes.append(sizes)

    def bytes(self) -> bytes:
        self.flush()
        values, sizes = np.concatenate(self.values), np.concatenate(self.sizes)
        bits = np.unpackbits(values.astype("<u2").view(np.uint8), bitorder="little").reshape(-1, 16)
        return np.packbits(bits[_FILLED[sizes]], bitorder="little").tobytes()


#: For each number of bits, which of 16 are written.
_FILLED = np.arange(16) < np.arange(17)[:, None]


#: Lengths for the code that carries code lengths: 13 symbols of 4 bits and 6 of 5 bits are complete.
_META = np.full(19, 4, np.uint8)
_META[10:16] = 5
_META_CODE, _META_SIZE = codes_of(_META).tolist(), _META.tolist()


def _write_lengths(out: Writer, lengths: np.ndarray) -> None:
    used = np.flatnonzero(lengths)
    if len(used) <= 2 and (not len(used) or used[-1] < 256):
        first = int(used[0]) if len(used) else 0
        out.put(1, 1)
        out.put(int(len(used) == 2), 1)
        out.put(1, 1)
        out.put(first, 8)
        if len(used) == 2:
            out.put(int(used[1]), 8)
        return
    values, sizes = [0, 15], [1, 4]
    for n in LENGTH_ORDER:
        values.append(int(_META[n]))
        sizes.append(3)
    values.append(0)
    sizes.append(1)
    zero = 0
    for at in [*used.tolist(), len(lengths)]:
        while at > zero:
            run = min(at - zero, 138)
            if run < 3:
                values.append(_META_CODE[0])
                sizes.append(_META_SIZE[0])
                run = 1
            elif run < 11:
                values += (_META_CODE[17], run - 3)
                sizes += (_META_SIZE[17], 3)
            else:
                values += (_META_CODE[18], run - 11)
                sizes += (_META_SIZE[18], 7)
            zero += run
        if at < len(lengths):
            n = int(lengths[at])
            values.append(_META_CODE[n])
            sizes.append(_META_SIZE[n])
            zero = at + 1
    out.many(np.array(values, np.uint32), np.array(sizes, np.uint8))


def _prefix(value: int) -> tuple[int, int, int]:
    """Prefix code, extra value and extra bits of a length or a distance."""
    v = value - 1
    if v < 4:
        return v, 0, 0
    top = v.bit_length() - 1
    second = (v >> (top - 1)) & 1
    return 2 * top + second, v - ((2 + second) << (top - 1)), top - 1


def _edges(same: np.ndarray) -> np.ndarray:
    """Starts and ends of the runs of True, in turn."""
    wide = np.zeros(len(same) + 2, np.int8)
    wide[1:-1] = same
    return np.flatnonzero(wide[1:] != wide[:-1])


#: Pixels that a back-reference covers at least (a power of two), and the largest distance that has a code.
LEAST_MATCH, FARTHEST = 16, (1 << 20) - 120


def _repeats(flat: np.ndarray) -> np.ndarray:
    """(start, end, distance) of the runs of places whose next LEAST_MATCH pixels stood nearest before at one distance."""
    n = len(flat) - LEAST_MATCH + 1
    if n < 2:
        return np.zeros((0, 3), np.int64)
    # The key of twice as many pixels is made of two keys.
    key, size, factor = flat.astype(np.uint64), 1, 0x9E3779B97F4A7C15
    while size < LEAST_MATCH:
        key = key[:-size] * np.uint64(factor) + key[size:]
        size, factor = 2 * size, factor * factor & 0xFFFFFFFFFFFFFFFF
    # Keys with their places in the low bits: sorted numbers are several times as fast as a sorted order of them.
    low = np.uint64((1 << n.bit_length()) - 1)
    key = np.sort((key & ~low) | np.arange(n, dtype=np.uint64))
    order = (key & low).astype(np.int64)
    again = np.flatnonzero((key[1:] ^ key[:-1]) <= low)
    back = np.zeros(n + 2, np.int64)
    back[order[again + 1] + 1] = order[again + 1] - order[again]
    edge = np.flatnonzero(back[1:] != back[:-1])
    runs = np.stack([edge[:-1], edge[1:], back[edge[:-1] + 1]], 1)
    return runs[(runs[:, 2] > 0) & (runs[:, 2] <= FARTHEST)]


def _matches(flat: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Disjoint (place, length, distance code) of pixels that stood before, at the nearest distance."""
    out, end = [], 0
    for a, b, back in _repeats(flat).tolist():
        code = 1 if back == width else 2 if back == 1 else back + 120
        # Keys may collide.
        b += LEAST_MATCH - 1
        unlike = np.flatnonzero(flat[a:b] != flat[a - back : b - back])
        b = a + int(unlike[0]) if len(unlike) else b
        a = max(a, end)
        while b - a >= LEAST_MATCH:
            n = min(b - a, 4096)
            out.append((a, n, code))
            a += n
            end = a
    return out


def _write_pixels(out: Writer, pixels: np.ndarray, width: int, main: bool, cache_bits: int = 0) -> None:
    """An entropy-coded picture with one group of prefix codes."""
    flat = pixels.ravel()
    varies = int(np.bitwise_or.reduce(flat ^ flat[0]))
    channels = [((flat >> s) & 255).astype(np.int64) if varies >> s & 255 or s == 8 else int(flat[0]) >> s & 255 for s in (8, 16, 0, 24)]
    matches = _matches(flat, width)
    plain = np.ones(len(flat), bool)
    for a, n, _ in matches:
        plain[a : a + n] = False
    green = channels[0]
    if cache_bits:
        slot = (flat.astype(np.uint64) * np.uint64(_CACHE_FACTOR) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - cache_bits)
        held: dict[int, int] = {}
        green = green.copy()
        for i, (s, v) in enumerate(zip(slot.tolist(), flat.tolist(), strict=True)):
            if plain[i] and held.get(s) == v:
                green[i] = 280 + s
            held[s] = v
    cached = green >= 280
    tokens = [(a, *_prefix(n), *_prefix(code), n) for a, n, code in matches]
    counts = [np.bincount(green[plain], minlength=280 + (1 << cache_bits if cache_bits else 0))]
    for t in tokens:
        counts[0][256 + t[1]] += 1
    for c in channels[1:]:
        counts.append(np.bincount([c] if isinstance(c, int) else c[plain & ~cached], minlength=256))
    counts.append(np.bincount([t[4] for t in tokens] or [0], minlength=40))
    lengths = [code_lengths(c) for c in counts]
    codes = [codes_of(n) for n in lengths]
    bare = [np.count_nonzero(n) < 2 for n in lengths]
    out.put(int(cache_bits > 0), 1)
    if cache_bits:
        out.put(cache_bits, 4)
    if main:
        out.put(0, 1)
    for n in lengths:
        _write_lengths(out, n)
    bits = [np.zeros_like(n) if b else n for n, b in zip(lengths, bare, strict=True)]
    a = 0
    for b, prefix, extra, extra_bits, far, far_extra, far_bits, n in [*tokens, (len(flat), *[0] * 7)]:
        if b > a:
            if all(bare[1:4]):
                out.many(codes[0][green[a:b]], bits[0][green[a:b]])
            else:
                own = [np.full(b - a, c) if isinstance(c, int) else c[a:b] for c in channels]
                own[0] = green[a:b]
                values = np.stack([codes[k][own[k]] for k in range(4)], 1)
                sizes = np.stack([bits[k][own[k]] for k in range(4)], 1)
                sizes[cached[a:b], 1:] = 0
                out.many(values.ravel(), sizes.ravel())
        if n:
            out.put(int(codes[0][256 + prefix]), int(bits[0][256 + prefix]))
            out.put(extra, extra_bits)
            out.put(int(codes[4][far]), int(bits[4][far]))
            # No value of more than 16 bits is written at once.
            out.put(far_extra & 0xFFFF, min(far_bits, 16))
            out.put(far_extra >> 16, max(far_bits - 16, 0))
            a = b + n


def _apply_predictor(pixels: np.ndarray, modes: np.ndarray, block: int) -> np.ndarray:
    height, width = pixels.shape
    c = _channels(pixels)
    guess = np.zeros_like(c)
    guess[0, 1:] = c[0, :-1]
    guess[1:, 0] = c[:-1, 0]
    guess[0, 0] = (255, 0, 0, 0)
    if height > 1 and width > 1:
        left, top, topleft = c[1:, :-1], c[:-1, 1:], c[:-1, :-1]
        topright = np.concatenate([c[:-1, 2:], c[1:, :1]], 1)
        each = np.repeat(np.repeat(modes, 1 << block, 0)[:height], 1 << block, 1)[1:, 1:width]
        for mode in np.unique(each):
            g = _guess(int(mode), left, top, topleft, topright)
            guess[1:, 1:][each == mode] = g[each == mode]
    return _joined(c - guess)


def _apply_cross(pixels: np.ndarray, elements: np.ndarray, block: int) -> np.ndarray:
    c = _channels(pixels).astype(np.int32)
    green_red, green_blue, red_blue = _cross(c, elements, block)
    green, red = _signed(c[..., 2]), _signed(c[..., 1])
    c[..., 1] -= (green_red * green) >> 5
    c[..., 3] -= ((green_blue * green) >> 5) + ((red_blue * red) >> 5)
    return _joined(c)


def encode_picture(pixels: np.ndarray, steps: tuple = (), cache_bits: int = 0) -> bytes:
    """A lossless bitstream.

    steps: transforms in the order in which they are applied: (PREDICTOR, modes, block),
    (CROSS_COLOUR, elements, block), (SUBTRACT_GREEN,), (PALETTE,).
    """
    height, width = pixels.shape
    out, now = Writer(), width
    out.put(0x2F, 8)
    out.put(width - 1, 14)
    out.put(height - 1, 14)
    out.put(1, 1)
    out.put(0, 3)
    for kind, *more in steps:
        out.put(1, 1)
        out.put(kind, 2)
        if kind == PREDICTOR:
            modes, block = more
            out.put(block - 2, 3)
            _write_pixels(out, (modes.astype(np.uint32) << 8) | np.uint32(_BLACK), modes.shape[1], False)
            pixels = _apply_predictor(pixels, modes, block)
        elif kind == CROSS_COLOUR:
            elements, block = more
            out.put(block - 2, 3)
            _write_pixels(out, elements.astype(np.uint32), elements.shape[1], False)
            pixels = _apply_cross(pixels, elements, block)
        elif kind == SUBTRACT_GREEN:
            c = _channels(pixels)
            c[..., 1] -= c[..., 2]
            c[..., 3] -= c[..., 2]
            pixels = _joined(c)
        else:
            colours, index = np.unique(pixels, return_inverse=True)
            n = len(colours)
            out.put(n - 1, 8)
            c = _channels(colours)
            _write_pixels(out, _joined(np.diff(c, axis=0, prepend=np.zeros((1, 4), np.int16))), n, False)
            index = index.reshape(height, now).astype(np.uint32)
            per = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            if per:
                now = -(-now >> per)
                index = np.pad(index, ((0, 0), (0, (now << per) - index.shape[1]))).reshape(height, now, 1 << per)
                index = (index << (np.arange(1 << per, dtype=np.uint32) * (8 >> per))).sum(-1, dtype=np.uint32)
            pixels = (index << 8) | np.uint32(_BLACK)
    out.put(0, 1)
    _write_pixels(out, pixels, now, True, cache_bits)
    return out.bytes()


def as_file(picture: bytes) -> bytes:
    body = b"WEBPVP8L" + struct.pack("<I", len(picture)) + picture + b"\0" * (len(picture) & 1)
    return b"RIFF" + struct.pack("<I", len(body)) + body


# --- operator -------------------------------------------------------------


def _bits(values: np.ndarray) -> float:
    """The bits of the values by the entropy of their counts."""
    c = np.bincount(values, minlength=1)
    c = c[c > 0]
    return float((c * (np.log2(len(values)) - np.log2(c))).sum())


#: Predictors that are tried for a block of 16 by 16 samples: none, left, above, their mean.
_TRIED, _BLOCK = (0, 1, 2, 7), 4


def predictor_modes(samples: np.ndarray) -> tuple[np.ndarray, float]:
    """The mode of each block that leaves the least residuals, and the bits of all residuals with those of the modes."""
    x = samples.astype(np.int16)
    height, width = x.shape
    left, above = np.zeros_like(x), np.zeros_like(x)
    left[:, 1:], above[1:] = x[:, :-1], x[:-1]
    rest = np.stack([(x - g) & 255 for g in (np.zeros_like(x), left, above, (left + above) >> 1)])
    rest[:, 0, 1:], rest[:, 1:, 0] = rest[1, 0, 1:], rest[2, 1:, 0]  # fixed by the format
    size = np.minimum(rest, 256 - rest)
    down, across = -(-height >> _BLOCK), -(-width >> _BLOCK)
    whole = np.pad(size, ((0, 0), (0, (down << _BLOCK) - height), (0, (across << _BLOCK) - width)))
    cost = whole.reshape(len(_TRIED), down, 1 << _BLOCK, across, 1 << _BLOCK).sum((2, 4), dtype=np.int64)
    best = cost.argmin(0)
    each = np.repeat(np.repeat(best, 1 << _BLOCK, 0)[:height], 1 << _BLOCK, 1)[:, :width]
    own = np.take_along_axis(rest, each[None], 0)[0]
    return np.array(_TRIED)[best], _bits(own.ravel()) + 2 * best.size + 128


def chosen_steps(samples: np.ndarray) -> tuple:
    """The transforms that the estimate finds smallest: palette, predictor, or none.

    Only green varies, so the transforms between channels and the colour cache can't gain: a literal is its green code alone.
    """
    flat = samples.ravel()
    if np.count_nonzero(np.bincount(flat, minlength=256)) <= 16:
        return ((PALETTE,),)
    plain = _bits(flat)
    # Blocks can hardly gain where neither neighbour is near a gain for the whole picture.
    if min(_bits(flat[back:] - flat[:-back]) if len(flat) > back else plain for back in (1, WIDTH)) > 1.1 * plain:
        return ()
    modes, bits = predictor_modes(samples)
    return ((PREDICTOR, modes, _BLOCK),) if bits < plain else ()


def store(payload: bytes) -> bytes:
    """A payload, a multiple of 64 bytes, as lossless WebP: bytes are green samples."""
    out = []
    for a in range(0, len(payload), WIDTH * ROWS):
        part = np.frombuffer(payload, np.uint8, min(WIDTH * ROWS, len(payload) - a), a).reshape(-1, WIDTH)
        pixels = (part.astype(np.uint32) << 8) | np.uint32(_BLACK)
        out.append(as_file(encode_picture(pixels, chosen_steps(part))))
    return b"".join(out)


def load(media: bytes) -> bytes:
    return b"".join(((p >> 8) & 255).astype(np.uint8).tobytes() for p in pictures(media))


def padded(text: bytes) -> bytes:
    return text + b"\0" * (-len(text) % 64 or 64 * (not text))


def feature(samples: bytes) -> str:
    """Rows, mean, deviation, distinct values and an 8 by 8 map of what lies above the mean."""
    x = np.frombuffer(samples, np.uint8)
    counts = np.bincount(x, minlength=256)
    level = np.arange(256)
    mean = float((counts * level).sum() / len(x))
    spread = float(np.sqrt(max(0.0, (counts * level**2).sum() / len(x) - mean * mean)))
    edge = np.linspace(0, len(x), 65).astype(np.int64)
    cell = np.add.reduceat(x, edge[:-1], dtype=np.int64) / np.diff(edge)
    above = np.packbits(cell > mean).tobytes().hex()
    return f"{len(x) // WIDTH}:{mean:.4f}:{spread:.4f}:{np.count_nonzero(counts)}:{above}"


FIELDS = (
    "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long,"
    " media_bytes long, media_sha256 string, feature string"
)


def _row(text: bytes) -> tuple:
    media = store(padded(text))
    back = load(media)
    return (
        len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]),
        len(media), hashlib.sha256(media).hexdigest(), feature(back), media,
    )


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """The stored form of every text, read back: doc_id, the digests, and (keep) the media bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_row(t.encode("utf-8", "surrogatepass")) for t in batch.column(1).to_pylist()]
            cols = [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 8
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
            names = ["doc_id", *(x.split()[0] for x in FIELDS.split(",")), "media"]
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))]
            n = len(arrays) - (not keep)
            yield pa.RecordBatch.from_arrays(arrays[:n], names[:n])

    narrow = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = dict(narrow.dtypes)["doc_id"]
    return arrow_pass(narrow, run, f"doc_id {kind}, {FIELDS}" + ", media binary" * keep)


def op1_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_column(table(spark, sf_dir, "documents"), keep=False)
