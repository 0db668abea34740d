"""Lossless WebP (VP8L): an encoder and a decoder for still pictures as pixel arrays, and the media query.

The decoder reads every feature of the format: simple and normal prefix codes, groups of prefix codes chosen
by an entropy image, back-references with the near-distance map, the colour cache, and the four transforms
(predictor, cross-colour, subtract-green, palette with bundled pixels), inverted in reverse order. A picture
whose only varying symbols are green ones and distances is decoded by a table over all bit offsets.

The media query stores a text's bytes as grey samples, 64 a row, one sample a pixel: with back-references for what
repeats where they pay, with a palette of bundled pixels where there are at most 16 values, else with
subtract-green. Predictors, cross-colour and the colour cache never pay for texts; ``encode`` writes them as asked.

Defined results: a null text counts as empty (64 zero bytes); texts above 1 MiB are stored as consecutive
files of at most 16384 rows; repeated rows give equal values; an empty table gives no rows; extra columns are
ignored. Damaged files raise ValueError.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame

from .base import map_text

PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
#: Fixed by the format: the order in which lengths of the code-length code are stored.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
#: Near distances by rule: offsets to the left and above, nearest first, then by column, right ones first.
NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), -p[0]))
ALPHABETS = (256 + 24, 256, 256, 256, 40)
CACHE_FACTOR = 0x1E35A7BD
MOST_BITS = 11


# --- prefix codes ---------------------------------------------------------------------------------------------


def code_lengths(counts: list[int], most: int = MOST_BITS) -> list[int]:
    """Lengths of a prefix code; a lone symbol gets length 1. Counts are flattened until ``most`` bits suffice."""
    used = [s for s, c in enumerate(counts) if c]
    lengths = [0] * len(counts)
    if len(used) < 2:
        for s in used:
            lengths[s] = 1
        return lengths
    floor = 1
    while True:
        heap = [(max(counts[s], floor), n) for n, s in enumerate(used)]
        heapq.heapify(heap)
        parent = [0] * (2 * len(used) - 1)
        for node in range(len(used), 2 * len(used) - 1):
            a = heapq.heappop(heap)
            b = heap[0]
            parent[a[1]] = parent[b[1]] = node
            heapq.heapreplace(heap, (a[0] + b[0], node))
        depth = [0] * len(parent)
        for node in range(len(parent) - 2, -1, -1):
            depth[node] = depth[parent[node]] + 1
        if max(depth) <= most:
            break
        floor = max(floor * 2, max(counts) >> most)
    for s, d in zip(used, depth, strict=False):
        lengths[s] = d
    return lengths


#: Numbers with their bits reversed, by the number of bits.
REVERSED = [[int(f"{v:0{n}b}"[::-1], 2) if n else 0 for v in range(1 << n)] for n in range(MOST_BITS + 1)]


def canonical(lengths: list[int]) -> dict[int, tuple[int, int]]:
    """Symbol to (bits as stored, first bit lowest, length)."""
    code, out, last = 0, {}, 0
    for length, symbol in sorted((n, s) for s, n in enumerate(lengths) if n):
        code <<= length - last
        last = length
        out[symbol] = (REVERSED[length][code] if length <= MOST_BITS else int(f"{code:0{length}b}"[::-1], 2), length)
        code += 1
    return out


class Reader:
    def __init__(self, data: bytes):
        self.value, self.at, self.end = int.from_bytes(data, "little"), 0, 8 * len(data)
        self.data = data

    def bits(self, n: int) -> int:
        # a slice of bytes instead of a shift of the whole number
        a = self.at >> 3
        found = int.from_bytes(self.data[a : a + 8], "little") >> (self.at & 7) & ((1 << n) - 1)
        self.at += n
        if self.at > self.end:
            raise ValueError("the picture ends early")
        return found


class Code:
    """A prefix code as a table over its longest length, or a single symbol that takes no bits."""

    def __init__(self, lengths: list[int] | None = None, single: int | None = None):
        if lengths is None:
            self.single, self.symbols = single, [single]
            return
        used = [s for s, n in enumerate(lengths) if n]
        self.single = used[0] if len(used) == 1 else None
        self.symbols = used
        if not used:
            self.single = 0
        if self.single is not None:
            return
        if sum(1 << (15 - n) for n in lengths if n) != 1 << 15:
            raise ValueError("a prefix code is not complete")
        self.most = max(lengths)
        self.table = np.zeros(1 << self.most, np.int32)
        for symbol, (bits, n) in canonical(lengths).items():
            self.table[bits :: 1 << n] = symbol | n << 16
        self.rows: list[int] | None = None

    def read(self, r: Reader) -> int:
        if self.single is not None:
            return self.single
        if self.rows is None:
            self.rows = self.table.tolist()
        a = r.at >> 3
        found = self.rows[int.from_bytes(r.data[a : a + 3], "little") >> (r.at & 7) & ((1 << self.most) - 1)]
        r.at += found >> 16
        if r.at > r.end:
            raise ValueError("the picture ends early")
        return found & 0xFFFF


def read_code(r: Reader, size: int) -> Code:
    if r.bits(1):
        two = r.bits(1)
        first = r.bits(8 if r.bits(1) else 1)
        second = r.bits(8) if two else first
        if first == second:
            return Code(single=first)
        if max(first, second) >= size:
            raise ValueError("a code has a symbol that does not exist")
        lengths = [0] * size
        lengths[first] = lengths[second] = 1
        return Code(lengths)
    lengths = [0] * size
    own = [0] * 19
    for i in range(4 + r.bits(4)):
        own[LENGTH_ORDER[i]] = r.bits(3)
    code = Code(own)
    left = 2 + r.bits(2 + 2 * r.bits(3)) if r.bits(1) else size
    at, last = 0, 8
    while at < size and left:
        left -= 1
        s = code.read(r)
        if s < 16:
            lengths[at] = s
            at += 1
            last = s or last
            continue
        times, value = (3 + r.bits(2), last) if s == 16 else (3 + r.bits(3), 0) if s == 17 else (11 + r.bits(7), 0)
        if at + times > size:
            raise ValueError("code lengths run over")
        lengths[at : at + times] = [value] * times
        at += times
    return Code(lengths)


# --- decoder --------------------------------------------------------------------------------------------------


def _extra(r: Reader, symbol: int) -> int:
    if symbol < 4:
        return symbol + 1
    n = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << n) + r.bits(n) + 1


def _bits_at(raw: np.ndarray, at: np.ndarray, n) -> np.ndarray:
    """``n`` bits (one number or one each) from each of the bit offsets ``at``."""
    first = np.minimum(at >> 3, len(raw) - 5)
    word = sum(raw[first + k].astype(np.int64) << (8 * k) for k in range(5))
    return word >> (at & 7) & ((1 << np.asarray(n, np.int64)) - 1)


def _extras(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of extra bits of length or distance symbols, and the values that these are added to."""
    n = np.where(symbols < 4, 0, (symbols - 2) >> 1)
    return n, np.where(symbols < 4, symbols + 1, ((2 + (symbols & 1)) << n) + 1)


def _walk(step: np.ndarray, at: int, most: int) -> np.ndarray:
    """The offsets at which tokens start, from ``at`` on, until the end of ``step`` or ``most`` of them."""
    # leaps of 16 tokens by doubling; the walk takes the leaps, then all of them are filled in side by side
    limit = len(step) - 1
    one = np.minimum(np.arange(len(step), dtype=np.int32) + step, limit)
    leap = one
    for _ in range(4):
        leap = leap[leap]
    starts, item = [], leap.item
    for _ in range(-(-most // 16)):
        starts.append(at)
        at = item(at)
        if at >= limit:
            break
    places = np.empty((len(starts), 16), np.int32)
    column = np.array(starts, np.int32)
    for k in range(16):
        places[:, k] = column
        column = one[column]
    return places.ravel()[:most]


def _green_tokens(r: Reader, code: Code, far: Code, width: int, n: int) -> np.ndarray:
    """``n`` green values where other channels take no bits: what stands at every bit offset by table, then a walk along
    the offsets, then the back-references in order."""
    first = r.at >> 3
    # no token is longer than two codes and two times 18 extra bits
    raw = np.frombuffer(r.data[first : first + (n * (code.most + (66 if max(code.symbols) > 255 else 0)) + 7 >> 3) + 4] + bytes(8), np.uint8).astype(np.int32)
    three = raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16
    windows = ((three[:, None] >> np.arange(8, dtype=np.int32)) & ((1 << code.most) - 1)).ravel()
    step = (code.table >> 16).astype(np.uint8)[windows]
    copies = np.flatnonzero(((code.table & 0xFFFF) > 255)[windows]) if max(code.symbols) > 255 else np.empty(0, np.int64)
    length, distance = {}, {}
    if len(copies):
        step = step.astype(np.int32)
        more, base = _extras((code.table[windows[copies]] & 0xFFFF) - 256)
        at = copies + step[copies]
        long = base + _bits_at(raw, at, more)
        at = at + more
        if far.single is not None:
            symbols, own = np.full(len(at), far.single), 0
        else:
            entry = far.table[_bits_at(raw, at, far.most)]
            symbols, own = entry & 0xFFFF, entry >> 16
        more, base = _extras(symbols)
        back = base + _bits_at(raw, at + own, more)
        step[copies] = np.minimum(at + own + more - copies, 1 << 20)
        length, distance = long, np.where(back > 120, back - 120, _near(width)[np.minimum(back, 120)])
    places = _walk(step, r.at & 7, n)
    values = code.table[windows[places]] & 0xFFFF
    if not len(copies):
        if len(places) < n or places[-1] >= len(step) - 1:
            raise ValueError("the picture ends early")
        r.at = 8 * first + int(places[-1]) + int(step[places[-1]])
        if r.at > r.end:
            raise ValueError("the picture ends early")
        return values.astype(np.uint8)
    sizes = np.ones(len(places), np.int64)
    referring = np.flatnonzero(values > 255)
    which = np.searchsorted(copies, places[referring])
    if len(referring):
        sizes[referring] = length[which]
    ends = np.cumsum(sizes)
    last = int(np.searchsorted(ends, n))
    if last >= len(ends) or ends[last] != n:
        raise ValueError("the picture ends early" if last >= len(ends) else "a back-reference leaves the picture")
    r.at = 8 * first + int(places[last]) + int(step[places[last]])
    if r.at > r.end:
        raise ValueError("the picture ends early")
    out = np.zeros(n, np.uint8)
    plain = np.flatnonzero(values[: last + 1] < 256)
    out[ends[plain] - 1] = values[plain]
    for k, w in zip(referring.tolist(), which.tolist(), strict=True):
        if k > last:
            break
        end, size, back = int(ends[k]), int(length[w]), int(distance[w])
        start = end - size
        if back > start:
            raise ValueError("a back-reference leaves the picture")
        out[start:end] = out[start - back : end - back] if back >= size else np.resize(out[start - back : start], size)
    return out


_NEAR_BY_WIDTH: dict[int, np.ndarray] = {}


def _near(width: int) -> np.ndarray:
    """Distances by their near codes from 1 to 120."""
    if width not in _NEAR_BY_WIDTH:
        _NEAR_BY_WIDTH[width] = np.array([0, *(max(1, x + y * width) for x, y in NEAR)], np.int64)
    return _NEAR_BY_WIDTH[width]


def _image(r: Reader, width: int, height: int, top: bool) -> np.ndarray:
    """Entropy-coded ARGB pixels, flat uint32."""
    cache_bits = 0
    if r.bits(1):
        cache_bits = r.bits(4)
        if not 1 <= cache_bits <= 11:
            raise ValueError("a colour cache of this size does not exist")
    groups_of, tile_bits, tiles = None, 0, 0
    number = 1
    if top and r.bits(1):
        tile_bits = r.bits(3) + 2
        tiles = -(-width >> tile_bits)
        tiles = (width + (1 << tile_bits) - 1) >> tile_bits
        rows = (height + (1 << tile_bits) - 1) >> tile_bits
        groups_of = (_image(r, tiles, rows, False) >> 8 & 0xFFFF).tolist()
        number = max(groups_of) + 1
    sizes = (ALPHABETS[0] + (1 << cache_bits if cache_bits else 0), *ALPHABETS[1:])
    groups = [[read_code(r, n) for n in sizes] for _ in range(number)]
    total = width * height
    if number == 1:
        green, red, blue, alpha, far = groups[0]
        rest = red.single is not None and blue.single is not None and alpha.single is not None
        if rest and not cache_bits and (green.single is None or green.single < 256):
            base = alpha.single << 24 | red.single << 16 | blue.single
            if green.single is not None:
                return np.full(total, base | green.single << 8, np.uint32)
            return base | _green_tokens(r, green, far, width, total).astype(np.uint32) << 8
    out = [0] * total
    cache = [0] * (1 << cache_bits)
    shift = 32 - cache_bits
    at = 0
    while at < total:
        group = groups[0] if groups_of is None else groups[groups_of[(at // width >> tile_bits) * tiles + (at % width >> tile_bits)]]
        s = group[0].read(r)
        if s < 256:
            red, blue, alpha = group[1].read(r), group[2].read(r), group[3].read(r)
            pixels = [alpha << 24 | red << 16 | s << 8 | blue]
        elif s < 280:
            length = _extra(r, s - 256)
            distance = _extra(r, group[4].read(r))
            if distance <= 120:
                x, y = NEAR[distance - 1]
                distance = max(1, x + y * width)
            else:
                distance -= 120
            if distance > at or at + length > total:
                raise ValueError("a back-reference leaves the picture")
            part = out[at - distance : at - distance + min(length, distance)]
            pixels = (part * (-(-length // len(part))))[:length]
        else:
            pixels = [cache[s - 280]]
        out[at : at + len(pixels)] = pixels
        at += len(pixels)
        if cache_bits:
            for p in pixels:
                cache[(CACHE_FACTOR * p & 0xFFFFFFFF) >> shift] = p
    return np.array(out, np.uint32)


def _channels(argb: np.ndarray) -> np.ndarray:
    """Flat uint32 to (n, 4) int32 in the order alpha, red, green, blue."""
    return np.stack([argb >> s & 0xFF for s in (24, 16, 8, 0)], -1).astype(np.int32)


def _joined(channels: np.ndarray) -> np.ndarray:
    c = (channels & 0xFF).astype(np.uint32)
    return c[..., 0] << 24 | c[..., 1] << 16 | c[..., 2] << 8 | c[..., 3]


def predict(mode: int, left, top, right, corner):
    """The predicted pixel; arguments are the left, upper, upper right and upper left ones (arrays of channels)."""
    half = lambda a, b: (a + b) >> 1
    if mode == 0:
        return np.broadcast_to(np.array([255, 0, 0, 0], np.int32), np.shape(left))
    if mode in (1, 2, 3, 4):
        return (left, top, right, corner)[mode - 1]
    if mode == 5:
        return half(half(left, right), top)
    if mode in (6, 7, 8, 9):
        return half(*((left, corner), (left, top), (corner, top), (top, right))[mode - 6])
    if mode == 10:
        return half(half(left, corner), half(top, right))
    if mode == 11:
        to_left = np.abs(top - corner).sum(-1, keepdims=True)
        to_top = np.abs(left - corner).sum(-1, keepdims=True)
        return np.where(to_left < to_top, left, top)
    if mode == 12:
        return np.clip(left + top - corner, 0, 255)
    if mode == 13:
        mean = half(left, top)
        return np.clip(mean + np.fix((mean - corner) / 2).astype(np.int32), 0, 255)
    return predict(0, left, top, right, corner)


def _modes(modes: np.ndarray, width: int, height: int, bits: int) -> np.ndarray:
    tiles = (width + (1 << bits) - 1) >> bits
    return (modes >> 8 & 0xF).astype(np.int64).reshape(-1, tiles)[np.arange(height)[:, None] >> bits, np.arange(width)[None, :] >> bits]


def _unpredict(argb: np.ndarray, width: int, height: int, modes: np.ndarray, bits: int) -> np.ndarray:
    rest = _channels(argb).reshape(height, width, 4)
    mode = _modes(modes, width, height, bits)
    out = np.zeros((height, width, 4), np.int32)
    out[0] = np.cumsum(rest[0], 0)
    out[0, :, 0] += 255
    out[0] &= 0xFF
    for y in range(1, height):
        up = out[y - 1]
        out[y, 0] = (rest[y, 0] + up[0]) & 0xFF
        row = mode[y]
        if (row[1:] == 1).all():
            out[y, 1:] = (np.cumsum(rest[y, 1:], 0) + out[y, 0]) & 0xFF
        elif np.isin(row[1:], (0, 2, 4, 8)).all():  # nothing to the left is needed
            for m in np.unique(row[1:]):
                at = np.flatnonzero(row[1:] == m) + 1
                out[y, at] = (rest[y, at] + predict(m, up[at], up[at], up[at], up[at - 1])) & 0xFF
        else:
            for x in range(1, width):
                right = up[x + 1] if x + 1 < width else out[y, 0]
                out[y, x] = (rest[y, x] + predict(int(row[x]), out[y, x - 1], up[x], right, up[x - 1])) & 0xFF
    return _joined(out.reshape(-1, 4))


def _predicted(argb: np.ndarray, width: int, height: int, modes: np.ndarray, bits: int) -> np.ndarray:
    """What is left of the pixels after prediction (the encoder's side)."""
    p = _channels(argb).reshape(height, width, 4)
    mode = _modes(modes, width, height, bits)
    guess = np.zeros_like(p)
    left = np.roll(p, 1, 1)
    up = np.roll(p, 1, 0)
    right = np.roll(up, -1, 1)
    right[1:, -1] = p[1:, 0]
    corner = np.roll(up, 1, 1)
    for m in np.unique(mode):
        at = mode == m
        guess[at] = predict(int(m), left[at], up[at], right[at], corner[at])
    guess[:, 0] = up[:, 0]
    guess[0] = left[0]
    guess[0, 0] = [255, 0, 0, 0]
    return _joined((p - guess).reshape(-1, 4))


def _signed(x: np.ndarray) -> np.ndarray:
    return (x & 0xFF ^ 0x80) - 0x80


def _cross(argb: np.ndarray, width: int, height: int, elements: np.ndarray, bits: int, sign: int) -> np.ndarray:
    """Cross-colour transform: ``sign`` 1 inverts it, -1 applies it."""
    tiles = (width + (1 << bits) - 1) >> bits
    place = ((np.arange(height)[:, None] >> bits) * tiles + (np.arange(width)[None, :] >> bits)).ravel()
    e = _channels(elements)[place]
    to_red, green_to_blue, red_to_blue = _signed(e[:, 3]), _signed(e[:, 2]), _signed(e[:, 1])
    c = _channels(argb)
    old_red = c[:, 1].copy()
    green = _signed(c[:, 2])
    c[:, 1] = (c[:, 1] + sign * (to_red * green >> 5)) & 0xFF
    known_red = c[:, 1] if sign > 0 else old_red
    c[:, 3] = (c[:, 3] + sign * ((green_to_blue * green >> 5) + (red_to_blue * _signed(known_red) >> 5))) & 0xFF
    return _joined(c)


def _green(argb: np.ndarray, sign: int) -> np.ndarray:
    green = argb >> 8 & 0xFF
    step = green if sign > 0 else 256 - green
    return argb & 0xFF00FF00 | ((argb >> 16) + step & 0xFF) << 16 | (argb + step & 0xFF)


def _bundle_bits(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def _unbundle(argb: np.ndarray, width: int, height: int, table: np.ndarray) -> np.ndarray:
    bits = _bundle_bits(len(table))
    packed = (argb >> 8 & 0xFF).reshape(height, -1)
    each = 8 >> bits
    index = packed[:, np.arange(width) >> bits] >> ((np.arange(width) & ((1 << bits) - 1)) * each).astype(np.uint32) & ((1 << each) - 1)
    full = np.zeros(256, np.uint32)
    full[: len(table)] = table
    return full[index.ravel()]


def decode(data: bytes) -> np.ndarray:
    """Pixels (height, width, 4) uint8 in the order red, green, blue, alpha of one file."""
    if len(data) < 21 or data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ValueError("not a WebP file")
    at = 12
    while data[at : at + 4] != b"VP8L":
        if at + 8 > len(data):
            raise ValueError("no lossless picture")
        size = struct.unpack("<I", data[at + 4 : at + 8])[0]
        at += 8 + size + (size & 1)
    size = struct.unpack("<I", data[at + 4 : at + 8])[0]
    r = Reader(data[at + 8 : at + 8 + size])
    if r.bits(8) != 0x2F:
        raise ValueError("wrong signature")
    width, height = r.bits(14) + 1, r.bits(14) + 1
    r.bits(1)
    if r.bits(3):
        raise ValueError("unknown version")
    inner, steps = width, []
    while r.bits(1):
        kind = r.bits(2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            bits = r.bits(3) + 2
            tile = lambda n, b=bits: (n + (1 << b) - 1) >> b
            steps.append((kind, inner, _image(r, tile(inner), tile(height), False), bits))
        elif kind == PALETTE:
            n = r.bits(8) + 1
            table = _joined(np.cumsum(_channels(_image(r, n, 1, False)), 0))
            steps.append((kind, inner, table, 0))
            inner = (inner + (1 << _bundle_bits(n)) - 1) >> _bundle_bits(n)
        else:
            steps.append((kind, inner, None, 0))
    argb = _image(r, inner, height, True)
    for kind, inner, extra, bits in reversed(steps):
        if kind == PREDICTOR:
            argb = _unpredict(argb, inner, height, extra, bits)
        elif kind == CROSS_COLOUR:
            argb = _cross(argb, inner, height, extra, bits, 1)
        elif kind == SUBTRACT_GREEN:
            argb = _green(argb, 1)
        else:
            argb = _unbundle(argb, inner, height, extra)
    return np.stack([argb >> s & 0xFF for s in (16, 8, 0, 24)], -1).astype(np.uint8).reshape(height, width, 4)


# --- encoder --------------------------------------------------------------------------------------------------


class Writer:
    def __init__(self):
        self.value, self.at = 0, 0
        self.parts: list[np.ndarray] = []

    def bits(self, value: int, n: int) -> None:
        self.value |= value << self.at
        self.at += n

    def bit_array(self) -> np.ndarray:
        raw = np.frombuffer(self.value.to_bytes((self.at + 7) // 8 or 1, "little"), np.uint8)
        return np.unpackbits(raw, bitorder="little")[: self.at]


def write_single(w: Writer, symbol: int) -> None:
    """Store a code of one symbol below 256; the symbol takes no bits."""
    w.bits(1, 2)
    w.bits(int(symbol > 1), 1)
    w.bits(symbol, 8 if symbol > 1 else 1)


def write_code(w: Writer, lengths: list[int]) -> dict[int, tuple[int, int]]:
    """Store a code; the bits of each symbol."""
    used = [s for s, n in enumerate(lengths) if n]
    if len(used) < 2 and (used or [0])[0] < 256:
        write_single(w, (used or [0])[0])
        return {(used or [0])[0]: (0, 0)}
    steps, at = [], 0
    while at < len(lengths):
        n = lengths[at]
        same = at
        while same < len(lengths) and lengths[same] == n:
            same += 1
        times = same - at
        if n == 0 and times >= 3:
            times = min(times, 138)
            steps.append((17, times - 3, 3) if times <= 10 else (18, times - 11, 7))
        elif at and n == lengths[at - 1] and n and times >= 3:
            times = min(times, 6)
            steps.append((16, times - 3, 2))
        else:
            times = 1
            steps.append((n, 0, 0))
        at += times
    counts = [0] * 19
    for s, _, _ in steps:
        counts[s] += 1
    own = code_lengths(counts, 7)
    w.bits(0, 1)
    stored = max((i for i, s in enumerate(LENGTH_ORDER) if own[s]), default=3) + 1
    w.bits(max(4, stored) - 4, 4)
    for s in LENGTH_ORDER[: max(4, stored)]:
        w.bits(own[s], 3)
    w.bits(0, 1)
    codes = canonical(own)
    lone = len(codes) == 1
    for s, extra, n in steps:
        if not lone:
            w.bits(*codes[s])
        w.bits(extra, n)
    return {used[0]: (0, 0)} if len(used) == 1 else canonical(lengths)


def _prefix(value: int) -> tuple[int, int, int]:
    """Symbol, extra bits' value and number of a length or distance."""
    if value <= 4:
        return value - 1, 0, 0
    value -= 1
    n = value.bit_length() - 2
    half = value >> n & 1
    return 2 * n + 2 + half, value - ((2 + half) << n), n


def _tokens(argb: list[int], cache_bits: int, references: bool) -> list[tuple]:
    out, at, seen = [], 0, {}
    cache: dict[int, int] = {}
    total = len(argb)
    while at < total:
        length, source = 0, -1
        if references and at + 3 <= total:
            source = seen.get(tuple(argb[at : at + 3]), -1)
            if source >= 0:
                while at + length < total and length < 4096 and argb[source + length] == argb[at + length]:
                    length += 1
        slot = (CACHE_FACTOR * argb[at] & 0xFFFFFFFF) >> (32 - cache_bits) if cache_bits else -1
        if length >= 3:
            out.append(("copy", length, at - source))
        elif cache_bits and cache.get(slot) == argb[at]:
            out.append(("cache", slot))
            length = 1
        else:
            out.append(("pixel", argb[at]))
            length = 1
        for i in range(at, at + length):
            if references and i + 3 <= total:
                seen[tuple(argb[i : i + 3])] = i
            if cache_bits:
                cache[(CACHE_FACTOR * argb[i] & 0xFFFFFFFF) >> (32 - cache_bits)] = argb[i]
        at += length
    return out


def _write_image(w: Writer, argb: np.ndarray, width: int, top: bool, cache_bits: int = 0, references: bool = False, tile_bits: int = 0) -> None:
    """Entropy-coded pixels. ``tile_bits``: two groups of codes, alternating by tile."""
    w.bits(int(cache_bits > 0), 1)
    if cache_bits:
        w.bits(cache_bits, 4)
    height = len(argb) // width
    tiles = (width + (1 << tile_bits) - 1) >> tile_bits
    if top:
        w.bits(int(tile_bits > 0), 1)
        if tile_bits:
            w.bits(tile_bits - 2, 3)
            rows = (height + (1 << tile_bits) - 1) >> tile_bits
            groups = (np.arange(tiles)[None, :] + np.arange(rows)[:, None]) % 2
            _write_image(w, groups.astype(np.uint32).ravel() << 8, tiles, False)
    number = 2 if top and tile_bits else 1
    near = {max(1, x + y * width): n + 1 for n, (x, y) in reversed(list(enumerate(NEAR)))}
    tokens = _tokens(argb.tolist(), cache_bits, references)
    symbols, at = [], 0
    for kind, *value in tokens:
        group = ((at % width >> tile_bits) + (at // width >> tile_bits)) % 2 if number == 2 else 0
        if kind == "pixel":
            p = value[0]
            symbols.append((group, [(0, p >> 8 & 0xFF), (1, p >> 16 & 0xFF), (2, p & 0xFF), (3, p >> 24)], ()))
            at += 1
        elif kind == "cache":
            symbols.append((group, [(0, 280 + value[0])], ()))
            at += 1
        else:
            length, distance = value
            s, e, n = _prefix(length)
            d, de, dn = _prefix(near.get(distance, distance + 120))
            symbols.append((group, [(0, 256 + s), (4, d)], ((e, n), (de, dn))))
            at += length
    sizes = (ALPHABETS[0] + (1 << cache_bits if cache_bits else 0), *ALPHABETS[1:])
    codes = []
    for g in range(number):
        counts = [Counter() for _ in sizes]
        for group, parts, _ in symbols:
            if group == g:
                for k, s in parts:
                    counts[k][s] += 1
        codes.append([write_code(w, code_lengths([c[s] for s in range(n)])) for c, n in zip(counts, sizes, strict=True)])
    for group, parts, extra in symbols:
        for n, (k, s) in enumerate(parts):
            w.bits(*codes[group][k][s])
            if extra:
                w.bits(*extra[n])


def _file(bits: np.ndarray) -> bytes:
    body = np.packbits(bits, bitorder="little").tobytes()
    chunk = b"VP8L" + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)
    return b"RIFF" + struct.pack("<I", 4 + len(chunk)) + b"WEBP" + chunk


def _header(w: Writer, width: int, height: int, alpha: bool) -> None:
    w.bits(0x2F, 8)
    w.bits(width - 1, 14)
    w.bits(height - 1, 14)
    w.bits(int(alpha), 1)
    w.bits(0, 3)


def encode(
    pixels: np.ndarray, modes: np.ndarray | None = None, elements: np.ndarray | None = None, subtract_green: bool = False, palette: bool = False,
    cache_bits: int = 0, references: bool = False, tile_bits: int = 0, transform_bits: int = 2,
) -> bytes:
    """A file from pixels (height, width, 4) uint8 in RGBA order. Transforms are used as asked for, in this order:
    predictor (``modes``: flat numbers by tile), cross-colour (``elements``: flat ARGB by tile), subtract-green;
    or ``palette`` alone (at most 256 colours)."""
    height, width = pixels.shape[:2]
    p = pixels.reshape(-1, 4).astype(np.uint32)
    argb = p[:, 3] << 24 | p[:, 0] << 16 | p[:, 1] << 8 | p[:, 2]
    w = Writer()
    _header(w, width, height, bool((p[:, 3] != 255).any()))
    tile = lambda n: (n + (1 << transform_bits) - 1) >> transform_bits
    inner = width
    if modes is not None:
        w.bits(1 | PREDICTOR << 1 | (transform_bits - 2) << 3, 6)
        stored = np.asarray(modes, np.uint32) << 8
        _write_image(w, stored, tile(width), False)
        argb = _predicted(argb, width, height, stored, transform_bits)
    if elements is not None:
        w.bits(1 | CROSS_COLOUR << 1 | (transform_bits - 2) << 3, 6)
        _write_image(w, np.asarray(elements, np.uint32), tile(width), False)
        argb = _cross(argb, width, height, np.asarray(elements, np.uint32), transform_bits, -1)
    if subtract_green:
        w.bits(1 | SUBTRACT_GREEN << 1, 3)
        argb = _green(argb, -1)
    if palette:
        table, index = np.unique(argb, return_inverse=True)
        if len(table) > 256:
            raise ValueError("too many colours for a palette")
        w.bits(1 | PALETTE << 1, 3)
        w.bits(len(table) - 1, 8)
        steps = _channels(table)
        _write_image(w, _joined(np.diff(steps, axis=0, prepend=0)), len(table), False)
        bits = _bundle_bits(len(table))
        inner = (width + (1 << bits) - 1) >> bits
        padded = np.zeros((height, inner << bits), np.uint32)
        padded[:, :width] = index.reshape(height, width)
        each = 8 >> bits
        packed = sum(padded[:, k :: 1 << bits] << np.uint32(k * each) for k in range(1 << bits))
        argb = (packed.ravel() << np.uint32(8)) | np.uint32(0xFF000000)
    w.bits(0, 1)
    _write_image(w, argb, inner, True, cache_bits, references, tile_bits)
    return _file(w.bit_array())


#: The shortest repeat that is looked for, and the bits that a reference takes and a literal saves, about.
REPEAT, REFERENCE_BITS, LITERAL_BITS = 16, 30, 4
LONGEST = 4096


def repeats(flat: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, distance, length) of stretches that occur before, from the left, without overlap. A stretch starts
    after a blank or another control character, or at a multiple of ``REPEAT``."""
    n = len(flat)
    follows = np.empty(n, bool)
    follows[0] = True
    np.less_equal(flat[:-1], 32, out=follows[1:])
    follows[::REPEAT] = True
    starts = np.flatnonzero(follows[: max(0, n - REPEAT + 1)])
    if len(starts) < 2:
        return []
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(flat, REPEAT)[starts]).view(np.uint64)
    with np.errstate(over="ignore"):
        key = (words[:, 0] * np.uint64(0x9E3779B97F4A7C15)) ^ (words[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F))
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = np.flatnonzero(key[1:] == key[:-1])
    if not len(same):
        return []
    later, earlier = order[same + 1], order[same]
    by_place = np.argsort(later)
    at, source = starts[later[by_place]], starts[earlier[by_place]]
    out, k = [], 0
    while k < len(at):
        p, q = int(at[k]), int(source[k])
        most = min(LONGEST, n - p)
        unequal = flat[p : p + most] != flat[q : q + most]
        first = int(unequal.argmax())
        length = first if unequal[first] else most
        if length >= REPEAT:
            out.append((p, p - q, length))
            k = int(np.searchsorted(at, p + length))
        else:
            k += 1
    return out


def _write_green(w: Writer, flat: np.ndarray, width: int) -> np.ndarray:
    """Entropy-coded pixels whose green values alone vary (others 0, alpha 255): the codes go to ``w``, the bits of the
    pixels are returned."""
    w.bits(0, 2)  # no colour cache, one group of codes
    copies = repeats(flat)
    if sum(length for _, _, length in copies) * LITERAL_BITS < (len(copies) + 8) * REFERENCE_BITS:
        lengths = code_lengths(np.bincount(flat, minlength=ALPHABETS[0]).tolist())
        value, size = np.zeros(256, np.uint16), np.zeros(256, np.int64)
        for symbol, (v, n) in write_code(w, lengths).items():
            value[symbol], size[symbol] = v, n
        for s in (0, 0, 255, 0):
            write_single(w, s)
        return _spelled(value[flat], size[flat])
    covered = np.zeros(len(flat) + 1, np.int32)
    start, distance, length = np.array(copies, np.int64).reshape(-1, 3).T
    covered[start] += 1
    covered[start + length] -= 1
    literal = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
    codes = np.searchsorted(near := _near(width), distance, sorter=(by_value := np.argsort(near, kind="stable")))
    codes = by_value[np.minimum(codes, len(near) - 1)]
    codes = np.where(near[codes] == distance, codes, distance + 120)
    long, far = ([_prefix(int(v)) for v in values] for values in (length, codes))
    order = np.argsort(np.concatenate([literal, start]), kind="stable")
    symbols = np.concatenate([flat[literal].astype(np.int64), 256 + np.array([x[0] for x in long], np.int64)])[order]
    far_symbols = np.array([x[0] for x in far], np.int64)

    def code(used: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        value, bits = np.zeros(size, np.uint32), np.zeros(size, np.int64)
        for symbol, (v, n) in write_code(w, code_lengths(np.bincount(used, minlength=size).tolist())).items():
            value[symbol], bits[symbol] = v, n
        return value, bits

    green = code(symbols, ALPHABETS[0])
    for s in (0, 0, 255):
        write_single(w, s)
    reach = code(far_symbols, ALPHABETS[4])
    # one field a literal; four a reference: length, its extra bits, distance, its extra bits
    fields = np.where(symbols > 255, 4, 1)
    at = np.cumsum(fields) - fields
    value, size = np.zeros(int(fields.sum()), np.uint32), np.zeros(int(fields.sum()), np.int64)
    value[at], size[at] = green[0][symbols], green[1][symbols]
    at = at[symbols > 255]
    for k, (v, n) in enumerate((([x[1] for x in long], [x[2] for x in long]), (reach[0][far_symbols], reach[1][far_symbols]), ([x[1] for x in far], [x[2] for x in far]))):
        value[at + k + 1], size[at + k + 1] = v, n
    return _spelled(value, size)


def _spelled(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bits of numbers, each with its own size, lowest first."""
    ends = np.cumsum(size)
    place = np.arange(int(ends[-1]), dtype=np.int32) - np.repeat((ends - size).astype(np.int32), size)
    return (np.repeat(value, size) >> place.astype(value.dtype) & 1).astype(np.uint8)


def encode_grey(samples: np.ndarray) -> bytes:
    """A file from grey samples (height, width): by a palette of bundled pixels, or by subtract-green."""
    height, width = samples.shape
    w = Writer()
    _header(w, width, height, False)
    used = np.flatnonzero(np.bincount(samples.ravel(), minlength=256))
    if len(used) <= 16:
        w.bits(1 | PALETTE << 1, 3)
        w.bits(len(used) - 1, 8)
        colours = np.stack([np.full(len(used), 255), used, used, used], -1)
        _write_image(w, _joined(np.diff(colours, axis=0, prepend=0)), len(used), False)
        bits = _bundle_bits(len(used))
        index = np.zeros(256, np.uint8)
        index[used] = np.arange(len(used))
        padded = np.zeros((height, ((width + (1 << bits) - 1) >> bits) << bits), np.uint8)
        padded[:, :width] = index[samples]
        samples = sum(padded[:, k :: 1 << bits] << np.uint8(k * (8 >> bits)) for k in range(1 << bits)).astype(np.uint8)
    else:
        w.bits(1 | SUBTRACT_GREEN << 1, 3)
    w.bits(0, 1)  # no further transform
    body = _write_green(w, np.ascontiguousarray(samples).ravel(), samples.shape[1])
    return _file(np.concatenate([w.bit_array(), body]))


# --- media query ----------------------------------------------------------------------------------------------

ROW, ROWS = 64, 16384


def store(payload: bytes) -> bytes:
    """A payload, a positive multiple of 64 bytes, as one file or (above 1 MiB) consecutive ones."""
    samples = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    return b"".join(encode_grey(samples[i : i + ROWS]) for i in range(0, len(samples), ROWS))


def load(media: bytes) -> np.ndarray:
    """The samples (rows, 64) of what ``store`` wrote, by decoding."""
    parts, at = [], 0
    while at < len(media):
        size = 8 + struct.unpack("<I", media[at + 4 : at + 8])[0]
        parts.append(decode(media[at : at + size])[:, :, 0])
        at += size
    return np.concatenate(parts)


def features(samples: np.ndarray) -> str:
    """Rows, sum, sum of horizontal and of vertical steps, and a histogram over 16 ranges."""
    x = samples.astype(np.int32)
    hist = np.bincount(samples.ravel() >> 4, minlength=16)
    return ":".join(map(str, (len(x), x.sum(), np.abs(np.diff(x, axis=1)).sum(), np.abs(np.diff(x, axis=0)).sum(), ",".join(map(str, hist)))))


def _row(text: str) -> tuple:
    data = text.encode()
    payload = data + b"\0" * (-len(data) % ROW or (0 if data else ROW))
    media = store(payload)
    samples = load(media)
    back = samples.tobytes()
    return (len(data), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-ROW:]), len(media), hashlib.sha256(media).hexdigest(), features(samples))


def media_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature for every row."""
    schema = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return map_text(docs, id_col, text_col, _row, schema)
