"""Stored media against a second decoder, written bit by bit and pixel by pixel from the format's description."""

import numpy as np
import pytest

from ledgerloom.llm import webp

# The first near distances of the format, as (x, y), in its order.
FIRST_NEAR = [
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3), (-1, 3), (3, 1), (-3, 1),
    (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4),
]
# The order of the lengths of the code-length code.
ORDER = [17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15]


class Plain:
    def __init__(self, data):
        self.bits_of = "".join(f"{b:08b}"[::-1] for b in data)
        self.at = 0

    def bits(self, n):
        part = self.bits_of[self.at : self.at + n]
        assert len(part) == n
        self.at += n
        return int(part[::-1] or "0", 2)

    def tree(self, lengths):
        """Codes as strings of bits, most significant first."""
        used = [s for s, n in enumerate(lengths) if n]
        if len(used) == 1:
            return {"": used[0]}
        out, code = {}, 0
        for n in range(1, 16):
            code <<= 1
            for s, length in enumerate(lengths):
                if length == n:
                    out[f"{code:0{n}b}"] = s
                    code += 1
        return out

    def symbol(self, tree):
        word = ""
        while word not in tree:
            word += self.bits_of[self.at]
            self.at += 1
        return tree[word]

    def code(self, size):
        lengths = [0] * size
        if self.bits(1):
            two = self.bits(1)
            lengths[self.bits(8) if self.bits(1) else self.bits(1)] = 1
            if two:
                lengths[self.bits(8)] = 1
            return self.tree(lengths)
        own = [0] * 19
        for i in range(self.bits(4) + 4):
            own[ORDER[i]] = self.bits(3)
        tree = self.tree(own)
        most = 2 + self.bits(2 + 2 * self.bits(3)) if self.bits(1) else size
        s = before = 0
        before = 8
        while s < size and most:
            most -= 1
            c = self.symbol(tree)
            if c < 16:
                lengths[s] = c
                s += 1
                before = c or before
            else:
                value = before if c == 16 else 0
                for _ in range({16: 3, 17: 3, 18: 11}[c] + self.bits({16: 2, 17: 3, 18: 7}[c])):
                    lengths[s] = value
                    s += 1
        return self.tree(lengths)

    def number(self, prefix):
        if prefix < 4:
            return prefix + 1
        extra = (prefix - 2) // 2
        return (2 + prefix % 2) * 2**extra + self.bits(extra) + 1

    def image(self, width, height, top):
        cache = [0] * 2 ** self.bits(4) if self.bits(1) else []
        assert not (top and self.bits(1)), "one group of codes"
        codes = [self.code(n) for n in (280 + len(cache), 256, 256, 256, 40)]
        out = []
        while len(out) < width * height:
            s = self.symbol(codes[0])
            if s < 256:
                red, blue, alpha = (self.symbol(c) for c in codes[1:4])
                new = [(alpha, red, s, blue)]
            elif s < 280:
                length = self.number(s - 256)
                d = self.number(self.symbol(codes[4]))
                if d > 120:
                    d -= 120
                else:
                    x, y = webp.NEAR[d - 1]
                    d = max(1, x + y * width)
                new = []
                for _ in range(length):
                    new.append((out[-d:] + new)[-d])
            else:
                new = [cache[s - 280]]
            for p in new:
                out.append(p)
                if cache:
                    number = p[0] << 24 | p[1] << 16 | p[2] << 8 | p[3]
                    cache[(0x1E35A7BD * number % 2**32) >> (32 - (len(cache).bit_length() - 1))] = p
        return out


def plain_grey(data):
    """Grey rows of one file that has subtract-green or a palette as its only transform."""
    r = Plain(data[20:])
    assert data[:4] == b"RIFF" and data[8:16] == b"WEBPVP8L" and r.bits(8) == 0x2F
    width, height = r.bits(14) + 1, r.bits(14) + 1
    r.bits(4)
    assert r.bits(1)
    kind, table, inner, bits = r.bits(2), None, width, 0
    if kind == 3:
        n = r.bits(8) + 1
        steps = r.image(n, 1, False)
        table = [tuple(sum(p[c] for p in steps[: i + 1]) % 256 for c in range(4)) for i in range(n)]
        bits = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
        inner = -(-width // 2**bits)
    assert not r.bits(1)
    pixels = r.image(inner, height, True)
    rows = []
    for y in range(height):
        row = pixels[y * inner : (y + 1) * inner]
        if table is None:
            assert all((red + green) % 256 == (blue + green) % 256 == green for _, red, green, blue in row)
            rows.append([green for _, _, green, _ in row])
        else:
            each = 8 // 2**bits
            rows.append([table[(row[x // 2**bits][2] >> (x % 2**bits * each)) % 2**each][1] for x in range(width)])
    return np.array(rows, np.uint8), kind


LINE = "the quick brown fox jumps over the lazy dog, said the 1st of 27 foxes\n"
TEXTS = {
    "empty": "", "one": "a", "two values": "ab" * 40, "hex": "0123456789abcdef" * 30, "line again": (LINE * 9) + "end", "long run": "x" * 700,
    "prose": " ".join(str(i * 7919 % 1000) + "wxyz"[i % 4] for i in range(150)), "far repeat": LINE + " ".join(str(i * i) for i in range(200)) + LINE, "letters": "é中🙂 " * 40,
}


@pytest.mark.parametrize("name", TEXTS)
def test_stored_files_decode_alike(name):
    data = TEXTS[name].encode()
    payload = data + b"\0" * (-len(data) % 64 or (0 if data else 64))
    media = webp.store(payload)
    rows, kind = plain_grey(media)
    assert rows.tobytes() == payload == webp.load(media).tobytes()
    assert (kind == webp.PALETTE) == (len(set(payload)) <= 16)


def test_repeats_are_stored_as_references():
    unit = TEXTS["prose"] + "\n"
    once, often = (webp.store(t.encode() + b"\0" * (-len(t.encode()) % 64)) for t in (unit, unit * 20))
    assert len(often) < len(once) + 20 * 12
    flat = np.frombuffer((unit * 3).encode(), np.uint8)
    found = webp.repeats(flat)
    assert sum(length for _, _, length in found) >= 2 * len(unit) - 64
    for start, distance, length in found:
        assert all(flat[start + i] == flat[start + i - distance] for i in range(length))


def test_near_distances():
    assert webp.NEAR[: len(FIRST_NEAR)] == FIRST_NEAR and len(webp.NEAR) == 120


def test_damaged_references_are_reported():
    data = bytearray(webp.store((LINE * 40).encode()[:2560]))
    for at in range(40, len(data)):
        for value in (0, 255):
            broken = bytearray(data)
            broken[at] = value
            try:
                assert webp.decode(bytes(broken)).shape == (40, 64, 4)
            except ValueError:
                pass


def test_very_repetitive_texts_stay_cheap():
    import time

    began = time.perf_counter()
    for text in ("y" * 3_000_000, "ab " * 700_000, LINE * 30_000):
        data = text.encode()
        payload = data + b"\0" * (-len(data) % 64)
        assert webp.load(webp.store(payload)).tobytes() == payload
    assert time.perf_counter() - began < 60
