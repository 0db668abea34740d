"""Round trips through every feature of the lossless WebP codec, and a file made elsewhere."""

import base64

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import webp


def picture(seed, height, width, colours=None):
    rng = np.random.default_rng(seed)
    if colours:
        table = rng.integers(0, 256, (colours, 4), np.uint8)
        return table[rng.integers(0, colours, (height, width))]
    base = np.cumsum(rng.integers(-3, 4, (height, width, 4)), axis=1) + 100
    return (base % 256).astype(np.uint8)


def test_file_made_elsewhere():
    pixels = webp.decode(base64.b64decode("UklGRhoAAABXRUJQVlA4TA0AAAAvAAAAEAcQERGIiP4HAA=="))
    assert pixels.shape == (1, 1, 4)


@pytest.mark.parametrize("mode", range(14))
def test_predictors(mode):
    p = picture(mode, 11, 13)
    assert (webp.decode(webp.encode(p, modes=[mode] * 12)) == p).all()


def test_mixed_predictors_and_cross_colour():
    p = picture(1, 12, 17)
    tiles = 5 * 3
    elements = np.random.default_rng(2).integers(0, 1 << 24, tiles) | 0xFF000000
    data = webp.encode(p, modes=[n % 14 for n in range(tiles)], elements=elements, subtract_green=True, cache_bits=4, references=True, tile_bits=2)
    assert (webp.decode(data) == p).all()


@pytest.mark.parametrize("colours", [1, 2, 3, 4, 16, 17, 256])
def test_palettes(colours):
    p = picture(colours, 9, 21, colours)
    assert (webp.decode(webp.encode(p, palette=True, references=True)) == p).all()


@pytest.mark.parametrize("cache_bits", [0, 1, 6, 11])
@pytest.mark.parametrize("references", [False, True])
def test_cache_and_references(cache_bits, references):
    p = np.tile(picture(5, 4, 6, 9), (3, 4, 1))
    data = webp.encode(p, cache_bits=cache_bits, references=references)
    assert (webp.decode(data) == p).all()


@settings(max_examples=40, deadline=None)
@given(st.binary(max_size=3000))
def test_store_and_load(data):
    payload = data + b"\0" * (-len(data) % 64 or (0 if data else 64))
    assert webp.load(webp.store(payload)).tobytes() == payload


def test_long_payload_takes_several_files():
    payload = bytes(range(256)) * 4097 + b"\1" * 64
    assert len(payload) > 64 * 16384
    assert webp.load(webp.store(payload)).tobytes() == payload


def test_skewed_counts_keep_codes_short():
    lengths = webp.code_lengths([2**i for i in range(30)], 11)
    assert max(lengths) <= 11 and sum(2.0**-n for n in lengths) == 1


def test_damage_is_reported():
    with pytest.raises(ValueError):
        webp.decode(b"RIFF" + b"\0" * 30)
    data = webp.encode(picture(1, 4, 4))
    with pytest.raises(ValueError):
        webp.decode(data[: len(data) // 2])
