"""The multi-index verifies a small part of the codes, and takes odd vectors."""

import numpy as np
import pytest

from ledgerloom.llm import hamming


def clustered(n, bits, seed, noise=0.06):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 256, (max(1, n // 20), bits // 8), dtype=np.uint8)
    return np.unique(base[rng.integers(0, len(base), n)] ^ np.packbits(rng.random((n, bits)) < noise, axis=1), axis=0)


@pytest.mark.parametrize("n, bits, share", [(20_000, 64, 0.02), (20_000, 128, 0.02), (8_000, 768, 0.1)])
def test_few_codes_are_verified(n, bits, share):
    codes = clustered(n, bits, bits)
    index = hamming.MultiIndex(codes, np.ones(len(codes), int))
    queries = codes[:: len(codes) // 40]
    for q in queries:
        found, away = index.search(q, 10)
        every = np.bitwise_count(codes ^ q).sum(1)
        assert sorted(away.tolist())[:10] == sorted(every.tolist())[:10] and (every[found] == away).all()
        assert set(np.flatnonzero(every <= away[9])) <= set(found.tolist())
    assert index.verified / len(queries) / len(codes) < share


@pytest.mark.parametrize("n, bits, k", [(1, 8, 10), (5, 64, 10), (300, 8, 3), (2000, 24, 200), (500, 40, 1)])
def test_small_tables_by_brute_force(n, bits, k):
    rng = np.random.default_rng(n)
    codes = np.unique(rng.integers(0, 256, (n, bits // 8), dtype=np.uint8), axis=0)
    weights = rng.integers(1, 4, len(codes))
    index = hamming.MultiIndex(codes, weights)
    for q in (*codes[:10], rng.integers(0, 256, bits // 8, dtype=np.uint8)):
        found, away = index.search(q, k)
        every = np.bitwise_count(codes ^ q).sum(1)
        order = np.argsort(every, kind="stable")
        last = min(np.searchsorted(np.cumsum(weights[order]), k), len(codes) - 1)
        assert sorted(found.tolist()) == np.flatnonzero(every <= every[order[last]]).tolist() and away.tolist() == sorted(away.tolist())


def test_values_of_segments():
    codes = np.random.default_rng(3).integers(0, 256, (50, 12), dtype=np.uint8)
    bits = np.unpackbits(codes, axis=1).astype(int)
    for a, b in ((0, 8), (3, 19), (7, 27), (80, 96), (13, 14), (5, 25)):
        assert hamming.MultiIndex._value(codes, a, b).tolist() == (bits[:, a:b] @ (1 << np.arange(b - a)[::-1])).tolist()


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, -1.0, 2.0]), (0, [1.0, -1.0, 2.0]), (1, [nan, -1.0, None]), (2, None), (3, []), (100, [1.0]), (None, [1.0, 1.0, 1.0]), (4, [-0.0, 0.0, 1.0]), (200, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("vec_id", "embedding", "'x' AS id", "1 AS code", "2 AS rank", "3 AS side", "4 AS task", "5 AS n")
    got = sorted(tuple(r) for r in hamming.nearest_codes(df, k=3).collect())
    # a row without an id is never found; NaN counts as above 0; short codes are filled up with zeros
    assert got == [(0, 1, 0, 0), (0, 1, 0, 0), (0, 2, 0, 0), (0, 2, 0, 0), (0, 3, 1, 1), (0, 3, 1, 1), (100, 1, 1, 0), (100, 2, 100, 0), (100, 3, 0, 1)]
