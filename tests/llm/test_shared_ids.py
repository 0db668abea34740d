"""Near copies among rows that share an id or have none."""

import random

from ledgerloom.llm import ngram_join

SCHEMA = "doc_id long, text string"


def words(seed, n=120):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def near(base, seed):
    own = list(base)
    own[len(own) // 2] = f"x{seed}"
    return " ".join(own)


def test_rows_with_one_id_are_linked_each_by_its_own_text(spark):
    a, b = words(1), words(2)
    rows = []
    for i in range(12):  # each id has a near copy of a and a text of its own; b is under two ids
        rows += [(i, near(a, i)), (i, " ".join(words(100 + i)))]
    rows += [(20, near(b, 1)), (20, near(words(3), 9)), (21, near(b, 2)), (21, "short one")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = ngram_join._linked(docs, 5, 80)[1].collect()
    by_class = {ngram_join.set_hash(ngram_join.shingles(t, 5)): t for _, t in rows}
    groups = {}
    for r in got:
        groups.setdefault(r["component"], set()).add(by_class[r["class"]])
    copies = {frozenset(near(a, i) for i in range(12)), frozenset(near(b, i) for i in (1, 2))}
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == copies
    kept = sorted(tuple(r) for r in ngram_join.keep_one(docs).select("doc_id", "text").collect())
    gone = {(i, near(a, i)) for i in range(1, 12)} | {(21, near(b, 2))}
    assert kept == sorted(set(rows) - gone)


def test_rows_without_ids_are_linked(spark):
    a = words(5)
    rows = [(None, near(a, 1)), (None, near(a, 2)), (7, near(a, 3)), (8, near(a, 4)), (9, "alone"), (9, "alone"), (10, None), (10, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    links = sorted((r.doc_id or 0, r.component_id, r.n_links) for r in ngram_join.jaccard_components(docs, 5, 80).collect() if r.n_shingles > 20)
    assert links == [(0, 7, 3), (0, 7, 3), (7, 7, 3), (8, 7, 3)]
    kept = sorted(r[0] or 0 for r in ngram_join.keep_one(docs).select("doc_id").collect())
    assert kept == [0, 0, 7, 9, 10]


def test_sets_that_share_a_name_are_told_apart(spark):
    """With names of few bits, most of which two sets share, nothing changes."""
    rng = random.Random(11)
    rows = [(i, " ".join(words(i // 3, 40 + i % 5))) for i in range(300)] + [(1000 + i, near(words(i, 60), i)) for i in range(40)] + [(2000 + i, near(words(i, 60), 7)) for i in range(40)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = sorted(map(tuple, ngram_join.jaccard_components(docs, 3, 80).collect()))
    for bits in (5, 9):
        assert sorted(map(tuple, ngram_join.jaccard_components(docs, 3, 80, name_bits=bits).collect())) == want


def test_outlines_bound_overlaps():
    import numpy as np

    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (0, 1, 63, 500, 1100, 1200, 5000, 5200, 9000)]
    sets += [np.unique(np.concatenate([s[: int(len(s) * 0.97)], rng.integers(0, 2**63, 5).astype(np.uint64)])) for s in sets]
    sizes = np.array([len(s) for s in sets])
    every = np.arange(len(sets))
    alive, needed = ngram_join.possible(sizes, [ngram_join.outline(s) for s in sets], every, every, 90)
    for i in every:
        for j in every:
            common = len(np.intersect1d(sets[i], sets[j]))
            assert alive[i, j] or common < needed[i, j] or not common
    assert not alive[6, 7]  # large sets that meet by chance


def test_sketch_sums_every_count(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(4)
    bits = 17
    parts = [rng.integers(0, 3, 1 << bits).astype(np.uint32) for _ in range(30)]
    parts.append(np.full(1 << bits, 0xFFFFFFF0, np.uint32))
    size = 1 << ngram_join.CHUNK_BITS
    rows = [(c, bytearray(ngram_join._packed(p[c * size : (c + 1) * size]))) for p in parts for c in range((1 << bits) // size)]
    table = spark.createDataFrame([*rows, (None, None)], "chunk int, counts binary").repartition(5)
    want = np.minimum(sum(p.astype(np.uint64) for p in parts), 0xFFFFFFFF)
    for summed in (64, 3, 2):  # one step, several steps
        monkeypatch.setattr(ngram_join, "SUMMED", summed)
        assert (ngram_join._summed(table, bits) == want).all()
    assert not ngram_join._summed(table.filter("chunk is null"), bits).any()
