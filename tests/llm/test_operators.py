"""The training-data operators against brute force, on odd rows and on the smallest tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import components, entry, hamming, mixing, ngram_join, packing, pii, quality, secrets, sharding, toxicity, webp
from ledgerloom.llm.base import table
from tests.oracle import differences, duck

SF = "/root/testdata/sf0.001"


def pandas(df):
    return df.toPandas()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(20, 1, 0), (21, 0, 1), (None, 1, 0), (22, None, None), (20, 1, 0)], "doc_id long, quality int, toxic int")


# --- every operator takes odd rows and empty tables ---


def test_odd_rows(odd_docs, labels):
    n = odd_docs.count()
    for df in (
        webp.media_rows(odd_docs), pii.pii_rows(odd_docs), ngram_join.jaccard_components(odd_docs, 3, 90), toxicity.toxicity_rows(odd_docs, labels),
        secrets.scan_secrets(odd_docs), quality.quality_rows(odd_docs, labels), sharding.shard_rows(odd_docs),
    ):
        assert df.count() == n, df.columns
    assert mixing.mix_rows(odd_docs).count() >= n
    assert mixing.mixed(odd_docs).columns == odd_docs.columns
    for f in (lambda d: quality.keep_good(d, labels), ngram_join.keep_one, pii.redact):
        assert f(odd_docs).columns == odd_docs.columns and f(odd_docs).count() <= n


def test_empty_tables(spark, no_docs, labels):
    for df in (
        webp.media_rows(no_docs), pii.pii_rows(no_docs), ngram_join.jaccard_components(no_docs, 3, 90), toxicity.toxicity_rows(no_docs, labels), mixing.mix_rows(no_docs),
        secrets.scan_secrets(no_docs), quality.quality_rows(no_docs, labels), sharding.shard_rows(no_docs), packing.pack(no_docs, entry.TOKENIZER), ngram_join.keep_one(no_docs),
    ):
        assert df.count() == 0
    assert hamming.nearest_codes(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# --- 1 ---


def test_mixing_reaches_its_targets(spark, odd_docs):
    rows = pandas(mixing.mix_rows(table(spark, SF, "documents"), target_entropy=0.999, most_repeats=1.5))
    whole = pandas(table(spark, SF, "documents").select("doc_id", "source"))
    assert set(rows.doc_id) == set(whole.doc_id)  # nothing is dropped by default
    assert rows.groupby("doc_id").size().max() <= 2
    sizes = rows[rows.epoch == 0].groupby("source").tokens.sum()
    taken = rows.groupby("source").tokens.sum()
    assert (taken / sizes).max() <= 1.5 + 1e-6
    p = sizes / sizes.sum()
    h = lambda w: -(w * np.log(w)).sum() / np.log(len(w))
    assert h(taken / taken.sum()) > h(p)
    for _, group in rows.groupby(["source", "epoch", "block"]):
        assert sorted(group.row_place) == list(range(len(group)))


def test_mixing_exponent_by_brute_force(spark):
    tokens = [1000, 300, 50, 7]
    sizes = spark.createDataFrame([(f"s{i}", t, 1) for i, t in enumerate(tokens)], "source string, tokens long, rows long")
    p = np.array(tokens) / sum(tokens)
    a, budget = mixing.choose_exponent(sizes, 0.9, None)
    w = p**a / (p**a).sum()
    assert -(w * np.log(w)).sum() == pytest.approx(0.9 * np.log(4), abs=1e-6)
    assert budget == pytest.approx(max(np.array(tokens) / w), rel=1e-9)
    a, budget = mixing.choose_exponent(sizes, None, 3.0)
    w = p**a / (p**a).sum()
    assert max(budget * w / np.array(tokens)) == pytest.approx(3.0, rel=1e-6)


def test_mixing_budget_takes_a_prefix(spark):
    docs = spark.createDataFrame([(i, "a b c", "x") for i in range(100)], "doc_id long, text string, source string")
    rows = pandas(mixing.mix_rows(docs, target_entropy=None, most_repeats=None, budget=90.0))
    assert rows.tokens.sum() == 88 and rows.doc_id.nunique() == 22


# --- 2 ---


@pytest.mark.parametrize("bits, n", [(64, 700), (8, 300), (128, 250)])
def test_hamming_by_brute_force(spark, bits, n):
    rng = np.random.default_rng(bits)
    base = rng.normal(size=(20, bits))
    vectors = base[rng.integers(0, 20, n)] + 0.7 * rng.normal(size=(n, bits))
    vectors[50:120] = vectors[50]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(n, None), (n + 1, [])], "vec_id long, embedding array<double>")
    got = pandas(hamming.nearest_codes(df, k=10, every=20))
    codes = vectors > 0
    for q, rows in got.groupby("query_id"):
        away = (codes != codes[q]).sum(1)
        best = np.lexsort((np.arange(n), away))[:10]
        rows = rows.sort_values("rank")
        assert rows.neighbour_id.tolist() == best.tolist() and rows.distance.tolist() == away[best].tolist()
    assert got.query_id.nunique() == len(range(0, n, 20))


# --- 3 ---


def test_media_columns(odd_docs):
    rows = pandas(webp.media_rows(odd_docs).join(odd_docs.select("doc_id", "text").distinct(), "doc_id"))
    for r in rows.itertuples():
        data = (r.text or "").encode()
        payload = data + b"\0" * (max(64, -(-len(data) // 64) * 64) - len(data))
        assert (r.n_bytes, r.payload_bytes) == (len(data), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])


# --- 4 ---


def brute_pii(text):
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out.append((m.start(), 2, m.end(), "card"))
    out += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(a, b, k) for a, _, b, k in sorted(out)]


def test_pii_by_brute_force():
    rng = random.Random(1)
    parts = ["a@b.c", "@", "1.2.3", "4111 1111 1111 1111", ".", "+", "1", "23", " ", "-", "4", "(", ")", "x@y", ".9", "555", "@z.co", "é", "+1 499 555 6503"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [s for s in pii.find_pii(text) if s[2] in pii.BASE_KINDS] == brute_pii(text), text


def test_pii_further_kinds_and_redaction():
    text = "see https://a.b/c?d=1. Account no: 12AB-3456 or me@x.org!"
    kinds = [(k, text[a:b]) for a, b, k in pii.find_pii(text)]
    assert ("url", "https://a.b/c?d=1") in kinds and ("account", "12AB-3456") in kinds and ("email", "me@x.org") in kinds
    assert pii.redacted(text) == "see [URL]. Account no: [ACCOUNT] or [EMAIL]!"
    assert len(pii.find_pii("1" * 300_000 + "@" * 100_000 + "+1" * 50_000)) >= 0  # linear time
    zeros = "0" * 9_000  # longer than int() reads
    assert (0, len(zeros) + 7, "ip") in pii.find_pii(f"{zeros}1.2.3.4") and not [s for s in pii.find_pii(f"{zeros}256.2.3.4") if s[2] == "ip"]


# --- 5 ---


def brute_components(rows, n, percent):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())
    label = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    pairs = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return sets, label, pairs


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80), (1, 50)])
def test_jaccard_by_brute_force(spark, odd_docs, n, percent):
    for docs in (odd_docs.filter("doc_id <> 25"), table(spark, SF, "documents")):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        sets, label, pairs = brute_components(rows, n, percent)
        got = pandas(ngram_join.jaccard_components(docs, n, percent))
        assert dict(zip(got.doc_id, got.component_id, strict=True)) == label
        assert dict(zip(got.doc_id, got.n_shingles, strict=True)) == {i: len(s) for i, s in sets.items()}
        links = pd.Series([x for p in pairs for x in p], dtype="int64").value_counts().to_dict()
        assert dict(zip(got.doc_id, got.n_links, strict=True)) == {i: links.get(i, 0) for i in sets}


def test_jaccard_in_a_large_group(spark):
    """Near copies of one text: every block pair is verified, none is lost."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        own = list(words)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    _, label, _ = brute_components(rows, 3, 90)
    got = pandas(ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90))
    assert dict(zip(got.doc_id, got.component_id, strict=True)) == label and len(set(label.values())) > 1


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(15)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(60):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {k: v for k, v in label.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_keep_one_keeps_the_smallest(spark):
    docs = spark.createDataFrame([(3, "a b c d e f"), (1, "A b c d e f"), (2, "other"), (2, "other"), (9, None)], "doc_id long, text string")
    assert sorted(r[0] for r in ngram_join.keep_one(docs).select("doc_id").collect()) == [1, 2, 9]
    nameless = docs.union(spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (None, "x")], docs.schema))
    assert sorted(r[0] or 0 for r in ngram_join.keep_one(nameless).select("doc_id").collect()) == [0, 0, 0, 1, 2, 9]


# --- 6, 9 ---


@pytest.mark.parametrize("rows, label, least", [(quality.quality_rows, "quality", 0.9), (toxicity.toxicity_rows, "toxic", 0.7)])
def test_classifiers_on_held_out_rows(spark, rows, label, least):
    d = "/root/testdata/sf0.01"
    got = pandas(rows(table(spark, d, "documents"), table(spark, d, "labels")).join(table(spark, d, "labels").dropDuplicates(["doc_id"]), "doc_id"))
    assert got.score.between(0, 1).all()
    held = got[got.held_out]
    one, zero = held[held[label] == 1].score.to_numpy(), held[held[label] == 0].score.to_numpy()
    assert (one[:, None] > zero[None]).mean() + 0.5 * (one[:, None] == zero[None]).mean() > least
    modulus, out = (5, 0) if label == "quality" else (3, 1)
    assert (held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % modulus) == out).all()


# --- 7 ---


def test_packing(spark, odd_docs):
    docs = odd_docs.filter("doc_id <> 25").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(1000, "one<|endoftext|> two<|endoftext|>")], docs.schema))
    got = pandas(packing.pack(docs, entry.TOKENIZER)).sort_values(["sequence_id", "offset"])
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(entry.TOKENIZER)
    texts = dict((r[0], r[1]) for r in docs.collect())
    for i, parts in got.groupby("doc_id"):
        ids = np.array([*own.encode(texts[i] or "", add_special_tokens=False).ids, 0], "<u4")
        parts = parts.sort_values("piece")
        assert parts.piece.tolist() == list(range(len(parts))) and parts.length.sum() == len(ids) and (parts.length.iloc[1:] == 2048).all()
        for r in parts.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for _, parts in got.groupby("sequence_id"):
        assert (parts.length.cumsum() - parts.length == parts.offset).all() and parts.length.sum() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 1


def test_packing_few_documents_a_sequence(spark):
    """A capacity of documents that binds: short texts fill sequences by number, not by tokens."""
    docs = spark.createDataFrame([(i, "word " * (i % 7)) for i in range(1000)], "doc_id long, text string")
    got = pandas(packing.pack(docs, entry.TOKENIZER, limit=2048, documents=64))
    held = got.groupby("sequence_id").agg(n=("length", "size"), tokens=("length", "sum"))
    assert held.n.max() == 64 and held.tokens.max() < 2048 and len(held) == 16 and got.doc_id.nunique() == 1000


@pytest.mark.parametrize("rule", ["dot", "norm"])
def test_packer_keeps_every_constraint(rule):
    rng = random.Random(4)
    numbers = {n: rng.randint(1, 40) for n in rng.sample(range(1, 101), 60)}
    packer = packing.pack_lengths(numbers, packing.Packer(100, 5, 4000 if rule == "dot" else 10_000, rule)) if rule == "norm" else packing.pack_lengths(
        {n: c for n, c in numbers.items() if n * n <= 4000}, packing.Packer(100, 5, 4000, rule)
    )
    bins, placed = {}, {}
    ordered = sorted(packer.plan, key=lambda p: (p[0], p[1]))
    ends = {}
    for i, (length, rank, first, offset) in enumerate(ordered):
        after = ordered[i + 1][1] if i + 1 < len(ordered) and ordered[i + 1][0] == length else numbers[length]
        for k in range(after - rank):
            bins.setdefault(first + k, []).append((offset, length))
        placed[length] = placed.get(length, 0) + after - rank
        ends[length] = after
    assert placed == {n: c for n, c in numbers.items() if n in placed}
    for own in bins.values():
        own.sort()
        assert len(own) <= 5 and sum(n * n for _, n in own) <= packer.capacity[2]
        at = 0
        for offset, length in own:
            assert offset == at
            at += length
        assert at <= 100


# --- 8 ---


def brute_secrets(text):
    assign = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text, re.ASCII) if len(m[1]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_secrets_by_brute_force(spark):
    rng = random.Random(6)
    parts = ["password", "Token", "API_KEY", "apikey", "passwd", "SECRET", "=", ": ", " ", '"', "'", "abcd1234", "x", "AKIA", "ABCDEFGHIJKL", "0" * 20, "deadbeef" * 4, "é🙂", "\n", "-----BEGIN RSA PRIVATE KEY-----"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))) for i in range(3000)]
    got = secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = dict(rows)
    for r in got:
        base = brute_secrets(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest(), texts[r["doc_id"]]
        kept = ",".join(s for s in r["spans"].split(",") if s.split(":")[0] in ("assign", "access", "hex"))
        assert kept == base
    assert any("private_key" in r["spans"] for r in got)


# --- 10 ---


def brute_capacity(sizes, shards):
    """The smallest capacity at which greedy runs need at most so many shards, groups above it being alone; all are tried."""
    for capacity in sorted({0, *(sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1))}):
        used, left = 0, 0
        for s in sizes:
            if s > left:
                used, left = used + 1, capacity
            left = left - s if s <= left else 0
        if used <= shards:
            return capacity


def test_minimax_by_brute_force(spark):
    rng = random.Random(8)
    for n, shards, hot in ((300, 24, ()), (50, 24, ()), (5, 24, ()), (400, 3, ()), (200, 24, (0.5,)), (200, 6, (0.4, 0.3)), (60, 4, (0.2, 0.2, 0.2, 0.2)), (90, 2, (0.9,))):
        rows = sorted({rng.randrange(1 << 60): rng.randint(8, 900) for _ in range(n)}.items())
        total = sum(s for _, s in rows)
        for share in hot:
            i = rng.randrange(n)
            rows[i] = (rows[i][0], int(total * share / (1 - sum(hot))))
        sizes = [s for _, s in rows]
        starts, capacity = sharding.minimax_cuts(spark.createDataFrame(rows, "key long, size long"), shards)
        assert capacity == brute_capacity(sizes, shards), (n, shards, hot)
        held = [[] for _ in range(shards)]
        for key, size in rows:
            held[sum(key >= s for s in starts)].append(size)
        assert all(len(own) == 1 or sum(own) <= capacity for own in held if own)
        assert len([own for own in held if own]) == min(n, shards)
        best = min(c for c in {capacity, *sizes} if c >= max(sizes)) if capacity < max(sizes) else capacity
        assert max(map(sum, held)) <= best  # the least that the largest shard can be


def test_close_keys_are_told_apart(spark):
    """Groups whose keys share most bits lie in one cell until it has been split many times."""
    rows = [((7 << 50) + i, 100 + i) for i in range(40)] + [((7 << 50) + (1 << 20), 50_000), (1 << 59, 10)]
    starts, capacity = sharding.minimax_cuts(spark.createDataFrame(rows, "key long, size long"), 8)
    assert capacity == brute_capacity([s for _, s in sorted(rows)], 8)


def test_shards(odd_docs):
    got = pandas(sharding.shard_rows(odd_docs).join(odd_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).distinct(), "doc_id"))
    assert got.groupby("text").shard.nunique().max() == 1 and got.shard.between(0, 23).all()
    for _, rows in got.groupby("shard"):
        assert sorted(rows.slot) == list(range(len(rows)))
    assert (got["size"] == got.text.map(lambda t: len(t.encode()) + 8)).all() and (got.text_crc32 == got.text.map(lambda t: zlib.crc32(t.encode()))).all()


# --- SQL and the pipeline ---


def test_sql_twins(spark):
    tables = duck(SF)
    for name, sql in entry.oracle_sql().items():
        assert differences(entry.queries()[name](spark, SF), tables, sql) == ""


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = stage(spark, before, SF)
        if name == "best_fit_packing":
            break
        assert kept.columns == docs.columns
        rows, old = pandas(kept), pandas(before)
        if name == "quality_classifier":
            model = quality.fit_quality(before, table(spark, SF, "labels"), quality.remainder("doc_id", 5) == 0)
            assert set(rows.doc_id) == {i for i, t in zip(old.doc_id, old.text, strict=True) if model.score(t or "") >= 0.3}
        elif name == "ngram_jaccard_join":
            _, label, _ = brute_components(list(zip(old.doc_id, old.text, strict=True)), 5, 80)
            assert sorted(rows.doc_id) == sorted(set(label.values()))
        elif name == "pii":
            texts = dict(zip(old.doc_id, old.text, strict=True))
            assert all(r.text == pii.redacted(texts[r.doc_id]) and r.n_chars == len(r.text) for r in rows.itertuples())
        else:
            assert set(rows.doc_id) == set(old.doc_id)
    held = kept.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count(F.lit(1)).alias("c")).agg(F.max("n"), F.max("c")).first()
    assert held[0] <= 2048 and held[1] <= 64
