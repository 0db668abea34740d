"""Odd rows in, defined values out: packing, shards, media, personal data, and the whole pipeline."""

import hashlib
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import entry, mixing, packing, pii, quality, secrets, sharding, toxicity
from ledgerloom.llm.base import spread


def pandas(df):
    return df.toPandas()


@pytest.fixture(scope="module")
def texts(odd_docs):
    """(id, text) of every row, repeated ones too."""
    return [(r[0], r[1]) for r in odd_docs.select("doc_id", "text").collect()]


def test_packing_of_repeated_rows_and_clashing_columns(odd_docs, texts):
    got = pandas(packing.pack(odd_docs, entry.TOKENIZER))
    encode = packing.encoder(entry.TOKENIZER)
    want = []
    for i, t in texts:
        ids = np.array([*encode(t or ""), 0], "<u4")
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want += [(i, n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    assert sorted(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)
    for _, parts in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert (parts.length.cumsum() - parts.length == parts.offset).all() and parts.length.sum() <= 2048


def test_spans_of_odd_rows(odd_docs, texts):
    by_row = lambda rows: sorted((r.doc_id, r.base_sha256, r.spans) for r in rows)
    want = []
    for i, t in texts:
        spans = pii.find_pii(t or "")
        base = ",".join(f"{k}:{a}:{b}" for a, b, k in spans if k in pii.BASE_KINDS)
        want.append((i, hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for a, b, k in spans)))
    assert by_row(pii.pii_rows(odd_docs).collect()) == sorted(want)
    again = by_row(secrets.scan_secrets(odd_docs).collect())
    assert [r[0] for r in again] == sorted(i for i, _ in texts)
    assert {s for _, _, s in again if "access" in s and "assign" in s} and all(h == hashlib.sha256(b"").hexdigest() for i, h, _ in again if i in (0, 1, 2))


def test_mixture_and_shards_of_odd_rows(odd_docs, texts):
    ids = sorted(i for i, _ in texts)
    first = pandas(mixing.mix_rows(odd_docs).filter("epoch = 0"))
    assert sorted(first.doc_id) == ids  # everything once, repeated rows as often as they come
    assert dict(zip(first.doc_id, first.tokens, strict=True)) == {i: len((t or "").encode().split()) + 1 for i, t in texts}
    shards = pandas(sharding.shard_rows(odd_docs))
    assert sorted(shards.doc_id) == ids and set(shards.law) == {"bytes"} and shards.grown_shard.isna().all()


def test_scores_without_labels(odd_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity_rows(odd_docs, none).collect()} == {0.0}
    assert {r.score for r in quality.quality_rows(odd_docs, none).collect()} == {1.0}
    assert quality.keep_good(odd_docs, none).count() == odd_docs.count()


def _folder(docs, labels, path):
    docs.write.parquet(str(path / "documents.parquet"))
    labels.write.parquet(str(path / "labels.parquet"))
    return str(path)


def test_pipeline_on_odd_rows(spark, odd_docs, tmp_path):
    nameless = odd_docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit("nobody knows this one at all"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = odd_docs.union(nameless)
    got = pandas(corpus_pipeline.run(spark, _folder(docs, labels, tmp_path)))
    held = got.groupby("sequence_id").agg(n=("length", "size"), tokens=("length", "sum"))
    assert held.n.max() <= 64 and held.tokens.max() <= 2048
    # of the copies and near copies of one text the smallest id stays; nothing else is lost
    ids = {r[0] for r in odd_docs.select("doc_id").collect()}
    lost = ids - set(got.doc_id.dropna().astype(int))
    texts = dict(odd_docs.select("doc_id", "text").collect())
    assert lost and all(any(j < i and (texts[j] or "").lower()[:200] in (texts[i] or "").lower() for j in ids) for i in lost)
    assert got.doc_id.isna().sum() >= 3


def test_pipeline_on_an_empty_table(spark, no_docs, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert corpus_pipeline.run(spark, _folder(no_docs, labels, tmp_path)).count() == 0


def test_small_tables_are_dealt_over_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(0, 1000, 1, 1)
    dealt = spread(one)
    assert dealt.select(F.spark_partition_id()).distinct().count() == cores and sorted(r[0] for r in dealt.collect()) == list(range(1000))
    many = spark.range(0, 1000, 1, 40)
    assert spread(many) is many and spread(one, few=1) is one
    assert spread(one.limit(0)).count() == 0
