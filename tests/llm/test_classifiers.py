"""Scores of the two compression classifiers against plain Python, and what their fits read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import quality, toxicity
from ledgerloom.llm.base import table
from ledgerloom.llm.compression import labelled_sample, remainder

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("module, fit, rows, modulus, out, cut", [
    (toxicity, toxicity.fit_toxicity, toxicity.toxicity_rows, 3, 1, 0.7), (quality, quality.fit_quality, quality.quality_rows, 5, 0, 0.3),
])
def test_scores_by_plain_python(spark, module, fit, rows, modulus, out, cut):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = fit(docs, labels, remainder("doc_id", modulus) == out)
    assert model.fit is not None
    texts = dict(docs.select("doc_id", "text").collect())
    for r in rows(docs, labels).collect():
        assert r.score == pytest.approx(model.score(texts[r.doc_id] or ""), abs=1e-12) and r.predicted == int(r.score >= cut)


def test_conflicting_and_held_out_labels_are_not_read(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc_id long, text string")
    given = [(i, i % 2) for i in range(60)] + [(4, 1), (7, 7), (8, 0), (None, 1), (9, None)]
    labels = spark.createDataFrame(given, "doc_id long, quality int")
    held = F.col("doc_id") >= 40
    zero, one = labelled_sample(docs, labels, "quality", held, 100, 1000)
    assert sorted(zero) == sorted(f"text {i}" for i in range(0, 40, 2) if i != 4) and sorted(one) == sorted(f"text {i}" for i in range(1, 40, 2))
    zero, one = labelled_sample(docs, labels, "quality", held, 5, 1000)
    assert len(zero) == len(one) == 5
    assert labelled_sample(docs, labels, "quality", held, 5, 3) == ([], [])


def test_thresholds_follow_the_savings():
    toxic = [np.array([0, 1, 5.0]), np.array([6.0, 0]), np.array([5.0])]
    ordinary = [np.array([0, 2.0, 1]), np.array([3.0]), np.array([0.0])]
    assert toxicity.thresholds(toxic, ordinary) == (5, 6)
