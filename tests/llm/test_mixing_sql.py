"""The mixture against its SQL where sources are uneven, so that epochs repeat and budgets cut."""

import random

import duckdb
import pytest

from ledgerloom.llm import entry, mixing
from tests.oracle import differences


@pytest.mark.parametrize("sizes", [(3000, 90, 25, 4, 1), (2600, 2400, 3), (50,), (700, 700), (4000, 10, 9, 8, 7, 6, 5)])
def test_uneven_sources_by_sql(spark, sizes):
    rng = random.Random(sum(sizes))
    rows = []
    for k, n in enumerate(sizes):
        rows += [(len(rows) + i, None if rng.random() < 0.02 else "w " * rng.randint(0, 40), None if k == 1 else f"s{k}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").cache()
    c = duckdb.connect()
    frame = docs.toPandas()
    c.register("documents", frame)
    mixture = mixing.mix_rows(docs, target_entropy=0.95, most_repeats=2.0)
    assert differences(mixture, c, entry.MIXING_SQL) == ""
    if len(sizes) > 2:
        assert mixture.filter("epoch > 0").count() > 0
    docs.unpersist()
