"""Connected components of a graph held as an edge table, by hash-to-min with checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that edges reach. Nodes without edges are absent.

    Alternates the two star steps on edges that point from larger to smaller nodes: every node's larger
    neighbours move to its smallest neighbour, then its smaller ones do. Each round roughly halves distances,
    and a round's rows never exceed the edges. Rounds end when nothing changed; the tables between rounds are
    written to the shared folder. A node with very many neighbours is aggregated partially before each shuffle.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    now = materialize(pairs)
    before = None
    for _ in range(most_rounds):
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # larger neighbours of u go to the least node around u
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # of its smaller neighbours, u keeps the least and hands the others to it
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        now = materialize(small.select("e.u", "e.v").filter("u <> v").distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == state:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v"), F.col("v")).distinct())
