"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit a dimension: whether the value is above 0. Equal codes are searched once; of each
code the k smallest ids are kept, as no other can be among the k nearest by (distance, id).

Codes are dealt out in blocks as large as a task holds (all in one while they fit) and queries in more; a task
holds one block of each. It cuts the codes into m segments of about log2(block) bits and indexes each: the codes
by a segment's value. A query looks up its segments' values within radius 0, then 1, and so on, and verifies the
codes that it meets for the first time. After radius s in j of the segments every code at distance m * s + j - 1 or
less has been verified, so the search stops as soon as the k-th verified distance is that small. The values within
a radius are listed by flipping bits or, where there are more of them than values that occur, picked from those
that occur: the buckets are the same ones. The best k of each task are merged per query.

Defined results: rows with a null or empty vector have no code, are no queries and are never found, nor are rows
without an id; a null value counts as 0, NaN as above 0 (as SQL orders it); codes are filled up to bytes with zeros,
and those of other numbers of bytes never meet; ties go to smaller ids; repeated rows (equal ids too) are rows of
their own in the order of ids; with fewer than k rows all are returned; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import materialize, runs

#: Bytes of codes in a block: with its index a task holds about five times as much.
CODE_BYTES, MOST_CODES = 32 << 20, 1_000_000
#: Queries of a block; their blocks are more where the codes have too few to occupy a cluster.
QUERY_BLOCK, LEAST_QUERIES, TASKS = 100_000, 64, 64
#: Bits of a segment at most.
WIDEST = 20
#: Queries whose results a task holds before it passes them on.
OUT_QUERIES = 2_000


def binary_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, code): bits of the signs, packed into bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            above = ~(column.flatten().fill_null(0.0).to_numpy(zero_copy_only=False) <= 0)
            sizes = pc.list_value_length(column).to_numpy()
            if len(sizes) and (sizes == sizes[0]).all():
                codes = [row.tobytes() for row in np.packbits(above.reshape(len(sizes), -1), axis=1)]
            else:
                codes = [np.packbits(part).tobytes() for part in np.split(above, np.cumsum(sizes)[:-1])] if len(sizes) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary())], names=["id", "code"])

    rows = vectors.filter(F.size(vector_col) > 0).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "id long, code binary")


class MultiIndex:
    """Codes (n, bytes) uint8 with the number of ids of each, indexed by segments."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray):
        self.codes, self.weights = codes, weights
        self.verified = 0  # codes whose distance was taken, over all searches
        bits = 8 * codes.shape[1]
        width = min(WIDEST, max(4, round(np.log2(max(2, len(codes))))))
        self.segments = max(1, -(-bits // width))
        cuts = np.linspace(0, bits, self.segments + 1).astype(int)
        self.bounds = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        self.index = []
        for a, b in self.bounds:
            value = self._value(codes, a, b)
            order = np.argsort(value, kind="stable").astype(np.int32)
            present, first = np.unique(value[order], return_index=True)
            self.index.append((order, present, np.append(first, len(codes)).astype(np.int32)))
        self._masks: dict[tuple[int, int], np.ndarray] = {}

    @staticmethod
    def _value(codes: np.ndarray, a: int, b: int) -> np.ndarray:
        """Bits a to b of each code as a number."""
        part = codes[:, a // 8 : -(-b // 8)]
        out = np.zeros(len(codes), np.uint32)
        for column in part.T:
            out = out << np.uint32(8) | column
        return (out >> np.uint32(-b % 8)) & np.uint32((1 << (b - a)) - 1)

    def _flips(self, width: int, radius: int) -> np.ndarray:
        if (width, radius) not in self._masks:
            self._masks[width, radius] = np.array([sum(1 << i for i in c) for c in combinations(range(width), radius)], np.uint32)
        return self._masks[width, radius]

    def _buckets(self, n: int, value: int, radius: int, away: dict[int, np.ndarray]) -> np.ndarray:
        """Places in segment n's list of occurring values of those exactly ``radius`` bits from ``value``."""
        a, b = self.bounds[n]
        present = self.index[n][1]
        if comb(b - a, radius) <= len(present):
            probe = np.uint32(value) ^ self._flips(b - a, radius)
            at = np.minimum(np.searchsorted(present, probe), len(present) - 1)
            return at[present[at] == probe]
        if n not in away:
            away[n] = np.bitwise_count(present ^ np.uint32(value))
        return np.flatnonzero(away[n] == radius)

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Indices and distances of codes, all those among the k nearest ids included, nearest first."""
        values = [int(self._value(query[None, :], a, b)[0]) for a, b in self.bounds]
        seen = np.zeros(len(self.codes), bool)
        found, away = np.empty(0, np.int64), np.empty(0, np.int64)
        apart: dict[int, np.ndarray] = {}
        for radius in range(max(b - a for a, b in self.bounds) + 1):
            for n, value in enumerate(values):
                a, b = self.bounds[n]
                at = self._buckets(n, value, radius, apart) if radius <= b - a else ()
                if len(at):
                    order, _, starts = self.index[n]
                    number = starts[at + 1] - starts[at]
                    ends = np.cumsum(number)
                    hits = order[np.arange(ends[-1]) + np.repeat(starts[at] - ends + number, number)]
                    hits = hits[~seen[hits]]  # a code is once in a segment's list
                    seen[hits] = True
                    found = np.concatenate([found, hits])
                    away = np.concatenate([away, np.bitwise_count(self.codes[hits] ^ query).sum(1).astype(np.int64)])
                if len(found) == len(self.codes) or self.weights[found[away < self.segments * radius + n + 1]].sum() >= k:
                    break
            else:
                continue
            break
        self.verified += len(found)
        nearest = np.argsort(away, kind="stable")
        found, away = found[nearest], away[nearest]
        enough = min(np.searchsorted(np.cumsum(self.weights[found]), k), len(found) - 1)
        kept = away <= away[enough] if len(found) else slice(0)
        return found[kept], away[kept]


def _search_blocks(dealt: DataFrame, k: int) -> DataFrame:
    """(query, id, distance) from rows (task, side, code, ids); side 0 holds codes, side 1 queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "task"):
            side = np.array(rows.column("side").to_pylist())
            codes, ids = rows.column("code").to_pylist(), rows.column("ids").to_pylist()
            base, asked = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            by_length: dict[int, list[int]] = {}
            for i in base:
                by_length.setdefault(len(codes[i]), []).append(int(i))
            index = {n: MultiIndex(np.array([np.frombuffer(codes[i], np.uint8) for i in own]), np.array([len(ids[i]) for i in own])) for n, own in by_length.items()}
            for start in range(0, len(asked), OUT_QUERIES):
                out: list[tuple[bytes, int, int]] = []
                for q in asked[start : start + OUT_QUERIES]:
                    own = by_length.get(len(codes[q]))
                    if own is None:
                        continue
                    found, away = index[len(codes[q])].search(np.frombuffer(codes[q], np.uint8), k)
                    best = sorted((int(d), x) for f, d in zip(found, away, strict=True) for x in ids[own[f]])[:k]
                    out += [(codes[q], x, d) for d, x in best]
                if not out:
                    continue
                q, x, d = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.binary()), pa.array(x, pa.int64()), pa.array(d, pa.int32())], names=["query", "id", "distance"])

    return dealt.mapInArrow(run, "query binary, id long, distance int")


def nearest_codes(
    vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), neighbour_id, distance: the k nearest rows of each row whose id ``every`` divides."""
    codes = materialize(binary_codes(vectors, id_col, vector_col))
    first = Window.partitionBy("code").orderBy("id")
    kept = codes.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k)
    classes = materialize(kept.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")))  # at most k ids a code
    queries = codes.filter(F.pmod("id", F.lit(every)) == 0)
    asked = materialize(queries.select("code").distinct())
    number, longest = classes.agg(F.count(F.lit(1)), F.max(F.octet_length("code"))).first()
    code_blocks = max(1, -(-number // max(1, min(MOST_CODES, CODE_BYTES // (longest or 1)))))
    asking = asked.count()
    query_blocks = max(1, -(-asking // QUERY_BLOCK), min(-(-TASKS // code_blocks), -(-asking // LEAST_QUERIES)))
    block = lambda n: F.pmod(F.xxhash64("code", F.lit(n)), F.lit(n)).cast("long")
    a = classes.select(block(code_blocks).alias("c"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"), F.lit(0).alias("side"), "code", "ids")
    b = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(code_blocks - 1))).alias("c"), block(query_blocks).alias("q"), F.lit(1).alias("side"), "code", F.lit(None).cast("array<bigint>").alias("ids")
    )
    tasks = a.union(b).select((F.col("c") * query_blocks + F.col("q")).cast("long").alias("task"), "side", "code", "ids")
    hits = _search_blocks(tasks.repartition(code_blocks * query_blocks, "task").sortWithinPartitions("task", "side"), k)
    best = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))).filter(F.col("rank") <= k)
    best = best.select(F.col("query").alias("code"), "rank", F.col("id").alias("neighbour_id"), "distance")
    return queries.join(best, "code").select(F.col("id").alias("query_id"), F.col("rank").cast("int").alias("rank"), "neighbour_id", "distance")
