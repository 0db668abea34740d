"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import drop, materialize, release, shared_folder  # noqa: F401 - taken from here by the operators

#: Rows of text that one Arrow batch may hold in a Python worker; long texts make a batch large.
BATCH_ROWS = 256
ARROW_ROWS = 512
#: Tables in fewer partitions are dealt over the cores before texts are worked on.
SPREAD_PARTS = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir``, read by Spark alone (any file system that it knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """``df`` (a written table of ids and numbers) marked for broadcast if it has at most ``rows`` rows; else as it is,
    and the join is by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(df: DataFrame, few: int = SPREAD_PARTS) -> DataFrame:
    """``df``, dealt anew over the cores if its rows lie in fewer partitions than there are cores and than ``few``.

    One Parquet row group is one task, so a small table of one file would occupy one core. The partitions that have
    rows are counted without reading a column; tables of ``few`` partitions or more stay as they are, and nothing of
    them is shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    held = df.select(F.spark_partition_id().alias("part")).distinct().count()
    return df.repartition(cores) if held < min(cores, few) else df


def bounded_batches(spark: SparkSession) -> None:
    """Cut Arrow batches to ``ARROW_ROWS`` rows in this session, unless it has its own setting: whole texts are long,
    and a batch is held by the JVM and by the Python worker at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(ARROW_ROWS))


def map_text(
    df: DataFrame, key: str, text: str, row: Callable[[str], tuple], schema: str, setup: Callable[[], object] | None = None
) -> DataFrame:
    """``row`` of each whole text: columns ``key`` and those of ``schema``. A null text counts as empty.

    Only two columns reach Python, in Arrow batches; each row stands alone, so nothing is shuffled.
    """
    bounded_batches(df.sparkSession)
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [kinds[part.split()[1]] for part in schema.split(", ")]
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if setup is not None:
            setup()
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                found = [row(value or "") for value in part.column(1).to_pylist()]
                columns = list(zip(*found, strict=True)) if found else [[] for _ in names]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(column, kind) for column, kind in zip(columns, fields, strict=True))], names=[key, *names]
                )

    return spread(df.select(F.col(key), F.col(text).cast("string").alias(text))).mapInArrow(run, f"`{key}` {key_type}, {schema}")


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``key`` as tables, across the borders of batches. The input must be sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_pylist()
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            if held and held_key != keys[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, i - start))
            held_key = keys[start]
            start = i
    if held:
        yield pa.Table.from_batches(held)


def ranked(df: DataFrame, group: list[str], order: list[str], spread: str, rows_per_part: int = 50_000) -> DataFrame:
    """Add ``rank``: gapless from 0 within ``group``, without ever sorting a whole group in one task.

    Each group is split by a hash of ``spread`` into parts of about ``rows_per_part`` rows at most (when one
    group holds all rows); ranks inside a part come from a window on (group, part), and the parts' offsets
    from a running sum over the few rows (group, part, count).
    """
    from pyspark.sql import Window

    total = df.count()
    parts = max(16, min(4096, -(-total // rows_per_part) * 4))
    split = df.withColumn("_part", F.pmod(F.xxhash64(spread), F.lit(parts)).cast("int"))
    counts = split.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, "_part").orderBy(*order)
    numbered = split.withColumn("_inside", F.row_number().over(inside) - 1)
    same = [numbered[c].eqNullSafe(offsets[c]) for c in group] + [numbered["_part"] == offsets["_part"]]
    condition = same[0]
    for extra in same[1:]:
        condition = condition & extra
    return numbered.join(offsets, condition).select(
        *(numbered[c] for c in df.columns), (F.col("_before") + F.col("_inside")).cast("long").alias("rank")
    )
