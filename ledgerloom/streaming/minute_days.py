"""New minute days as a stream: a file source of Parquet bars, each bar taken once, whatever files bring it.

A bar is known by (date, code, time). A day may come in several files and batches, and again: bars that the history
has are compared, not taken; a bar that comes with other values stops the stream, and nothing of its batch is
written. A batch that runs twice changes nothing.

The file source remembers paths, so a file that is corrected in place is not seen by it. With ``digests``, a folder of
(path, digest) rows, every file's content is noted when it is taken; ``corrected_files`` tells which have changed
since, and ``take_corrections`` writes their days anew from all files that have them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.minute import KEY, changed_bars, conflicting_bars, fresh_bars, single_bars
from ..operators.storage import changed_contents, digests as content_digests

SCHEMA = "code long, date int, time int, open double, high double, low double, close double, volume double, amount double, row_id long"


def _table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A Parquet folder, or None if there is none yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _single(bars: DataFrame) -> DataFrame:
    """One row a bar; equal repeats are one, others are an error."""
    _refuse(conflicting_bars(bars), "minute bars repeat with other values")
    return single_bars(bars).select(*(c.split()[0] for c in SCHEMA.split(", ")))


def _refuse(keys: DataFrame, text: str) -> None:
    if found := keys.select(*KEY).limit(5).collect():
        raise ValueError(f"{text}: {', '.join(str(tuple(r)) for r in found)}")


def _append(bars: DataFrame, history: str) -> None:
    """Add the bars that the history lacks; those that it has must be equal."""
    bars = _single(bars).persist()
    try:
        days = [r[0] for r in bars.select("date").distinct().collect()]  # of one batch: its files' days
        known = _table(bars.sparkSession, history, SCHEMA)
        if known is not None:
            known = known.filter(F.col("date").isin(days))
            _refuse(changed_bars(bars, known), "minute bars differ from the history")
            new = fresh_bars(bars, known)
        else:
            new = bars
        new.repartition("date").sortWithinPartitions(*KEY).write.mode("append").partitionBy("date").parquet(history)
    finally:
        bars.unpersist()


def _contents(spark: SparkSession, paths: list[str]) -> DataFrame:
    return content_digests(spark.read.format("binaryFile").load(paths), "path", "content").withColumn("noted", F.current_timestamp())


def ingest_days(spark: SparkSession, landing: str, history: str, checkpoint: str, digests: str | None = None, files: int = 64) -> StreamingQuery:
    """Append to the history, partitioned by day, what new files under ``landing`` bring; ``files`` a batch at most."""

    def apply(batch: DataFrame, _: int) -> None:
        _append(batch.drop("_path"), history)
        if digests is not None:
            paths = [r[0] for r in batch.select("_path").distinct().collect()]  # at most ``files``
            if paths:
                _contents(batch.sparkSession, paths).write.mode("append").parquet(digests)

    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(landing).select("*", F.col("_metadata.file_path").alias("_path"))
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def corrected_files(spark: SparkSession, landing: str, digests: str) -> DataFrame:
    """(path, digest) of files that were taken and have another content now."""
    noted = _table(spark, digests)
    now = content_digests(spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(landing), "path", "content")
    return now.limit(0) if noted is None else changed_contents(now, noted)


def take_corrections(spark: SparkSession, landing: str, history: str, digests: str) -> list[int]:
    """Write the days of corrected files anew, from all files that have them, and note the new contents. The days."""
    paths = [r[0] for r in corrected_files(spark, landing, digests).collect()]  # corrections are few
    if not paths:
        return []
    changed = spark.read.schema(SCHEMA).parquet(*paths).select("date").distinct()
    held = _table(spark, history, SCHEMA)
    days = {r[0] for r in changed.collect()}
    every = spark.read.schema(SCHEMA).parquet(landing)
    rewritten = _single(every.filter(F.col("date").isin(list(days))))
    if held is not None:  # a day that a correction no longer has is left as it is
        days &= {r[0] for r in rewritten.select("date").distinct().collect()}
    rewritten.repartition("date").sortWithinPartitions(*KEY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(history)
    _contents(spark, paths).write.mode("append").parquet(digests)
    return sorted(days)
