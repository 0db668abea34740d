"""Intermediate tables, written once and read several times.

They lie in the folder that the cluster names in ``spark.checkpoint.dir``, which all nodes share. The lineage of a
table that is read back ends at its files, so a lost executor costs nothing that was written.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, else the context's checkpoint folder. Where neither is set a temporary one
    is, on one machine; on a cluster that is an error, as its nodes have no folder of one machine in common."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        folder = tempfile.mkdtemp(prefix="ledgerloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, tidy: bool = True) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The files go when the driver exits, or earlier by ``drop`` or ``release``. With ``tidy`` the driver collects
    garbage at once, so that Spark also deletes the shuffle files that nothing needs any more.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/ledgerloom-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    if tidy:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._ledgerloom_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop(*tables: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these tables; nothing may read them any more."""
    for df in tables:
        _delete(df.sparkSession, df._ledgerloom_path)
        _written.remove((df.sparkSession, df._ledgerloom_path))


def release() -> None:
    """Delete everything that ``materialize`` wrote."""
    while _written:
        try:
            _delete(*_written.pop())
        except Exception:  # noqa: BLE001 - the session may have ended; its folder goes with the cluster
            return


atexit.register(release)
