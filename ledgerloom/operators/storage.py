"""Digests, currency, versions and tallies as plans over listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Limits of an archive: members, bytes of a member, bytes in all, and expansion.
MEMBERS, MEMBER_BYTES, TOTAL_BYTES, RATIO = 20_000, 8 << 30, 128 << 30, 1000


def archive_faults(members: DataFrame, most: int = MEMBERS, member_bytes: int = MEMBER_BYTES, total_bytes: int = TOTAL_BYTES, ratio: int = RATIO) -> DataFrame:
    """Per archive: its totals and the first limit that it breaks, else 'ok'."""
    expanded = F.when(F.col("compressed_size") > 0, F.col("file_size") / F.when(F.col("compressed_size") > 0, F.col("compressed_size")))
    found = members.groupBy("archive").agg(
        F.count(F.lit(1)).alias("members"), F.max("file_size").alias("largest"), F.sum("file_size").alias("total"), F.max(expanded).alias("ratio"),
        F.count_if((F.col("compressed_size") == 0) & (F.col("file_size") > 0)).alias("impossible"),
    )
    verdict = (
        F.when(F.col("members") > most, "members").when(F.col("largest") > member_bytes, "member size").when(F.col("total") > total_bytes, "total size")
        .when(F.col("impossible") > 0, "no compressed bytes").when(F.col("ratio") > ratio, "ratio").otherwise("ok")
    )
    return found.withColumn("verdict", verdict)


def currency(sources: DataFrame, recorded: DataFrame, targets: DataFrame) -> DataFrame:
    """(key, current): whether the recorded digest is the source's and the target exists."""
    known = sources.join(recorded.select("key", F.col("digest").alias("recorded")), "key", "left").join(targets.select("key").distinct().withColumn("there", F.lit(True)), "key", "left")
    return known.select("key", (F.col("digest").eqNullSafe(F.col("recorded")) & F.col("there").isNotNull()).alias("current"))


def digests(files: DataFrame, key: str, content: str) -> DataFrame:
    """(key, digest): SHA-256 of each content; a missing one counts as empty."""
    return files.select(key, F.sha2(F.coalesce(F.col(content).cast("binary"), F.lit(b"")), 256).alias("digest"))


def group_digest(files: DataFrame, by: str = "name") -> DataFrame:
    """Per group of files: SHA-256 over name, NUL, digest, newline of each in order of ``by``. Groups are listings."""
    line = F.concat("name", F.lit("\0"), "digest", F.lit("\n"))
    listed = files.groupBy("group").agg(F.sort_array(F.collect_list(F.struct(by, line.alias("line")))).alias("l"))
    return listed.select("group", F.sha2(F.array_join(F.transform("l", lambda x: x["line"]), ""), 256).alias("digest"))


def changed_contents(now: DataFrame, noted: DataFrame, key: str = "path") -> DataFrame:
    """(key, digest) of what was noted and has another content than at the latest time, by ``noted``."""
    known = latest(noted, key, "noted", ["digest"]).select(key, F.col("digest").alias("known"))
    return now.join(known, key).filter("digest <> known").select(key, "digest")


def match_names(held: DataFrame, delivered: DataFrame) -> DataFrame:
    """(name, state): names of a delivery against those of the history: matched, missing or extra."""
    both = held.select("name").distinct().withColumn("_held", F.lit(True)).join(delivered.select("name").distinct().withColumn("_delivered", F.lit(True)), "name", "full")
    return both.select("name", F.when(F.col("_held").isNull(), "extra").when(F.col("_delivered").isNull(), "missing").otherwise("matched").alias("state"))


def names_twice(files: DataFrame) -> DataFrame:
    """(name, files, first_path) of names at several places, from rows (path, name)."""
    return files.groupBy("name").agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("first_path")).filter("files > 1")


def latest(versions: DataFrame, key: str, version: str, columns: list[str]) -> DataFrame:
    """The row of the newest version of each key, by one aggregation."""
    return versions.groupBy(key).agg(F.max_by(F.struct(*columns), version).alias("_row"), F.max(version).alias(version)).select(key, version, *(f"_row.{c}" for c in columns))


def tally(issues: DataFrame) -> DataFrame:
    """Per source: issues by level and the worst one."""
    rank = F.when(F.col("level") == "FAIL", 2).when(F.col("level") == "WARNING", 1).otherwise(0)
    found = issues.groupBy("source").agg(F.count_if(F.col("level") == "FAIL").alias("fails"), F.count_if(F.col("level") == "WARNING").alias("warnings"), F.max(rank).alias("worst"))
    return found.withColumn("status", F.element_at(F.array(F.lit("PASS"), F.lit("WARNING"), F.lit("FAIL")), F.col("worst") + 1)).drop("worst")
