"""Reference data: snapshot rules, proven code changes, the trading calendar and the check of axes against it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def series_rule(local: DataFrame, incoming: DataFrame, value: str) -> DataFrame:
    """One row for a value set: nulls and repeats on either side, values lost and added, and the verdict."""
    sides = local.select(F.col(value), F.lit("local").alias("_side")).unionByName(incoming.select(F.col(value), F.lit("incoming").alias("_side")))
    keyed = sides.groupBy(value).agg(F.count_if(F.col("_side") == "local").alias("l"), F.count_if(F.col("_side") == "incoming").alias("i"))
    known = F.col(value).isNotNull()
    out = keyed.agg(
        F.coalesce(F.sum(F.when(~known, F.col("l") + F.col("i"))), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(F.when(known, F.greatest(F.col("l") - 1, F.lit(0)) + F.greatest(F.col("i") - 1, F.lit(0)))), F.lit(0)).alias("repeats"),
        F.count_if(known & (F.col("i") == 0)).alias("lost"),
        F.count_if(known & (F.col("l") == 0)).alias("added"),
    )
    verdict = (
        F.when(F.col("nulls") > 0, "nulls").when(F.col("repeats") > 0, "repeats").when(F.col("lost") == 0, "accepted")
        .when(F.col("added") == 0, "already applied").otherwise("lost values")
    )
    return out.withColumn("verdict", verdict)


def code_changes(local: DataFrame, incoming: DataFrame, key: str = "stkcode", identity: str = "compcode") -> DataFrame:
    """(identity, old key, new key): identities with exactly one lost key and exactly one added key."""
    lost = local.join(incoming.select(key), key, "left_anti").filter(F.col(identity).isNotNull())
    added = incoming.join(local.select(key), key, "left_anti").filter(F.col(identity).isNotNull())
    single = lambda df, name: df.groupBy(identity).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias(name)).filter("n = 1").drop("n")
    return single(lost, "old_key").join(single(added, "new_key"), identity)


def table_rule(local: DataFrame, incoming: DataFrame, key: str = "stkcode", identity: str | None = "compcode") -> DataFrame:
    """One row for a keyed table: as ``series_rule`` on keys, less the proven code changes. Columns and their order
    must be the same."""
    if local.columns != incoming.columns:
        raise ValueError("the fields or their order changed")
    base = series_rule(local.select(key), incoming.select(key), key).drop("verdict")
    changes = code_changes(local, incoming, key, identity) if identity in local.columns else None
    number = changes.agg(F.count(F.lit(1)).alias("changed")) if changes is not None else base.select(F.lit(0).alias("changed"))
    one = base.crossJoin(number).withColumns({"lost": F.col("lost") - F.col("changed"), "added": F.col("added") - F.col("changed")})  # single rows
    verdict = (
        F.when(F.col("nulls") > 0, "nulls").when(F.col("repeats") > 0, "repeats").when(F.col("lost") == 0, "accepted")
        .when(F.col("added") == 0, "already applied").otherwise("lost keys")
    )
    return one.withColumn("verdict", verdict)


def reference_window(calendar: DataFrame, length: int = 1000, day: str = "day") -> DataFrame:
    """The last ``length`` days of the calendar, held as a local table of that many rows, so that what uses it several
    times does not read the calendar again; a shorter calendar is an error."""
    window = calendar.select(day).filter(F.col(day).isNotNull()).distinct().orderBy(F.desc(day)).limit(length)
    days = window.collect()  # ``length`` rows, whatever the calendar
    if len(days) < length:
        raise ValueError(f"the calendar has fewer than {length} days")
    return calendar.sparkSession.createDataFrame(days, window.schema)


def axis_consistency(axes: DataFrame, window: DataFrame, most_lag: int = 5) -> DataFrame:
    """Every axis (rows axis, day) against the window in one job: start, last, missing, extra, lag and level.

    Days inside the window's range count; from the first of them (or the axis's last day, if there is none) to the
    last one every window day is expected. Days that the window does not have are extra. What the window has after
    the last day is the lag: up to ``most_lag`` a warning, beyond it an error, as any hole or extra day is. Days
    after the window's end are not judged. The window has a fixed length, hence is broadcast."""
    days = axes.select("axis", "day").distinct()
    ends = window.agg(F.min("day").alias("w0"), F.max("day").alias("wn"))
    marked = days.join(F.broadcast(window.withColumn("_known", F.lit(True))), "day", "left").join(F.broadcast(ends))
    inside = F.col("day").between(F.col("w0"), F.col("wn"))
    spans = marked.groupBy("axis").agg(
        F.max("day").alias("last"), F.min(F.when(inside, F.col("day"))).alias("first_inside"),
        F.count_if(inside & F.col("_known").isNull()).alias("extra"), F.count_if(inside & F.col("_known").isNotNull()).alias("present"),
    )
    ordered = window.agg(F.sort_array(F.collect_list("day")).alias("days"))  # the window: a fixed number of days
    one = spans.join(F.broadcast(ordered)).withColumn("start", F.coalesce("first_inside", "last"))
    expected = F.size(F.filter("days", lambda d: (d >= F.col("start")) & (d <= F.col("last"))))
    lag = F.size(F.filter("days", lambda d: d > F.col("last")))
    out = one.select("axis", "start", "last", (expected - F.col("present")).cast("long").alias("missing"), "extra", lag.cast("long").alias("lag"))
    level = F.when((F.col("missing") > 0) | (F.col("extra") > 0) | (F.col("lag") > most_lag), "error").when(F.col("lag") > 0, "warning").otherwise("ok")
    return out.withColumn("level", level)
