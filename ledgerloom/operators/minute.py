"""Minute bars: daily roll-up, validation, comparison of two versions of a day, adjustment and pivot.

Bars are rows (code, date, time, open, high, low, close, volume, amount, row_id); ``row_id`` is the order in the
source and breaks ties of equal (code, time).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import bar_end, valid_code

PRICES = ("open", "high", "low", "close")
REQUIRED = ("code", "date", "time", *PRICES, "volume", "amount")
#: What a bar is known by, and what it says.
KEY = ("date", "code", "time")
VALUES = (*PRICES, "volume", "amount")


def roll_up(bars: DataFrame, keys: tuple[str, ...] = ("code", "date")) -> DataFrame:
    """One daily bar a key, by one aggregation with map-side combination. Missing values are skipped; sums of
    nothing are 0; the times of the extremes are the earliest ones."""
    at = F.struct("time", "row_id")
    first = lambda c: F.when(F.col(c).isNotNull(), at)
    return bars.filter(F.col("code").isNotNull()).groupBy(*keys).agg(
        F.min_by("open", first("open")).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", first("close")).alias("close"),
        F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("amount"),
        F.min("time").alias("open_time"),
        F.max("time").alias("close_time"),
        F.min_by("time", F.when(F.col("high").isNotNull(), F.struct((-F.col("high")).alias("h"), "time", "row_id"))).alias("high_time"),
        F.min_by("time", F.when(F.col("low").isNotNull(), F.struct("low", "time", "row_id"))).alias("low_time"),
        F.count(F.lit(1)).alias("minute_rows"),
    )


def duplicate_bars(bars: DataFrame) -> DataFrame:
    """(date, code, time, rows) of keys on more than one row."""
    return bars.groupBy("date", "code", "time").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def day_faults(bars: DataFrame) -> DataFrame:
    """Per file day: rows, days found in it, repeated (code, time) keys. A sound day has 1 and 0; columns must exist."""
    missing = [c for c in REQUIRED if c not in bars.columns]
    if missing:
        raise ValueError(f"minute bars lack {', '.join(missing)}")
    keyed = bars.groupBy("file_date", "date", "code", "time").agg(F.count(F.lit(1)).alias("n"))
    return keyed.groupBy("file_date").agg(
        F.sum("n").alias("rows"), F.count_distinct("date").alias("days"), F.sum(F.col("n") - 1).alias("repeats"),
        F.max(F.when(F.col("date") != F.col("file_date"), 1).otherwise(0)).alias("strange"),
    )


def unequal_fields(old: DataFrame, new: DataFrame, fields: tuple[str, ...] = (*PRICES, "volume", "amount")) -> DataFrame:
    """Per day: the rows of each version and, by field, how many rows differ, whatever the rows' order. Rows are
    paired inside (date, code) by (time, row_id); types must agree."""
    for f in fields:
        if old.schema[f].dataType != new.schema[f].dataType:
            raise TypeError(f"{f} changed its type")
    order = Window.partitionBy("date", "code").orderBy("time", "row_id")
    number = lambda df, side: df.withColumn("n", F.row_number().over(order)).select(
        "date", "code", "n", *(F.col(c).alias(f"{side}_{c}") for c in ("time", *fields)), F.lit(1).alias(f"in_{side}")
    )
    both = number(old, "old").join(number(new, "new"), ["date", "code", "n"], "full")
    differs = lambda c: F.count_if(~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")))
    return both.groupBy("date").agg(
        F.count("in_old").alias("old_rows"), F.count("in_new").alias("new_rows"), *(differs(c).alias(f"{c}_differs") for c in ("time", *fields))
    )


def single_bars(bars: DataFrame) -> DataFrame:
    """Equal repeats of a bar as one row, with the smallest ``row_id``; bars without a code are left out."""
    return bars.filter("code is not null").groupBy(*KEY, *VALUES).agg(F.min("row_id").alias("row_id"))


def conflicting_bars(bars: DataFrame) -> DataFrame:
    """Keys of bars that come with more than one set of values."""
    return single_bars(bars).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*KEY)


def changed_bars(bars: DataFrame, known: DataFrame) -> DataFrame:
    """Keys of bars that the history has with other values."""
    held = known.select(*KEY, *(F.col(v).alias(f"known_{v}") for v in VALUES))
    unequal = reduce(lambda a, b: a | b, (~F.col(v).eqNullSafe(F.col(f"known_{v}")) for v in VALUES))
    return bars.join(held, list(KEY)).filter(unequal).select(*KEY).distinct()


def fresh_bars(bars: DataFrame, known: DataFrame) -> DataFrame:
    """Bars that the history lacks, whatever days and files they come in."""
    return bars.join(known.select(*KEY), list(KEY), "left_anti")


def unready_days(days: DataFrame, bars: DataFrame, factors: DataFrame) -> DataFrame:
    """(date, reason) of days that can't be adjusted: without factors, without bars, or with a bar twice."""
    known = factors.groupBy("date").agg(F.lit(True).alias("factors"))
    kept = bars.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).groupBy("date").agg(F.max("n").alias("most"))
    state = days.select("date").distinct().join(known, "date", "left").join(kept, "date", "left")
    reason = F.when(F.col("factors").isNull(), "no factors").when(F.col("most").isNull(), "no bars of listed codes").when(F.col("most") > 1, "bars repeat")
    return state.select("date", reason.alias("reason")).filter("reason is not null")


def adjust(bars: DataFrame, factors: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Bars of valid codes with prices times the (date, code) factor and the bar's end; without a factor prices are
    NULL. ``factors`` joins by (date, code); adaptive execution broadcasts it when it is small."""
    kept = bars.filter(valid_code(F.col("code").cast("string")))
    if universe is not None:
        kept = kept.join(universe, "code", "left_semi")
    joined = kept.join(factors.select("date", "code", "factor"), ["date", "code"], "left")
    return joined.select(
        bar_end(F.col("date"), F.col("time")).alias("datetime"), "code", *((F.col(c) * F.col("factor")).alias(c) for c in PRICES), "volume", "amount", "row_id"
    )


def pivot_field(adjusted: DataFrame, field: str, universe: list[int]) -> DataFrame:
    """Wide frame of one field: a row a datetime, a column a code of ``universe`` in ascending order. The last step
    of a plan; values are listed, so no extra job looks for them."""
    codes = sorted(universe)
    return adjusted.groupBy("datetime").pivot("code", codes).agg(F.max(field)).select("datetime", *(f"`{c}`" for c in codes))


def cells(adjusted: DataFrame, fields: tuple[str, ...] = (*PRICES, "volume", "amount")) -> DataFrame:
    """The wide frames of all ``fields`` in long form: a row a (datetime, code) over all codes, with no list of them."""
    return adjusted.groupBy("datetime", "code").agg(*(F.max(f).alias(f) for f in fields))
