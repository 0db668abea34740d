"""Market-shaped views of the star-schema tables, for queries and benchmarks. Each has its SQL twin in ``oracle``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import divide
from ..operators.minute import PRICES, roll_up

SYMBOL = "CONCAT(LPAD(CAST(code AS STRING), 6, '0'), CASE WHEN code % 2 = 0 THEN '.SZ' ELSE '.SH' END)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as one-minute bars; some opens and highs are missing."""
    e = table(spark, sf_dir, "events")
    v, n = F.col("value"), F.col("event_id")
    return e.select(
        F.col("user_id").alias("code"), F.date_format("ts", "yyyyMMdd").cast("int").alias("date"), F.date_format("ts", "HHmm").cast("int").alias("time"),
        F.when(n % 13 != 0, v).alias("open"), F.when(n % 29 != 0, v + (n % 3) * 0.5).alias("high"), (v - (n % 4) * 0.25).alias("low"),
        (v + (n % 5 - 2) * 0.125).alias("close"), (n % 1000).cast("double").alias("volume"), (F.floor(v) * (n % 1000)).cast("double").alias("amount"), n.alias("row_id"),
    )


def factor():
    return F.when(F.col("code") % 17 != 0, 1 + (F.col("code") % 8) / 8.0)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows from the roll-up, with a planted error where (code + date) % 11 = 0 and codes left out."""
    r = roll_up(bars(spark, sf_dir)).filter("code % 7 <> 3").withColumn("adjfactor", factor())
    planted = F.when((F.col("code") + F.col("date")) % 11 == 0, 0.5).otherwise(0.0)
    return r.select(
        "code", "date", F.expr(SYMBOL).alias("symbol"), "adjfactor",
        *(((F.col(p) + (planted if p == "close" else F.lit(0.0))) * F.col("adjfactor")).alias(f"daily_adj_{p}") for p in PRICES),
        (F.col("volume") / 10000.0).alias("daily_volume"), (F.col("amount") / 1000000.0).alias("daily_amount"),
        (divide(F.col("amount"), F.col("volume")) * F.col("adjfactor")).alias("daily_adj_vwap"),
    )


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates x suppliers: the largest price of a ship day."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("date"), F.col("l_suppkey").alias("stock")).agg(F.max("l_extendedprice").alias("value"))


def local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix(spark, sf_dir).filter("date < DATE'2000-01-01'")


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("stock")
    value = F.when(s % 19 == 0, None).when(s % 17 == 0, F.col("value") * 1.001).otherwise(F.col("value"))
    return matrix(spark, sf_dir).filter("date >= DATE'1999-06-01' AND stock % 10 <> 3").withColumn("value", value)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()


def axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days per nation; for some nations days that the calendar lacks are added (half days are whole days off)."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    base = o.join(c, o.o_custkey == c.c_custkey).select(F.col("c_nationkey").alias("axis"), F.col("o_orderdate").cast("date").alias("day"), "o_orderkey")
    shifted = base.filter("axis % 5 = 0 AND o_orderkey % 97 = 0").select("axis", F.expr("date_add(day, 3)").alias("day"))
    ended = base.filter("axis % 3 <> 0 OR day < DATE'2001-07-27'").select("axis", "day")
    return ended.unionByName(shifted)


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of a reference table (stkcode, name, compcode); codes change for some companies."""
    c = table(spark, sf_dir, "customer")
    shape = lambda key: [key.alias("stkcode"), F.col("c_mktsegment").alias("name"), F.when(F.col("c_custkey") % 40 != 0, F.col("c_name")).alias("compcode")]
    key = F.col("c_custkey")
    old = c.filter(key % 10 != 7).select(*shape(key))
    new = c.filter(key % 25 != 3).select(*shape(F.when(key % 50 == 0, key + 1_000_000).otherwise(key)))
    return old, new


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive members from pages: archive, member, file_size, compressed_size."""
    p = table(spark, sf_dir, "pages")
    size = F.length("html").cast("long")
    return p.select((F.col("page_id") % 20).alias("archive"), F.col("page_id").alias("member"), size.alias("file_size"), F.expr("CAST(length(html) AS BIGINT) DIV (1 + page_id % 7)").alias("compressed_size"))
