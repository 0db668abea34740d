"""The registered queries of the market-data engine, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import bar_end, symbol_code, valid_code
from ..operators import matrix, minute, quality, reference, storage
from . import bridge
from .oracle import SQL

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def query(f: Query) -> Query:
    _queries[f.__name__] = f
    return f


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*(F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _comparison(spark: SparkSession, d: str) -> DataFrame:
    return quality.compare(minute.roll_up(bridge.bars(spark, d)), bridge.daily(spark, d))


@query
def ohlcv_rollup(spark, d):
    return minute.roll_up(bridge.bars(spark, d))


@query
def extreme_times(spark, d):
    return minute.roll_up(bridge.bars(spark, d)).select("code", "date", "high", "high_time", "low", "low_time")


@query
def unmatched_codes(spark, d):
    return quality.unmatched(minute.roll_up(bridge.bars(spark, d)), bridge.daily(spark, d))


@query
def price_comparison(spark, d):
    kept = ["code", "date", "symbol", *(f"{x}_{p}" for x in ("minute_adj", "daily_raw", "raw_diff") for p in minute.PRICES), "unit_volume", "unit_amount", "minute_vwap", "minute_adj_vwap", "daily_raw_vwap"]
    return _rounded(_comparison(spark, d).select(*kept))


@query
def complete_rows(spark, d):
    return quality.complete(_comparison(spark, d)).select("code", "date", "symbol")


@query
def price_stats(spark, d):
    return _rounded(quality.statistics(_comparison(spark, d)))


@query
def mismatch_table(spark, d):
    return _rounded(quality.mismatches(quality.complete(_comparison(spark, d))))


@query
def mismatch_topk(spark, d):
    return _rounded(quality.mismatches(quality.complete(_comparison(spark, d))).orderBy(F.desc("adjusted_abs_error"), "code", "date", "field").limit(20))


@query
def symbol_parse(spark, d):
    c = bridge.table(spark, d, "customer")
    text = F.expr("CASE WHEN c_custkey % 5 = 0 THEN c_name WHEN c_custkey % 5 = 1 THEN CONCAT(LPAD(CAST(c_custkey AS STRING), 6, '0'), '.S1') ELSE CONCAT(LPAD(CAST(c_custkey AS STRING), 6, '0'), '.SZ') END")
    return c.select("c_custkey", text.alias("symbol")).withColumn("code", symbol_code(F.col("symbol")))


@query
def valid_codes(spark, d):
    p = bridge.table(spark, d, "part").select("p_partkey", F.expr("CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey * 1000 AS STRING) WHEN p_partkey % 4 = 1 THEN CAST(p_retailprice AS STRING) WHEN p_partkey % 4 = 2 THEN p_name ELSE CAST(p_partkey AS STRING) END").alias("text"))
    return p.select("p_partkey", F.coalesce(valid_code(F.col("text")), F.lit(False)).alias("valid"))


@query
def symbol_conflicts(spark, d):
    c = bridge.table(spark, d, "customer")
    return matrix.symbol_conflicts(c.select(F.expr("CONCAT(LPAD(CAST(c_custkey % 700 AS STRING), 6, '0'), CASE WHEN c_nationkey % 9 = 0 THEN '.SH' ELSE '.SZ' END)").alias("symbol")))


@query
def duplicate_minutes(spark, d):
    return minute.duplicate_bars(bridge.bars(spark, d))


@query
def day_validation(spark, d):
    b = bridge.bars(spark, d)
    return minute.day_faults(b.withColumn("file_date", F.expr("CASE WHEN row_id % 2000 = 0 THEN date - date % 100 + 1 ELSE date END")))


@query
def bar_end_timestamps(spark, d):
    return bridge.bars(spark, d).select("row_id", bar_end(F.col("date"), F.col("time")).alias("datetime"))


def _adjusted(spark: SparkSession, d: str) -> DataFrame:
    b = bridge.bars(spark, d)
    factors = b.select("date", "code").distinct().withColumn("factor", bridge.factor())
    return minute.adjust(b, factors)


@query
def adjusted_prices(spark, d):
    return _adjusted(spark, d)


@query
def minute_pivot(spark, d):
    """All six fields of every code, in long form; conversion pivots the same rows on the listed universe."""
    return minute.cells(_adjusted(spark, d))


@query
def overlap_report(spark, d):
    return _rounded(matrix.overlap_report(bridge.local(spark, d), bridge.incoming(spark, d)), 12)


@query
def overlap_examples(spark, d):
    return matrix.overlap_examples(bridge.local(spark, d), bridge.incoming(spark, d))


@query
def covers_dates(spark, d):
    return matrix.not_covered(bridge.local(spark, d), bridge.incoming(spark, d), "date")


@query
def covers_stocks(spark, d):
    return matrix.not_covered(bridge.local(spark, d), bridge.incoming(spark, d), "stock")


@query
def overlay_merge(spark, d):
    return matrix.overlay(bridge.local(spark, d), bridge.incoming(spark, d))


@query
def overlay_gaps(spark, d):
    return matrix.overlay_gaps(bridge.local(spark, d), bridge.incoming(spark, d))


@query
def ordered_axis_union(spark, d):
    s = bridge.table(spark, d, "supplier")
    base = s.filter("s_suppkey % 4 <> 1").select(F.col("s_suppkey").alias("stock"), (-F.col("s_suppkey")).alias("at"))
    more = s.filter("s_suppkey % 3 <> 1").select(F.col("s_suppkey").alias("stock"), F.col("s_suppkey").alias("at"))
    return matrix.ordered_union(base, more, "stock", "at")


@query
def axis_classifier(spark, d):
    part = lambda name, columns: bridge.table(spark, d, name).selectExpr(*columns)
    axes = (
        part("orders", ["'order days' AS axis", "'integer' AS kind", "date_format(o_orderdate, 'yyyyMMdd') AS label"])
        .unionByName(part("orders", ["'order text' AS axis", "'text' AS kind", "date_format(o_orderdate, 'yyyyMMdd') AS label"]))
        .unionByName(part("events", ["'event times' AS axis", "'datetime' AS kind", "CAST(ts AS STRING) AS label"]))
        .unionByName(part("part", ["'parts' AS axis", "'integer' AS kind", "CAST(p_partkey AS STRING) AS label"]))
        .unionByName(part("part", ["'far days' AS axis", "'integer' AS kind", "CAST(p_partkey + 21001200 AS STRING) AS label"]))
    )
    return matrix.axis_kinds(axes)


@query
def series_snapshot(spark, d):
    c = bridge.table(spark, d, "customer")
    old = c.filter("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("value"))
    new = c.filter("c_custkey % 7 <> 0").select(F.expr("CASE WHEN c_custkey % 9 = 0 THEN c_custkey - 1 ELSE c_custkey END").alias("value"))
    return reference.series_rule(old, new, "value")


@query
def table_snapshot(spark, d):
    return reference.table_rule(*bridge.snapshots(spark, d))


@query
def code_changes(spark, d):
    return reference.code_changes(*bridge.snapshots(spark, d))


@query
def reference_window(spark, d):
    return reference.reference_window(bridge.calendar(spark, d), 1000)


@query
def axis_consistency(spark, d):
    return reference.axis_consistency(bridge.axes(spark, d), reference.reference_window(bridge.calendar(spark, d), 1000))


@query
def tail_lag(spark, d):
    return reference.axis_consistency(bridge.axes(spark, d), reference.reference_window(bridge.calendar(spark, d), 1000)).select("axis", "lag")


@query
def day_diff_unequal_fields(spark, d):
    old = bridge.bars(spark, d)
    new = old.filter("row_id % 700 <> 1").withColumns({"close": F.expr("CASE WHEN row_id % 500 = 0 THEN close + 1 ELSE close END"), "open": F.expr("CASE WHEN row_id % 400 = 0 THEN NULL ELSE open END")})
    return minute.unequal_fields(old, new)


@query
def daily_normalize(spark, d):
    c = bridge.table(spark, d, "orders")
    shaped = c.selectExpr("CASE WHEN o_orderkey % 50 = 0 THEN '20261301' ELSE date_format(o_orderdate, 'yyyyMMdd') END AS day", "CONCAT(LPAD(CAST(o_custkey AS STRING), 6, '0'), CASE WHEN o_custkey % 6 = 0 THEN '.X' ELSE '.SZ' END) AS symbol", "o_totalprice AS value")
    return matrix.normalize_daily(shaped)


@query
def daily_bundle(spark, d):
    """All eight daily fields of every day."""
    return _rounded(bridge.daily(spark, d).drop("code"))


@query
def archive_caps(spark, d):
    return _rounded(storage.archive_faults(bridge.members(spark, d), most=20, member_bytes=9000, total_bytes=60000, ratio=6))


@query
def content_digest(spark, d):
    return storage.digests(bridge.table(spark, d, "documents"), "doc_id", "text")


@query
def group_digest(spark, d):
    files = bridge.table(spark, d, "customer").select(F.col("c_nationkey").alias("group"), F.col("c_name").alias("name"), F.sha2(F.concat("c_name", "c_mktsegment"), 256).alias("digest"))
    return storage.group_digest(files)


@query
def manifest_currency(spark, d):
    docs = bridge.table(spark, d, "documents").select(F.col("doc_id").alias("key"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    recorded = docs.filter("key % 4 <> 1").withColumn("digest", F.expr("CASE WHEN key % 9 = 0 THEN 'old' ELSE digest END"))
    return storage.currency(docs, recorded, docs.filter("key % 11 <> 5"))


@query
def staged_latest_version(spark, d):
    o = bridge.table(spark, d, "orders").select(F.col("o_custkey").alias("target"), F.col("o_orderkey").alias("version"), F.col("o_totalprice").alias("value"), F.col("o_orderstatus").alias("state"))
    return storage.latest(o, "target", "version", ["value", "state"])


@query
def issue_tally(spark, d):
    o = bridge.table(spark, d, "orders").selectExpr("o_custkey % 50 AS source", "CASE WHEN o_custkey % 50 < 10 AND o_orderkey % 3 = 0 THEN 'FAIL' WHEN o_custkey % 50 < 30 AND o_orderkey % 2 = 0 THEN 'WARNING' ELSE 'PASS' END AS level")
    return storage.tally(o)


@query
def catalog_duplicates(spark, d):
    """File names that a recursive listing has more than once."""
    return storage.names_twice(bridge.table(spark, d, "pages").selectExpr("url AS path", "regexp_extract(url, '[^/]*$', 0) AS name"))


@query
def delivery_match(spark, d):
    """Delivered names against the catalog: matched, missing and extra."""
    c = bridge.table(spark, d, "customer")
    return storage.match_names(c.filter("c_custkey % 3 <> 0").selectExpr("c_name AS name"), c.filter("c_custkey % 5 <> 0").selectExpr("c_name AS name"))


@query
def content_changes(spark, d):
    """What has another content than when it was noted last."""
    now = storage.digests(bridge.table(spark, d, "documents"), "doc_id", "text")
    first = now.filter("doc_id % 4 <> 1").selectExpr("doc_id", "CASE WHEN doc_id % 9 = 0 THEN 'old' ELSE digest END AS digest", "1 AS noted")
    again = now.filter("doc_id % 18 = 0").selectExpr("doc_id", "digest", "2 AS noted")
    return storage.changed_contents(now, first.unionByName(again), "doc_id")


def _one_a_key(spark: SparkSession, d: str) -> DataFrame:
    return bridge.bars(spark, d).groupBy(*minute.KEY).agg(*(F.max(v).alias(v) for v in minute.VALUES), F.min("row_id").alias("row_id"))


@query
def conflicting_bars(spark, d):
    return minute.conflicting_bars(bridge.bars(spark, d))


@query
def fresh_bars(spark, d):
    base = _one_a_key(spark, d)
    return minute.fresh_bars(base, base.filter("row_id % 3 <> 0"))


@query
def changed_bars(spark, d):
    base = _one_a_key(spark, d)
    batch = base.withColumns({"close": F.expr("CASE WHEN row_id % 500 = 0 THEN close + 1 ELSE close END"), "open": F.expr("CASE WHEN row_id % 700 = 0 THEN NULL ELSE open END")})
    return minute.changed_bars(batch, base.filter("row_id % 3 <> 0"))


@query
def unready_days(spark, d):
    b = bridge.bars(spark, d)
    days = b.select("date").unionByName(b.selectExpr("date + 1000000 AS date")).distinct()
    factors = days.filter("date % 4 <> 1").selectExpr("date", "1L AS code", "1D AS factor")
    return minute.unready_days(days, b.filter("code % 50 <> 3"), factors)


@query
def universe_prices(spark, d):
    """Adjusted bars of listed codes only."""
    b = bridge.bars(spark, d)
    factors = b.select("date", "code").distinct().withColumn("factor", bridge.factor())
    return minute.adjust(b, factors, b.filter("code % 7 <> 3").select("code").distinct())


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return {name: SQL[name] for name in _queries if name in SQL}
