"""Queries that cover whole tables: no code, field or day is left out."""

from ledgerloom.plans import registry
from tests.oracle import differences, duck

SF = "/root/testdata/sf0.01"


def test_minute_pivot_has_every_code_and_field(spark):
    df = registry.queries()["minute_pivot"](spark, SF)
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert df.select("code").distinct().count() == events.filter("user_id between 0 and 999999").select("user_id").distinct().count() > 20
    assert set(df.columns) == {"datetime", "code", "open", "high", "low", "close", "volume", "amount"}
    assert differences(df, duck(SF), registry.oracle_sql()["minute_pivot"]) == ""


def test_daily_bundle_has_every_day_and_field(spark):
    df = registry.queries()["daily_bundle"](spark, SF)
    days = spark.read.parquet(f"{SF}/events.parquet").filter("user_id % 7 <> 3").selectExpr("CAST(ts AS DATE)").distinct().count()
    assert df.select("date").distinct().count() == days > 1
    assert set(df.columns) == {"date", "symbol", "adjfactor", "daily_volume", "daily_amount", "daily_adj_vwap", *(f"daily_adj_{p}" for p in ("open", "high", "low", "close"))}
    assert differences(df, duck(SF), registry.oracle_sql()["daily_bundle"]) == ""
