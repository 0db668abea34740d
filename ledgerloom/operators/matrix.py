"""Date x stock matrices in long form, rows (date, stock, value): comparison, cover, overlay and axes.

A wide matrix is a full rectangle; in long form an absent row is a missing cell of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import deviation, symbol_code, unequal
from ..scratch import materialize


def dates(matrix: DataFrame) -> DataFrame:
    return matrix.select("date").distinct()


def stocks(matrix: DataFrame) -> DataFrame:
    return matrix.select("stock").distinct()


def _is_text(matrix: DataFrame) -> bool:
    return dict(matrix.dtypes)["value"] == "string"


def _paired(local: DataFrame, incoming: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(by, date, stock, local, incoming, in_local, in_incoming): both versions of every cell that either has, by one
    aggregation, written once: cells and both axes are taken from it."""
    side = lambda df, n: df.select(*by, "date", "stock", "value", F.lit(n).alias("side"))
    value = lambda n: F.max(F.when(F.col("side") == n, F.col("value")))
    has = lambda n: F.max(F.col("side") == n)
    both = side(local, 0).unionByName(side(incoming, 1))
    pairs = both.groupBy(*by, "date", "stock").agg(value(0).alias("local"), value(1).alias("incoming"), has(0).alias("in_local"), has(1).alias("in_incoming"))
    return materialize(pairs, tidy=False)


def _common(pairs: DataFrame, axis: str, by: tuple[str, ...]) -> DataFrame:
    """Labels of an axis that both versions have."""
    return pairs.groupBy(*by, axis).agg(F.max("in_local").alias("a"), F.max("in_incoming").alias("b")).filter("a and b").select(*by, axis)


def _overlap(pairs: DataFrame, rtol: float, atol: float, by: tuple[str, ...]) -> DataFrame:
    inside = pairs.join(_common(pairs, "date", by), [*by, "date"], "left_semi").join(_common(pairs, "stock", by), [*by, "stock"], "left_semi")
    exact = ~F.col("local").eqNullSafe(F.col("incoming"))
    text = dict(pairs.dtypes)["local"] == "string"
    return inside.select(*by, "date", "stock", "local", "incoming", (exact if text else unequal(F.col("local"), F.col("incoming"), rtol, atol)).alias("unequal"))


def overlap_cells(local: DataFrame, incoming: DataFrame, rtol: float, atol: float, by: tuple[str, ...] = ()) -> DataFrame:
    """Unequal-marked cells (date, stock, local, incoming, unequal) of common dates x common stocks that either has.
    Numbers are compared within tolerance, texts exactly. ``by`` names columns that tell several matrices apart."""
    return _overlap(_paired(local, incoming, by), rtol, atol, by)


def overlap_report(local: DataFrame, incoming: DataFrame, rtol: float = 1e-7, atol: float = 1e-7, by: tuple[str, ...] = ()) -> DataFrame:
    """One row a matrix: dates, stocks, mismatches, max_deviation, share of mismatches in the common rectangle."""
    pairs = _paired(local, incoming, by)
    cells = _overlap(pairs, rtol, atol, by)
    distance = F.lit(0.0) if _is_text(local) else deviation(F.col("local"), F.col("incoming"))
    found = cells.groupBy(*by).agg(F.count_if("unequal").alias("mismatches"), F.max(F.when(F.col("unequal"), distance)).alias("max_deviation"))
    number = lambda axis: _common(pairs, axis, by).groupBy(*by).agg(F.count(F.lit(1)).alias(f"{axis}s"))
    if by:  # a matrix without common labels has a row, too
        one = pairs.select(*by).distinct().join(found, list(by), "left").join(number("date"), list(by), "left").join(number("stock"), list(by), "left")
    else:
        one = found.crossJoin(number("date")).crossJoin(number("stock"))  # three single rows
    zero = one.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("dates", "stocks", "mismatches")} | {"max_deviation": F.coalesce("max_deviation", F.lit(0.0))})
    share = F.col("mismatches") / F.greatest(F.col("dates") * F.col("stocks"), F.lit(1))
    return zero.select(*by, "dates", "stocks", "mismatches", "max_deviation", share.alias("share"))


def overlap_examples(local: DataFrame, incoming: DataFrame, rtol: float = 1e-7, atol: float = 1e-7, show: int = 8, by: tuple[str, ...] = ()) -> DataFrame:
    """The first mismatches of each matrix by date, then stock."""
    found = overlap_cells(local, incoming, rtol, atol, by).filter("unequal").select(*by, "date", "stock", "local", "incoming")
    if not by:
        return found.orderBy("date", "stock").limit(show)
    return found.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("date", "stock"))).filter(F.col("_n") <= show).drop("_n")


def not_covered(local: DataFrame, incoming: DataFrame, axis: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Labels of the local axis that the delivery lacks; a full delivery must cover all."""
    return local.select(*by, axis).distinct().join(incoming.select(*by, axis).distinct(), [*by, axis], "left_anti")


def overlay(local: DataFrame, incoming: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Merged rows: inside incoming dates x incoming stocks the delivery wins, missing cells included; elsewhere local
    rows stay. Two joins with axes mark the rectangle, so cells are never joined with cells."""
    days, names = (incoming.select(*by, axis).distinct().withColumn(mark, F.lit(True)) for axis, mark in (("date", "_d"), ("stock", "_s")))
    marked = local.join(days, [*by, "date"], "left").join(names, [*by, "stock"], "left")
    kept = marked.filter(F.col("_d").isNull() | F.col("_s").isNull()).select(*incoming.columns)
    return kept.unionByName(incoming)


def overlay_gaps(local: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row: cells of the union grid, cells that the two rectangles cover, and whether gaps remain."""
    number = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    d, s = (dates(local), dates(incoming)), (stocks(local), stocks(incoming))
    one = (
        number(d[0], "ld").crossJoin(number(d[1], "idd")).crossJoin(number(d[0].intersect(d[1]), "bd"))
        .crossJoin(number(s[0], "ls")).crossJoin(number(s[1], "iss")).crossJoin(number(s[0].intersect(s[1]), "bs"))
    )  # single rows
    grid = (F.col("ld") + F.col("idd") - F.col("bd")) * (F.col("ls") + F.col("iss") - F.col("bs"))
    covered = F.col("ld") * F.col("ls") + F.col("idd") * F.col("iss") - F.col("bd") * F.col("bs")
    return one.select(grid.alias("grid"), covered.alias("covered"), (covered < grid).alias("has_gaps"))


def ordered_union(base: DataFrame, more: DataFrame, label: str, position: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Axis labels: those of ``base`` in its order, then the new ones in their own; (by, label, place from 0)."""
    both = base.select(*by, label, F.lit(0).alias("_side"), position).unionByName(more.select(*by, label, F.lit(1).alias("_side"), position))
    first = both.groupBy(*by, label).agg(F.min(F.struct("_side", position)).alias("_at"))
    return first.select(*by, label, (F.row_number().over(Window.partitionBy(*by).orderBy("_at")) - 1).alias("place"))  # an axis: thousands of labels


def normalize_daily(wide_long: DataFrame) -> DataFrame:
    """(datetime, stock_code, value) from rows (day, symbol, value): symbols only, dates parsed."""
    code = symbol_code(F.col("symbol"))
    return wide_long.select(F.try_to_date(F.col("day").cast("string"), "yyyyMMdd").alias("datetime"), code.alias("stock_code"), "value").filter("stock_code is not null")


def symbol_conflicts(symbols: DataFrame) -> DataFrame:
    """Codes under more than one suffix: (code, symbols)."""
    parsed = symbols.select("symbol", symbol_code(F.col("symbol")).alias("code")).filter("code is not null").distinct()
    return parsed.groupBy("code").agg(F.count(F.lit(1)).alias("symbols")).filter("symbols > 1")


def axis_kinds(labels: DataFrame) -> DataFrame:
    """Per axis: whether the ingestion rule and the conversion rule take it for dates, from (axis, kind, label).

    Ingestion: date-typed labels, or integers from 19000101 to 21001231. Conversion: every label prints as eight
    digits, which date-typed ones don't. An empty axis has no rows here and is no date axis."""
    number = F.when(F.col("kind") == "integer", F.col("label").try_cast("long"))
    in_range: Column = (F.col("kind") == "datetime") | F.coalesce(number.between(19000101, 21001231), F.lit(False))
    digits: Column = (F.col("kind") != "datetime") & F.col("label").rlike(r"\A\d{8}\z")
    return labels.groupBy("axis").agg(F.bool_and(in_range).alias("date_axis"), F.bool_and(digits).alias("eight_digits"), F.count(F.lit(1)).alias("labels"))
