"""One day's minute bars and daily rows from a history."""

from __future__ import annotations

from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..errors import UpdateError
from ..operators.minute import REQUIRED
from . import layout
from .pickled import days_of, load


def day_row(path: Path, day: int) -> pd.Series:
    wide = load(path)
    at = days_of(wide.index) == day
    if not at.any():
        raise UpdateError(f"{path} has no {day}")
    return wide[at].iloc[0]


def load_day(spark: SparkSession, root: Path, day: int) -> tuple[DataFrame, DataFrame]:
    table = load(layout.first_dir(root, layout.MINUTE_DIRS) / layout.minute_name(day))
    bars = spark.createDataFrame(table[list(REQUIRED)].reset_index(drop=True).assign(row_id=range(len(table))))
    folder = layout.first_dir(root, layout.DAILY_DIRS)
    parts = {"adjfactor": day_row(layout.factor_file(root), day)} | {c: day_row(folder / f, day) for c, f in layout.DAILY_FILES.items()}
    rows = pd.DataFrame(parts).rename_axis("symbol").reset_index()
    rows = rows[rows["symbol"].astype(str).str.fullmatch(r"\d{6}\.[A-Za-z]{2}")]
    rows = rows.assign(code=rows["symbol"].str[:6].astype("int64"), date=day)
    if rows["code"].duplicated().any():
        raise UpdateError("a code is under two suffixes")
    from pyspark.sql import functions as F

    from ..functions.exprs import nan_to_null

    daily = spark.createDataFrame(rows.astype({c: "float64" for c in parts}))
    return bars, daily.withColumns({c: nan_to_null(F.col(c)) for c in parts})
