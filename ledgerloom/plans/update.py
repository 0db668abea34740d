"""Update: a delivery of zip archives is checked and merged into the history, all or nothing."""

from __future__ import annotations

import math
import zipfile
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import DateAxisError, UpdateError
from ..operators import matrix, minute, reference, storage
from ..scratch import materialize
from ..sources import layout
from ..sources.archives import daily_packages, hold_to_limits, minute_members, pickles
from ..sources.pickled import catalog, decoded, has_dates, is_number, load, read_pairs, sorted_days, to_wide, widest
from ..sources.staging import Staging
from .results import OF_READING, Count, UpdateResult


@dataclass(frozen=True)
class Tolerance:
    rtol: float = 1e-7
    atol: float = 1e-7

    def __post_init__(self) -> None:
        if not all(math.isfinite(x) and x >= 0 for x in (self.rtol, self.atol)):
            raise ValueError("tolerances must be finite and not negative")


@dataclass(frozen=True)
class UpdateConfig:
    data: Path
    delivery: Path
    tolerance: Tolerance = Tolerance()
    trusted: bool = False
    dry_run: bool = False
    calendar_days: int = 1000
    most_lag: int = 5

    def __post_init__(self) -> None:
        if not self.trusted:
            raise ValueError("unpickling runs code; confirm that the delivery is trusted")
        for folder in (self.data, self.delivery):
            if not Path(folder).is_dir():
                raise ValueError(f"{folder} is no directory")


class _Run:
    def __init__(self, spark: SparkSession, config: UpdateConfig, staging: Staging, result: UpdateResult):
        self.spark, self.config, self.staging, self.result = spark, config, staging, result

    def wide(self, source, label: str) -> pd.DataFrame:
        value = load(source)
        if not isinstance(value, pd.DataFrame):
            raise UpdateError(f"{label} is no table")
        return value

    def pairs(self, paths: list[tuple[str, str, str]]) -> tuple[DataFrame, dict[str, str]]:
        """Cells and columns of pairs of matrices, read in tasks, and what is wrong with those that can't be read."""
        cells = materialize(read_pairs(self.spark, paths), tidy=False)
        wrong = {r["dataset"]: r["text"] for r in cells.filter("side < 0").collect()}  # a row a data set at most
        return cells.filter(~F.col("dataset").isin(list(wrong))) if wrong else cells, wrong

    def judge(self, cells: DataFrame, labels: list[str], level: str, prefix: str = "") -> None:
        """Say where the cells of both sides differ: numeric columns within tolerance, others exactly; all data sets of a
        kind in one plan."""
        found = [r["kind"] for r in cells.filter("side in (0, 1)").select("kind").distinct().collect()]  # two at most
        kinds = {kind: tuple(_of_kind(cells, kind).filter(f"side = {n}").drop("side") for n in (0, 1)) for kind in sorted(found)}
        t, by = self.config.tolerance, ("dataset",)
        total = {label: [0, 0, 0, 0.0, []] for label in labels}
        for kind, (a, b) in kinds.items():
            for r in matrix.overlap_report(a, b, t.rtol, t.atol, by).collect():  # a row a data set
                own = total[r["dataset"]]
                own[0] = max(own[0], r["dates"])
                own[1] += r["stocks"]
                own[2] += r["mismatches"]
                own[3] = max(own[3], r["max_deviation"])
            if any(own[2] for own in total.values()):
                plain = decoded if kind == "string" else lambda v: v
                for r in matrix.overlap_examples(a, b, t.rtol, t.atol, by=by).collect():
                    total[r["dataset"]][4].append((r["date"], r["stock"], plain(r["local"]), plain(r["incoming"])))
        for label, (dates, stocks, mismatches, most, shown) in total.items():
            label = prefix + label
            if not dates:
                self.result.add("warning", f"{label}: no date in common")
            elif not stocks and level == "error":
                raise UpdateError(f"{label}: no stock in common")
            elif not stocks:
                self.result.add("error", f"{label}: no stock in common")
            elif mismatches:
                text = "; ".join(f"{day} {stock}: {a} and {b}" for day, stock, a, b in sorted(shown, key=lambda r: r[:2])[:8])
                self.result.add(level, f"{label}: {mismatches} cells differ, by {most:.3g} at most ({text})")
                if level == "warning":
                    self.result.counts[Count.RISK_DIFFERENCES] += 1

    # --- sources ---

    def risk(self, path: Path, files: dict[str, Path]) -> None:
        """Full overwrite: everything local must be covered; differences only warn. The matrices are read in tasks."""
        with zipfile.ZipFile(path) as archive:
            hold_to_limits(self.spark, {path.name: archive})
            members = pickles(archive)
            named = lambda names: self.spark.createDataFrame([(n,) for n in names], "name string")
            states = {r["name"]: r["state"] for r in storage.match_names(named(files), named(n for n, _ in members)).collect()}
            for name, state in sorted(states.items()):
                if state != "matched":
                    self.result.add("error", f"{path.name}: {name} " + ("is missing" if state == "missing" else "is not in the history"))
            staged: dict[str, Path] = {}
            for name, info in members:
                if name in staged:
                    self.result.add("error", f"{path.name}: {name} comes twice")
                elif states[name] == "matched":
                    with archive.open(info) as stream:
                        staged[name] = self.staging.stage_bytes(stream, files[name])
        cells, wrong = self.pairs([(name, str(files[name]), str(place)) for name, place in staged.items()])
        for name, text in sorted(wrong.items()):
            self.staging.discard(files[name])
            self.result.add("error", f"{name}: {text}")
            del staged[name]
        sides = [cells.filter(f"side = {n}") for n in (0, 1)]
        for axis in ("date", "stock"):
            lost = matrix.not_covered(*sides, axis, ("dataset",)).groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.min(axis).alias("first"))
            for r in lost.collect():
                self.result.add("error", f"{r['dataset']}: the delivery lacks {r['n']} of the history's {axis}s, as {r['first']}")
        self.judge(cells, sorted(staged), "warning")
        self.result.counts[Count.RISK_FILES] += len(staged)

    def snapshot(self, local: object, new: object, name: str) -> None:
        if type(local) is not type(new) or not isinstance(new, (pd.Series, pd.DataFrame)):
            raise UpdateError(f"{name} changed its type")
        frame = lambda values: self.spark.createDataFrame([(None if pd.isna(v) else str(v),) for v in values], "value string")
        if isinstance(new, pd.Series):
            row = reference.series_rule(frame(local), frame(new), "value").first()
        else:
            if list(local.columns) != list(new.columns):
                raise UpdateError(f"{name}: the fields or their order changed")
            keys = lambda t: t["stkcode"] if "stkcode" in t.columns else pd.Series(t.index)
            if name == layout.STOCK_INFO and "compcode" in new.columns:
                table = lambda t: self.spark.createDataFrame(
                    [(None if pd.isna(k) else str(k), None if pd.isna(c) else str(c)) for k, c in zip(keys(t), t["compcode"], strict=True)], "stkcode string, compcode string"
                )
                row = reference.table_rule(table(local), table(new)).first()
            else:
                row = reference.series_rule(frame(keys(local)), frame(keys(new)), "value").first()
        if row["verdict"] != "accepted":
            raise UpdateError(f"{name}: {row['verdict']} ({row['lost']} lost, {row['added']} added)")

    def factors(self, path: Path, files: dict[str, Path]) -> None:
        """Daily packages in order; each is laid over what the day before left."""
        with zipfile.ZipFile(path) as outer:
            for label, package in daily_packages(self.spark, path.name, outer):
                seen: set[str] = set()
                matrices: list[tuple[str, str, str]] = []
                snapshots = 0
                for name, info in pickles(package):
                    if name in seen:
                        raise UpdateError(f"{label}: {name} comes twice")
                    seen.add(name)
                    if name not in files:
                        self.result.add("warning", f"{label}: {name} is not in the history")
                        self.result.unmatched.add(name)
                        continue
                    with package.open(info) as stream:
                        place = self.staging.aside(stream, name)
                    new, current = load(place), self.staging.current(files[name])
                    if name in layout.SNAPSHOTS:
                        self.snapshot(load(current), new, name)
                        self.staging.stage(new, files[name])
                        snapshots += 1
                    elif isinstance(new, pd.DataFrame) and has_dates(new.index):
                        matrices.append((name, str(current), str(place)))
                    else:
                        self.result.add("warning", f"{label}: {name} has no date axis and is left out")
                if not matrices and not snapshots:
                    raise UpdateError(f"{label}: nothing in it could be applied")
                if matrices:
                    self.merge(matrices, files, label)
                self.result.counts[Count.SNAPSHOTS] += snapshots
                self.result.counts[Count.PACKAGES] += 1

    def merge(self, matrices: list[tuple[str, str, str]], files: dict[str, Path], label: str) -> None:
        """Lay the matrices of one package over the history: read, compared and merged in one plan each; the driver holds
        one merged matrix at a time, to pickle it."""
        cells, wrong = self.pairs(matrices)
        if wrong:
            raise UpdateError("; ".join(f"{label}/{name}: {text}" for name, text in sorted(wrong.items())))
        self.judge(cells, [name for name, _, _ in matrices], "error", f"{label}/")
        by = ("dataset",)
        merged = materialize(matrix.overlay(*(cells.filter(f"side = {n}").drop("side") for n in (0, 1)), by), tidy=False)
        headers = [cells.filter(f"side = {n}").select("dataset", "stock", F.col("date").alias("at"), F.col("kind").alias("type")) for n in (2, 3)]
        types = {(r["dataset"], r["stock"]): widest(sorted(r["types"])) for r in headers[0].unionByName(headers[1]).groupBy("dataset", "stock").agg(F.collect_set("type").alias("types")).collect()}
        order: dict[str, list[str]] = {}
        for r in sorted(matrix.ordered_union(*headers, "stock", "at", by).collect(), key=lambda r: r["place"]):  # axes
            order.setdefault(r["dataset"], []).append(r["stock"])
        for name, _, _ in matrices:
            parts = []
            for kind, numeric in (("double", True), ("string", False)):
                own = [s for s in order[name] if is_number(types[name, s]) == numeric]
                if own:
                    long = _of_kind(merged.filter(F.col("dataset") == name), kind).select("date", "stock", "value")
                    parts.append(to_wide(long, own, {s: types[name, s] for s in own}))
            self.staging.stage(pd.concat(parts, axis=1)[order[name]].sort_index(), files[name])
            self.result.counts[Count.MATRICES] += 1

    def minutes(self, path: Path, folder: Path) -> None:
        """New days are validated and taken over; days that exist must be equal whatever the rows' order."""
        known = layout.minute_files(folder)
        with zipfile.ZipFile(path) as archive:
            hold_to_limits(self.spark, {path.name: archive})
            members = minute_members(path.name, archive)
            for day, info in members.items():
                try:
                    with archive.open(info) as stream:
                        new = self.bars(load(stream), day)
                    if day in known:
                        row = minute.unequal_fields(self.bars(load(known[day]), day), new).first()
                        wrong = [k for k, v in row.asDict().items() if k.endswith("_differs") and v]
                        if wrong or row["old_rows"] != row["new_rows"]:
                            raise UpdateError(f"{day} differs from the history: {row['old_rows']} and {row['new_rows']} rows, {', '.join(wrong)}")
                        self.result.counts[Count.MINUTE_DAYS_KNOWN] += 1
                    else:
                        row = minute.day_faults(new.withColumn("file_date", F.lit(day))).first()
                        if row is None or row["days"] != 1 or row["strange"] or row["repeats"]:
                            raise UpdateError(f"{day}: empty, of another day, or with repeated bars")
                        with archive.open(info) as stream:
                            self.staging.stage_bytes(stream, folder / layout.minute_name(day))
                        self.result.counts[Count.MINUTE_DAYS_NEW] += 1
                except (UpdateError, TypeError, ValueError) as e:
                    self.result.add("error", f"minute bars: {e}")
        self.problems(self.axes({"minute bars": sorted({*known, *members})}))

    def bars(self, value: object, day: int):
        if not isinstance(value, pd.DataFrame):
            raise UpdateError(f"{day} is no table")
        missing = [c for c in minute.REQUIRED if c not in value.columns]
        if missing:
            raise UpdateError(f"{day} lacks {', '.join(missing)}")
        if value.empty:
            raise UpdateError(f"{day} is empty")
        table = value[list(minute.REQUIRED)].reset_index(drop=True).assign(row_id=range(len(value)))
        return self.spark.createDataFrame(table)

    def calendar(self) -> list[tuple[int]]:
        path = catalog(self.config.data, [layout.first_dir(self.config.data, layout.MINUTE_DIRS)]).get(layout.TRADING_CALENDAR)
        if path is None:
            raise UpdateError("there is no trading calendar")
        value = load(self.staging.current(path))
        if not isinstance(value, pd.Series):
            raise UpdateError(f"the trading calendar is no series but a {type(value).__name__}")
        try:
            return [(int(d),) for d in sorted_days(pd.Index(value))]
        except DateAxisError as e:
            raise UpdateError(f"the trading calendar: {e}") from e

    def axes(self, axes: dict[str, list[int]]) -> list[str]:
        """Every axis against the calendar's last days, in one job. Lags within bounds warn; the rest is returned."""
        try:
            window = reference.reference_window(self.spark.createDataFrame(self.calendar(), "day int"), self.config.calendar_days)
        except ValueError as e:
            raise UpdateError(str(e)) from e
        rows = [(name, int(d)) for name, own in axes.items() for d in own]
        found = reference.axis_consistency(self.spark.createDataFrame(rows, "axis string, day int"), window, self.config.most_lag).collect()
        text = lambda r: f"{r['axis']}: {r['missing']} missing, {r['extra']} extra, {r['lag']} behind"
        for r in found:
            if r["level"] == "warning":
                self.result.add("warning", text(r))
        return [text(r) for r in found if r["level"] == "error"]

    def problems(self, texts: list[str]) -> None:
        if texts:
            self.result.add("error", f"{len(texts)} date axes: " + "; ".join(sorted(texts)))

    def all_axes(self, files: dict[str, Path]) -> None:
        """The data set as a commit would leave it: all problems of all axes in one error."""
        axes, bad = {}, []
        for name, path in files.items():
            if name in layout.WITHOUT_DATES or name == layout.TRADING_CALENDAR:
                continue
            try:
                axes[name] = sorted_days(self.wide(self.staging.current(path), name).index).tolist()
            except (UpdateError, DateAxisError) as e:
                bad.append(f"{name}: {e}")
        self.problems(bad + (self.axes(axes) if axes else []))


def _of_kind(cells: DataFrame, kind: str) -> DataFrame:
    """Cells of numeric or of other columns, with what they hold as ``value``."""
    kept = [c for c in cells.columns if c not in ("kind", "value", "text")]
    return cells.filter(F.col("kind") == kind).select(*kept, F.col("value" if kind == "double" else "text").alias("value"))


def update_dataset(spark: SparkSession, config: UpdateConfig, confirm: Callable[[UpdateResult], bool] = lambda _: True) -> UpdateResult:
    """Apply a delivery. Each source is a transaction: with an error its files and counters go back. Any error stops
    the commit; a dry run never commits; ``confirm``, which gets what was found so far, has the last word."""
    result = UpdateResult()
    minute_folder = layout.first_dir(config.data, layout.MINUTE_DIRS)
    try:
        files = catalog(config.data, [minute_folder])
    except UpdateError as e:
        result.add("error", str(e))
        return result
    risk_files = {n: p for n, p in files.items() if "barra" in p.relative_to(config.data).parts}
    others = {n: p for n, p in files.items() if n not in risk_files}
    with Staging(config.data) as staging:
        run = _Run(spark, config, staging, result)
        for archive, apply in (
            (layout.RISK_ARCHIVE, lambda p: run.risk(p, risk_files)),
            (layout.FACTOR_ARCHIVE, lambda p: run.factors(p, others)),
            (layout.MINUTE_ARCHIVE, lambda p: run.minutes(p, minute_folder)),
        ):
            path = config.delivery / archive
            if not path.exists():
                result.add("warning", f"the delivery has no {archive}")
                continue
            before, counts, errors = staging.checkpoint(), result.counts.copy(), len(result.errors)
            try:
                apply(path)
            except (UpdateError, DateAxisError, zipfile.BadZipFile, OSError) as e:
                result.add("error", f"{archive}: {e}")
            if len(result.errors) > errors:
                staging.rollback(before)
                counts.update({c: n - counts[c] for c, n in result.counts.items() if c in OF_READING})
                result.counts = counts
        try:
            run.all_axes(files)
        except UpdateError as e:
            result.add("error", str(e))
        result.staged = len(staging.versions)
        if staging.versions and not result.errors and not config.dry_run and confirm(result):
            result.counts[Count.WRITTEN] = staging.commit()
            result.committed = True
    return result
