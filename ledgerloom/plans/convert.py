"""Convert: pickles become canonical Parquet, changed sources only."""

from __future__ import annotations

import re
import shutil
import uuid
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import symbol_code
from ..operators import matrix, minute, storage
from ..sources import layout
from ..sources.pickled import load, split_kinds, to_long
from ..sources.staging import Manifest, file_digest
from .results import ConversionResult, ObjectKind


@dataclass(frozen=True)
class ConversionConfig:
    """``workers``: how many minute files are read at once at most; by default as many as the cluster has cores."""

    input: Path
    output: Path
    part: str = "all"
    overwrite: bool = False
    copy_other: bool = False
    dry_run: bool = False
    include_factors: bool = False
    workers: int | None = None

    def __post_init__(self) -> None:
        if self.part not in ("all", "regular", "minute"):
            raise ValueError("part is all, regular or minute")
        if self.workers is not None and self.workers < 1:
            raise ValueError("workers must be at least 1")
        if not Path(self.input).is_dir() or Path(self.input).resolve() == Path(self.output).resolve():
            raise ValueError("input must be a directory other than output")


def _write(df: DataFrame, target: Path) -> None:
    """Write beside the target, then swap; if the swap fails, the old output comes back."""
    part = target.with_name(f"{target.name}.{uuid.uuid4().hex}")
    df.write.mode("overwrite").option("compression", "zstd").parquet(str(part))
    old = part.with_suffix(".old") if target.exists() else None
    if old:
        target.rename(old)
    try:
        part.rename(target)
    except BaseException:
        if old:
            old.rename(target)
        raise
    if old:
        shutil.rmtree(old) if old.is_dir() else old.unlink()


def int_code(symbol: str) -> int | None:
    return int(symbol[:6]) if re.fullmatch(r"[0-9]{6}\.[A-Za-z]{2}", symbol) else None


def _indexed(value: pd.DataFrame) -> pd.DataFrame:
    """The index as a first column, under its name or ``index``."""
    table = value.reset_index(names=value.index.name or "index")
    table.columns = table.columns.astype(str)
    return table


def _codes(spark: SparkSession, value: pd.DataFrame, source: Path) -> list[int]:
    """The codes of a date x symbol matrix, ascending; none if the table is no such matrix."""
    if not len(value):
        return []
    kind = "datetime" if isinstance(value.index, pd.DatetimeIndex) else "integer" if pd.api.types.is_integer_dtype(value.index) else "text"
    labels = spark.createDataFrame([("rows", kind, str(x)) for x in value.index], "axis string, kind string, label string")
    symbols = spark.createDataFrame([(c,) for c in value.columns if isinstance(c, str)], "symbol string")
    if not matrix.axis_kinds(labels).first()["eight_digits"]:
        return []
    if clash := matrix.symbol_conflicts(symbols).collect():
        raise ValueError(f"{source}: a code is under two suffixes: {', '.join(str(r['code']) for r in clash[:5])}")
    return sorted(r["code"] for r in symbols.select(symbol_code(F.col("symbol")).alias("code")).filter("code is not null").distinct().collect())


def regular(spark: SparkSession, source: Path, target: Path) -> ObjectKind:
    """One pickle: a date x symbol matrix as (datetime, one column a code; cells that are no numbers as text), a series
    or a plain table with its index."""
    value = load(source)
    target.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(value, pd.Series):
        _write(spark.createDataFrame(_indexed(value.to_frame(value.name or "value"))), target)
        return ObjectKind.SERIES
    if isinstance(value, pd.DataFrame) and (codes := _codes(spark, value, source)):
        wide = None
        for kind, (part,) in split_kinds(value[[c for c in value.columns if isinstance(c, str) and int_code(c) is not None]]):
            cell = F.max("value") if kind == "double" else F.substr(F.max("value"), F.lit(2))
            long = matrix.normalize_daily(to_long(spark, part, kind).select(F.col("date").alias("day"), F.col("stock").alias("symbol"), "value"))
            own = long.groupBy("datetime").pivot("stock_code", [int_code(c) for c in part.columns]).agg(cell)
            wide = own if wide is None else wide.join(own, "datetime")
        _write(wide.select("datetime", *(f"`{c}`" for c in codes)).orderBy("datetime"), target)
        return ObjectKind.MATRIX
    if not isinstance(value, pd.DataFrame):
        raise ValueError(f"{source} is neither a table nor a series")
    named = value if value.index.is_monotonic_increasing else value.sort_index()
    _write(spark.createDataFrame(_indexed(named)), target)
    return ObjectKind.TABLE


def _read_minutes(spark: SparkSession, files: dict[int, Path], workers: int | None) -> DataFrame:
    """The bars of all day files, each read in one task and checked there."""
    columns = list(minute.REQUIRED)
    paths = spark.createDataFrame([(d, str(p)) for d, p in files.items()], "day int, path string").repartition(min(len(files), workers or len(files)))

    def read(batches):
        for batch in batches:
            for day, path in zip(batch["day"], batch["path"], strict=True):
                table = load(path)
                lacking = [c for c in columns if c not in table.columns]
                if lacking or table.empty or set(table["date"]) != {day}:
                    raise ValueError(f"{path}: empty, of another day, or without {lacking}")
                table = table[columns].apply(pd.to_numeric, errors="coerce")
                yield table.reset_index(drop=True).assign(row_id=range(len(table)))

    return paths.mapInPandas(read, "code double, date int, time int, open double, high double, low double, close double, volume double, amount double, row_id long")


def _factors(spark: SparkSession, path: Path) -> DataFrame:
    """(date, code, factor) of the factor matrix, which must have days and symbols."""
    value = load(path)
    if not isinstance(value, pd.DataFrame) or not len(value) or not any(int_code(str(c)) is not None for c in value.columns):
        raise ValueError(f"{path} is no daily matrix")
    long = to_long(spark, value).withColumn("code", symbol_code(F.col("stock"))).filter("code is not null")
    return long.select("date", "code", F.col("value").alias("factor"))


def _group_digest(spark: SparkSession, key: str, paths: list[Path]) -> str:
    """The digest of a group of files, whose contents are read and hashed in tasks."""
    listing = storage.digests(spark.read.format("binaryFile").load([str(p) for p in paths]), "path", "content")
    named = listing.select(F.lit(key).alias("group"), F.element_at(F.split("path", "/"), -1).alias("name"), "path", "digest")
    return storage.group_digest(named, by="path").first()["digest"]


def minutes(spark: SparkSession, config: ConversionConfig, manifest: Manifest, result: ConversionResult) -> None:
    """All days in one plan, six fields out, partitioned by day. The group's digest covers the day files (and the
    factors, if asked for)."""
    folder = layout.first_dir(config.input, layout.MINUTE_DIRS)
    files = layout.minute_files(folder)
    if not files:
        return
    fields = (*minute.PRICES, "volume", "amount")
    place = config.output / folder.relative_to(config.input)
    targets = [place / f"{f}.parquet" for f in fields]
    factors = layout.factor_file(config.input)
    key = str(folder.relative_to(config.input))
    digest = _group_digest(spark, key, [*files.values(), *([factors] if config.include_factors else [])])
    if not config.overwrite and manifest.is_current(key, digest, targets):
        result.counts[ObjectKind.CURRENT] += len(targets)
        return
    if config.dry_run:
        result.counts[ObjectKind.PLANNED] += len(files)
        return
    table = _factors(spark, factors)
    codes = table.select("code").distinct()
    universe = sorted(r[0] for r in codes.collect())  # stocks: thousands
    place.mkdir(parents=True, exist_ok=True)
    scratch = place / f".bars-{uuid.uuid4().hex}"  # pickles are read once, into long form
    try:
        bars = _read_minutes(spark, files, config.workers).filter("code = round(code) and code between 0 and 999999").withColumn("code", F.col("code").cast("long"))
        bars.join(codes, "code", "left_semi").write.option("compression", "zstd").parquet(str(scratch))
        bars = spark.read.parquet(str(scratch))
        bad = minute.unready_days(spark.createDataFrame([(d,) for d in files], "date int"), bars, table).orderBy("date").collect()
        if bad:
            raise ValueError("; ".join(f"{r['date']}: {r['reason']}" for r in bad))
        adjusted = minute.adjust(bars, table)
        for f, target in zip(fields, targets, strict=True):
            _write(minute.pivot_field(adjusted, f, universe).orderBy("datetime"), target)
    finally:
        shutil.rmtree(scratch, ignore_errors=True)
    result.counts[ObjectKind.MINUTE_DAYS] += len(files)
    manifest.record(key, digest)


def _current(spark: SparkSession, sources: list[tuple[str, str]], manifest: Manifest, output: Path) -> set[str]:
    """Keys of sources whose digest is the recorded one and whose target is there, as one plan over the listings."""
    keyed = spark.createDataFrame(sources, "key string, digest string")
    recorded = spark.createDataFrame(list(manifest.entries.items()), "key string, digest string")
    there = spark.createDataFrame([(k,) for k, _ in sources if (output / layout.output_path(k)).exists()], "key string")
    return {r["key"] for r in storage.currency(keyed, recorded, there).filter("current").collect()}


def convert_dataset(spark: SparkSession, config: ConversionConfig) -> ConversionResult:
    result = ConversionResult(dry_run=config.dry_run)
    manifest = Manifest.read(config.output / ".manifest.json", config.dry_run)
    folder = layout.first_dir(config.input, layout.MINUTE_DIRS)
    sources = []
    for path in sorted(config.input.rglob("*")) if config.part != "minute" else []:
        relative = path.relative_to(config.input).as_posix()
        if path.is_file() and folder not in path.parents and (layout.is_pickle(relative) or config.copy_other):
            sources.append((relative, file_digest(path)))
    current = _current(spark, sources, manifest, config.output) if sources and not config.overwrite else set()
    for relative, digest in sources:
        path, target = config.input / relative, config.output / layout.output_path(relative)
        if relative in current:
            result.counts[ObjectKind.CURRENT] += 1
            continue
        if config.dry_run:
            result.counts[ObjectKind.PLANNED] += 1
            continue
        if layout.is_pickle(relative):
            result.counts[regular(spark, path, target)] += 1
        else:
            target.parent.mkdir(parents=True, exist_ok=True)
            shutil.copyfile(path, target)
            result.counts[ObjectKind.COPY] += 1
        manifest.record(relative, digest)
    if config.part != "regular":
        minutes(spark, config, manifest, result)
    return result
