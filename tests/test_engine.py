"""Update, convert, check and stream on small histories."""

import io
import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom import cli
from ledgerloom.functions import exprs
from ledgerloom.errors import DateAxisError, UpdateError
from ledgerloom.operators import checks, matrix, minute, storage
from ledgerloom.plans.convert import ConversionConfig, convert_dataset
from ledgerloom.plans.update import Tolerance, UpdateConfig, update_dataset
from ledgerloom.sources import layout
from ledgerloom.plans.results import Count, ObjectKind
from ledgerloom.sources.archives import daily_packages, hold_to_limits, minute_members
from ledgerloom.sources.daily import load_day
from ledgerloom.sources.pickled import catalog, decoded, dump, encoded, sorted_days
from ledgerloom.sources.staging import Manifest, Staging

DAYS = [int(d.strftime("%Y%m%d")) for d in pd.bdate_range("2024-01-01", periods=30)]


def bars(day, close=11.5):
    rows = [(1, day, 930, 10.0, 11.0, 9.5, 10.5, 100, 1000.0), (1, day, 1459, 10.5, 12.0, 10.0, close, 200, 2300.0), (600000, day, 930, 20.0, 21.5, 19.5, 21.2, 300, 6300.0)]
    return pd.DataFrame(rows, columns=list(minute.REQUIRED))


def history(root):
    wide = lambda days, value: pd.DataFrame(value, index=days, columns=["000001.SZ", "600000.SH"])
    dump(pd.Series(DAYS), root / "market/calendar/trd_cal.pkl")
    dump(wide(DAYS[:-2], 2.0), root / "market/adjustment/adjfactor.pkl")
    dump(wide(DAYS[:-2], 1.5).astype("float32"), root / "barra/BETA.pkl")
    dump(pd.DataFrame({"stkcode": ["1", "2"], "name": ["a", "b"]}), root / "reference/securities/stk_info.pkl")
    for day in DAYS[:-2]:
        dump(bars(day), root / "market/bars/1m" / layout.minute_name(day))
    for name, value in {"adj_open": [20.0, 40.0], "adj_high": [24.0, 43.0], "adj_low": [19.0, 39.0], "adj_close": [23.0, 42.4], "volume": [0.03, 0.03], "amount": [0.0033, 0.0063], "adj_vwap": [22.0, 42.0]}.items():
        dump(wide(DAYS[:-2], [value] * len(DAYS[:-2])), root / "market/bars/1d" / f"{name}.pkl")
    return root


def packed(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, value in members.items():
            data = io.BytesIO()
            if isinstance(value, bytes):
                data.write(value)
            else:
                pd.to_pickle(value, data, compression=None)
            z.writestr(name, data.getvalue())
    return out.getvalue()


def delivery(folder, beta=1.5, factor=2.0, minute_days=DAYS[-3:], close=11.5):
    folder.mkdir(parents=True, exist_ok=True)
    wide = lambda days, value: pd.DataFrame(value, index=days, columns=["000001.SZ", "600000.SH"])
    (folder / layout.RISK_ARCHIVE).write_bytes(packed({"BETA.pkl": wide(DAYS, beta).astype("float32")}))
    days = {}
    for day in DAYS[-2:]:
        new = {"adjfactor.pkl": wide([DAYS[-3], day], factor)}
        new |= {f"{n}.pkl": wide([day], 1.0) for n in ("adj_open", "adj_high", "adj_low", "adj_close", "volume", "amount", "adj_vwap")}
        days[f"factorDatabase_incre_pkl_{day}.zip"] = packed(new)
    (folder / layout.FACTOR_ARCHIVE).write_bytes(packed(days))
    (folder / layout.MINUTE_ARCHIVE).write_bytes(packed({layout.minute_name(d): bars(d, close) for d in minute_days}))
    return folder


def config(tmp_path, **more):
    return UpdateConfig(tmp_path / "full", tmp_path / "new", trusted=True, calendar_days=20, **more)


def test_update_commits(spark, tmp_path):
    root = history(tmp_path / "full")
    delivery(tmp_path / "new")
    result = update_dataset(spark, config(tmp_path))
    assert result.errors == [] and result.committed
    merged = pd.read_pickle(root / "market/adjustment/adjfactor.pkl")
    assert merged.index.tolist() == DAYS and (merged == 2.0).all().all()
    assert set(layout.minute_files(root / "market/bars/1m")) == set(DAYS)
    assert result.counts[Count.MINUTE_DAYS_KNOWN] == 1 and result.counts[Count.MINUTE_DAYS_NEW] == 2
    assert result.counts[Count.WRITTEN] == result.staged > 0 and "committed" in result.summary()


@pytest.mark.parametrize("change", [{"factor": 2.1}, {"close": 11.6}, {"minute_days": DAYS[-1:]}])
def test_update_refuses(spark, tmp_path, change):
    root = history(tmp_path / "full")
    delivery(tmp_path / "new", **change)
    result = update_dataset(spark, config(tmp_path))
    assert result.errors and not result.committed
    assert len(pd.read_pickle(root / "market/adjustment/adjfactor.pkl")) == len(DAYS) - 2


def test_dry_run_and_refusal_write_nothing(spark, tmp_path):
    history(tmp_path / "full")
    delivery(tmp_path / "new", beta=1.6)
    before = {p: p.read_bytes() for p in (tmp_path / "full").rglob("*.pkl")}
    result = update_dataset(spark, config(tmp_path, dry_run=True))
    assert not result.errors and not result.committed and any("differ" in t for _, t in result.issues)
    assert not update_dataset(spark, config(tmp_path), lambda _: False).committed
    assert before == {p: p.read_bytes() for p in (tmp_path / "full").rglob("*.pkl")}


def test_texts_are_compared_and_merged(spark, tmp_path):
    root = history(tmp_path / "full")
    folder = delivery(tmp_path / "new")
    target = root / "reference/industries/ind_lv1.pkl"
    columns = ["000001.SZ", "600000.SH", "000002.SZ"]
    frame = lambda days, names: pd.DataFrame({columns[0]: names[0], columns[1]: names[1], columns[2]: 3.0}, index=days)
    dump(frame(DAYS[:-2], ("bank", None)), target)
    with_names = lambda names: packed({f"factorDatabase_incre_pkl_{day}.zip": packed({"ind_lv1.pkl": frame([DAYS[-3], day], names), "adjfactor.pkl": pd.DataFrame(2.0, index=[day], columns=columns[:2]),
        **{f"{n}.pkl": pd.DataFrame(1.0, index=[day], columns=columns[:2]) for n in ("adj_open", "adj_high", "adj_low", "adj_close", "volume", "amount", "adj_vwap")}}) for day in DAYS[-2:]})
    (folder / layout.FACTOR_ARCHIVE).write_bytes(with_names(("steel", None)))
    refused = update_dataset(spark, config(tmp_path))
    assert not refused.committed and any("bank and steel" in t for t in refused.errors)
    (folder / layout.FACTOR_ARCHIVE).write_bytes(with_names(("bank", None)))
    result = update_dataset(spark, config(tmp_path))
    assert result.errors == [] and result.committed
    merged = pd.read_pickle(target)
    assert merged.index.tolist() == DAYS and merged.columns.tolist() == columns
    assert set(merged[columns[0]]) == {"bank"} and merged[columns[1]].isna().all() and (merged[columns[2]] == 3.0).all()
    convert_dataset(spark, ConversionConfig(tmp_path / "full", tmp_path / "out", part="regular"))
    row = spark.read.parquet(str(tmp_path / "out/reference/industries/industry_l1.parquet")).orderBy("datetime").first()
    assert (row["1"], row["2"], row["600000"]) == ("bank", 3.0, None)


def test_encoded_cells_come_back():
    for value in ("a", "", True, False, 3, -4, 0.25, float("inf"), pd.Timestamp("2024-01-02 09:30")):
        assert decoded(encoded(value)) == value
    assert encoded(None) is None and encoded(float("nan")) is None and encoded(2.0) == encoded(2)
    with pytest.raises(UpdateError):
        encoded([1])


def test_axes_of_days():
    assert issubclass(DateAxisError, ValueError) and not issubclass(UpdateError, ValueError)
    for labels in ([], [20240102, 20240102], [20240103, 20240102], [20241301], ["x"]):
        with pytest.raises(DateAxisError):
            sorted_days(pd.Index(labels))


def test_log_of_a_run(tmp_path):
    path = cli.configure_logging(str(tmp_path / "logs"), "convert", tag="dryrun")
    assert path.name.startswith("convert_") and path.name.endswith("_dryrun.log") and path.exists()
    (tmp_path / "file").write_text("")
    assert cli.configure_logging(str(tmp_path / "file"), "convert") is None


def test_trust_and_tolerance():
    with pytest.raises(ValueError):
        UpdateConfig("/tmp", "/tmp")
    with pytest.raises(ValueError):
        Tolerance(float("nan"), 0)


def test_convert_and_skip(spark, tmp_path):
    history(tmp_path / "full")
    (tmp_path / "full/notes.txt").write_text("x")
    settings = ConversionConfig(tmp_path / "full", tmp_path / "out", copy_other=True)
    assert ConversionConfig and convert_dataset(spark, ConversionConfig(tmp_path / "full", tmp_path / "out", dry_run=True)).counts[ObjectKind.PLANNED]
    assert not (tmp_path / "out").exists()
    first = convert_dataset(spark, settings)
    assert first.counts[ObjectKind.MATRIX] == 9 and first.counts[ObjectKind.COPY] == 1 and first.counts[ObjectKind.MINUTE_DAYS] == len(DAYS) - 2
    beta = spark.read.parquet(str(tmp_path / "out/barra/beta.parquet"))
    assert beta.columns == ["datetime", "1", "600000"] and beta.count() == len(DAYS) - 2
    wide = spark.read.parquet(str(tmp_path / "out/market/bars/1m/open.parquet")).orderBy("datetime").first()
    assert str(wide["datetime"]).endswith("09:31:00") and wide["1"] == 20.0 and wide["600000"] == 40.0
    again = convert_dataset(spark, settings)
    assert set(again.counts) == {ObjectKind.CURRENT}


def test_check(spark, tmp_path, capsys):
    root = history(tmp_path / "full")
    context = checks.Context(spark, root, load_day)
    found = checks.run("price-consistency", context, date=DAYS[0])
    assert found.level == "pass" and found.figures["exact_points"] == 8 and not found.samples
    dump(bars(DAYS[0], 11.6), root / "market/bars/1m" / layout.minute_name(DAYS[0]))
    (found,) = checks.run_all(context, {"price-consistency": {"date": DAYS[0], "show": 1}})
    assert found.level == "fail" and [p.kind for p in found.problems] == ["price_mismatch"] and len(found.samples) == 1 and "14:59" in str(found)
    assert cli.main(["--log-dir", str(tmp_path / "logs"), "check", "price-consistency", "--date", str(DAYS[0]), "--input", str(root)]) == 0
    assert "FAIL" in capsys.readouterr().out
    assert cli.main(["--log-dir", str(tmp_path / "logs"), "check", "price-consistency", "--date", "20300101", "--input", str(root)]) == 2


def test_checks_are_made_from_functions():
    @checks.check("output")
    def made_up(context, *, least: int = 3, words: str = "x"):
        """Nothing.

        More."""
        yield checks.Figure("rows", 1234567)
        yield checks.Figure("share", 0.123456789)
        yield checks.Problem("warning", "few", f"less than {least}")

    try:
        assert [(p.name, p.type, p.default) for p in checks.parameters("made-up")] == [("least", int, 3), ("words", str, "x")]
        assert checks.about("made-up") == "Nothing." and checks.subject("made-up") == "output" and "made-up" in checks.names()
        found = checks.run("made-up", None, least=4)
        assert found.level == "warning" and "1,234,567" in str(found) and "0.123457" in str(found) and "less than 4" in str(found)
        args = cli.parser().parse_args(["check", "made-up", "--least", "9"])
        assert (args.name, args.least, args.words) == ("made-up", 9, "x")
        for name, options in (("nothing", {}), ("made-up", {"colour": 1})):
            with pytest.raises(KeyError):
                checks.run(name, None, **options)
        with pytest.raises(ValueError):
            checks.check("output")(made_up)
        with pytest.raises(ValueError):
            checks.check("elsewhere")
    finally:
        del checks._known["made-up"]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(io.BytesIO(packed({"folder/": b"", "a.pkl": b"1" * 5000, "b.pkl": b"2"}))) as z:
        hold_to_limits(spark, {"z": z})
        hold_to_limits(spark, {"z": z}, most=2)  # the folder does not count
        for limits in ({"most": 1}, {"member_bytes": 100}, {"total_bytes": 5000}):
            with pytest.raises(UpdateError):
                hold_to_limits(spark, {"z": z}, **limits)
        with pytest.raises(UpdateError):
            minute_members("z", z)
        assert [label for label, _ in daily_packages(spark, "z", z)] == ["z"]
    names = [f"factorDatabase_incre_pkl_{d}.zip" for d in (20240103, 20240102)]
    with zipfile.ZipFile(io.BytesIO(packed({n: packed({"x.pkl": b"1"}) for n in names}))) as z:
        assert [label for label, _ in daily_packages(spark, "z", z)] == ["20240102", "20240103"]
    for bad in ({"wrong.zip": packed({})}, {"factorDatabase_incre_pkl_20241301.zip": packed({})}, {names[0]: packed({}), "x/" + names[0]: packed({})}, {"../a.pkl": b"1"}):
        with zipfile.ZipFile(io.BytesIO(packed(bad))) as z, pytest.raises(UpdateError):
            list(daily_packages(spark, "z", z))


@pytest.mark.parametrize("error", [OSError("disk"), KeyboardInterrupt()])
@pytest.mark.parametrize("at", [1, 2, 3])
def test_staging_restores(tmp_path, monkeypatch, error, at):
    import os

    root = tmp_path / "full"
    for name in "ab":
        dump("old", root / f"{name}.pkl")
    with Staging(root) as s:
        s.stage("new", root / "a.pkl")
        mark = s.checkpoint()
        late = s.stage_bytes(io.BytesIO(b"x"), root / "b.pkl")
        s.rollback(mark)
        assert set(s.versions) == {root / "a.pkl"} and not late.exists()
        s.stage("new", root / "b.pkl")
        s.stage("new", root / "c/d.pkl")
        real, calls = os.replace, []

        def fails(a, b):
            calls.append(b)
            assert len(calls) != 1 or all((root / f"{n}.pkl").exists() for n in "ab")
            if len(calls) == at:
                raise error
            return real(a, b)

        monkeypatch.setattr(os, "replace", fails)
        with pytest.raises(type(error)):
            s.commit()
        monkeypatch.undo()
    assert pd.read_pickle(root / "a.pkl") == "old" and pd.read_pickle(root / "b.pkl") == "old" and not (root / "c/d.pkl").exists()
    assert not s.folder.exists()


def test_staging_keeps_old_contents_that_it_could_not_restore(tmp_path, monkeypatch):
    import os

    root = tmp_path / "full"
    for name in "abc":
        dump("old", root / f"{name}.pkl")
    with Staging(root) as s:
        for name in "abc":
            s.stage("new", root / f"{name}.pkl")
        real, calls = os.replace, []

        def fails(a, b):
            calls.append(b)
            if len(calls) in (3, 5):  # the third target, then the restoring of the second
                raise OSError("disk")
            return real(a, b)

        monkeypatch.setattr(os, "replace", fails)
        with pytest.raises(OSError) as caught:
            s.commit()
        monkeypatch.undo()
    assert "b.pkl" in caught.value.__notes__[0] and s.folder.exists()
    assert [pd.read_pickle(root / f"{n}.pkl") for n in "abc"] == ["old", "new", "old"]
    assert pd.read_pickle(s.folder / "old-1") == "old"


def test_overwritten_matrices_are_judged_in_one_plan(spark, tmp_path):
    root = history(tmp_path / "full")
    folder = delivery(tmp_path / "new")
    columns = ["000001.SZ", "600000.SH"]
    wide = lambda days, value, names=columns: pd.DataFrame(value, index=days, columns=names)
    for name in ("SIZE", "GROWTH", "TEXT", "LATE", "OTHER", "BROKEN"):
        dump(wide(DAYS[:-2], 1.0), root / f"barra/{name}.pkl")
    dump(wide(DAYS[:-2], "a"), root / "barra/TEXT.pkl")
    new = {
        "BETA.pkl": wide(DAYS, 1.5), "SIZE.pkl": wide(DAYS, 1.25), "GROWTH.pkl": wide(DAYS[1:], 1.0, columns[:1]), "TEXT.pkl": wide(DAYS, "b"),
        "LATE.pkl": wide([20300101], 1.0), "OTHER.pkl": wide(DAYS, 1.0, ["x"]), "BROKEN.pkl": b"no pickle", "EXTRA.pkl": wide(DAYS, 1.0),
    }
    (folder / layout.RISK_ARCHIVE).write_bytes(packed(new))
    result = update_dataset(spark, config(tmp_path))
    said = "\n".join(result.errors)
    assert not result.committed and result.counts[Count.RISK_FILES] == 0
    assert "EXTRA.pkl is not in the history" in said and "BROKEN.pkl: " in said and "BETA.pkl" not in said
    assert f"GROWTH.pkl: the delivery lacks 1 of the history's dates, as {DAYS[0]}" in said and "GROWTH.pkl: the delivery lacks 1 of the history's stocks, as 600000.SH" in said
    assert "LATE.pkl: the delivery lacks 28" in said and "OTHER.pkl: no stock in common" in said
    warned = "\n".join(result.warnings)
    assert "SIZE.pkl: 56 cells differ, by 0.2 at most" in warned and "TEXT.pkl: 56 cells differ" in warned and "a and b" in warned and "LATE.pkl: no date in common" in warned
    assert not any("BETA" in w and "differ" in w for w in result.warnings)
    (folder / layout.RISK_ARCHIVE).write_bytes(packed({f"{n}.pkl": wide(DAYS, 1.0) for n in ("BETA", "SIZE", "GROWTH", "LATE", "OTHER", "BROKEN")} | {"TEXT.pkl": wide(DAYS, "a")}))
    result = update_dataset(spark, config(tmp_path))
    assert result.committed and result.counts[Count.RISK_FILES] == 7 and result.counts[Count.RISK_DIFFERENCES] == 1


def test_merged_columns_keep_the_widest_type(spark, tmp_path):
    root = history(tmp_path / "full")
    folder = delivery(tmp_path / "new")
    columns = ["000001.SZ", "600000.SH", "000002.SZ", "000003.SZ"]

    def frame(days, kinds):
        return pd.DataFrame({c: pd.Series([n + 1] * len(days), index=days, dtype=k) for n, (c, k) in enumerate(zip(columns, kinds, strict=True)) if k})

    target = root / "x/mixed.pkl"
    dump(frame(DAYS[:-2], ("float32", "int64", "Int64", None)), target)
    rest = {f"{n}.pkl": pd.DataFrame(1.0, index=[0], columns=columns[:2]) for n in ("adj_open", "adj_high", "adj_low", "adj_close", "volume", "amount", "adj_vwap")}
    days = {}
    for day in DAYS[-2:]:
        own = {n: f.set_axis([day]) for n, f in rest.items()} | {"adjfactor.pkl": pd.DataFrame(2.0, index=[day], columns=columns[:2])}
        days[f"factorDatabase_incre_pkl_{day}.zip"] = packed(own | {"mixed.pkl": frame([day], ("float64", "int32", "Int64", "int64"))})
    (folder / layout.FACTOR_ARCHIVE).write_bytes(packed(days))
    result = update_dataset(spark, config(tmp_path))
    assert result.errors == [] and result.committed
    merged = pd.read_pickle(target)
    assert [str(t) for t in merged.dtypes] == ["float64", "int64", "Int64", "float64"]  # days before the last column began are missing
    assert merged.iloc[-1].tolist() == [1, 2, 3, 4] and merged[columns[3]].isna().sum() == len(DAYS) - 2


def test_every_bad_axis_is_named(spark, tmp_path):
    root = history(tmp_path / "full")
    delivery(tmp_path / "new")
    wide = lambda days: pd.DataFrame(1.0, index=days, columns=["000001.SZ"])
    dump(wide([]), root / "x/empty.pkl")
    dump(wide(DAYS[::-1]), root / "x/backward.pkl")
    dump(wide([1, 2]), root / "x/numbers.pkl")
    dump(wide([d for d in DAYS if d != DAYS[-4]]), root / "x/hole.pkl")
    result = update_dataset(spark, config(tmp_path))
    (error,) = result.errors
    assert not result.committed and all(n in error for n in ("empty.pkl", "backward.pkl", "numbers.pkl", "hole.pkl")) and "adjfactor" not in error


def test_the_calendar_must_be_a_sorted_series(spark, tmp_path):
    root = history(tmp_path / "full")
    delivery(tmp_path / "new")
    for calendar in (pd.Series(DAYS[::-1]), pd.DataFrame({"d": DAYS}), pd.Series(DAYS + DAYS[-1:])):
        dump(calendar, root / "market/calendar/trd_cal.pkl")
        assert any("calendar" in e for e in update_dataset(spark, config(tmp_path)).errors)


def test_a_name_in_two_places_stops_an_update(spark, tmp_path):
    root = history(tmp_path / "full")
    delivery(tmp_path / "new")
    dump(1, root / "x/adjfactor.pkl")
    result = update_dataset(spark, config(tmp_path))
    assert len(result.errors) == 1 and "adjfactor.pkl" in result.errors[0] and not result.committed


def test_conversion_refuses_days_that_it_can_not_adjust(spark, tmp_path):
    root = history(tmp_path / "full")
    settings = ConversionConfig(root, tmp_path / "out", part="minute", workers=2)
    dump(bars(DAYS[-1]), root / "market/bars/1m" / layout.minute_name(DAYS[-1]))
    dump(bars(DAYS[0]).assign(code=[5, 5, 6]), root / "market/bars/1m" / layout.minute_name(DAYS[0]))
    dump(pd.concat([bars(DAYS[1])] * 2), root / "market/bars/1m" / layout.minute_name(DAYS[1]))
    with pytest.raises(ValueError, match=f"{DAYS[0]}: no bars of listed codes; {DAYS[1]}: bars repeat; {DAYS[-1]}: no factors"):
        convert_dataset(spark, settings)
    assert not list((tmp_path / "out").rglob("*.parquet"))
    with pytest.raises(ValueError):
        ConversionConfig(root, tmp_path / "out", workers=0)
    dump(pd.DataFrame({"a": [1]}), root / "market/adjustment/adjfactor.pkl")
    with pytest.raises(ValueError, match="no daily matrix"):
        convert_dataset(spark, settings)


def test_a_series_keeps_its_index(spark, tmp_path):
    dump(pd.Series([1.5, 2.5], index=pd.Index(["x", "y"], name="key"), name="size"), tmp_path / "in/s.pkl")
    dump(pd.Series([3], index=["z"]), tmp_path / "in/t.pkl")
    convert_dataset(spark, ConversionConfig(tmp_path / "in", tmp_path / "out", part="regular"))
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out/s.parquet")).select("key", "size").collect()) == [("x", 1.5), ("y", 2.5)]
    assert spark.read.parquet(str(tmp_path / "out/t.parquet")).select("index", "value").first() == ("z", 3)


def test_exit_codes(spark, tmp_path):
    logs = ["--log-dir", str(tmp_path / "logs")]
    assert cli.main([*logs, "update", "--delivery", str(tmp_path / "none"), "--data", str(tmp_path)]) == 2
    assert cli.main([*logs, "convert", "--input", str(tmp_path / "none")]) == 2
    history(tmp_path / "full")
    assert cli.main([*logs, "convert", "--input", str(tmp_path / "full"), "--output", str(tmp_path / "out"), "--part", "regular", "--workers", "2"]) == 0
    (tmp_path / "new").mkdir()
    (tmp_path / "new" / layout.RISK_ARCHIVE).write_bytes(b"no zip")
    assert cli.main([*logs, "update", "--delivery", str(tmp_path / "new"), "--data", str(tmp_path / "full"), "--trusted-pickle"]) == 2


def test_public_names():
    import ledgerloom

    assert all(hasattr(ledgerloom, n) for n in ledgerloom.__all__) and "update_dataset" in ledgerloom.__all__


def test_catalog_and_manifest(tmp_path):
    dump(1, tmp_path / "a/x.pkl")
    dump(1, tmp_path / "b/x.pkl")
    with pytest.raises(UpdateError):
        catalog(tmp_path)
    path = tmp_path / "m.json"
    Manifest.read(path).record("k", "d")
    assert Manifest.read(path).is_current("k", "d", []) and not Manifest.read(path).is_current("k", "e", [])
    path.write_text("{")
    assert Manifest.read(path).entries == {}


def test_names():
    assert layout.output_path("full/market/adjustment/adjfactor.pkl") == "full/market/adjustment/adj_factor.parquet"
    assert layout.output_path("barra/BETA.PKL") == "barra/BETA.parquet" and layout.output_path("notes.txt") == "notes.txt"
    assert layout.minute_day("kline_day_20240102.pkl") == 20240102 and layout.minute_day("x.pkl") is None
    assert cli.parser().parse_args(["update", "--delivery", "d"]).rtol == 1e-7


def test_equality_rules(spark):
    inf = float("inf")
    rows = [(1.0, 1.0000001, False), (100.0, 110.0, True), (None, None, False), (1.0, None, True), (inf, inf, False), (1.0, inf, True), (0.0, 0.0, False)]
    df = spark.createDataFrame(rows, "l double, r double, e boolean")
    assert df.filter(exprs.unequal(F.col("l"), F.col("r"), 1e-6, 0.0) != F.col("e")).count() == 0
    assert df.select(F.max(exprs.deviation(F.col("l"), F.col("r")))).first()[0] == pytest.approx(10 / 110)
    got = spark.sql("SELECT 1D AS a, 0D AS b").select(exprs.divide(F.col("a"), F.col("b"))).first()[0]
    assert got == inf
    text = spark.createDataFrame([("000001.SZ", 1), ("000001.SZ\n", None), ("1.SZ", None)], "s string, c long")
    assert text.filter(~exprs.symbol_code(F.col("s")).eqNullSafe(F.col("c"))).count() == 0


def test_rollup_ties_and_missing(spark):
    table = bars(20240102).assign(row_id=range(3))
    table.loc[0, "open"] = np.nan
    df = spark.createDataFrame(table).withColumn("open", exprs.nan_to_null(F.col("open")))
    row = minute.roll_up(df).filter("code = 1").first()
    assert (row["open"], row["close"], row["high_time"], row["low_time"], row["minute_rows"]) == (10.5, 11.5, 1459, 930, 2)


def test_overlay_keeps_missing_cells(spark):
    local = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0)], "date int, stock string, value double")
    new = spark.createDataFrame([(1, "a", None), (3, "c", 5.0)], "date int, stock string, value double")
    got = {(r[0], r[1]): r[2] for r in matrix.overlay(local, new).collect()}
    assert got == {(1, "b"): 2.0, (2, "a"): 3.0, (1, "a"): None, (3, "c"): 5.0}


def landed(spark, path, table, name):
    """One Parquet file of bars under a given name."""
    from ledgerloom.streaming.minute_days import SCHEMA

    table = table.assign(row_id=range(len(table))).astype({"volume": "float64"})
    import pyarrow as pa
    import pyarrow.parquet as pq

    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    path.mkdir(parents=True, exist_ok=True)
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in SCHEMA.split(", ")])
    pq.write_table(pa.Table.from_pandas(table, schema=schema, preserve_index=False), path / f"{name}.parquet")


def test_stream_takes_each_bar_once(spark, tmp_path):
    from ledgerloom.streaming.minute_days import ingest_days

    taken = lambda: {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("date", "code", "time", "close").collect()}
    run = lambda checkpoint, **more: ingest_days(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / checkpoint), **more).awaitTermination()
    whole = bars(20240102)
    landed(spark, tmp_path / "in", whole[:2], "a")  # one day in two files and two batches
    landed(spark, tmp_path / "in", bars(20240103), "b")
    run("c1")
    landed(spark, tmp_path / "in", whole[2:], "c")
    landed(spark, tmp_path / "in", whole, "d")  # the whole day again
    run("c1", files=1)
    run("c2")  # everything again
    rows = {tuple(map(float, r)) for t in (whole, bars(20240103)) for r in t[["date", "code", "time", "close"]].itertuples(index=False)}
    assert taken() == rows and spark.read.parquet(str(tmp_path / "out")).count() == 6
    landed(spark, tmp_path / "in", bars(20240103, close=99.0), "e")
    with pytest.raises(Exception, match="differ from the history"):
        run("c1")
    assert taken() == rows


def test_stream_takes_corrections(spark, tmp_path):
    from ledgerloom.streaming.minute_days import corrected_files, ingest_days, take_corrections

    paths = [str(tmp_path / n) for n in ("in", "out", "digests")]
    assert corrected_files(spark, str(tmp_path), paths[2]).count() == 0
    landed(spark, tmp_path / "in", bars(20240102)[:2], "a")
    landed(spark, tmp_path / "in", bars(20240102)[2:], "b")
    landed(spark, tmp_path / "in", bars(20240103), "c")
    ingest_days(spark, paths[0], paths[1], str(tmp_path / "c"), digests=paths[2]).awaitTermination()
    assert take_corrections(spark, *paths) == []
    landed(spark, tmp_path / "in", bars(20240102, close=50.0)[:2], "a")
    assert [r["path"].rsplit("/", 1)[1] for r in corrected_files(spark, paths[0], paths[2]).collect()] == ["a.parquet"]
    assert take_corrections(spark, *paths) == [20240102] and take_corrections(spark, *paths) == []
    got = spark.read.parquet(paths[1])
    assert got.count() == 6 and {r[0] for r in got.filter("date = 20240102 AND code = 1 AND time = 1459").select("close").collect()} == {50.0}


def test_issue_status(spark):
    df = spark.createDataFrame([("a", "PASS"), ("a", "FAIL"), ("b", "WARNING")], "source string, level string")
    assert {r["source"]: r["status"] for r in storage.tally(df).collect()} == {"a": "FAIL", "b": "WARNING"}
