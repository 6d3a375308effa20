"""Raw files: scanning, verdicts, storing, registering, importing again."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests import ticks as made
from tests.ticks import MORNING
from tickloom.functions import ids, times
from tickloom.operators import bars, catalog, quality
from tickloom.plans import importing, sessions
from tickloom.schema import CATALOG, CLEAN_TICK, RAW_TICK
from tickloom.sources import raw, stores
from tickloom.streaming.incremental import import_arrivals
from tickloom.streaming.live_bars import import_bars


@pytest.fixture
def root(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    return folder


def tags_by_path(files):
    return {r.path: list(r.tags) for r in files.collect()}


def test_scan_types_and_origin(spark, root):
    path = made.write(root, made.every_half_second(5))
    ticks = raw.scan(spark, str(root))
    assert [f.name for f in RAW_TICK] == ticks.columns[:42]
    assert dict(ticks.dtypes)["UpdateTime"] == "timestamp_ntz"
    found = ticks.orderBy("seq").collect()
    assert {r.path for r in found} == {path}
    assert [r.OpenInterest for r in found] == [1000, 1001, 1002, 1003, 1004]
    assert found[1].UpdateTime == made.MORNING + timedelta(milliseconds=500)
    assert found[0].hhmmss is None and found[0].AskPrice2 is None


def test_positions_follow_the_file_over_many_splits(spark, root):
    made.write(root, made.every_half_second(3000))
    made.write(root, made.every_half_second(900), "CU1906")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        ticks = raw.scan(spark, str(root))
        assert ticks.rdd.getNumPartitions() > 4
        found = ticks.select("path", "seq", "OpenInterest").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    by_file = {}
    for r in sorted(found, key=lambda r: (r.path, r.seq)):
        by_file.setdefault(r.path, []).append(r.OpenInterest)
    assert sorted(len(v) for v in by_file.values()) == [900, 3000]
    assert all(v == list(range(1000, 1000 + len(v))) for v in by_file.values())
    assert len({(r.path, r.seq) for r in found}) == 3900


def test_wrong_widths(spark, root):
    paths = made.all_cases(root)
    ticks = raw.scan(spark, str(root))
    n = {r.path: r["count"] for r in ticks.groupBy("path").count().collect()}
    assert n[paths["wide"]] == 220
    assert n[paths["narrow"]] == 221
    short = ticks.filter(F.col("path") == paths["narrow"]).orderBy(F.desc("seq")).first()
    assert short.LastPrice == 100.0 and short.HighestPrice is None
    strict = raw.scan(spark, str(root), bad_rows="fail_file")
    failed = {r.path for r in strict.filter(quality.FAILED).select("path").distinct().collect()}
    assert failed == {paths["wide"], paths["badtime"]}
    one_column = strict.filter(F.col(quality.FAILED)).select("path").collect()
    assert len(one_column) == 2
    with pytest.raises(ValueError):
        raw.scan(spark, str(root), bad_rows="guess")


def test_legacy_layout(spark, root):
    made.write(root, made.every_half_second(3, layout=made.LEGACY))
    ticks = raw.scan_legacy(spark, str(root))
    assert ticks.columns == [*raw.LEGACY_KEPT, "subID", "path", "seq", quality.FAILED]
    row = ticks.orderBy("seq").first()
    assert (row.subID, row.OpenPrice, row.LastPrice) == ("1906", 100.0, 100.0)


def test_listing(spark, root):
    path = made.write(root, made.every_half_second(3), "CL9999")
    row = raw.list_files(spark, str(root)).first()
    assert row.path == path and row.size == (root / path).stat().st_size
    assert (row.year, row.MarketID, row.category, row.InstrumentID) == ("2019", 4, "CL", "CL9999")
    assert (row.month, row.day, row.subID, row.data_type) == ("201903", "20190326", "9999", "9999")


def test_verdicts(spark, root):
    paths = made.all_cases(root)
    ticks = raw.scan(spark, str(root))
    verdicts = {r.path: r for r in importing.judged(ticks, importing.Rules()).collect()}
    tag = {name: verdicts[path].tag for name, path in paths.items()}
    assert tag == {
        "clean": None,
        "empty": "empty_df",
        "small": "too_small",
        "badtime": None,
        "wide": None,
        "narrow": None,
        "gap": "time_error",
        "dirty": None,
    }
    assert verdicts[paths["dirty"]].line_num == 222
    assert verdicts[paths["dirty"]].zip_line_num == 220
    assert verdicts[paths["badtime"]].zip_line_num == 220
    assert verdicts[paths["clean"]].diff_sec == 109
    strict = importing.judged(raw.scan(spark, str(root), bad_rows="fail_file"), importing.Rules())
    failed = {r.path for r in strict.filter("tag = 'load_df_fail'").collect()}
    assert failed == {paths["wide"], paths["badtime"]}


def test_too_few_columns(spark, root):
    path = made.write(root, ["A1,4,1.0,1,,,2019-03-26 09:00:00.000"] * 220)
    verdict = importing.judged(raw.scan(spark, str(root)), importing.Rules()).first()
    assert (verdict.path, verdict.tag) == (path, "col_error")


def test_accounting_adds_up(spark, root):
    made.all_cases(root)
    for r in quality.wash_accounting(raw.scan(spark, str(root))).collect():
        assert r.line_num == r.kept + r.bad_time + r.bad_volume


def test_import_stores_and_registers(spark, root, tmp_path):
    paths = made.all_cases(root)
    ticks, files = str(tmp_path / "ticks"), str(tmp_path / "files")
    found = importing.import_files(spark, str(root), ticks, files)
    assert tags_by_path(found) == {
        path: {"empty": ["empty_df"], "small": ["too_small"], "gap": ["time_error"]}.get(name, [])
        for name, path in paths.items()
    }
    assert found.filter("line_num is null").count() == 0
    stored = stores.read_ticks(spark, ticks, CLEAN_TICK)
    assert stored.groupBy("path").count().count() == 5
    assert stored.select("time_type").distinct().collect()[0][0] == "fam"
    assert dict(stored.dtypes)["month"] == "string"
    good = {p for n, p in paths.items() if n in ("clean", "badtime", "wide", "narrow", "dirty")}
    assert {r.path for r in found.filter("zip_path is not null").collect()} == good
    assert catalog.missing_data(found, stored).count() == 0


def test_import_twice_changes_nothing(spark, root, tmp_path):
    made.all_cases(root)
    ticks, files = str(tmp_path / "ticks"), str(tmp_path / "files")
    first = importing.import_files(spark, str(root), ticks, files)
    before = sorted(map(str, first.collect()))
    rows = stores.read_ticks(spark, ticks, CLEAN_TICK).count()
    made.write(root, made.every_half_second(300), "ZN1906", "20190327")
    again = importing.import_files(spark, str(root), ticks, files)
    assert again.count() == len(before) + 1
    assert sorted(map(str, again.filter("day = '20190326'").collect())) == before
    assert stores.read_ticks(spark, ticks, CLEAN_TICK).count() == rows + 300


def test_import_after_a_broken_run(spark, root, tmp_path):
    """Ticks stored by a run that died before it registered them do not double."""
    made.all_cases(root)
    ticks, files = str(tmp_path / "ticks"), str(tmp_path / "files")
    importing.import_files(spark, str(root), ticks, files)
    rows = stores.read_ticks(spark, ticks, CLEAN_TICK).count()
    importing.import_files(spark, str(root), ticks, str(tmp_path / "lost"))
    assert stores.read_ticks(spark, ticks, CLEAN_TICK).count() == rows
    found = importing.import_files(spark, str(root), ticks, files, force=True)
    stored = stores.read_ticks(spark, ticks, CLEAN_TICK)
    assert stored.count() == stored.select("path", "seq").distinct().count() == rows
    assert found.count() == 8


def test_import_rules(spark, root, tmp_path):
    made.write(root, made.every_half_second(220), "CU1906")
    made.write(root, made.every_half_second(220), "CU9999")
    made.write(root, made.every_half_second(220, market=3), "IF1906", market=3)
    made.write(root, [*made.every_half_second(220), made.line("2019-03-26 05:00:00", seq=9)], "AL1906")
    rules = importing.Rules(skip_kinds=("9999",), markets=(4,), keep_without_unknown=True)
    found = importing.import_files(spark, str(root), str(tmp_path / "t"), str(tmp_path / "f"), rules=rules)
    assert {r.InstrumentID for r in found.collect()} == {"CU1906", "AL1906"}
    stored = stores.read_ticks(spark, str(tmp_path / "t"), CLEAN_TICK, category="AL")
    assert stored.count() == 220


def test_arrivals(spark, root, tmp_path):
    paths = made.all_cases(root)
    folders = [str(tmp_path / n) for n in ("ticks", "files", "progress")]
    import_arrivals(spark, str(root), *folders, files_per_batch=3)
    files = spark.read.schema(CATALOG).parquet(folders[1])
    assert tags_by_path(files)[paths["gap"]] == ["time_error"]
    assert files.count() == len(paths)
    batch = importing.import_files(spark, str(root), str(tmp_path / "b"), str(tmp_path / "c"))
    keys = ["path", "seq", "UpdateTime", "LastPrice", "time_type"]
    arrived = spark.read.schema(CLEAN_TICK).parquet(folders[0])
    whole = stores.read_ticks(spark, str(tmp_path / "b"), CLEAN_TICK)
    assert arrived.count() == whole.count() > 0
    by_time = ["path", "UpdateTime", "LastPrice", "time_type"]
    assert arrived.select(by_time).exceptAll(whole.select(by_time)).count() == 0
    assert arrived.select(keys).distinct().count() == arrived.count()
    assert batch.count() == files.count()
    made.write(root, made.every_half_second(250), "ZN1906", "20190327")
    import_arrivals(spark, str(root), *folders)
    assert spark.read.schema(CLEAN_TICK).parquet(folders[0]).count() == whole.count() + 250
    sizes = spark.read.schema(CATALOG).parquet(folders[1])
    assert sizes.filter("size > 0").count() == sizes.count() == len(paths) + 1
    again = importing.import_files(spark, str(root), folders[0], folders[1])
    assert again.count() == len(paths) + 1  # the batch import finds nothing left to do


def test_stray_rows_are_kept_and_not_doubled(spark, root, tmp_path):
    """Rows may name another market, none, or spell their contract otherwise."""
    strays = [made.line(datetime(2019, 3, 26, 9, 30, 0, 500000), instrument="ag1906", market=m, seq=300) for m in (3, None)]
    made.write(root, [*made.every_half_second(220), *strays])
    made.write(root, made.every_half_second(230, instrument="cu1906"), "CU1906")
    ticks, files = str(tmp_path / "ticks"), str(tmp_path / "files")
    for force in (False, True):
        found = importing.import_files(spark, str(root), ticks, files, force=force)
        stored = stores.read_ticks(spark, ticks, CLEAN_TICK)
        assert stores.batch_load(stored, found, view="").count() == stored.count() == 452


def test_import_reads_only_new_files(spark, root, tmp_path, monkeypatch):
    for i in range(5):
        made.write(root, made.every_half_second(220), f"A{chr(65 + i)}1906")
    ticks, files = str(tmp_path / "ticks"), str(tmp_path / "files")
    importing.import_files(spark, str(root), ticks, files)
    made.write(root, made.every_half_second(220), "ZN1906")
    read = []
    scan = raw.scan_files
    monkeypatch.setattr(raw, "scan_files", lambda *a, **b: read.append(scan(*a, **b)) or read[-1])
    importing.import_files(spark, str(root), ticks, files)
    assert [len(r.inputFiles()) for r in read] == [1]


def test_imported_files_have_statistics_and_a_dominant_contract(spark, root, tmp_path):
    made.write(root, made.every_half_second(220), "AG1906")
    ticks, files = str(tmp_path / "ticks"), str(tmp_path / "files")
    importing.import_files(spark, str(root), ticks, files)
    made.write(root, [made.line(MORNING, seq=0, OpenInterest=9_000_000, instrument="AG1912"), *made.every_half_second(220, OpenInterest=9_000_000, instrument="AG1912")], "AG1912")
    found = importing.import_files(spark, str(root), ticks, files)
    rows = {r.InstrumentID: r for r in found.collect()}
    assert rows["AG1912"].isDominant and not rows["AG1906"].isDominant
    assert rows["AG1906"].high == 106.0 and rows["AG1906"].volume_sum == 220
    stored = stores.read_ticks(spark, ticks, CLEAN_TICK)
    assert stores.batch_load(stored, found).count() == 221


def test_missing_store_reads_empty(spark, tmp_path):
    none = stores.read_ticks(spark, str(tmp_path / "none"), CLEAN_TICK)
    assert none.count() == 0 and none.columns == CLEAN_TICK.names


def test_append_sets_aside_unusable(spark, root, tmp_path):
    made.write(root, [*made.every_half_second(3), made.line("never")])
    ticks = raw.with_file_columns(raw.scan(spark, str(root)))
    stores.append_ticks(ticks, str(tmp_path / "good"), str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "good")).count() == 3
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1


def test_path_parts_of_short_path(spark):
    df = spark.createDataFrame([("2019/4/A/A1905/2019/201903/20190326.spt",)], "path string")
    row = ids.with_path_parts(df).first()
    assert (row.category, row.InstrumentID, row.subID, row.data_type) == ("A", "A1905", "1905", "tick")


def test_split_job(spark, root, tmp_path):
    made.write(root, made.every_half_second(220), "AG1906")
    made.write(root, [*made.every_half_second(220), *made.every_half_second(150, volume=2)], "CU1906")
    made.write(root, made.every_half_second(230), "AL1906")
    ticks, files, slices, splits = (str(tmp_path / n) for n in ("ticks", "files", "slices", "splits"))
    importing.import_files(spark, str(root), ticks, files)
    stored = stores.read_ticks(spark, ticks, CLEAN_TICK)
    for _ in range(2):
        found = sessions.split_files(spark, stored, files, slices, splits)
        assert sorted((r.InstrumentID, r.time_type, r.zip_line_num) for r in found.collect()) == [("AG1906", "fam", 220), ("AL1906", "fam", 230)]
        assert spark.read.parquet(slices).count() == 450
        tags = {r.InstrumentID: (r.tags, r.doc_num) for r in spark.read.schema(CATALOG).parquet(files).collect()}
        assert tags == {"AG1906": (["splited"], 1), "AL1906": (["splited"], 1), "CU1906": (["dup_time"], 0)}
    one = spark.read.schema(CATALOG).parquet(files).filter("InstrumentID = 'AG1906'")
    sessions.retract_splits(spark, one, files, slices, splits)
    assert [r.InstrumentID for r in sessions.read_splits(spark, splits).collect()] == ["AL1906"]
    assert spark.read.parquet(slices).count() == 230
    left = {r.InstrumentID: (r.tags, r.doc_num) for r in spark.read.schema(CATALOG).parquet(files).collect()}
    assert left["AG1906"] == ([], 0) and left["AL1906"] == (["splited"], 1)


def test_late_ticks_change_bars_within_the_watermark(spark, root, tmp_path):
    folders = str(tmp_path / "bars"), str(tmp_path / "progress")

    def arrive(day, *lines):
        made.write(root, list(lines), day=day)
        import_bars(spark, str(root), *folders, "15min", delay="1 hour")
        stored = stores.read_bars(spark, folders[0]).orderBy("TradingTime").collect()
        return {(r.TradingTime - timedelta(hours=6)).strftime("%H:%M"): (r.open, r.close, r.high, r.TotalVolume) for r in stored}

    def at(hour, minute, price, second=0):
        return made.line(datetime(2019, 3, 26, hour, minute, second), price=price, volume=2)

    first = arrive("20190326", at(9, 1, 100.0), at(9, 5, 101.0), at(9, 20, 102.0))
    assert first == {"09:00": (100.0, 101.0, 101.0, 4.0), "09:15": (102.0, 102.0, 102.0, 2.0)}
    late = arrive("20190327", at(9, 40, 99.0), at(9, 0, 98.0), at(9, 7, 105.0))
    assert late["09:00"] == (98.0, 105.0, 105.0, 8.0) and late["09:30"] == (99.0, 99.0, 99.0, 2.0)
    assert late["09:15"] == first["09:15"]
    moved = arrive("20190328", at(11, 0, 97.0))
    assert moved["11:00"] == (97.0, 97.0, 97.0, 2.0) and moved["09:00"] == late["09:00"]
    beyond = arrive("20190329", at(9, 2, 1.0), at(10, 50, 96.0), at(10, 1, 95.0))
    assert beyond["09:00"] == late["09:00"]
    assert beyond["10:45"] == (96.0, 96.0, 96.0, 2.0) and beyond["10:00"] == (95.0, 95.0, 95.0, 2.0)


def test_streamed_bars_equal_batch_bars(spark, root, tmp_path):
    for i, name in enumerate(("AG1906", "CU1906", "ZN1906")):
        made.write(root, made.every_half_second(4000, instrument=name, start=made.MORNING + timedelta(minutes=7 * i)), name)
    folders = str(tmp_path / "bars"), str(tmp_path / "progress")
    import_bars(spark, str(root), *folders, "5min", files_per_batch=1)
    ticks = raw.scan(spark, str(root)).withColumn("TradingTime", times.bar_time(F.col("UpdateTime")))
    batch = bars.bars(ticks, "5min")
    stored = stores.read_bars(spark, folders[0])
    exact = [c for c in batch.columns if c not in ("volume_std", "Turnover_new")]
    assert stored.count() == batch.count() > 15
    assert stored.select(exact).exceptAll(batch.select(exact)).isEmpty()


def test_import_of_some_months(spark, root, tmp_path):
    for day in ("20190328", "20190401", "20190530", "20190603", "20200102"):
        start = datetime.strptime(day + "0900", "%Y%m%d%H%M")
        made.write(root, made.every_half_second(220, start=start), day=day)
    folders = str(tmp_path / "ticks"), str(tmp_path / "files")
    pattern = raw.months_glob("201904", "201905")
    assert pattern == "*/*/*/*/*/{201904,201905}/*.spt"
    assert {r.day for r in raw.list_files(spark, str(root), pattern).collect()} == {"20190401", "20190530"}
    importing.import_files(spark, str(root), *folders, pattern=pattern)
    files = importing.import_files(spark, str(root), *folders, pattern=raw.months_glob("201912", "202002"))
    assert {r.day for r in files.collect()} == {"20190401", "20190530", "20200102"}
    with pytest.raises(ValueError, match="is after"):
        raw.months_glob("202001", "201912")


def test_import_judges_once_and_copies_ticks_once(spark, root, tmp_path, monkeypatch):
    """Beside the lines only a row per file is written down: verdicts and the catalog."""
    path = made.write(root, made.every_half_second(2000))
    made.write(root, made.every_half_second(5), "CU1906")
    written, judged, scratch = [], [], importing.scratch
    monkeypatch.setattr(importing, "scratch", lambda df: written.append(df.columns) or scratch(df))
    monkeypatch.setattr(importing, "judged", lambda *a, f=importing.judged: judged.append(f(*a)) or judged[-1])
    ticks, files = str(tmp_path / "ticks"), str(tmp_path / "files")
    found = importing.import_files(spark, str(root), ticks, files)
    assert [c for c in written if "LastPrice" in c] == written[:1] and judged[0].columns in written
    stored = stores.read_ticks(spark, ticks, CLEAN_TICK).select("path").distinct().collect()
    assert [r.path for r in stored] == [path] and len(tags_by_path(found)) == 2
