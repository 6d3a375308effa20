"""Stores that are rewritten: pruned reads, mapped and retracted files, features, bars."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tests.plans import scanned
from tickloom.operators import bars, userfuncs
from tickloom.plans import counting, rewriting, sessions
from tickloom.plans.queries import _stored, _stored_splits
from tickloom.schema import BAR, CATALOG
from tickloom.session import staged
from tickloom.sources import shared_tables as tables, stores

SF = "/root/testdata/sf0.001"


@pytest.fixture
def root(spark):
    return _stored(spark, SF)


def read(spark, root):
    return stores.read_ticks(spark, f"{root}/ticks", stores.tick_schema(spark, f"{root}/ticks"))


def catalog(spark, root):
    return stores.read_or_empty(spark, f"{root}/files", CATALOG)


def test_only_the_partitions_named_are_read(spark, tmp_path):
    """Market, product and month of a file are taken together: the months of one product
    are not read of another."""
    folder = str(tmp_path / "ticks")
    rows = [(f"2024/{m}/{c}/{c}2401/2024/{t}/{t}05.spt", m, c, t, v) for m, c in ((3, "CU"), (4, "AG")) for t in ("202401", "202402", "202403") for v in range(3)]
    ticks = spark.createDataFrame(rows, "path string, market int, category string, month string, seq long")
    ticks.write.partitionBy(*stores.TICK_PARTITIONS).parquet(folder)
    stored = spark.read.schema(ticks.schema).parquet(folder)
    files = ticks.filter("(category = 'CU' AND month = '202401') OR (category = 'AG' AND month = '202403')")
    loaded = stores.load_for_catalog(stored, files, clean=False, sort=False)
    partitions, files_read = zip(*scanned(loaded, folder), strict=True)
    named = [f for f in glob.glob(f"{folder}/**/*.parquet", recursive=True) if "CU/month=202401" in f or "AG/month=202403" in f]
    assert partitions == (2,) and files_read == (len(named),)
    assert loaded.count() == 6


def test_partitions_without_a_key_are_kept(spark, tmp_path):
    folder = str(tmp_path / "rows")
    rows = spark.createDataFrame([(None, "a", 1), ("x", "a", 2), ("y", "b", 3)], "part string, key string, v int")
    stores.replace_rows(rows, folder, ["part"], ["key"])
    stores.replace_rows(rows.filter("v = 2").withColumn("v", F.lit(9)), folder, ["part"], ["key"])
    assert sorted(r.v for r in spark.read.parquet(folder).collect()) == [1, 3, 9]


def test_mapping_keeps_files_and_notes_columns(spark, root):
    before = {r.path: r for r in catalog(spark, root).collect()}
    ticks = staged(read(spark, root))
    own = staged(catalog(spark, root).filter("category = 'CL' AND day < '20240110'"))
    doubled = userfuncs.whole(lambda f: f.assign(LastPrice=2 * f.LastPrice, extra=f.seq % 7))
    schema = StructType(ticks.schema.fields).add("extra", "long")
    rewriting.map_stored_files(spark, f"{root}/ticks", f"{root}/files", own, doubled, schema)
    after = {r.path: r for r in catalog(spark, root).collect()}
    mapped = {r.path for r in own.join(ticks, "path", "left_semi").collect()}
    assert mapped and before.keys() == after.keys()
    for path, row in after.items():
        expected = (len(schema) - 6, before[path].zip_ver + 1) if path in mapped else (before[path].column_num, before[path].zip_ver)
        assert (row.column_num, row.zip_ver) == expected and row.tags == before[path].tags
    now = read(spark, root).select("path", "seq", F.col("LastPrice").alias("new"), "extra")
    pairs = ticks.join(now, ["path", "seq"], "full").select("path", "seq", "LastPrice", "new", "extra").collect()
    assert len(pairs) == ticks.count()
    for r in pairs:
        assert (r.new, r.extra) == ((2 * r.LastPrice, r.seq % 7) if r.path in mapped else (r.LastPrice, None))


def test_mapping_that_fails_changes_nothing(spark, root):
    ticks, own = staged(read(spark, root)), staged(catalog(spark, root).filter("category = 'CL'"))
    folders = f"{root}/ticks", f"{root}/files"
    files = sorted(glob.glob(f"{root}/**/*.parquet", recursive=True))
    for func, schema, problem in (
        (lambda f: f.iloc[1:], ticks.schema, "row count changed"),
        (lambda f: f.assign(path=f.path.str.replace("/CL/", "/ER/")), ticks.schema, "change their file"),
        (lambda f: f[["path"]], "path string", "keeps"),
        (lambda f: f.assign(seq="x"), StructType([f for f in ticks.schema if f.name != "seq"]).add("seq", "string"), "another type"),
    ):
        with pytest.raises(Exception, match=problem):
            rewriting.map_stored_files(spark, *folders, own, userfuncs.whole(func), schema)
    kept = sorted(glob.glob(f"{root}/ticks/**/*.parquet", recursive=True))
    assert kept == [f for f in files if f.startswith(f"{root}/ticks")] or read(spark, root).exceptAll(ticks).isEmpty()


def test_doubtful_files_are_not_mapped_twice(spark, root):
    from tickloom.operators.catalog import add_tag
    from tickloom.plans.importing import register

    own = staged(catalog(spark, root).filter("category = 'CL'"))
    register(add_tag(own, rewriting.MAPPING).select(*CATALOG.names), f"{root}/files")
    schema = stores.tick_schema(spark, f"{root}/ticks")
    with pytest.raises(RuntimeError, match="broken run"):
        rewriting.map_stored_files(spark, f"{root}/ticks", f"{root}/files", own, userfuncs.whole(lambda f: f), schema)


def test_mapping_no_file(spark, root):
    schema = stores.tick_schema(spark, f"{root}/ticks")
    none = catalog(spark, root).filter("category = 'none'")
    files = rewriting.map_stored_files(spark, f"{root}/ticks", f"{root}/files", none, userfuncs.whole(lambda f: f), schema)
    assert files.filter("zip_ver <> 1").isEmpty()


def test_retracting_twice_and_forgetting(spark, root):
    _stored_splits(spark, SF, root)
    folders = [f"{root}/{name}" for name in ("ticks", "files", "sessions", "splits")]
    some = staged(catalog(spark, root).filter("category = 'ER' AND day < '20240115'"))
    total, files = read(spark, root).count(), catalog(spark, root).count()
    gone = read(spark, root).join(some, "path", "left_semi").count()
    for _ in range(2):
        left = rewriting.retract_files(spark, some, *folders)
        assert left.count() == files and read(spark, root).count() == total - gone
        assert left.join(some, "path", "left_semi").filter("zip_path IS NOT NULL").isEmpty()
    for folder in folders[2:]:
        assert spark.read.parquet(folder).join(some, "path", "left_semi").isEmpty()
    whole_day = staged(catalog(spark, root).filter("day = '20240103'"))
    left = rewriting.retract_files(spark, whole_day, *folders, forget=True)
    assert left.filter("day = '20240103'").isEmpty() and left.count() == files - whole_day.count()
    assert not os.path.exists(f"{root}/files/day=20240103".removeprefix("file:"))


def test_features_of_unknown_slices_are_refused(spark, root):
    _stored_splits(spark, SF, root)
    rows = staged(sessions.read_splits(spark, f"{root}/splits").select(*stores.FEATURE_KEYS, "high"))
    at = F.lit("2024-02-01 01:00:00").cast("timestamp_ntz")
    with pytest.raises(LookupError, match="no such slice"):
        rewriting.save_feature(spark, rows.withColumn("day", F.lit("19990101")), "f", at, f"{root}/features", f"{root}/splits")
    assert not os.path.exists(f"{root}/features".removeprefix("file:"))
    for _ in range(2):
        saved = rewriting.save_feature(spark, rows, "f", at, f"{root}/features", f"{root}/splits")
        assert {(tuple(r.feature_files), r.feature_num) for r in saved.collect()} == {(("f",), 1)}
    assert spark.read.parquet(f"{root}/features").count() == rows.count() == saved.count()
    reset = rewriting.reset_features(spark, rows, f"{root}/features", f"{root}/splits")
    assert {(tuple(r.feature_files), r.feature_num) for r in reset.collect()} == {((), 0)}
    assert not glob.glob(f"{root}/features/feature=f/*.parquet".removeprefix("file:"))


def test_bars_share_few_files(spark, tmp_path):
    folder = str(tmp_path / "bars")
    ticks = tables.ticks(spark, SF).withColumn("TradingTime", F.col("UpdateTime"))
    made = staged(bars.bars_at_levels(ticks, ["1H", "2H"], seq_bound=tables.seq_bound(spark, SF)))
    stores.write_bars(made, folder)
    stores.write_bars(made, folder)
    assert stores.read_bars(spark, folder).exceptAll(made.select(*BAR.names)).isEmpty()
    assert stores.read_bars(spark, folder).count() == made.count()
    contracts = made.select("level", "category", "InstrumentID").distinct().count()
    assert len(glob.glob(f"{folder}/*/*/*/*.parquet")) <= min(contracts, 2 * 5 * stores.BAR_BUCKETS)
    one = stores.bars_of(spark, folder, "CL2401", "1H")
    assert one.count() == made.filter("InstrumentID = 'CL2401' AND level = '1H'").count() > 0
    assert scanned(one, folder)[0][0] == 1


# --- count tables ---------------------------------------------------------------


def counts(spark, folder):
    return {name: {tuple(r) for r in counting.read_counts(spark, folder, name).collect()} for name in counting.TABLES}


def recounted(rows):
    out = {}
    for name, keys in counting.TABLES.items():
        counted = rows if name not in counting.NAMED else rows.filter(F.coalesce(F.col(name), F.lit("")) != "")
        out[name] = {tuple(r) for r in counted.groupBy(*keys).count().collect()}
    return out


def test_counts_by_changes_equal_a_recount(spark, tmp_path):
    folder = str(tmp_path / "counts")
    rows = staged(tables.annotations(spark, SF).withColumn("source", F.when(F.col("dataset") != 3, F.col("source"))))
    few, more = rows.filter("dataset < 4"), rows.filter("dataset >= 2")
    counting.count_changes(spark, folder, "a", few)
    assert counts(spark, folder) == recounted(few)
    counting.count_changes(spark, folder, "b", more, few)
    assert counts(spark, folder) == recounted(more)
    counting.count_changes(spark, folder, "c", removed=more)
    assert counts(spark, folder) == {name: set() for name in counting.TABLES}
    counting.count_changes(spark, folder, "d", few)
    counting.count_changes(spark, folder, "d", few)
    assert counts(spark, folder) == recounted(few)


def test_a_broken_change_is_completed(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "counts")
    rows = staged(tables.annotations(spark, SF))
    write, left = stores.write_partitions, [2]

    def breaks(df, *args, **kwargs):
        left[0] -= 1
        if left[0] < 0:
            raise OSError("lost")
        write(df.filter("bucket < '5'") if left[0] == 0 else df, *args, **kwargs)

    monkeypatch.setattr(stores, "write_partitions", breaks)
    with pytest.raises(OSError, match="lost"):
        counting.count_changes(spark, folder, "a", rows)
    monkeypatch.setattr(stores, "write_partitions", write)
    counting.count_changes(spark, folder, "a", rows)
    assert counts(spark, folder) == recounted(rows)


def test_rows_that_were_never_there_are_not_taken_away(spark, tmp_path):
    folder = str(tmp_path / "counts")
    rows = staged(tables.annotations(spark, SF))
    counting.count_changes(spark, folder, "a", rows.limit(10))
    before = counts(spark, folder)
    with pytest.raises(ValueError, match="taken away"):
        counting.count_changes(spark, folder, "b", removed=rows)
    assert counts(spark, folder)["source"] == before["source"]


def test_stored_stocks_are_not_copied(spark, tmp_path, monkeypatch):
    """Daily bars that lie in files already, and those of a new folder, go to their
    buckets without being written anywhere else."""
    days = [(f"{i}.SZ", f"2024010{d}", float(i), float(v)) for i in range(40) for d, v in ((1, i), (2, i), (2, i))]
    trades = spark.createDataFrame([(*r, k) for k, r in enumerate(days)], "ts_code string, day string, price double, volume double, seq long")
    daily = stores.stock_daily(trades)
    folder, kept = str(tmp_path / "stocks"), staged(daily)
    monkeypatch.setattr(stores, "scratch", None)
    stores.write_stocks(daily.filter("ts_code < '2'"), folder)
    zeros = kept.withColumn("close", F.lit(0.0))
    stores.write_stocks(zeros.filter("ts_code >= '15'"), folder, stored=True)
    stores.write_stocks(zeros.limit(0), folder, stored=True)
    got = stores.read_stocks(spark, folder).select(*daily.columns).collect()
    want = [*daily.filter("ts_code < '15'").collect(), *zeros.filter("ts_code >= '15'").collect()]
    assert sorted(got) == sorted(want) and len(got) == 80
