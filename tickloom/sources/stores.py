"""Parquet stores of ticks, bars, catalogs, features and stocks."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickloom.functions import ids, times
from tickloom.operators.catalog import FILE_VIEWS, remove_tag
from tickloom.operators.filters import filter_by
from tickloom.operators.projections import catalog_days, for_load, without_level
from tickloom.schema import BAR, CLEAN_TICK, MIN_ROWS, STOCK_BAR, STORED_CATEGORIES, layout
from tickloom.session import delete_folder, folder_exists, listed, scratch

# Market, product and month of the file a tick came from; its row may say otherwise.
TICK_PARTITIONS = ["market", "category", "month"]
TICK_ORDER = ["InstrumentID", "UpdateTime", "seq"]
STOCK_BUCKETS = 64
BAR_BUCKETS = 8
BAR_PARTITIONS = ["level", "category", "bucket"]
BAR_KEYS = ["level", "InstrumentID"]
FEATURE_KEYS = ["path", "day", "time_type"]
_STORED_STOCK = StructType(STOCK_BAR.fields).add("bucket", "string")
_STORED_BAR = StructType(BAR.fields).add("bucket", "string")
# Beside the partitions of a tick store, a list of the columns mapped files have
# gained. Readers of the store skip folders with this first letter.
_GAINED = "_gained_columns"
_GAINED_SCHEMA = layout("string name type")


def write_partitions(
    df: DataFrame, folder: str, partitions: list[str], sort: list[str] = (), mode: str = "overwrite"
) -> None:
    """Write the partitions present in ``df``, leaving others as they are.

    The rebalance hint gathers a partition's rows into few files, splits large
    partitions and merges small ones."""
    rows = df.hint("rebalance", *partitions)
    if sort:
        rows = rows.sortWithinPartitions(*partitions, *sort)
    (
        rows.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partitions)
        .parquet(folder)
    )


def read_or_empty(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def drop_partition(spark: SparkSession, folder: str, partition: dict[str, str]) -> bool:
    """Delete the folder of one partition; false if there is none."""
    parts = "/".join(f"{k}={v}" for k, v in partition.items())
    return delete_folder(spark, f"{folder}/{parts}")


# --- ticks -------------------------------------------------------------------


def write_ticks(ticks: DataFrame, folder: str, mode: str = "overwrite") -> None:
    write_partitions(ticks, folder, TICK_PARTITIONS, TICK_ORDER, mode)


def append_ticks(ticks: DataFrame, folder: str, rejected_folder: str) -> None:
    """Append ticks; rows without contract or time go to a table of their own."""
    usable = F.col("InstrumentID").isNotNull() & F.col("UpdateTime").isNotNull()
    write_ticks(ticks.filter(usable), folder, mode="append")
    ticks.filter(~usable).write.mode("append").parquet(rejected_folder)


def read_ticks(spark: SparkSession, folder: str, schema: StructType, **wanted) -> DataFrame:
    """Stored ticks that match the keywords; none if nothing is stored."""
    return filter_by(read_or_empty(spark, folder, schema), **wanted)


def partitions_of(paths: DataFrame) -> DataFrame:
    """Paths with the partition their ticks are stored in."""
    parts = ids.with_path_parts(paths.select("path").distinct()).withColumn("market", F.col("MarketID"))
    return parts.select("path", *TICK_PARTITIONS)


def _partition_key(partitions: list[str]) -> Column:
    return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in partitions])


def near(rows: DataFrame, keys: DataFrame, partitions: list[str] = TICK_PARTITIONS) -> DataFrame:
    """Stored rows of the partitions that a list of keys names, each by all its columns
    together. The join with the list, one short row a partition, prunes the scan while
    it runs: no other partition is read. Rows that do not have all partition columns
    are returned as they are."""
    if not set(partitions) <= set(rows.columns) & set(keys.columns):
        return rows
    named = listed(keys.select(_partition_key(partitions).alias("_near")).distinct())
    # Spark prunes by a list that a comparison narrows; all keys pass this one.
    named = named.filter(F.col("_near") >= "")
    return rows.join(named, _partition_key(partitions) == F.col("_near"), "left_semi")


def retract_ticks(spark: SparkSession, folder: str, schema: StructType, paths: DataFrame) -> None:
    """Delete the stored ticks of some files."""
    doomed = listed(partitions_of(paths))
    stored = near(read_or_empty(spark, folder, schema), doomed)
    drop_rows(stored, folder, TICK_PARTITIONS, doomed, ["path"], TICK_ORDER)


def drop_rows(
    stored: DataFrame, folder: str, partitions: list[str], doomed: DataFrame, keys: list[str], sort: list[str] = ()
) -> None:
    """Delete the stored rows with some keys. Only the partitions that hold any are
    rewritten, all in one step; those left with no rows go last."""
    doomed = doomed.select(*keys)
    touched = listed(stored.join(doomed, keys, "left_semi").select(*partitions).distinct())
    if touched.isEmpty():
        return
    kept = near(stored, touched, partitions).join(doomed, keys, "left_anti").select(*stored.columns)
    _overwrite(kept, touched, folder, partitions, sort)


def _overwrite(
    rows: DataFrame, touched: DataFrame | None, folder: str, partitions: list[str], sort: list[str]
) -> None:
    """Put rows in place of their partitions, which they may be read from: Spark replaces
    these only once all rows are written elsewhere. Those of ``touched`` that get no rows
    are deleted after that."""
    emptied = []
    if touched is not None:
        emptied = touched.join(rows.select(*partitions).distinct(), partitions, "left_anti").collect()
    write_partitions(rows, folder, partitions, sort)
    for partition in emptied:
        drop_partition(rows.sparkSession, folder, partition.asDict())


def tick_schema(spark: SparkSession, folder: str) -> StructType:
    """Columns of a tick store: those of an import, and what mapped files have gained.
    A file that has no such column reads as null."""
    gained = read_or_empty(spark, f"{folder}/{_GAINED}", _GAINED_SCHEMA).distinct().orderBy("name").collect()
    return StructType([*CLEAN_TICK.fields, *[StructType.fromDDL(f"`{r.name}` {r.type}").fields[0] for r in gained]])


def gain_columns(spark: SparkSession, folder: str, schema: StructType) -> StructType:
    """Note the columns of ``schema`` that the store does not have yet; returns the
    store's columns. A column that is stored with another type is an error."""
    known = {f.name: f.dataType for f in tick_schema(spark, folder)}
    other = sorted(f.name for f in schema if known.get(f.name, f.dataType) != f.dataType)
    if other:
        raise ValueError(f"stored with another type: {other}")
    new = [(f.name, f.dataType.simpleString()) for f in schema if f.name not in known]
    if new:
        spark.createDataFrame(new, _GAINED_SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{_GAINED}")
    return tick_schema(spark, folder)


def replace_ticks(ticks: DataFrame, folder: str) -> None:
    """Ticks in place of those stored of the same files. Columns they do not have are
    null, columns the store does not have are added to it."""
    schema = gain_columns(ticks.sparkSession, folder, ticks.schema)
    aligned = [
        (F.col(f.name) if f.name in ticks.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ]
    replace_rows(ticks.select(*aligned), folder, TICK_PARTITIONS, ["path"], TICK_ORDER)


def load_for_catalog(ticks: DataFrame, files: DataFrame, clean: bool = True, sort: bool = True) -> DataFrame:
    """Ticks of the selected catalog rows, found by the path of their file, with the
    day of the file, in time order. Only the partitions the selection names are
    read."""
    chosen = listed(partitions_of(files))
    loaded = near(ticks, chosen).join(chosen.select("path"), "path", "left_semi")
    loaded = for_load(loaded) if clean else loaded
    return loaded.orderBy("UpdateTime", "seq") if sort else loaded


def batch_load(
    ticks: DataFrame, files: DataFrame, view: str = "main", clean: bool = True, sort: bool = True, **wanted
) -> DataFrame:
    """Ticks of the files a view and keywords select."""
    return load_for_catalog(ticks, filter_by(FILE_VIEWS[view](files), **wanted), clean, sort)


def load_days(files: DataFrame, view: str = "main", **wanted) -> DataFrame:
    """Daily rows of the files a view and keywords select."""
    return catalog_days(filter_by(FILE_VIEWS[view](files), **wanted))


def category_ticks(
    ticks: DataFrame, categories: list[str], known: list[str] = STORED_CATEGORIES, dominant: bool = False
) -> DataFrame:
    """Ticks of products that have a table; with ``dominant`` of the contracts
    flagged as such."""
    strangers = sorted(set(categories) - set(known))
    if strangers:
        raise ValueError(f"no tick table for {strangers}")
    own = ticks.filter(F.col("category").isin(*categories))
    return own.filter("isDominant") if dominant else own


# --- bars --------------------------------------------------------------------


def _bar_bucket(instrument: Column) -> Column:
    return F.pmod(F.xxhash64(instrument), F.lit(BAR_BUCKETS)).cast("string")


def write_bars(bars: DataFrame, folder: str, instruments: list[str] = (), levels: list[str] = ()) -> None:
    """Replace the bars of each contract and level. The contracts and levels named lose
    their old bars even where there are no new ones.

    Products share partitions with their level; contracts lie in a few buckets of
    these, in order, so that there are few files and a contract is found by the extremes
    of their blocks."""
    rows = bars.select(*BAR.names).withColumn("bucket", _bar_bucket(F.col("InstrumentID")))
    gone = None
    if instruments and levels:
        names = bars.sparkSession.createDataFrame([(i,) for i in instruments], "InstrumentID string")
        gone = names.select(
            F.explode(F.array(*[F.lit(level) for level in levels])).alias("level"),
            ids.category(F.col("InstrumentID")).alias("category"),
            _bar_bucket(F.col("InstrumentID")).alias("bucket"),
            "InstrumentID",
        )
    replace_rows(rows, folder, BAR_PARTITIONS, BAR_KEYS, ["InstrumentID", "TradingTime"], gone)


def merge_bars(bars: DataFrame, folder: str) -> None:
    """Put bars in place of those of the same contract, level and time; all others stay."""
    rows = bars.select(*BAR.names).withColumn("bucket", _bar_bucket(F.col("InstrumentID")))
    replace_rows(rows, folder, BAR_PARTITIONS, [*BAR_KEYS, "TradingTime"], ["InstrumentID", "TradingTime"])


def read_bars(spark: SparkSession, folder: str) -> DataFrame:
    return read_or_empty(spark, folder, _STORED_BAR).select(*BAR.names)


def bars_of(spark: SparkSession, folder: str, instrument: str, level: str) -> DataFrame:
    """Stored bars of a contract, from its bucket only."""
    category = ids.category(F.lit(instrument))
    own = (F.col("level") == level) & (F.col("category") == category) & (F.col("InstrumentID") == instrument)
    stored = read_or_empty(spark, folder, _STORED_BAR).filter(own & (F.col("bucket") == _bar_bucket(F.lit(instrument))))
    return stored.select(*BAR.names)


def write_daily(bars: DataFrame, folder: str, instruments: list[str] = ()) -> None:
    """Replace the daily bars of each contract, also of those named without any."""
    rows = without_level(bars).withColumn("bucket", _bar_bucket(F.col("InstrumentID")))
    gone = None
    if instruments:
        names = bars.sparkSession.createDataFrame([(i,) for i in instruments], "InstrumentID string")
        gone = names.select(
            ids.category(F.col("InstrumentID")).alias("category"),
            _bar_bucket(F.col("InstrumentID")).alias("bucket"),
            "InstrumentID",
        )
    replace_rows(rows, folder, BAR_PARTITIONS[1:], ["InstrumentID"], ["InstrumentID", "TradingTime"], gone)


def load_bars(bars: DataFrame, categories: list[str], level: str) -> DataFrame:
    """Bars of products at a level in time order; no bars is an error."""
    found = bars.filter(F.col("category").isin(*categories) & (F.col("level") == level))
    if found.isEmpty():
        raise LookupError(f"no {level} bars of {categories}")
    return found.orderBy("TradingTime", "InstrumentID")


def load_daily(daily: DataFrame, categories: list[str], main: bool = True) -> DataFrame:
    """Daily bars of products, of dominant contracts only while ``main``, in
    time order; no bars is an error."""
    found = daily.filter(F.col("category").isin(*categories)).drop("tags")
    found = found.filter("isDominant") if main else found
    if found.isEmpty():
        raise LookupError(f"no daily bars of {categories}")
    return found.orderBy("TradingTime", "InstrumentID")


# --- sessions, features, stocks ------------------------------------------------


def replace_rows(
    rows: DataFrame,
    folder: str,
    partitions: list[str],
    keys: list[str],
    sort: list[str] = (),
    gone: DataFrame | None = None,
    stored: bool = False,
) -> None:
    """Store rows in place of those with the same keys. Other rows of the partitions
    they fall into are kept, other partitions are not touched. ``gone`` names further
    keys, with their partitions, that lose their rows.

    Rows are written down first, since they are used twice, unless they are ``stored``:
    a selection from files outside ``folder``. A new folder has nothing to replace."""
    if not folder_exists(rows.sparkSession, folder):
        write_partitions(rows, folder, partitions, sort)
        return
    columns = list(dict.fromkeys([*partitions, *keys]))
    with nullcontext(rows) if stored else scratch(rows) as new:
        names = new.select(*columns).distinct()
        if gone is not None:
            names = names.unionByName(gone.select(*columns)).distinct()
        names = listed(names)
        touched = names.select(*partitions).distinct()
        old = near(read_or_empty(rows.sparkSession, folder, new.schema), touched, partitions)
        kept = old.join(names.select(*keys).distinct(), keys, "left_anti").select(*new.columns)
        _overwrite(kept.unionByName(new), None if gone is None else touched, folder, partitions, sort)


def write_sessions(ticks: DataFrame, folder: str, min_rows: int = MIN_ROWS) -> None:
    """Labelled ticks by the day of their file (``file_day``). What an earlier run
    has stored of the same files goes, other files of the day stay. Slices of a
    trading day and session below ``min_rows`` ticks are not stored."""
    slices = ["path", "split_day", "time_type"]
    labelled = ticks.withColumn("split_day", times.split_day(F.col("UpdateTime")))
    sizes = labelled.groupBy(*slices).agg(F.count(F.lit(1)).alias("n"))
    enough = listed(sizes.filter(F.col("n") >= min_rows).select(*slices))
    kept = labelled.join(enough, slices, "left_semi").select(*labelled.columns)
    replace_rows(kept, folder, ["file_day"], ["path"], ["InstrumentID", "split_day", "time_type", "UpdateTime", "seq"])


def write_feature(rows: DataFrame, folder: str, name: str, keys: list[str] = FEATURE_KEYS) -> None:
    """Rows of a feature, in place of those of the same slices."""
    replace_rows(rows.withColumn("feature", F.lit(name)), folder, ["feature"], ["feature", *keys])


def retract_feature(spark: SparkSession, folder: str, name: str, slices: DataFrame) -> None:
    """Delete the rows of some slices from a feature, if it is stored."""
    try:
        stored = spark.read.option("basePath", folder).parquet(f"{folder}/feature={name}")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return
    drop_rows(stored, folder, ["feature"], slices, FEATURE_KEYS)


def drop_feature(spark: SparkSession, folder: str, name: str) -> bool:
    return drop_partition(spark, folder, {"feature": name})


def stock_daily(trades: DataFrame) -> DataFrame:
    """Daily bars of stocks from priced trades in the order of ``seq``."""
    price = F.col("price").cast("double")
    return trades.groupBy("ts_code", "day").agg(
        F.min_by(price, "seq").alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, "seq").alias("close"),
        F.sum("volume").cast("double").alias("volume"),
        F.count(F.lit(1)).alias("trades"),
    )


def _bucket(code: Column) -> Column:
    return F.pmod(F.xxhash64(code), F.lit(STOCK_BUCKETS)).cast("string")


def write_stocks(daily: DataFrame, folder: str, stored: bool = False) -> None:
    """Daily bars in place of those of the same stocks. Stocks share buckets: there
    are too many for a folder each. Bars that are ``stored`` elsewhere are not written
    down first."""
    rows = daily.select(*STOCK_BAR.names).withColumn("bucket", _bucket(F.col("ts_code")))
    replace_rows(rows, folder, ["bucket"], ["bucket", "ts_code"], ["ts_code", "day"], stored=stored)


def read_stocks(spark: SparkSession, folder: str) -> DataFrame:
    """Stored daily bars; none if nothing is stored."""
    return read_or_empty(spark, folder, _STORED_STOCK)


def read_stock(spark: SparkSession, folder: str, code: str) -> DataFrame:
    own = (F.col("bucket") == _bucket(F.lit(code))) & (F.col("ts_code") == code)
    return read_stocks(spark, folder).filter(own).drop("bucket")


def drop_stock(spark: SparkSession, folder: str, stocks: DataFrame, code: str) -> DataFrame:
    """Delete a stock's bars; returns the list of stocks without its tag for them."""
    own = read_stocks(spark, folder).filter(F.col("bucket") == _bucket(F.lit(code)))
    doomed = spark.createDataFrame([(code,)], "ts_code string")
    drop_rows(own, folder, ["bucket"], doomed, ["ts_code"], ["ts_code", "day"])
    return remove_tag(stocks, "got_1dK", F.col("ts_code") == code)
