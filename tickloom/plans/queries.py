"""One query per operator over the shared tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickloom.functions import ids, times
from tickloom.operators import backtest, bars, catalog, filters, projections, quality, sampling, stats, userfuncs
from tickloom.plans import counting, importing, klines, rewriting, sessions
from tickloom.schema import CATALOG, CLEAN_TICK, LEVELS, RAW_TICK, RAW_TICK_LEGACY
from tickloom.session import move_only_file, shared_folder, staged
from tickloom.sources import raw, shared_tables as tables, stores

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# The shared tables hold about eleven ticks per contract and day, so the limits
# on rows and repeats are lower here than their defaults.
MIN_FILE_ROWS = 10
MIN_SLICE_ROWS = 3
MAX_HOURLY_REPEATS = 2
PRICE_STD = 30
SOME_PRODUCTS = ["CL", "ER", "PU"]
STAT_COLUMNS = ["LastPrice", "LastVolume", "HighestPrice", "LowestPrice", "OpenPrice"]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def products(spark: SparkSession, sf: str) -> list[str]:
    """All products of the ticks."""
    return sorted(r.category for r in tables.ticks(spark, sf).select("category").distinct().collect())


def scratch_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def rounded(df: DataFrame, *columns: str, digits: int = 10) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("UpdateTime")
    return filters.wash(tables.ticks(spark, sf)).withColumn("time_type", times.session_by_hour(t))


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks on whole hours, so that instants repeat."""
    us = times.micros(F.col("UpdateTime"))
    return tables.ticks(spark, sf).withColumn(
        "UpdateTime", times.from_micros(times.bin_start(us, times.HOUR))
    )


def split_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sessions.split_rows(
        sessions.labelled_ticks(filters.wash(tables.ticks(spark, sf)), strict=False),
        tables.catalog(spark, sf),
        MIN_SLICE_ROWS,
        tables.seq_bound(spark, sf),
    )


# --- sources and stores --------------------------------------------------------


@query
def path_parts(spark: SparkSession, sf: str) -> DataFrame:
    return ids.with_path_parts(tables.ticks(spark, sf).select("path").distinct())


@query
def incremental_new(spark: SparkSession, sf: str) -> DataFrame:
    listing = tables.ticks(spark, sf).select("path").distinct()
    registered = tables.catalog(spark, sf).filter(F.col("line_num").isNotNull())
    return catalog.files_to_import(listing, registered)


@query
def load_ticks(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf).select(
        "path", "seq", "InstrumentID", "UpdateTime", "LastPrice", "LastVolume", "time_type"
    )


@query
def batch_load(spark: SparkSession, sf: str) -> DataFrame:
    loaded = stores.batch_load(labelled(spark, sf), tables.catalog(spark, sf), "main", MarketID__in=[3, 4])
    return loaded.select(
        "InstrumentID", "day", "UpdateTime", "seq", "LastPrice", "LastVolume", "OpenInterest", "time_type"
    )


@query
def load_days(spark: SparkSession, sf: str) -> DataFrame:
    days = stores.load_days(tables.catalog(spark, sf), "")
    return rounded(rounded(days, "Turnover", "Turnover_calc", digits=4), "mean")


@query
def category_ticks(spark: SparkSession, sf: str) -> DataFrame:
    own = stores.category_ticks(tables.ticks(spark, sf), SOME_PRODUCTS, products(spark, sf))
    return own.select("category", "InstrumentID", "UpdateTime", "seq", "LastPrice")


@query
def dominant_ticks(spark: SparkSession, sf: str) -> DataFrame:
    flagged = catalog.with_dominant_flag(tables.ticks(spark, sf), tables.catalog(spark, sf), F.col("day"))
    every = products(spark, sf)
    own = stores.category_ticks(flagged, every, every, dominant=True)
    return own.select("category", "InstrumentID", "UpdateTime", "seq", "LastPrice")


@query
def ticks_by_id(spark: SparkSession, sf: str) -> DataFrame:
    chosen = klines.bar_input(tables.ticks(spark, sf))
    return rounded(chosen, "Turnover", "HighestPrice", "LowestPrice", digits=4)


@query
def replace_by_key(spark: SparkSession, sf: str) -> DataFrame:
    ticks, bound = klines.bar_input(tables.ticks(spark, sf)), tables.seq_bound(spark, sf)
    made = bars.bars_at_levels(ticks, ["1H", "1d"], seq_bound=bound)
    short = staged(made.select("InstrumentID", "level", "TradingTime", "close"))
    stale = short.withColumn("close", F.lit(0.0))
    scope = stale.filter("level = '1H'").select("InstrumentID", "level")
    return stats.replace_by_key(stale, short.filter("level = '1H'"), scope)


def _bars(spark: SparkSession, sf: str, level: str) -> DataFrame:
    ticks = klines.bar_input(tables.ticks(spark, sf))
    return bars.bars(ticks, level, seq_bound=tables.seq_bound(spark, sf))


def _rounded_bars(made: DataFrame) -> DataFrame:
    prices = ["HighestPrice", "LowestPrice", "OpenPrice", "AvePrice", "Turnover", "Turnover_new", "volume_std"]
    return rounded(made, *prices, digits=4)


@query
def load_kline(spark: SparkSession, sf: str) -> DataFrame:
    stored = staged(_bars(spark, sf, "1H"))
    return _rounded_bars(stores.load_bars(stored, products(spark, sf), "1H"))


@query
def bar_store(spark: SparkSession, sf: str) -> DataFrame:
    """Bars of two levels stored twice, the second time the hourly ones only. Contracts
    of one product are named without new bars."""
    ticks, folder = klines.bar_input(tables.ticks(spark, sf)), scratch_folder(spark, "bars")
    made = staged(bars.bars_at_levels(ticks, ["1H", "2H"], seq_bound=tables.seq_bound(spark, sf)))
    stores.write_bars(made.withColumn("close", F.lit(0.0)), folder)
    named = made.filter(F.col("category").isin("ER", "VI")).select("InstrumentID").distinct().collect()
    fresh = made.filter("level = '1H' AND category <> 'VI'")
    stores.write_bars(fresh, folder, [r.InstrumentID for r in named], ["1H"])
    return stores.read_bars(spark, folder).select("InstrumentID", "level", "TradingTime", "close")


@query
def load_1day_kline(spark: SparkSession, sf: str) -> DataFrame:
    daily = catalog.with_dominant_flag(
        bars.daily(_bars(spark, sf, "1d")),
        tables.catalog(spark, sf),
        times.calendar_day(F.col("TradingTime")),
    )
    return _rounded_bars(stores.load_daily(staged(daily), products(spark, sf)))


@query
def feature_register(spark: SparkSession, sf: str) -> DataFrame:
    rows = split_rows(spark, sf)
    for name, hour, where in (
        ("momentum", 1, None),
        ("depth", 2, F.col("time_type") == "night"),
    ):
        at = F.lit(f"2024-02-01 0{hour}:00:00").cast("timestamp_ntz")
        rows = catalog.register_feature(rows, name, at, where)
    return rows.select(
        "path", "day", "time_type", F.array_join("feature_files", "|").alias("features"),
        "feature_num", "feature_time",
    )


@query
def stock_daily(spark: SparkSession, sf: str) -> DataFrame:
    return stores.stock_daily(tables.stock_trades(spark, sf))


@query
def stock_store(spark: SparkSession, sf: str) -> DataFrame:
    """Stocks saved in turns, one of them twice; each save replaces its own only."""
    daily, folder = staged(stores.stock_daily(tables.stock_trades(spark, sf))), scratch_folder(spark, "stocks")
    odd = F.pmod(F.xxhash64("ts_code"), F.lit(2)) == 1
    stores.write_stocks(daily.filter(odd).withColumn("close", F.lit(0.0)), folder, stored=True)
    stores.write_stocks(daily.filter(~odd), folder, stored=True)
    stores.write_stocks(daily.filter(odd), folder, stored=True)
    return stores.read_stocks(spark, folder).drop("bucket")


@query
def store_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks of one market stored, those of the others appended; rows without a
    contract are set aside by the append."""
    lost = F.col("seq") % 101 == 0
    ticks = tables.ticks(spark, sf).select(
        "path", "seq", "UpdateTime", "LastPrice", F.when(~lost, F.col("InstrumentID")).alias("InstrumentID")
    )
    ticks, folder = raw.with_file_columns(ticks), scratch_folder(spark, "ticks")
    stores.write_ticks(ticks.filter("market = 3"), folder)
    stores.append_ticks(ticks.filter("market <> 3"), folder, scratch_folder(spark, "rejected"))
    return stores.read_ticks(spark, folder, ticks.schema).select("path", "seq", "market", "InstrumentID", "LastPrice")


@query
def session_store(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions saved market by market, one market twice."""
    labelled = sessions.labelled_ticks(filters.wash(tables.ticks(spark, sf)), strict=False)
    rows = staged(labelled.withColumn("file_day", F.col("day")))
    folder = scratch_folder(spark, "sessions")
    for market in (3, 4, 3):
        stores.write_sessions(rows.filter(F.col("MarketID") == market), folder, MIN_SLICE_ROWS)
    return spark.read.parquet(folder).select("path", "file_day", "time_type", "seq", "LastPrice")


@query
def feature_store(spark: SparkSession, sf: str) -> DataFrame:
    """A feature saved slice by slice, some slices twice, and a second one dropped."""
    rows = staged(split_rows(spark, sf).select("path", "day", "time_type", F.col("high").alias("value")))
    folder = scratch_folder(spark, "features")
    night = F.col("time_type") == "night"
    stores.write_feature(rows.filter(night).withColumn("value", F.lit(0.0)), folder, "highest")
    stores.write_feature(rows.filter(~night), folder, "highest")
    stores.write_feature(rows, folder, "other")
    stores.write_feature(rows.filter(night), folder, "highest")
    stores.drop_feature(spark, folder, "other")
    return spark.read.parquet(folder).select("feature", "path", "day", "time_type", "value")


def _stored(spark: SparkSession, sf: str) -> str:
    """Folder with the shared ticks as a store and the shared catalog."""
    root = scratch_folder(spark, "stored")
    ticks = raw.with_file_columns(labelled(spark, sf))
    stores.write_ticks(ticks.select(*[c for c in CLEAN_TICK.names if c in ticks.columns]), f"{root}/ticks")
    files = tables.catalog(spark, sf)
    columns = [
        (F.col(f.name) if f.name in files.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in CATALOG
    ]
    stores.write_partitions(files.select(*columns), f"{root}/files", ["day"], ["path"])
    return root


def _stored_splits(spark: SparkSession, sf: str, root: str) -> None:
    """The shared ticks' sessions and their catalog, stored too."""
    ticks = sessions.labelled_ticks(filters.wash(tables.ticks(spark, sf)), strict=False)
    stores.write_sessions(ticks.withColumn("file_day", F.col("day")), f"{root}/sessions", MIN_SLICE_ROWS)
    rows = split_rows(spark, sf)
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in sessions.STORED_SPLIT]
    stores.write_partitions(rows.select(*columns), f"{root}/splits", ["file_day"], ["path"])


def _without_main(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.drop(columns="mainID").assign(off_mean=frame.LastPrice - frame.LastPrice.mean())


def _checked(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.assign(checked=True)


@query
def map_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a market mapped where they are stored, some of them twice."""
    root = _stored(spark, sf)
    ticks, files = f"{root}/ticks", f"{root}/files"
    known = stores.tick_schema(spark, ticks)
    without = [f for f in known if f.name != "mainID"]
    own = staged(stores.read_or_empty(spark, files, CATALOG).filter("MarketID = 3"))
    first = StructType(without).add("off_mean", "double")
    rewriting.map_stored_files(spark, ticks, files, own, userfuncs.whole(_without_main), first)
    some = own.filter(F.array_contains("tags", "dup_time"))
    second = StructType(stores.tick_schema(spark, ticks).fields).add("checked", "boolean")
    rewriting.map_stored_files(spark, ticks, files, some, userfuncs.whole(_checked), second)
    versions = stores.read_or_empty(spark, files, CATALOG).select("path", "column_num", "zip_ver")
    rows = stores.read_ticks(spark, ticks, stores.tick_schema(spark, ticks)).join(versions, "path")
    return rounded(
        rows.select("path", "seq", "LastPrice", "mainID", "off_mean", "checked", "column_num", "zip_ver"), "off_mean", digits=8
    )


@query
def retract_files(spark: SparkSession, sf: str) -> DataFrame:
    """Some files retracted from all stores, those of a product with their rows."""
    root = _stored(spark, sf)
    _stored_splits(spark, sf, root)
    folders = {"tick_folder": f"{root}/ticks", "catalog_folder": f"{root}/files"}
    folders |= {"session_folder": f"{root}/sessions", "split_folder": f"{root}/splits"}
    files = staged(stores.read_or_empty(spark, f"{root}/files", CATALOG))
    rewriting.retract_files(spark, files.filter(F.array_contains("tags", "dup_time")), **folders)
    left = rewriting.retract_files(spark, files.filter("category = 'VI'"), **folders, forget=True)

    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("path").agg(F.count(F.lit(1)).alias(name))

    rows = left.select("path", "zip_path", "zip_line_num", F.array_contains("tags", "splited").alias("splited"))
    stored = stores.read_ticks(spark, f"{root}/ticks", CLEAN_TICK)
    for df, name in (
        (stored, "ticks"),
        (spark.read.parquet(f"{root}/sessions"), "sessions"),
        (sessions.read_splits(spark, f"{root}/splits"), "slices"),
    ):
        rows = rows.join(counts(df, name), "path", "full")
    return rows


@query
def feature_job(spark: SparkSession, sf: str) -> DataFrame:
    """Two features saved and registered, one of them twice for some slices, and the
    features of a product reset."""
    root = _stored(spark, sf)
    _stored_splits(spark, sf, root)
    features, catalog_ = f"{root}/features", f"{root}/splits"
    rows = staged(sessions.read_splits(spark, catalog_))
    value = rows.select("path", "day", "time_type", F.col("high").alias("value"))
    night = F.col("time_type") == "night"

    def save(df: DataFrame, name: str, hour: int) -> None:
        at = F.lit(f"2024-02-01 0{hour}:00:00").cast("timestamp_ntz")
        rewriting.save_feature(spark, df, name, at, features, catalog_)

    save(value, "highest", 1)
    save(value.filter(night).withColumnRenamed("value", "depth"), "depth", 2)
    save(value.filter(night).withColumn("value", 2 * F.col("value")), "highest", 3)
    rewriting.reset_features(spark, rows.filter("category = 'CL'"), features, catalog_)
    keys = stores.FEATURE_KEYS
    stored = sessions.read_splits(spark, catalog_).select(
        *keys, F.array_join("feature_files", "|").alias("features"), "feature_num", "feature_time"
    )
    for name in ("highest", "depth"):
        own = spark.read.parquet(f"{features}/feature={name}")
        stored = stored.join(own.withColumnRenamed("value", name).select(*keys, name), keys, "full")
    return stored


@query
def first_match(spark: SparkSession, sf: str) -> DataFrame:
    files = tables.catalog(spark, sf).select("path", "category", "isDominant", "line_num")
    row = filters.first_match(files, ["path"], category="ER", isDominant=True)
    return spark.createDataFrame([row] if row else [], files.schema)


@query
def row_invariant(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of both sides of a step that must keep them, counted while it is written."""
    ticks = tables.ticks(spark, sf).select("seq", "UpdateTime")
    rounded_, check = quality.counting(
        ticks, lambda df: df.withColumn("UpdateTime", times.half_second(F.col("UpdateTime")))
    )
    rounded_.write.parquet(scratch_folder(spark, "counted"))
    return spark.createDataFrame([(check(),)], "n long")


def _csv_lines(spark: SparkSession, sf: str, layout) -> DataFrame:
    """Ticks as the columns of a raw file. Some rows spell their contract in lower
    case or name no market or another."""
    seq = F.col("seq")
    ticks = tables.ticks(spark, sf).withColumns(
        {
            "UpdateTime": F.date_format("UpdateTime", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            "MarketID": F.when(seq % 11 == 0, F.lit(9)).when(seq % 7 != 0, F.col("MarketID")),
            "row_id": F.when(seq % 5 == 0, F.lower("InstrumentID")).otherwise(F.col("InstrumentID")),
        }
    )
    known = {c: F.col(c) for c in ticks.columns} | {"InstrumentID": F.col("row_id")}
    return ticks.select(
        *[known.get(n, F.lit(None)).cast("string").alias(n) for n in layout.names],
        F.concat_ws("/", F.split_part("path", F.lit("/"), F.lit(2)), "category", "InstrumentID").alias("contract"),
    )


def _scanned(spark: SparkSession, sf: str, layout, scan) -> DataFrame:
    folder = scratch_folder(spark, "raw")
    lines = _csv_lines(spark, sf, layout).drop("contract")
    lines.write.csv(f"{folder}/2024/4/AG/AG2401/2024/202401/20240131.spt")
    return scan(spark, folder, "*/*/*/*/*/*/*.spt/*.csv").select(
        "InstrumentID", "MarketID", "UpdateTime", "LastPrice", "LastVolume", "OpenInterest", "row_failed"
    )


@query
def scan_raw(spark: SparkSession, sf: str) -> DataFrame:
    return _scanned(spark, sf, RAW_TICK, raw.scan)


@query
def scan_legacy(spark: SparkSession, sf: str) -> DataFrame:
    return _scanned(spark, sf, RAW_TICK_LEGACY, raw.scan_legacy)


def _imported(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Ticks and catalog of an archive with one raw file per contract, imported once
    and once more by force."""
    root = scratch_folder(spark, "archive")
    lines = _csv_lines(spark, sf, RAW_TICK)
    text = lines.select("contract", F.to_csv(F.struct(*RAW_TICK.names), {"emptyValue": ""}).alias("value"))
    text.repartition("contract").write.partitionBy("contract").text(f"{root}/written")
    names = [r.contract for r in lines.select("contract").distinct().collect()]
    for name in names:
        move_only_file(
            spark, f"{root}/written/contract={quote(name, safe='')}", f"{root}/raw/2024/{name}/2024/202401/20240131.spt"
        )
    rules = importing.Rules(min_rows=MIN_FILE_ROWS, keep_without_unknown=True)
    for force in (False, True):
        files = importing.import_files(spark, f"{root}/raw", f"{root}/ticks", f"{root}/files", rules=rules, force=force)
    return stores.read_ticks(spark, f"{root}/ticks", CLEAN_TICK), files


@query
def import_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    loaded = stores.batch_load(*_imported(spark, sf), view="")
    return loaded.select("path", "InstrumentID", "MarketID", "UpdateTime", "LastPrice", "LastVolume", "time_type")


@query
def imported_main(spark: SparkSession, sf: str) -> DataFrame:
    loaded = stores.batch_load(*_imported(spark, sf))
    return loaded.select("path", "day", "UpdateTime", "LastPrice", "OpenInterest")


@query
def retract(spark: SparkSession, sf: str) -> DataFrame:
    files = tables.catalog(spark, sf)
    doomed = files.filter(F.array_contains("tags", "dup_time"))
    folder = scratch_folder(spark, "retract")
    ticks = raw.with_file_columns(tables.ticks(spark, sf).select("path", "InstrumentID", "UpdateTime", "seq"))
    stores.write_ticks(ticks, folder)
    stores.retract_ticks(spark, folder, ticks.schema, doomed)
    left = stores.read_ticks(spark, folder, ticks.schema).groupBy("path").agg(F.count(F.lit(1)).alias("ticks"))
    marked = catalog.mark_retracted(files, doomed).select("path", "zip_path", "zip_line_num")
    return marked.join(left, "path", "left")


# --- catalog -------------------------------------------------------------------


@query
def tag_update(spark: SparkSession, sf: str) -> DataFrame:
    files = tables.catalog(spark, sf)
    tagged = catalog.remove_tag(catalog.add_tag(files, "checked"), "splited")
    return tagged.select("path", F.array_join("tags", "|").alias("tags"))


@query
def missing_data(spark: SparkSession, sf: str) -> DataFrame:
    ticks = tables.ticks(spark, sf)
    verdicts = quality.file_verdicts(ticks, min_rows=MIN_FILE_ROWS)
    stored = verdicts.filter("zip_line_num >= 10")
    return catalog.missing_data(tables.catalog(spark, sf), stored).select("path", "zip_path")


@query
def pending_symbols(spark: SparkSession, sf: str) -> DataFrame:
    stocks = tables.stock_basic(spark, sf)
    claimed = catalog.claim(stocks, catalog.pending_symbols(stocks))
    return claimed.select("ts_code", "name", F.array_join("tags", "|").alias("tags"))


@query
def catalog_report(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.report(tables.catalog(spark, sf))


def _view(name: str) -> Query:
    def build(spark: SparkSession, sf: str) -> DataFrame:
        seen = catalog.FILE_VIEWS[name](tables.catalog(spark, sf))
        return seen.select("path", "InstrumentID", "day", F.array_join("tags", "|").alias("tags"))

    return build


for _name in ("wait_import", "df_valid", "valid", "main", "sub_main"):
    QUERIES[f"view_{_name}"] = _view(_name)


@query
def split_views(spark: SparkSession, sf: str) -> DataFrame:
    rows = staged(split_rows(spark, sf))
    return stats.concat(
        [
            view(rows).select(F.lit(name).alias("view"), "path", "day", "time_type", "high")
            for name, view in catalog.SPLIT_VIEWS.items()
        ]
    )


@query
def split_with_parent(spark: SparkSession, sf: str) -> DataFrame:
    rows = split_rows(spark, sf).select("path", "day", "time_type", "zip_line_num")
    return catalog.with_parent(rows, tables.catalog(spark, sf), ["line_num", "subID", "start"])


@query
def dominant_flags(spark: SparkSession, sf: str) -> DataFrame:
    files = catalog.file_stats(tables.ticks(spark, sf), seq_bound=tables.seq_bound(spark, sf))
    return catalog.with_dominance(files).select(
        "category", "day", "InstrumentID", "OpenInterest", "isDominant", "is2ndDominant"
    )


@query
def file_stats(spark: SparkSession, sf: str) -> DataFrame:
    found = catalog.file_stats(tables.ticks(spark, sf), tables.seq_bound(spark, sf))
    return rounded(rounded(found, "Turnover", "Turnover_calc", digits=4), "mean")


@query
def split_sessions(spark: SparkSession, sf: str) -> DataFrame:
    rows = split_rows(spark, sf).select(
        "path", "InstrumentID", "file_day", "day", "time_type", "year", "month", "zip_line_num",
        "start", "end", "diff_sec", "open", "close", "high", "low", "mean", "OpenInterest", "volume_sum",
    )
    return rounded(rows, "mean")


@query
def instrument_stats(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(catalog.instrument_stats(tables.ticks(spark, sf)), "highest_price", digits=6)


# --- filters and projections ---------------------------------------------------


@query
def wash_ticks(spark: SparkSession, sf: str) -> DataFrame:
    washed = filters.wash(tables.ticks(spark, sf), "2024-01-03", "2024-01-28")
    return washed.select("seq", "InstrumentID", "UpdateTime", "LastPrice", "LastVolume")


@query
def kind_filter(spark: SparkSession, sf: str) -> DataFrame:
    own = filters.of_kind(tables.ticks(spark, sf), skip_markets=[3])
    return own.select("seq", "InstrumentID", "MarketID", "LastPrice")


@query
def filter_by(spark: SparkSession, sf: str) -> DataFrame:
    files = tables.catalog(spark, sf)
    asked = filters.keyword_condition(
        files, tags=[], zip_path__ne=None, MarketID__in=[4], data_type__nin=["0000"], line_num__exists=True
    )
    tagged = filters.keyword_condition(files, tags="dup_time", category__ne="VI")
    return files.select("path", asked.alias("asked"), tagged.alias("tagged")).filter("asked or tagged")


@query
def in_time_range(spark: SparkSession, sf: str) -> DataFrame:
    return filters.in_tradable_time(tables.ticks(spark, sf)).select("seq", "UpdateTime", "LastPrice")


@query
def session_choice(spark: SparkSession, sf: str) -> DataFrame:
    ticks = labelled(spark, sf)
    return stats.concat(
        [
            filters.in_session(ticks, choice).select(F.lit(choice).alias("choice"), "seq", "time_type")
            for choice in ("am_pm", "night")
        ]
    )


@query
def project_kind(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(projections.for_kind(tables.ticks(spark, sf), "9999"), "HighestPrice", "LowestPrice", "Turnover", digits=4)


@query
def union_kinds(spark: SparkSession, sf: str) -> DataFrame:
    whole = projections.of_all_kinds(tables.ticks(spark, sf)).select(
        "seq", "InstrumentID", "LastPrice", "HighestPrice", "Turnover", "mainID"
    )
    return rounded(whole, "HighestPrice", "Turnover", digits=4)


@query
def random_load(spark: SparkSession, sf: str) -> DataFrame:
    window = backtest.two_day_window(labelled(spark, sf), "20240110", "20240111")
    night = filters.in_session(window, "night")
    return night.select("category", "day", "seq", "UpdateTime", "LastPrice", "time_type")


@query
def unwind_tags(spark: SparkSession, sf: str) -> DataFrame:
    files = tables.catalog(spark, sf).select("path", F.col("tags").alias("tag"))
    return stats.concat(
        [
            stats.unwound(files, "tag", keep).withColumn("kept_empty", F.lit(keep))
            for keep in (True, False)
        ]
    )


@query
def distinct_ids(spark: SparkSession, sf: str) -> DataFrame:
    return stats.distinct_values(tables.ticks(spark, sf), "InstrumentID")


# --- sessions and times --------------------------------------------------------


@query
def session_label(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("UpdateTime")
    return tables.ticks(spark, sf).select("seq", times.session_by_hour(t).alias("time_type"))


@query
def session_label_clock(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("UpdateTime")
    return tables.ticks(spark, sf).select("seq", times.session_by_clock(t).alias("time_type"))


@query
def trading_day(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("UpdateTime")
    return tables.ticks(spark, sf).select(
        "seq", times.split_day(t).alias("split_day"), times.bar_time(t).alias("bar_time")
    )


@query
def normalize_ms(spark: SparkSession, sf: str) -> DataFrame:
    return tables.ticks(spark, sf).select("seq", times.half_second(F.col("UpdateTime")).alias("UpdateTime"))


# --- quality -------------------------------------------------------------------


@query
def file_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return quality.file_verdicts(tables.ticks(spark, sf), min_rows=MIN_FILE_ROWS)


@query
def wash_accounting(spark: SparkSession, sf: str) -> DataFrame:
    return quality.wash_accounting(tables.ticks(spark, sf), low="2024-01-03", high="2024-01-28")


@query
def ms_profile(spark: SparkSession, sf: str) -> DataFrame:
    ticks = tables.ticks(spark, sf)
    return stats.concat([quality.sub_second_verdict(df) for df in (ticks, _whole_seconds(ticks))])


def _whole_seconds(ticks: DataFrame) -> DataFrame:
    us = times.micros(F.col("UpdateTime"))
    return ticks.withColumns(
        {
            "UpdateTime": times.from_micros(times.bin_start(us, times.SECOND)),
            "path": F.concat(F.lit("whole/"), "path"),
        }
    )


@query
def oi_repair(spark: SparkSession, sf: str) -> DataFrame:
    mended = quality.repair_open_interest(tables.ticks(spark, sf))
    return mended.select("InstrumentID", "UpdateTime", "seq", "OpenInterest")


@query
def describe_ticks(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.describe(tables.ticks(spark, sf), [*STAT_COLUMNS, "OpenInterest", "Turnover", "AvePrice"])
    return rounded(found, "mean", "std", "min", "p25", "p50", "p75", "max", digits=4)


@query
def std_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.std_outliers(tables.ticks(spark, sf), STAT_COLUMNS, PRICE_STD), "std", digits=4)


@query
def single_market(spark: SparkSession, sf: str) -> DataFrame:
    return quality.single_market(tables.ticks(spark, sf))


@query
def dup_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_verdict(hourly(spark, sf), ["path"], MAX_HOURLY_REPEATS)


@query
def dedupe_time(spark: SparkSession, sf: str) -> DataFrame:
    once = quality.dedupe_time(hourly(spark, sf), ["InstrumentID"])
    return once.select("InstrumentID", "UpdateTime", "seq", "LastPrice")


@query
def dedupe_rows(spark: SparkSession, sf: str) -> DataFrame:
    ticks = tables.ticks(spark, sf).select("InstrumentID", "UpdateTime", "LastPrice", "LastVolume", "seq")
    copies = ticks.withColumn("seq", F.col("seq") + 1_000_000_000)
    return quality.dedupe_rows(copies.unionByName(ticks))


# --- bars ----------------------------------------------------------------------


def _kline(level: str) -> Query:
    return lambda spark, sf: _rounded_bars(_bars(spark, sf, level))


for _level in LEVELS:
    QUERIES[f"kline_{_level.lower()}"] = _kline(_level)


@query
def kline_all_levels(spark: SparkSession, sf: str) -> DataFrame:
    ticks = klines.bar_input(tables.ticks(spark, sf))
    return _rounded_bars(bars.bars_at_levels(ticks, seq_bound=tables.seq_bound(spark, sf)))


@query
def kline_zero_fallback(spark: SparkSession, sf: str) -> DataFrame:
    made = _bars(spark, sf, "15min")
    return rounded(made, "OpenPrice", "HighestPrice", "LowestPrice", digits=4).select(
        "InstrumentID", "TradingTime", "open", "OpenPrice", "high", "HighestPrice", "low", "LowestPrice"
    )


# --- statistics ----------------------------------------------------------------


@query
def doc_statics(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.nested_documents(spark, sf)
    return stats.doc_statics(docs, {"meta.source": None, "meta.lang": "lang"})


@query
def doc_statics_sum(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.nested_documents(spark, sf)
    return stats.doc_statics(docs, {"meta.source": None, "meta.lang": None}, sum_field="n_chars")


@query
def src_stat(spark: SparkSession, sf: str) -> DataFrame:
    return stats.group_counts(tables.annotations(spark, sf), stats.SRC)


@query
def cat_stat(spark: SparkSession, sf: str) -> DataFrame:
    return stats.group_counts(tables.annotations(spark, sf), stats.CAT)


@query
def src_cat_stat(spark: SparkSession, sf: str) -> DataFrame:
    return stats.group_counts(tables.annotations(spark, sf), stats.SRC_CAT)


@query
def notes_count(spark: SparkSession, sf: str) -> DataFrame:
    return stats.notes_count(tables.notes(spark, sf))


@query
def dataset_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.annotations(spark, sf)
    empty = rows.agg(F.max("dataset") + 1).toDF("dataset")
    return stats.dataset_counts(rows.select("dataset").distinct().unionByName(empty), rows)


@query
def regen_src(spark: SparkSession, sf: str) -> DataFrame:
    return stats.name_counts(tables.annotations(spark, sf), "source")


@query
def regen_cat(spark: SparkSession, sf: str) -> DataFrame:
    return stats.name_counts(tables.annotations(spark, sf), "category")


@query
def scoped_refresh(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.annotations(spark, sf)
    stale = stats.group_counts(rows, stats.SRC_CAT).withColumn("count", F.lit(0).cast("long"))
    fresh = stats.group_counts(rows, stats.SRC_CAT, category="en")
    return stats.refreshed(stale, fresh, category="en")


@query
def count_upsert(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.annotations(spark, sf)
    old = stats.name_counts(rows.filter("subcategory is not null"), "source")
    return stats.count_upsert(old, rows, "source", "src7")


@query
def counts_upsert(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.annotations(spark, sf)
    old = stats.group_counts(rows, stats.SRC)
    judged = stats.group_counts(rows.filter("subcategory is not null"), stats.SRC)
    return stats.upserted(old, judged, stats.SRC, ["count"])


@query
def related_refresh(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.annotations(spark, sf)
    judged = rows.filter("subcategory is not null")
    old = {
        "source": stats.name_counts(judged, "source"),
        "category": stats.name_counts(judged, "category"),
        "src_stat": stats.group_counts(judged, stats.SRC),
        "cat_stat": stats.group_counts(judged, stats.CAT),
        "src_cat_stat": stats.group_counts(judged, stats.SRC_CAT),
    }
    new = stats.update_related(old, rows, source="src7", category="en")
    return stats.concat([df.withColumn("tab", F.lit(name)) for name, df in new.items()])


@query
def count_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """Count tables stored, then changed by rows that come and go, one change run twice."""
    rows, folder = staged(tables.annotations(spark, sf)), scratch_folder(spark, "counts")
    counting.count_changes(spark, folder, "first", rows.filter("dataset < 6"))
    later, gone = rows.filter("dataset >= 4"), rows.filter("dataset IN (0, 4, 5)")
    for _ in range(2):
        counting.count_changes(spark, folder, "second", later, gone)
    counts = [
        counting.read_counts(spark, folder, name).select(
            F.lit(name).alias("name"), *[F.col(k) if k in keys else F.lit(None).cast("string").alias(k) for k in stats.SRC_CAT], "count"
        )
        for name, keys in counting.TABLES.items()
    ]
    return stats.concat(counts)


@query
def append_fake_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.annotations(spark, sf)
    made = {name: stats.group_counts(rows, keys) for name, keys in (("src_stat", stats.SRC), ("cat_stat", stats.CAT), ("src_cat_stat", stats.SRC_CAT))}
    grown = stats.with_made_up_rows(made, source="s", subsource="ss", category="c", subcategory="sc", input_tag="t")
    return stats.concat([df.withColumn("tab", F.lit(name)) for name, df in grown.items()])


# --- back-testing --------------------------------------------------------------


@query
def running_high_low(spark: SparkSession, sf: str) -> DataFrame:
    return backtest.running_high_low(tables.price_paths(spark, sf), ["trade_id"], ["ts", "seq"])


@query
def trailing_stop_buy(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(backtest.trailing_stop(tables.price_paths(spark, sf), "buy", 0.02), "reward", digits=4)


@query
def trailing_stop_sell(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(backtest.trailing_stop(tables.price_paths(spark, sf), "sell", 0.02), "reward", digits=4)


@query
def cut_before(spark: SparkSession, sf: str) -> DataFrame:
    event = (F.col("day") == "20240115") & (F.col("time_type") != "night")
    ticks = labelled(spark, sf)
    return backtest.cut_before(ticks, ["InstrumentID"], ["UpdateTime", "seq"], event).select(
        "InstrumentID", "seq", "UpdateTime", "time_type"
    )


# --- samples and pages ---------------------------------------------------------


@query
def page(spark: SparkSession, sf: str) -> DataFrame:
    ticks = tables.ticks(spark, sf).select("UpdateTime", "seq", "InstrumentID", "LastPrice")
    return sampling.page(ticks, ["UpdateTime", "seq"], number=2, pages=4)


@query
def doc_sample(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.table(spark, sf, "documents").select("doc_id", "source", "lang")
    return sampling.random_rows(docs, 100, seed=7, key=["doc_id"])


@query
def systematic_sample(spark: SparkSession, sf: str) -> DataFrame:
    ticks = tables.ticks(spark, sf).select("UpdateTime", "seq", "InstrumentID", "LastPrice")
    return sampling.systematic_sample(ticks, ["UpdateTime", "seq"], 700)


@query
def strided_chunks(spark: SparkSession, sf: str) -> DataFrame:
    names = tables.ticks(spark, sf).select("UpdateTime", "seq", "InstrumentID")
    return sampling.strided_chunks(names, ["UpdateTime", "seq"], 120)


# --- user functions ------------------------------------------------------------


def _from_file_mean(frame: pd.DataFrame) -> pd.DataFrame:
    off = frame.LastPrice - frame.LastPrice.mean()
    return pd.DataFrame({"path": frame.path, "seq": frame.seq, "off_mean": off})


@query
def map_df(spark: SparkSession, sf: str) -> DataFrame:
    ticks = tables.ticks(spark, sf).select("path", "seq", "LastPrice")
    mapped = userfuncs.map_files(ticks, userfuncs.whole(_from_file_mean), "path string, seq long, off_mean double")
    return rounded(mapped, "off_mean")


def _tick_value(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"seq": frame.seq, "value": frame.LastPrice * frame.LastVolume * 10})


@query
def map_rows(spark: SparkSession, sf: str) -> DataFrame:
    ticks = tables.ticks(spark, sf).select("seq", "LastPrice", "LastVolume", "MarketID")
    mapped = userfuncs.map_rows(ticks, _tick_value, "seq long, value double", F.col("MarketID") == 4)
    return rounded(mapped, "value", digits=4)


GROUP_SUMS = "InstrumentID string, ticks long, volume double, highest double"


def _group_partial(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.groupby("InstrumentID", as_index=False).agg(
        ticks=("LastPrice", "count"), volume=("LastVolume", "sum"), highest=("LastPrice", "max")
    )


def _group_merge(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.groupby("InstrumentID", as_index=False).agg(
        ticks=("ticks", "sum"), volume=("volume", "sum"), highest=("highest", "max")
    )


@query
def fold_groups(spark: SparkSession, sf: str) -> DataFrame:
    ticks = tables.ticks(spark, sf).select("InstrumentID", "LastPrice", "LastVolume")
    return userfuncs.fold_groups(ticks, ["InstrumentID"], _group_partial, _group_merge, GROUP_SUMS)


def _group_sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of a group, batch by batch."""
    parts = pd.concat([_group_partial(frame) for frame in frames], ignore_index=True)
    yield _group_merge(parts)


@query
def map_groups(spark: SparkSession, sf: str) -> DataFrame:
    ticks = tables.ticks(spark, sf).select("InstrumentID", "LastPrice", "LastVolume")
    return userfuncs.map_groups(ticks, ["InstrumentID"], _group_sums, GROUP_SUMS)
