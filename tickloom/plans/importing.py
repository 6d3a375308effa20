"""Import of raw tick files: scan, wash, judge, label, store, register."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions import ids, times
from tickloom.operators import filters, quality
from tickloom.operators.catalog import files_to_import, slice_stats, with_dominance
from tickloom.schema import CATALOG, MAX_DATE, MIN_DATE, MIN_ROWS, RAW_TICK
from tickloom.session import listed, scratch
from tickloom.sources import raw, stores


@dataclass(frozen=True)
class Rules:
    """What an import accepts."""

    min_rows: int = MIN_ROWS
    low: str = MIN_DATE
    high: str = MAX_DATE
    bad_rows: str = "skip"
    skip_kinds: tuple[str, ...] = ()
    markets: tuple[int, ...] | None = None
    # Keep a file whose only fault is rows without a session, less those rows.
    keep_without_unknown: bool = False


def judged(ticks: DataFrame, rules: Rules) -> DataFrame:
    """Verdict per file of unwashed ticks."""
    verdicts = quality.file_verdicts(
        ticks, ["path"], RAW_TICK.names, rules.min_rows, low=rules.low, high=rules.high
    )
    if rules.keep_without_unknown:
        verdicts = verdicts.withColumn("tag", F.when(F.col("tag") != "time_error", F.col("tag")))
    return verdicts


def cleaned(ticks: DataFrame, verdicts: DataFrame, rules: Rules) -> DataFrame:
    """Washed and labelled ticks of the files that pass."""
    washed = filters.wash(ticks, rules.low, rules.high)
    labelled = quality.passing(washed, verdicts).withColumn(
        "time_type", times.session_by_hour(F.col("UpdateTime"))
    )
    if rules.keep_without_unknown:
        labelled, _ = quality.set_aside(labelled)
    return raw.with_file_columns(labelled).drop(quality.FAILED)


def catalog_rows(files: DataFrame, verdicts: DataFrame, stored_stats: DataFrame | None = None) -> DataFrame:
    """Catalog rows of listed files with their verdicts and, where there are any, the
    statistics of their stored ticks. The line count is kept for rejected files
    too."""
    stored = F.concat_ws(
        "/",
        F.col("MarketID").cast("string"),
        "category",
        "InstrumentID",
        "month",
        F.concat("InstrumentID", F.lit("_"), "day", F.lit(".parquet")),
    )
    rows = files.join(verdicts, "path", "left")
    if stored_stats is not None:
        fresh = [c for c in stored_stats.columns if c == "path" or c not in rows.columns]
        rows = rows.join(stored_stats.select(*fresh), "path", "left")
    rows = rows.withColumns(
        {
            "tags": F.when(F.col("tag").isNull(), F.array().cast("array<string>")).otherwise(F.array("tag")),
            "zip_path": F.when(F.col("tag").isNull() & F.col("line_num").isNotNull(), stored),
            "doc_num": F.lit(0),
            "zip_ver": F.lit(1),
            "stored": F.col("tag").isNull() & F.col("line_num").isNotNull(),
            "isDominant": F.lit(False),
            "is2ndDominant": F.lit(False),
        }
    )
    known = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CATALOG
        ]
    )


def wanted_files(files: DataFrame, rules: Rules) -> DataFrame:
    markets = None if rules.markets is None else list(rules.markets)
    return filters.of_kind(files, rules.skip_kinds, markets)


def import_files(
    spark: SparkSession,
    root: str,
    tick_folder: str,
    catalog_folder: str,
    pattern: str = raw.GLOB,
    rules: Rules = Rules(),
    force: bool = False,
) -> DataFrame:
    """Import the matching files that are not stored yet, or with ``force`` all;
    returns the catalog.

    Narrow ``pattern`` to a year, market, product or some months (``raw.months_glob``) to
    narrow what is listed and read; files outside it stay as they are. Ticks
    are stored before their files are registered; what a broken run has stored
    without registering is deleted by the next."""
    files = stores.read_or_empty(spark, catalog_folder, CATALOG)
    listing = wanted_files(raw.list_files(spark, root, pattern), rules)
    todo = listed((listing if force else files_to_import(listing, files)).select("path", "size", "uri"))
    # A scan names its files on the driver anyway; it is given those to import only.
    named = [row.uri for row in todo.select("uri").toLocalIterator()]
    if not named:
        return files
    store_files(spark, raw.scan_files(spark, named, rules.bad_rows), todo, tick_folder, catalog_folder, rules)
    return stores.read_or_empty(spark, catalog_folder, CATALOG)


def store_files(
    spark: SparkSession, lines: DataFrame, files: DataFrame, tick_folder: str, catalog_folder: str, rules: Rules
) -> None:
    """Judge, wash, store and register the ticks of some files (``path``, ``size``),
    in place of what is stored of them."""
    listed_ = ids.with_path_parts(files.select("path", "size"))
    # Judging reads all columns and is done once; washing costs less than another copy.
    with scratch(lines) as ticks, scratch(judged(ticks, rules)) as verdicts:
        clean = cleaned(ticks, verdicts, rules)
        with scratch(catalog_rows(listed_, verdicts, slice_stats(clean, ["path"]))) as rows:
            stores.retract_ticks(spark, tick_folder, stores.tick_schema(spark, tick_folder), files)
            stores.write_ticks(clean, tick_folder, mode="append")
            register(rows, catalog_folder)


def register(rows: DataFrame, catalog_folder: str, gone: DataFrame | None = None) -> None:
    """Add catalog rows, replacing those of the same path, and mark the dominant
    contracts of the days touched anew. Rows of the paths in ``gone`` are taken out. The
    catalog is small next to the ticks; these days are rewritten as a whole."""
    spark = rows.sparkSession
    old = stores.read_or_empty(spark, catalog_folder, CATALOG)
    changed = rows.select("path", "day")
    if gone is not None:
        changed = changed.unionByName(old.join(gone.select("path"), "path", "left_semi").select("path", "day"))
    changed = listed(changed)
    days = changed.select("day").distinct()
    kept = old.join(days, "day", "left_semi").join(changed.select("path"), "path", "left_anti")
    with scratch(with_dominance(kept.select(*CATALOG.names).unionByName(rows)).select(*CATALOG.names)) as merged:
        stores.write_partitions(merged, catalog_folder, ["day"], ["path"])
        if gone is not None:
            for day in days.join(merged.select("day"), "day", "left_anti").collect():
                stores.drop_partition(spark, catalog_folder, day.asDict())
