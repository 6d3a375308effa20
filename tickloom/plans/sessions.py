"""Splitting stored files into trading days and sessions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickloom.functions import times
from tickloom.operators import catalog, quality
from tickloom.plans.importing import register
from tickloom.schema import CATALOG, MAX_REPEATS, MIN_ROWS, SPLIT
from tickloom.session import listed, scratch
from tickloom.sources import stores

STORED_SPLIT = StructType(SPLIT.fields).add("file_day", "string")


def _rounded(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("UpdateTime", times.half_second(F.col("UpdateTime")))


def split_verdicts(ticks: DataFrame, max_repeats: int = MAX_REPEATS, keys: list[str] = ["path"]) -> DataFrame:
    """The tag of each file that cannot be split: whole or half seconds only, too
    many repeated instants, or ticks outside the clock's sessions. Copies of a
    row do not count as repeats and must be gone already."""
    t = F.col("UpdateTime")
    instants = _rounded(ticks).groupBy(*keys, "UpdateTime").agg(F.count(F.lit(1)).alias("n"))
    whole = times.sub_second(t) == 0
    stats = instants.groupBy(*keys).agg(
        (F.sum("n") - F.count(F.lit(1))).alias("dropped"),
        (F.max(whole) & F.max(~whole)).alias("has_both"),
        F.max(times.session_by_clock(t) == times.UNKNOWN).alias("unknown"),
    )
    tag = (
        F.when(~F.col("has_both"), F.lit("time_no_ms"))
        .when(F.col("dropped") > max_repeats, F.lit("dup_time"))
        .when(F.col("unknown"), F.lit(times.UNKNOWN))
    )
    return stats.select(*keys, tag.alias("tag"))


def labelled_ticks(
    ticks: DataFrame,
    strict: bool = True,
    max_repeats: int = MAX_REPEATS,
    keys: list[str] = ["path"],
    verdicts: DataFrame | None = None,
) -> DataFrame:
    """Ticks ready to split: parts of a second rounded, the first tick of each
    instant, sessions from the clock. ``strict`` leaves out the files that cannot
    be split, by their ``verdicts`` if these are known; otherwise only their ticks
    without a session.

    Keeping one tick an instant takes care of copies, which need removing only
    to judge a file by its repeats."""
    usable = ticks
    if strict:
        if verdicts is None:
            verdicts = split_verdicts(quality.dedupe_rows(ticks), max_repeats, keys)
        usable = quality.passing(ticks, verdicts, keys)
    once = quality.dedupe_time(_rounded(usable), keys)
    known, _ = quality.set_aside(
        once.withColumn("time_type", times.session_by_clock(F.col("UpdateTime")))
    )
    return known


def split_rows(
    labelled: DataFrame, files: DataFrame, min_rows: int = MIN_ROWS, seq_bound: int | None = None
) -> DataFrame:
    """Session rows of labelled ticks with the flags of their file."""
    stats = catalog.session_stats(labelled, min_rows, seq_bound=seq_bound)
    flags = files.select("path", "isDominant", "is2ndDominant")
    stored = F.concat_ws(
        "/",
        F.col("MarketID").cast("string"),
        "category",
        "InstrumentID",
        F.substring("file_day", 1, 6),
        F.concat_ws("_", "InstrumentID", "file_day", "day", F.concat("time_type", F.lit(".parquet"))),
    )
    return stats.join(flags, "path", "left").withColumns(
        {
            "zip_path": stored,
            "tags": F.array().cast("array<string>"),
            "feature_files": F.array().cast("array<string>"),
            "feature_num": F.lit(0),
            "feature_time": F.lit(None).cast("timestamp_ntz"),
        }
    )


def mark_split(files: DataFrame, splits: DataFrame) -> DataFrame:
    """Catalog rows of split files, tagged and counted."""
    counts = splits.groupBy("path").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    marked = files.join(counts, "path", "left")
    return marked.transform(catalog.add_tag, "splited", F.col("_n").isNotNull()).withColumn(
        "doc_num", F.coalesce("_n", "doc_num")
    ).drop("_n")


def read_splits(spark: SparkSession, folder: str) -> DataFrame:
    """The stored split catalog; none if nothing is split."""
    return stores.read_or_empty(spark, folder, STORED_SPLIT)


def split_files(
    spark: SparkSession,
    ticks: DataFrame,
    catalog_folder: str,
    session_folder: str,
    split_folder: str,
    min_rows: int = MIN_ROWS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """Split the files of stored ticks into sessions; returns the split catalog.

    Sessions and their rows take the place of those of an earlier split. Files that
    cannot be split get the tag that says why and lose their old sessions; the
    others are tagged as split and count their sessions."""
    files = stores.read_or_empty(spark, catalog_folder, CATALOG)
    verdicts = listed(split_verdicts(quality.dedupe_rows(ticks), max_repeats))
    own = files.join(verdicts.select("path"), "path", "left_semi")
    labelled = labelled_ticks(ticks, True, max_repeats, verdicts=verdicts).withColumn("file_day", F.col("day"))
    with scratch(labelled) as usable, scratch(own) as judged:
        found = split_rows(usable, judged, min_rows).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in STORED_SPLIT]
        )
        with scratch(found) as rows:
            retract_splits(spark, judged, None, session_folder, split_folder)
            stores.write_sessions(usable, session_folder, min_rows)
            stores.replace_rows(rows, split_folder, ["file_day"], ["path"], ["path", "day", "time_type"])
            marked = mark_split(judged.join(verdicts, "path"), rows)
            for tag in ("time_no_ms", "dup_time"):
                marked = catalog.add_tag(marked, tag, F.col("tag") == tag)
            with scratch(marked.select(*CATALOG.names)) as fresh:
                register(fresh, catalog_folder)
    return read_splits(spark, split_folder)


def retract_splits(
    spark: SparkSession, files: DataFrame, catalog_folder: str | None, session_folder: str, split_folder: str
) -> None:
    """Delete the sessions of some catalog rows and their rows in the split catalog.
    With a catalog folder the files also lose their mark and their count."""
    doomed = listed(files.select("path").distinct())
    for folder, schema in ((session_folder, None), (split_folder, STORED_SPLIT)):
        try:
            stored = stores.read_or_empty(spark, folder, schema) if schema else spark.read.parquet(folder)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        stores.drop_rows(stored, folder, ["file_day"], doomed, ["path"])
    if catalog_folder is not None:
        known = stores.read_or_empty(spark, catalog_folder, CATALOG).join(doomed, "path", "left_semi")
        reset = catalog.remove_tag(known, "splited").withColumn("doc_num", F.lit(0))
        with scratch(reset.select(*CATALOG.names)) as rows:
            register(rows, catalog_folder)
