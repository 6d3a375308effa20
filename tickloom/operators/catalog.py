"""File and session catalogs: statistics, dominance, views, tags, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions import ids, text, times
from tickloom.operators.bars import fits_one_key, tick_order
from tickloom.operators.filters import has_volume, in_dates, without_tags
from tickloom.schema import DOMINANT_KIND, INDEX_KIND, MAX_DATE, MIN_DATE, MIN_ROWS, MULTIPLIER
from tickloom.session import listed

# Widths a group's first and last ticks may be found in before its parts merge.
PARTS = (times.DAY, times.HOUR, times.MINUTE)

# Tags that keep a file out of the valid and dominant views.
UNUSABLE = ["invalid_day", "too_small", "dup_time", "time_no_ms"]


def slice_stats(
    ticks: DataFrame,
    keys: list[str],
    seq_bound: int | None = None,
    multiplier: float = MULTIPLIER,
    low: str = MIN_DATE,
    high: str = MAX_DATE,
) -> DataFrame:
    """Time span and price statistics of the ticks of each group. Lines are counted
    as they are, everything else is of the washed ones.

    Groups are summed up by day first, or by hour or minute where positions grow
    so large that they and the time fit a single order key only within those."""
    price, volume = F.col("LastPrice"), F.col("LastVolume")
    key, start = F.col("_order"), F.col("_part")
    at = times.micros(F.col("UpdateTime"))
    width = next((w for w in PARTS if fits_one_key(w, seq_bound)), PARTS[-1])
    clean = in_dates(F.col("UpdateTime"), low, high) & has_volume(volume)
    measured = ("LastPrice", "LastVolume", "OpenInterest", "Turnover", "UpdateTime")
    washed = ticks.withColumns({c: F.when(clean, F.col(c)) for c in measured})
    parts = (
        washed.withColumn("_part", times.bin_start(at, width))
        .withColumn("_order", tick_order(at, F.col("seq"), start, width, seq_bound))
        .groupBy(*keys, "_part")
        .agg(
            F.count(F.lit(1)).alias("line_num"),
            F.count("UpdateTime").alias("zip_line_num"),
            F.min("UpdateTime").alias("start"),
            F.max("UpdateTime").alias("end"),
            F.min_by(price, key).alias("open"),
            F.max_by(price, key).alias("close"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.sum(price).alias("price_sum"),
            F.count(price).alias("prices"),
            F.max_by("OpenInterest", key).alias("OpenInterest"),
            F.max_by("Turnover", key).alias("Turnover"),
            F.sum(price * volume * F.lit(float(multiplier))).alias("Turnover_calc"),
            F.sum(volume).alias("volume_sum"),
        )
    )
    merged = parts.groupBy(*keys).agg(
        F.sum("line_num").alias("line_num"),
        F.sum("zip_line_num").alias("zip_line_num"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.min_by("open", start).alias("open"),
        F.max_by("close", start).alias("close"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("price_sum").alias("price_sum"),
        F.sum("prices").alias("prices"),
        F.max_by("OpenInterest", start).alias("OpenInterest"),
        F.max_by("Turnover", start).alias("Turnover"),
        F.coalesce(F.sum("Turnover_calc"), F.lit(0.0)).alias("Turnover_calc"),
        F.coalesce(F.sum("volume_sum"), F.lit(0.0)).alias("volume_sum"),
    )
    return merged.withColumns(
        {
            "diff_sec": times.span_seconds(F.col("start"), F.col("end")),
            "mean": F.when(F.col("prices") > 0, F.col("price_sum") / F.col("prices")),
        }
    ).drop("price_sum", "prices")


def file_stats(
    ticks: DataFrame, seq_bound: int | None = None, multiplier: float = MULTIPLIER
) -> DataFrame:
    """Time span and price statistics of each file, with its path columns."""
    return ids.with_path_parts(slice_stats(ticks, ["path"], seq_bound, multiplier))


def session_stats(
    ticks: DataFrame,
    min_rows: int = MIN_ROWS,
    seq_bound: int | None = None,
    multiplier: float = MULTIPLIER,
) -> DataFrame:
    """Statistics of each (file, trading day, session); ``ticks`` carry their
    session in ``time_type``. The file's own day is kept as ``file_day``."""
    labelled = ticks.withColumn("split_day", times.split_day(F.col("UpdateTime")))
    stats = slice_stats(labelled, ["path", "split_day", "time_type"], seq_bound, multiplier)
    named = ids.with_path_parts(stats.filter(F.col("line_num") >= min_rows))
    return (
        named.withColumns(
            {
                "zip_line_num": F.col("line_num"),
                "file_day": F.col("day"),
                "day": F.col("split_day"),
                "year": F.date_format("start", "yyyy"),
                "month": F.date_format("start", "yyyyMM"),
            }
        )
        .drop("line_num", "split_day")
    )


def with_dominance(files: DataFrame) -> DataFrame:
    """Mark, per product and day, the contract with the largest last open
    interest and those above half of it. Index and dominant series take no part.

    The window runs over one row per contract and day, so a group holds at most
    the contracts listed for a product."""
    sub = ids.sub_id(F.col("InstrumentID"))
    takes_part = ~sub.isin(INDEX_KIND, DOMINANT_KIND)
    group = Window.partitionBy("category", "day", takes_part)
    ranked = files.withColumns(
        {
            "_rank": F.row_number().over(
                group.orderBy(F.desc_nulls_last("OpenInterest"), "InstrumentID", "path")
            ),
            "_most": F.max("OpenInterest").over(group),
        }
    )
    first = takes_part & (F.col("_rank") == 1) & F.col("OpenInterest").isNotNull()
    second = takes_part & (F.col("_rank") > 1) & (F.col("OpenInterest") > F.col("_most") / 2)
    return ranked.withColumns(
        {
            "isDominant": F.coalesce(first, F.lit(False)),
            "is2ndDominant": F.coalesce(second, F.lit(False)),
        }
    ).drop("_rank", "_most")


def with_dominant_flag(rows: DataFrame, files: DataFrame, day: Column) -> DataFrame:
    """Ticks or bars with the dominance of their contract on their day."""
    flags = files.groupBy("InstrumentID", "day").agg(F.max("isDominant").alias("isDominant"))
    flags = listed(flags.withColumnRenamed("day", "_day"))
    joined = rows.withColumn("_day", day).join(flags, ["InstrumentID", "_day"], "left").drop("_day")
    return joined.withColumn("isDominant", F.coalesce("isDominant", F.lit(False)))


def instrument_stats(ticks: DataFrame) -> DataFrame:
    stats = ticks.groupBy("InstrumentID").agg(
        F.count(F.lit(1)).alias("tick_num"), F.max("HighestPrice").alias("highest_price")
    )
    return stats.withColumn("category", ids.category(F.col("InstrumentID")))


# --- views -----------------------------------------------------------------


def wait_import(files: DataFrame) -> DataFrame:
    return files.filter(F.col("line_num").isNull())


def df_valid(files: DataFrame) -> DataFrame:
    return files.filter(without_tags("tags", ["too_small"]))


def valid(files: DataFrame) -> DataFrame:
    return files.filter(without_tags("tags", UNUSABLE))


def _usable_contracts(files: DataFrame) -> DataFrame:
    sub = F.col("subID")
    return valid(files).filter(
        F.col("zip_path").isNotNull()
        & F.col("high").isNotNull()
        & (sub.isNull() | ~sub.isin(INDEX_KIND, DOMINANT_KIND))
    )


def main(files: DataFrame) -> DataFrame:
    return _usable_contracts(files).filter("isDominant")


def sub_main(files: DataFrame) -> DataFrame:
    return _usable_contracts(files).filter("is2ndDominant")


def split_valid(splits: DataFrame) -> DataFrame:
    return df_valid(splits)


def split_main(splits: DataFrame) -> DataFrame:
    return df_valid(splits).filter("zip_path is not null and high is not null and isDominant")


def split_sub_main(splits: DataFrame) -> DataFrame:
    return df_valid(splits).filter("zip_path is not null and high is not null and is2ndDominant")


FILE_VIEWS = {
    "wait_import": wait_import,
    "df_valid": df_valid,
    "valid": valid,
    "main": main,
    "sub_main": sub_main,
    "": lambda files: files,
}
SPLIT_VIEWS = {"valid": split_valid, "main": split_main, "sub_main": split_sub_main}


# --- tags and column updates -------------------------------------------------


def _tags(tags: str) -> Column:
    return F.coalesce(F.col(tags), F.array().cast("array<string>"))


def add_tag(df: DataFrame, tag: str, where: Column | None = None, tags: str = "tags") -> DataFrame:
    added = F.array_union(_tags(tags), F.array(F.lit(tag)))
    return df.withColumn(tags, added if where is None else F.when(where, added).otherwise(F.col(tags)))


def remove_tag(df: DataFrame, tag: str, where: Column | None = None, tags: str = "tags") -> DataFrame:
    removed = F.array_remove(_tags(tags), tag)
    return df.withColumn(tags, removed if where is None else F.when(where, removed).otherwise(F.col(tags)))


def register_feature(splits: DataFrame, name: str, at: Column, where: Column | None = None) -> DataFrame:
    """Append a feature name to the session rows, count it and stamp the time."""
    hit = F.lit(True) if where is None else where
    files = F.coalesce(F.col("feature_files"), F.array().cast("array<string>"))
    return splits.withColumns(
        {
            "feature_files": F.when(hit, F.array_append(files, F.lit(name))).otherwise(F.col("feature_files")),
            "feature_num": F.when(hit, F.coalesce(F.col("feature_num"), F.lit(0)) + 1).otherwise(F.col("feature_num")),
            "feature_time": F.when(hit, at).otherwise(F.col("feature_time")),
        }
    )


def reset_features(splits: DataFrame) -> DataFrame:
    return splits.withColumns(
        {"feature_files": F.array().cast("array<string>"), "feature_num": F.lit(0)}
    )


# --- lookups -----------------------------------------------------------------


def with_parent(splits: DataFrame, files: DataFrame, columns: list[str]) -> DataFrame:
    """Session rows with columns of their file row, prefixed ``file_``."""
    parent = files.select("path", *[F.col(c).alias(f"file_{c}") for c in columns])
    return splits.join(parent, "path", "left")


def missing_data(files: DataFrame, stored: DataFrame, keys: list[str] = ["path"]) -> DataFrame:
    """Catalog rows that claim stored ticks which are not there."""
    return files.filter(F.col("zip_path").isNotNull()).join(
        stored.select(*keys).distinct(), keys, "left_anti"
    )


def files_to_import(listing: DataFrame, files: DataFrame) -> DataFrame:
    """Listed files that are not registered, or registered but not stored and
    not known to be empty or unreadable. Stored files are skipped."""
    known = files.select(
        "path",
        F.lit(True).alias("_known"),
        (
            F.col("zip_path").isNotNull()
            | ~without_tags("tags", ["empty_df", "load_df_fail"])
        ).alias("_skip"),
    )
    return (
        listing.join(known, "path", "left")
        .filter(~F.coalesce("_skip", F.lit(False)))
        .withColumn("reason", F.when(F.col("_known"), F.lit("not_stored")).otherwise(F.lit("new")))
        .drop("_known", "_skip")
    )


def pending_symbols(stocks: DataFrame) -> DataFrame:
    """Stocks neither being fetched nor fetched already."""
    return stocks.filter(without_tags("tags", ["ing", "got_1dK"]))


def claim(stocks: DataFrame, codes: DataFrame) -> DataFrame:
    """Tag the given stocks as being fetched."""
    return (
        stocks.join(codes.select("ts_code", F.lit(True).alias("_claimed")).distinct(), "ts_code", "left")
        .transform(add_tag, "ing", F.coalesce("_claimed", F.lit(False)))
        .drop("_claimed")
    )


def retract_rows(rows: DataFrame, keys: DataFrame, on: list[str] = ["path"]) -> DataFrame:
    """Rows without those of the retracted keys."""
    return rows.join(listed(keys.select(*on)), on, "left_anti")


def mark_retracted(files: DataFrame, keys: DataFrame) -> DataFrame:
    """Catalog rows whose stored ticks were retracted, now without a store path; the
    count of what was stored stays."""
    gone = keys.select("path", F.lit(True).alias("_gone")).distinct()
    marked = files.join(gone, "path", "left")
    return marked.withColumn("zip_path", F.when(F.col("_gone").isNull(), F.col("zip_path"))).drop("_gone")


# --- reports -----------------------------------------------------------------


def report(files: DataFrame) -> DataFrame:
    """One line of text per file."""

    def shown(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("None"))

    line = F.concat(
        F.lit("["), "InstrumentID", F.lit("-"), "day", F.lit("]: file="), "path",
        F.lit("("), text.size_text(F.col("size")), F.lit("), "),
        shown(F.col("zip_line_num")), F.lit("/"), shown(F.col("line_num")),
        F.lit(", tags="), F.coalesce(text.tags_text(F.col("tags")), F.lit("[]")),
        F.lit(", time_len="), text.duration_text(F.col("diff_sec")),
    )
    return files.select("path", line.alias("report"))


def split_report(splits: DataFrame) -> DataFrame:
    """One line of text per session row."""

    def shown(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("None"))

    line = F.concat(
        F.lit("["), "InstrumentID", F.lit("-"), "day", F.lit("-"), "time_type", F.lit("]: file="),
        shown(F.col("zip_path")), F.lit(", "), shown(F.col("zip_line_num")),
        F.lit(", tags="), F.coalesce(text.tags_text(F.col("tags")), F.lit("[]")),
        F.lit(", time_len="), text.duration_text(F.col("diff_sec")),
        F.lit(", f_num="), shown(F.col("feature_num")),
    )
    return splits.select("path", "day", "time_type", line.alias("report"))
