"""Verdicts, accounting, duplicates, repair and profiles of ticks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from tickloom.functions import times
from tickloom.operators import ordered
from tickloom.operators.filters import has_volume, in_dates
from tickloom.operators.projections import contract_facts
from tickloom.schema import (
    MAX_DATE,
    MAX_REPEATS,
    MIN_COLUMNS,
    MIN_DATE,
    MIN_ROWS,
    OPEN_INTEREST_STD,
    PRICE_STD,
)
from tickloom.session import listed, staged

FAILED = "row_failed"
QUARTILES = (25, 50, 75)
CELLS = 1024


# --- washing and file verdicts -------------------------------------------------


def wash_accounting(
    ticks: DataFrame, keys: list[str] = ["path"], low: str = MIN_DATE, high: str = MAX_DATE
) -> DataFrame:
    """Lines read and kept per file, and how many each rule turned away."""
    timely = in_dates(F.col("UpdateTime"), low, high)
    traded = has_volume(F.col("LastVolume"))
    return ticks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("line_num"),
        F.count_if(timely & traded).alias("kept"),
        F.count_if(~timely).alias("bad_time"),
        F.count_if(timely & ~traded).alias("bad_volume"),
    )


def file_verdicts(
    ticks: DataFrame,
    keys: list[str] = ["path"],
    columns: list[str] | None = None,
    min_rows: int = MIN_ROWS,
    min_columns: int = MIN_COLUMNS,
    low: str = MIN_DATE,
    high: str = MAX_DATE,
) -> DataFrame:
    """One row per file: line counts, time span and the first rule it breaks.

    ``ticks`` are the unwashed rows. A true ``row_failed`` marks a row that makes
    the whole file unreadable."""
    t = F.col("UpdateTime")
    kept = in_dates(t, low, high) & has_volume(F.col("LastVolume"))
    looked_at = columns or [c for c in ticks.columns if c not in ("path", "seq", FAILED)]
    failed = F.col(FAILED) if FAILED in ticks.columns else F.lit(False)
    filled = [F.max(kept & F.col(c).isNotNull()).cast("int") for c in looked_at]
    stats = ticks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("line_num"),
        F.count_if(kept).alias("zip_line_num"),
        F.max(failed).alias("failed"),
        F.min(F.when(kept, t)).alias("start"),
        F.max(F.when(kept, t)).alias("end"),
        F.count_if(kept & (times.session_by_hour(t) == times.UNKNOWN)).alias("unknown"),
        sum(filled[1:], filled[0]).alias("column_num"),
    )
    diff = times.span_seconds(F.col("start"), F.col("end"))
    n = F.col("zip_line_num")
    tag = (
        F.when(F.col("failed"), F.lit("load_df_fail"))
        .when(n == 0, F.lit("empty_df"))
        .when(n < min_rows, F.lit("too_small"))
        .when(F.col("column_num") < min_columns, F.lit("col_error"))
        .when(F.col("diff_sec").isNull(), F.lit("diff_sec_error"))
        .when(F.col("unknown") > 0, F.lit("time_error"))
    )
    return stats.withColumn("diff_sec", diff).withColumn("tag", tag).drop("failed")


def passing(ticks: DataFrame, verdicts: DataFrame, keys: list[str] = ["path"]) -> DataFrame:
    """Ticks of the files no rule rejected."""
    rejected = listed(verdicts.filter(F.col("tag").isNotNull()).select(*keys))
    return ticks.join(rejected, keys, "left_anti")


def set_aside(ticks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split off the rows without a session instead of rejecting their file."""
    unknown = F.col("time_type") == times.UNKNOWN
    return ticks.filter(~unknown), ticks.filter(unknown)


def single_market(ticks: DataFrame) -> DataFrame:
    """Per product its market, and whether it is the only one."""
    return ticks.groupBy("category").agg(
        F.min("MarketID").alias("MarketID"),
        F.coalesce(F.min("MarketID") == F.max("MarketID"), F.lit(False)).alias("single"),
    )


def require_single_market(ticks: DataFrame) -> int:
    low, high = ticks.agg(F.min("MarketID"), F.max("MarketID")).first()
    if low is None or low != high:
        raise ValueError(f"expected one market, found {low} to {high}")
    return low


# --- sub-seconds and duplicates ------------------------------------------------


def sub_second_profile(ticks: DataFrame, keys: list[str] = ["path"]) -> DataFrame:
    """How often each part of a second occurs in a file."""
    part = times.sub_second(F.col("UpdateTime")).alias("micros")
    return ticks.groupBy(*keys, part).agg(F.count(F.lit(1)).alias("n"))


def sub_second_verdict(ticks: DataFrame, keys: list[str] = ["path"]) -> DataFrame:
    """Per file: distinct parts of a second before and after rounding, whether
    they differ from {0, 500000}, and the tag of a file with only one."""
    profile = sub_second_profile(ticks, keys)
    m = F.col("micros")
    half = times.SECOND // 2
    stats = profile.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("parts"),
        (F.max(~m.isin(0, half)) | ~F.max(m == 0) | ~F.max(m == half)).alias("differs"),
        (F.max(m == 0).cast("int") + F.max(m != 0).cast("int")).alias("rounded_parts"),
    )
    return stats.withColumn("tag", F.when(F.col("rounded_parts") < 2, F.lit("time_no_ms")))


def dedupe_rows(ticks: DataFrame, ignore: list[str] = ["seq"]) -> DataFrame:
    """Exact copies collapse to the one at the lowest position. Grouping on the
    data columns merges copies before any of them is shuffled."""
    data = [c for c in ticks.columns if c not in ignore]
    return ticks.groupBy(*data).agg(*[F.min(c).alias(c) for c in ignore]).select(*ticks.columns)


def dedupe_time(ticks: DataFrame, keys: list[str] = ["path"], time: str = "UpdateTime") -> DataFrame:
    """Keep the first tick of each instant of a file. The rank limit applies
    before the shuffle too, so a heavily repeated instant sends one row a task."""
    first = Window.partitionBy(*keys, time).orderBy("seq")
    return ticks.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def duplicate_verdict(
    ticks: DataFrame, keys: list[str] = ["path"], max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Per file the ticks that repeat an instant, and the tag of a file with
    more than ``max_repeats``."""
    instants = ticks.groupBy(*keys, "UpdateTime").agg(F.count(F.lit(1)).alias("n"))
    stats = instants.groupBy(*keys).agg(
        F.sum("n").alias("line_num"), F.count(F.lit(1)).alias("distinct_times")
    )
    dropped = F.col("line_num") - F.col("distinct_times")
    return stats.withColumn("dropped", dropped).withColumn(
        "tag", F.when(F.col("dropped") > max_repeats, F.lit("dup_time"))
    )


# --- repair and profiles -------------------------------------------------------


def repair_open_interest(
    ticks: DataFrame,
    std_limit: float = OPEN_INTEREST_STD,
    time: str = "UpdateTime",
    max_group_rows: int = ordered.MAX_GROUP_ROWS,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Where the open interest of a contract spreads beyond the limit, values
    above twice the spread take the last value before them.

    Only contracts beyond the limit enter the ordered pass; their list, one row
    each, comes from the contracts' ``facts`` or is found first. Ticks of the others are
    read apart only if there are any."""
    key = ["InstrumentID"]
    value = F.col("OpenInterest")
    known = contract_facts(ticks) if facts is None else facts
    beyond = F.coalesce(F.col("oi_std") > std_limit, F.lit(False)) & F.col("InstrumentID").isNotNull()
    extent, others = known.agg(F.max(F.when(beyond, F.col("rows"))), F.count_if(~beyond)).first()
    if extent is None:
        return ticks
    spread = known.filter(beyond).select(*key, F.col("oi_std").alias("_std"))
    wild = ticks.join(spread, key)
    seen = F.when(value > 2 * F.col("_std"), F.lit(None)).otherwise(value)
    mended = ordered.running(
        wild, key, [time, "seq"], {"_filled": ("last", seen)}, max_group_rows, extent
    )
    mended = mended.withColumn("OpenInterest", F.col("_filled")).select(*ticks.columns)
    return ticks.join(spread, key, "left_anti").unionByName(mended) if others else mended


def describe(ticks: DataFrame, columns: list[str], key: str = "InstrumentID") -> DataFrame:
    """Count, mean, spread, extremes and exact quartiles per contract and column.

    One aggregate gives all but the quartiles. These lie between two ranks each, and
    ``values_at`` narrows down the value at every rank."""
    numbers = ticks.select(key, *[F.col(c).cast("double").alias(c) for c in columns])
    made = {
        "count": F.count,
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    wide = numbers.groupBy(key).agg(
        *[f(c).alias(f"{c}.{n}") for c in columns for n, f in made.items()]
    )
    rows = [
        F.struct(F.lit(c).alias("field"), *[F.col(f"`{c}.{n}`").alias(n) for n in made]) for c in columns
    ]
    moments = staged(wide.select(key, F.inline(F.array(*rows))).filter(F.col("count") > 0))
    at = [(F.col("count") - 1) * F.lit(percent / 100) for percent in QUARTILES]
    ranks = F.array_distinct(F.array(*[rank for a in at for rank in (F.floor(a), F.ceil(a))]))
    wanted = moments.select(key, "field", F.explode(ranks).alias("rank"), F.col("min").alias("low"), F.col("max").alias("high"))
    found = values_at(numbers, columns, key, wanted)
    by_rank = F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_at")
    located = moments.join(found.groupBy(key, "field").agg(by_rank), [key, "field"])
    for percent, a in zip(QUARTILES, at, strict=True):
        low, high = (F.element_at("_at", rank) for rank in (F.floor(a), F.ceil(a)))
        located = located.withColumn(f"p{percent}", low + (high - low) * (a - F.floor(a)))
    return located.drop("_at")


def values_at(numbers: DataFrame, columns: list[str], key: str, wanted: DataFrame) -> DataFrame:
    """The values at some ranks, from 0, of the columns of each contract, nulls left out.

    ``wanted`` has the contract, the ``field``, the ``rank`` and the extremes (``low``,
    ``high``) of all values. Each round counts the values within the bounds of the ranks
    still open, in equal cells and at both ends, all columns in one scan; a rank goes on
    with the extremes of the cell it falls into until these are one value. Every round
    leaves out the ends, so it comes to its end with any values, after two or three
    rounds with most. Only counts of cells are shuffled or written."""
    bounds = [key, "field", "low", "high"]
    opened = wanted.withColumn("below", F.lit(0).cast("long"))
    done = None
    while True:
        settled = F.col("low").eqNullSafe(F.col("high"))
        now = staged(opened)
        closed = now.filter(settled).select(key, "field", "rank", F.col("low").alias("value"))
        done = closed if done is None else done.unionByName(closed)
        opened = now.filter(~settled)
        if opened.isEmpty():
            return done
        cells = staged(_cell_counts(numbers, columns, key, opened.select(*bounds).distinct()))
        upto = Window.partitionBy(*bounds).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        counted = cells.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
        here = F.col("rank") - F.col("below") - F.col("before")
        opened = (
            opened.join(counted, bounds)
            .filter((here >= 0) & (here < F.col("n")))
            .select(
                key, "field", "rank", F.col("least").alias("low"), F.col("most").alias("high"),
                (F.col("below") + F.col("before")).alias("below"),
            )
        )


def _cell_counts(numbers: DataFrame, columns: list[str], key: str, bounds: DataFrame) -> DataFrame:
    """Rows and extremes of the cells between each pair of bounds: a cell for either end
    and ``CELLS`` between. The bounds of a contract are one row of the list joined."""
    field = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("field")).cast("int")
    listed_ = bounds.select(key, F.struct(field.alias("at"), "field", "low", "high").alias("b"))
    lists = listed(listed_.groupBy(key).agg(F.collect_list("b").alias("_bounds")))
    every = F.array(*[F.col(c) for c in columns])
    pairs = F.transform("_bounds", lambda b: F.struct(b.alias("b"), F.element_at(every, b["at"]).alias("value")))
    inside = F.filter(pairs, lambda p: (p["value"] >= p["b"]["low"]) & (p["value"] <= p["b"]["high"]))
    rows = numbers.join(lists, key).select(key, F.explode(inside).alias("p"))
    value, low, high = F.col("p.value"), F.col("p.b.low"), F.col("p.b.high")
    # Halves keep the difference of two large values finite.
    share = F.try_divide(value / 2 - low / 2, high / 2 - low / 2) * CELLS
    middle = F.when(share.isNull() | F.isnan(share), 1).otherwise(F.least(F.floor(share) + 1, F.lit(CELLS)))
    cell = F.when(value == low, 0).when(value == high, CELLS + 1).otherwise(middle)
    return rows.select(key, "p.b.field", "p.b.low", "p.b.high", cell.cast("int").alias("cell"), value.alias("value")).groupBy(
        key, "field", "low", "high", "cell"
    ).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))


def std_outliers(ticks: DataFrame, columns: list[str], limit: float = PRICE_STD, key: str = "InstrumentID") -> DataFrame:
    """Columns of a contract whose sample spread exceeds the limit."""
    spreads = ticks.groupBy(key).agg(*[F.stddev_samp(c).alias(c) for c in columns])
    return spreads.unpivot(key, columns, "field", "std").filter(F.col("std") > limit)


# --- row counts ----------------------------------------------------------------


def counting(before: DataFrame, after: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, Callable[[], int]]:
    """Apply ``after`` and count rows on both sides while the result is written.

    The second value returned, called once the result has run, raises unless
    both counts agree."""
    counts = [Observation(), Observation()]
    result = after(before.observe(counts[0], F.count(F.lit(1)).alias("n"))).observe(
        counts[1], F.count(F.lit(1)).alias("n")
    )

    def check() -> int:
        rows_in, rows_out = (c.get["n"] for c in counts)
        if rows_in != rows_out:
            raise ValueError(f"row count changed from {rows_in} to {rows_out}")
        return rows_out

    return result, check
