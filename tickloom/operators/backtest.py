"""Running extremes, trailing stops and training windows over price paths."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators import ordered
from tickloom.operators.filters import in_session
from tickloom.operators.projections import for_load, for_training
from tickloom.schema import DOMINANT_KIND, MULTIPLIER
from tickloom.session import listed

# What the running extremes start from, and the share of the move
# since entry by which a trailing stop widens.
HIGH_SEED = 0.0
LOW_SEED = 1e20
MOVE_SHARE = 0.2


def running_high_low(
    paths: DataFrame,
    keys: list[str],
    order: list[str],
    price: str = "LastPrice",
    max_group_rows: int = ordered.MAX_GROUP_ROWS,
) -> DataFrame:
    p = F.col(price)
    found = ordered.running(
        paths, keys, order, {"highest": ("max", p), "lowest": ("min", p)}, max_group_rows
    )
    return found.withColumns(
        {
            "highest": F.greatest(F.lit(HIGH_SEED), F.col("highest")),
            "lowest": F.least(F.lit(LOW_SEED), F.col("lowest")),
        }
    )


def trailing_stop(
    paths: DataFrame,
    op_type: str,
    stop_loss: float,
    multiplier: float = MULTIPLIER,
    keys: list[str] = ["trade_id"],
    order: list[str] = ["ts", "seq"],
    price: str = "LastPrice",
    max_group_rows: int = ordered.MAX_GROUP_ROWS,
) -> DataFrame:
    """Entry, exit and reward of each trade: it leaves at the first price beyond
    the stop that trails the running extreme, else at its last price."""
    if op_type not in ("buy", "sell"):
        raise ValueError(f"unknown operation: {op_type}")
    p, buy = F.col(price), op_type == "buy"
    seen = ordered.running(
        paths.filter(p.isNotNull()),
        keys,
        order,
        {"_extreme": ("max" if buy else "min", p), "_entry": ("first", p)},
        max_group_rows,
    )
    entry = F.col("_entry")
    if buy:
        extreme = F.greatest(F.lit(HIGH_SEED), F.col("_extreme"))
        stop = extreme * F.lit(1 - stop_loss) - (extreme - entry) * F.lit(MOVE_SHARE)
        hit = p <= stop
    else:
        extreme = F.least(F.lit(LOW_SEED), F.col("_extreme"))
        stop = extreme * F.lit(1 + stop_loss) + (entry - extreme) * F.lit(MOVE_SHARE)
        hit = p >= stop
    at = F.struct(*order)
    exits = seen.groupBy(*keys).agg(
        F.max("_entry").alias("entry_price"),
        F.coalesce(F.min_by(p, F.when(hit, at)), F.max_by(p, at)).alias("exit_price"),
        F.max(hit).alias("stopped"),
    )
    gain = F.col("exit_price") - F.col("entry_price")
    return exits.withColumn("reward", (gain if buy else -gain) * F.lit(multiplier))


def cut_before(df: DataFrame, keys: list[str], order: list[str], event: Column) -> DataFrame:
    """Rows of a group before its first row where ``event`` holds; the whole
    group if there is none."""
    at = F.struct(*order)
    cuts = listed(df.filter(event).groupBy(*keys).agg(F.min(at).alias("_cut")))
    return (
        df.join(cuts, keys, "left")
        .filter(F.col("_cut").isNull() | (at < F.col("_cut")))
        .drop("_cut")
    )


def two_day_window(ticks: DataFrame, first_day: str, second_day: str, keys: list[str] = ["category"]) -> DataFrame:
    """Training columns of the dominant series over two days, up to the first
    tick of the second day that is not at night."""
    series = ticks.filter(F.right("InstrumentID", F.lit(4)) == DOMINANT_KIND)
    both = series.filter(F.col("day").isin(first_day, second_day))
    starts = (F.col("day") == second_day) & (F.col("time_type") != "night")
    return for_training(for_load(cut_before(both, keys, ["UpdateTime", "seq"], starts)))


def random_window(ticks: DataFrame, category: str, seed: int | None = None) -> tuple[DataFrame, list[str], str]:
    """A random pair of adjacent days of a product's dominant series and a random
    session choice. Only the distinct days reach the driver."""
    own = ticks.filter(
        (F.col("category") == category) & (F.right("InstrumentID", F.lit(4)) == DOMINANT_KIND)
    )
    days = sorted(row.day for row in own.select("day").distinct().collect())
    if len(days) < 2:
        raise ValueError(f"{category} has fewer than two days")
    draw = random.Random(seed)
    at = draw.randint(0, len(days) - 2)
    pair, choice = days[at : at + 2], draw.choice(["night", "am_pm"])
    return in_session(two_day_window(own, *pair), choice), pair, choice
