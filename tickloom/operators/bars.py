"""OHLC bars from ticks.

A bar is built from a *state*: sums, extremes and first/last values of the ticks
in one bin. States merge, so the one-minute states of a single scan serve every
level. First and last values are kept with a numeric order key where the tick
positions allow it, which lets the aggregate hash its groups instead of sorting
all ticks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions import ids, times
from tickloom.schema import BAR, LEVELS, MULTIPLIER
from tickloom.session import listed, staged

GROUP = ["InstrumentID", "MarketID"]

# Bar columns taken from the first or last tick that has a value.
FIRST = ["OpenPrice"]
LAST = ["HighestPrice", "LowestPrice", "AvePrice", "OpenInterest", "Turnover"]


def _width(level: str) -> int:
    return LEVELS[level] * times.MINUTE


def fits_one_key(width: int, seq_bound: int | None) -> bool:
    return seq_bound is not None and width.bit_length() + seq_bound.bit_length() <= 62


def tick_order(at: Column, seq: Column, base: Column, width: int, seq_bound: int | None) -> Column:
    """Order of ticks within a bin: microseconds into the bin, then position.

    Both fit one long while ``seq_bound``, an upper bound of the positions, is
    small enough for the bin width; a pair takes over beyond that."""
    if fits_one_key(width, seq_bound):
        beyond = F.raise_error(F.lit(f"a tick's position is above the bound of {seq_bound}")).cast("long")
        return (at - base) * F.lit(1 << seq_bound.bit_length()) + F.when(seq > seq_bound, beyond).otherwise(seq)
    return F.struct(at.alias("at"), seq.alias("seq"))


def _first(value: Column, key: Column) -> Column:
    return F.min_by(value, F.when(value.isNotNull(), key))


def _last(value: Column, key: Column) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), key))


def bar_states(
    ticks: DataFrame,
    level: str = "1min",
    time: str = "TradingTime",
    seq_bound: int | None = None,
    multiplier: float = MULTIPLIER,
) -> DataFrame:
    """One mergeable state per contract and bin of ``level``."""
    width = _width(level)
    at = times.micros(F.col(time))
    binned = ticks.filter(F.col(time).isNotNull()).withColumn("bin", times.bin_start(at, width))
    ordered = binned.withColumn("_order", tick_order(at, F.col("seq"), F.col("bin"), width, seq_bound))
    return ordered.groupBy(*GROUP, "bin").agg(*state_columns(F.col("_order"), multiplier))


def state_columns(key: Column, multiplier: float = MULTIPLIER) -> list[Column]:
    """Aggregates of the ticks of a bin that make up its state; ``key`` orders them."""
    price, volume = F.col("LastPrice"), F.col("LastVolume")
    return [
        _first(price, key).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        _last(price, key).alias("close"),
        F.count(volume).alias("volumes"),
        F.coalesce(F.sum(volume), F.lit(0.0)).alias("volume"),
        F.coalesce(F.var_pop(volume) * F.count(volume), F.lit(0.0)).alias("spread"),
        F.coalesce(F.sum(price * volume * F.lit(float(multiplier))), F.lit(0.0)).alias("Turnover_new"),
        F.count("Turnover").alias("tick_num"),
        *[_first(F.col(c), key).alias(c) for c in FIRST],
        *[_last(F.col(c), key).alias(c) for c in LAST],
    ]


def roll_up(states: DataFrame, levels: list[str]) -> DataFrame:
    """States of several coarser levels, all in one shuffle, with their level.

    Sums of volumes are taken from the contract's mean volume on, so that the squares
    that make up the spread between states do not drown it."""
    key = F.col("bin")
    volumes = F.col("volumes")
    middle = listed(states.groupBy(*GROUP).agg(F.try_divide(F.sum("volume"), F.sum(volumes)).alias("_middle")))
    off = F.col("volume") - F.coalesce(volumes * F.col("_middle"), F.lit(0.0))
    states = states.join(middle, GROUP, "left").withColumn("_off", off).drop("_middle")
    level = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.lit(_width(n)).alias("width")) for n in levels]))
    wide = states.select("*", level.alias("_l")).select(
        *GROUP,
        F.col("_l.level").alias("level"),
        (key - F.pmod(key, F.col("_l.width"))).alias("start"),
        *[c for c in states.columns if c not in GROUP],
    )
    mean_square = F.when(volumes > 0, F.col("_off") * F.col("_off") / volumes)
    merged = wide.groupBy(*GROUP, "level", "start").agg(
        _first(F.col("open"), key).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        _last(F.col("close"), key).alias("close"),
        F.sum(volumes).alias("volumes"),
        F.sum("volume").alias("volume"),
        F.sum("_off").alias("_off"),
        F.sum("spread").alias("_within"),
        F.coalesce(F.sum(mean_square), F.lit(0.0)).alias("_means"),
        F.sum("Turnover_new").alias("Turnover_new"),
        F.sum("tick_num").alias("tick_num"),
        *[_first(F.col(c), key).alias(c) for c in FIRST],
        *[_last(F.col(c), key).alias(c) for c in LAST],
    )
    between = F.col("_means") - F.coalesce(mean_square, F.lit(0.0))
    return (
        merged.withColumn("spread", F.col("_within") + F.greatest(between, F.lit(0.0)))
        .withColumnRenamed("start", "bin")
        .drop("_within", "_means", "_off")
    )


def zero_fallback(bars: DataFrame) -> DataFrame:
    """Reported prices of zero give way to the prices seen in the bar."""
    pairs = {"HighestPrice": "high", "LowestPrice": "low", "OpenPrice": "open"}
    return bars.withColumns(
        {c: F.when(F.col(c) == 0, F.col(seen)).otherwise(F.col(c)) for c, seen in pairs.items()}
    )


def finished(states: DataFrame, level: Column | None = None) -> DataFrame:
    """Bars of states: fallbacks applied, incomplete bars left out."""
    n = F.col("volumes")
    bars = zero_fallback(
        states.withColumns(
            {
                "TradingTime": times.from_micros(F.col("bin")),
                "level": F.col("level") if level is None else level,
                "category": ids.category(F.col("InstrumentID")),
                "TotalVolume": F.col("volume"),
                "volume_std": F.when(n > 1, F.sqrt(F.col("spread") / (n - 1))).otherwise(1.0),
            }
        )
    )
    return bars.select(*BAR.names).dropna()


def bars(
    ticks: DataFrame,
    level: str,
    time: str = "TradingTime",
    seq_bound: int | None = None,
    multiplier: float = MULTIPLIER,
) -> DataFrame:
    """Bars of one level straight from the ticks."""
    return finished(bar_states(ticks, level, time, seq_bound, multiplier), F.lit(level))


def bars_at_levels(
    ticks: DataFrame,
    levels: list[str] | None = None,
    time: str = "TradingTime",
    seq_bound: int | None = None,
    multiplier: float = MULTIPLIER,
) -> DataFrame:
    """Bars of many levels from one scan of the ticks."""
    states = staged(bar_states(ticks, "1min", time, seq_bound, multiplier))
    return finished(roll_up(states, levels or list(LEVELS)))


def daily(bars_1d: DataFrame) -> DataFrame:
    """Daily statistics rows: daily bars without their level, with empty tags."""
    return bars_1d.drop("level").withColumn("tags", F.array().cast("array<string>"))
