"""Bars of stored ticks, at every level and replaced by contract and level."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.operators import bars, quality
from tickloom.operators.projections import contract_facts, for_bars
from tickloom.schema import LEVELS, OPEN_INTEREST_STD
from tickloom.session import scratch
from tickloom.sources import stores

MIN_TICKS = 2


def bar_input(
    ticks: DataFrame, instruments: list[str] | None = None, std_limit: float = OPEN_INTEREST_STD
) -> DataFrame:
    """Ticks as bars are computed from: projected, timed, open interest mended. What has
    to be known of the contracts before comes from one aggregate."""
    facts = contract_facts(ticks, instruments)
    enough = facts.filter(F.col("rows") >= MIN_TICKS)
    chosen = for_bars(ticks, instruments, MIN_TICKS, facts)
    return quality.repair_open_interest(chosen, std_limit, "TradingTime", facts=enough)


def refresh_bars(
    spark: SparkSession,
    ticks: DataFrame,
    bar_folder: str,
    daily_folder: str,
    instruments: list[str] | None = None,
    seq_bound: int | None = None,
) -> None:
    """Compute all levels from one scan and replace the stored bars. Without a bound
    of the ticks' positions the largest is looked up first, which reads one column
    and lets the bars be hashed instead of sorted. Without ``instruments`` bars of
    contracts that have none any more go too."""
    if seq_bound is None:
        seq_bound = ticks.agg(F.max("seq")).first()[0] or 0
    levels = [level for level in LEVELS if level not in ("1d", "2H")]
    made = bars.bars_at_levels(bar_input(ticks, instruments), [*levels, "1d"], seq_bound=seq_bound)
    with scratch(made) as rows:
        if instruments is None:
            stored = stores.read_bars(spark, bar_folder).select("InstrumentID").distinct()
            instruments = sorted(r.InstrumentID for r in stored.collect())
        stores.write_bars(rows.filter("level <> '1d'"), bar_folder, instruments, levels)
        stores.write_daily(rows.filter("level = '1d'"), daily_folder, instruments)
