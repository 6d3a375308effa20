"""Column selections for file kinds, batch loads, training and bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions import ids, times
from tickloom.schema import (
    BAR_INPUT,
    CATALOG_BOOKKEEPING,
    DROPPED_ALWAYS,
    DROPPED_BY_KIND,
    DROPPED_FOR_TRAINING,
    DROPPED_ON_LOAD,
)
from tickloom.session import listed


def for_kind(ticks: DataFrame, kind: str) -> DataFrame:
    """Ticks of one kind of file, ``0000``, ``9999`` or ``tick``, without the
    columns that carry nothing for it."""
    own = ticks.filter(ids.kind(ids.sub_id(F.col("InstrumentID"))) == kind)
    return own.drop(*DROPPED_ALWAYS, *DROPPED_BY_KIND[kind])


def of_all_kinds(ticks: DataFrame) -> DataFrame:
    """The kinds of file by column name in one frame; what a kind lacks is null."""
    parts = [for_kind(ticks, kind) for kind in DROPPED_BY_KIND]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def for_load(ticks: DataFrame) -> DataFrame:
    return ticks.drop(*DROPPED_ON_LOAD)


def for_training(ticks: DataFrame) -> DataFrame:
    return ticks.drop(*DROPPED_FOR_TRAINING)


def catalog_days(files: DataFrame) -> DataFrame:
    return files.drop(*CATALOG_BOOKKEEPING)


def contract_facts(ticks: DataFrame, instruments: list[str] | None = None) -> DataFrame:
    """Rows and spread of the open interest of each contract, a short list."""
    own = ticks if instruments is None else ticks.filter(F.col("InstrumentID").isin(*instruments))
    facts = [F.count(F.lit(1)).alias("rows"), F.stddev_samp("OpenInterest").alias("oi_std")]
    return listed(own.groupBy("InstrumentID").agg(*facts))


def for_bars(
    ticks: DataFrame, instruments: list[str] | None = None, min_rows: int = 2, facts: DataFrame | None = None
) -> DataFrame:
    """What a bar computation reads of the contracts, with the time bars are cut
    by. Contracts with fewer than ``min_rows`` ticks are left out; ``facts`` are the
    contracts' (see ``contract_facts``) if they are known."""
    own = ticks if instruments is None else ticks.filter(F.col("InstrumentID").isin(*instruments))
    known = contract_facts(ticks, instruments) if facts is None else facts
    few = known.filter(F.col("rows") < min_rows).select("InstrumentID")
    chosen = own.select("InstrumentID", "MarketID", *BAR_INPUT, "seq")
    if not few.isEmpty():
        chosen = chosen.join(few, "InstrumentID", "left_anti")
    return chosen.withColumn("TradingTime", times.bar_time(F.col("UpdateTime")))


def without_level(bars: DataFrame) -> DataFrame:
    return bars.drop("level")
