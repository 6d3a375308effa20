"""Bars of arriving ticks, kept as event-time state until the watermark passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions import times
from tickloom.operators import bars, filters
from tickloom.schema import LEVELS, RAW_TICK
from tickloom.sources import raw, stores

DELAY = "1 hour"


def bars_of_stream(ticks: DataFrame, level: str, delay: str = DELAY) -> DataFrame:
    """Bars of one level of a stream of ticks with ``TradingTime`` and ``seq``.

    A bar is state until the latest time seen is ``delay`` past its end: ticks that
    arrive late change it as long as that lasts and are left out after. In update mode
    a bar comes out whenever it has changed, in append mode once it is final."""
    # A watermark wants a zoned time; in a UTC session the cast leaves it as it is.
    timed = ticks.filter(F.col("TradingTime").isNotNull()).withColumn("_event", F.col("TradingTime").cast("timestamp"))
    timely = timed.withWatermark("_event", delay)
    window = F.window("_event", f"{LEVELS[level]} minutes")
    order = F.struct("TradingTime", "seq")
    states = timely.groupBy(*bars.GROUP, window).agg(*bars.state_columns(order))
    binned = states.withColumn("bin", times.micros(F.col("window.start"))).drop("window")
    return bars.finished(binned, F.lit(level))


def import_bars(
    spark: SparkSession,
    root: str,
    bar_folder: str,
    progress_folder: str,
    level: str,
    delay: str = DELAY,
    pattern: str = raw.GLOB,
    files_per_batch: int | None = None,
) -> None:
    """Bring the stored bars of a level up to date with the raw files that have arrived
    since the last run, then stop.

    Bars that have changed take the place of the stored ones by contract and time, so a
    batch that is repeated after a failure changes nothing. Ticks are washed; those of
    one instant are in the order of a hash of their values, since the position in a file
    is not known here. State and watermark live in ``progress_folder``, one for each
    level."""
    options = raw.csv_options()
    if files_per_batch:
        options["maxFilesPerTrigger"] = str(files_per_batch)
    lines = raw.with_origin(
        spark.readStream.schema(raw.raw_schema(RAW_TICK))
        .options(**options)
        .csv(f"{root}/{pattern}")
        .select("*", "_metadata")
    )
    ticks = filters.wash(raw.typed(lines, RAW_TICK)).withColumns(
        {"TradingTime": times.bar_time(F.col("UpdateTime")), "seq": F.xxhash64(*RAW_TICK.names)}
    )

    def store(batch: DataFrame, number: int) -> None:
        stores.merge_bars(batch, bar_folder)

    (
        bars_of_stream(ticks, level, delay)
        .writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", progress_folder)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
