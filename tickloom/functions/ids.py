"""Parts of contract ids and tick-file paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.schema import DOMINANT_KIND, INDEX_KIND


def sub_id(instrument: Column) -> Column:
    return F.right(instrument, F.lit(4))


def category(instrument: Column) -> Column:
    return F.regexp_extract(instrument, "^([A-Za-z]+)", 1)


def kind(sub: Column) -> Column:
    return F.when(sub.isin(INDEX_KIND, DOMINANT_KIND), sub).otherwise(F.lit("tick"))


def with_path_parts(files: DataFrame, path: str = "path") -> DataFrame:
    """Year, market, product, contract, month and day from the last seven path
    segments ``year/market/product/contract/year/month/day.ext``."""
    parts = F.split(F.col(path), "/")

    def segment(i: int) -> Column:
        return F.element_at(parts, i - 7)

    return files.select(
        "*",
        segment(0).alias("year"),
        segment(1).try_cast("int").alias("MarketID"),
        segment(2).alias("category"),
        segment(3).alias("InstrumentID"),
        segment(5).alias("month"),
        F.split_part(segment(6), F.lit("."), F.lit(1)).alias("day"),
    ).withColumns(
        {"subID": sub_id(F.col("InstrumentID")), "data_type": kind(sub_id(F.col("InstrumentID")))}
    )
