"""The shared test tables in the shapes the operators read (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.functions import times
from tickloom.operators import catalog as cat
from tickloom.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def seq_bound(spark: SparkSession, sf_dir: str) -> int:
    """Upper bound of the tick positions."""
    return table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = table(spark, sf_dir, "events")
    value, seq = F.col("value"), F.col("seq")
    kind = F.col("user_id") % 6
    k = F.regexp_extract("props", '"k": *(-?[0-9]+)', 1).try_cast("int")

    def unless_fifth(price: Column) -> Column:
        return F.when(seq % 5 == 0, F.lit(0.0)).otherwise(price)

    shaped = event.select(
        F.col("event_id").alias("seq"),
        F.upper(F.substring("event_type", 1, 2)).alias("category"),
        F.when(kind == 0, F.lit("0000"))
        .when(kind == 5, F.lit("9999"))
        .otherwise(F.concat(F.lit("240"), kind.cast("string")))
        .alias("subID"),
        F.col("ts").alias("UpdateTime"),
        "value",
        k.alias("k"),
    )
    day = times.calendar_day(F.col("UpdateTime"))
    named = shaped.select(
        F.concat("category", "subID").alias("InstrumentID"),
        F.when(F.col("category") == "CL", F.lit(3)).otherwise(F.lit(4)).alias("MarketID"),
        "category",
        "subID",
        "UpdateTime",
        value.alias("LastPrice"),
        (F.col("k") - 5).cast("double").alias("LastVolume"),
        F.when(seq % 97 == 0, F.lit(900_000_000)).otherwise(100_000 + seq % 1000).cast("long").alias("OpenInterest"),
        F.when(seq % 11 != 0, value * F.col("k")).alias("Turnover"),
        value.alias("AvePrice"),
        unless_fifth(value + 1).alias("HighestPrice"),
        unless_fifth(value - 1).alias("LowestPrice"),
        unless_fifth(value).alias("OpenPrice"),
        F.when(F.col("subID") == "9999", F.concat("category", F.lit("2401"))).alias("mainID"),
        "seq",
        day.alias("day"),
        F.substring(day, 1, 6).alias("month"),
    )
    return named.withColumn(
        "path",
        F.concat_ws(
            "/",
            F.lit("2024"),
            F.col("MarketID").cast("string"),
            "category",
            "InstrumentID",
            F.lit("2024"),
            "month",
            F.concat("day", F.lit(".spt")),
        ),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contract and day, with the tags FIXTURES.md gives them."""
    rows = cat.file_stats(ticks(spark, sf_dir), seq_bound=seq_bound(spark, sf_dir))
    day = F.substring("day", 7, 2)
    n = F.col("line_num")
    stored = F.concat_ws(
        "/",
        F.col("MarketID").cast("string"),
        "category",
        "InstrumentID",
        "month",
        F.concat("InstrumentID", F.lit("_"), "day", F.lit(".pkl")),
    )
    tags = (
        F.when(n < 5, F.array(F.lit("too_small")))
        .when(day == "20", F.array(F.lit("dup_time"), F.lit("splited")))
        .when(day != "21", F.array().cast("array<string>"))
    )
    described = rows.withColumns(
        {
            "tags": tags,
            "zip_path": F.when(day != "13", stored),
            "zip_ver": F.lit(1),
            "stored": F.lit(False),
            "size": n * 150,
        }
    )
    return cat.with_dominance(described).withColumn("line_num", F.when(day != "07", n))


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").select(
        "source",
        F.col("lang").alias("subsource"),
        F.col("lang").alias("category"),
        F.col("quality").cast("string").alias("subcategory"),
        F.col("toxic").cast("string").alias("input_tag"),
        (F.col("doc_id") % 10).alias("dataset"),
    )


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Note keys of a conversation; some are empty and some missing."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.sort_array(F.collect_set("role")).alias("roles")
    )
    part = F.col("conv_id") % 7
    return turns.select(
        "conv_id",
        F.when(part == 0, F.array().cast("array<string>")).when(part != 1, F.col("roles")).alias("notes_key"),
    )


def price_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("trade_id"), "ts", F.col("event_id").alias("seq"), F.col("value").alias("LastPrice")
    )


def stock_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.col("p_size") % 3
    return table(spark, sf_dir, "part").select(
        F.concat(F.col("p_partkey").cast("string"), F.lit(".SZ")).alias("ts_code"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("industry"),
        F.when(state == 0, F.array().cast("array<string>"))
        .when(state == 1, F.array(F.lit("ing")))
        .otherwise(F.array(F.lit("got_1dK")))
        .alias("tags"),
    )


def stock_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.col("l_partkey").cast("string"), F.lit(".SZ")).alias("ts_code"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("day"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
        F.col("l_quantity").alias("volume"),
    )


def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.struct("source", "lang").alias("meta"), "n_chars"
    )
