"""Stored count tables, kept by the rows that come and go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickloom.operators.stats import CAT, SRC, SRC_CAT
from tickloom.schema import layout
from tickloom.session import scratch
from tickloom.sources import stores

# What each table counts by.
TABLES = {"source": ["source"], "category": ["category"], "src_stat": SRC, "cat_stat": CAT, "src_cat_stat": SRC_CAT}
NAMED = ("source", "category")
BUCKETS = 16


def _schema(keys: list[str]) -> StructType:
    return StructType([*layout(f"string {' '.join(keys)}"), *layout("long count\nstring batch bucket")])


def _stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return stores.read_or_empty(spark, f"{folder}/{name}", _schema(TABLES[name]))


def read_counts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Combinations with at least one row, and how many they have."""
    return _stored(spark, folder, name).filter("count > 0").select(*TABLES[name], "count")


def count_changes(
    spark: SparkSession, folder: str, batch: str, added: DataFrame | None = None, removed: DataFrame | None = None
) -> None:
    """Bring all count tables up to date with rows that were added and rows that were
    taken away; nothing else is counted again.

    The changes are read once, as signed counts of full combinations, which add up to
    those of every table. Tables are stored in buckets of combinations, and only buckets
    with changes are rewritten. Each bears the name of the ``batch`` it was last changed
    by, and passes a batch of this name over: a run that broke between tables or buckets
    is completed by running it again, before any other batch.

    Rows without a source (or category) do not count in its table, nulls are
    combinations of the others. A count below zero, rows taken away that were never
    added, is an error, and the table in question stays as it is."""
    signed = [df.select(*SRC_CAT, F.lit(sign).alias("_by")) for df, sign in ((added, 1), (removed, -1)) if df is not None]
    if not signed:
        return
    rows = signed[0] if len(signed) == 1 else signed[0].unionByName(signed[1])
    changes = rows.groupBy(*[F.col(k).cast("string").alias(k) for k in SRC_CAT]).agg(F.sum("_by").cast("long").alias("_by"))
    with scratch(changes.filter("_by <> 0")) as net:
        for name, keys in TABLES.items():
            _merge(spark, folder, name, batch, net.groupBy(*keys).agg(F.sum("_by").alias("_by")).filter("_by <> 0"))


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("string")


def _merge(spark: SparkSession, folder: str, name: str, batch: str, changes: DataFrame) -> None:
    keys = TABLES[name]
    if name in NAMED:
        changes = changes.filter(F.col(name).isNotNull() & (F.col(name) != ""))
    table = _stored(spark, folder, name)
    done = table.filter(F.col("batch") == batch).select("bucket").distinct()
    with scratch(changes.withColumn("bucket", _bucket(keys)).join(done, "bucket", "left_anti")) as open_:
        touched = open_.select("bucket").distinct()
        old = stores.near(table, touched, ["bucket"]).select(*keys, "bucket", F.col("count").alias("_by"))
        # A combination that has come down to nothing stays until the next change, so
        # that a bucket always tells its batch.
        kept = old.filter("_by > 0").unionByName(open_.select(*old.columns))
        merged = kept.groupBy(*keys, "bucket").agg(F.sum("_by").alias("count")).withColumn("batch", F.lit(batch))
        with scratch(merged.select(*_schema(keys).names)) as rows:
            below = rows.filter("count < 0").first()
            if below:
                raise ValueError(f"{name}: more rows of {[below[k] for k in keys]} taken away than there were")
            stores.write_partitions(rows, f"{folder}/{name}", ["bucket"], keys)
