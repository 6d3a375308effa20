"""Import of raw tick files as they arrive, into the store of the batch import.

A file source remembers which files it has read, so each run picks up what is
new. A batch stores its files the way a batch import does: in place of what is
stored of them, so a batch that is repeated after a failure doubles nothing, and
files that are registered already are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions import ids
from tickloom.operators.catalog import files_to_import
from tickloom.plans import importing
from tickloom.schema import CATALOG, RAW_TICK
from tickloom.session import listed
from tickloom.sources import raw, stores


def import_arrivals(
    spark: SparkSession,
    root: str,
    tick_folder: str,
    catalog_folder: str,
    progress_folder: str,
    pattern: str = raw.GLOB,
    rules: importing.Rules = importing.Rules(),
    files_per_batch: int | None = None,
) -> None:
    """Import everything that arrived since the last run, then stop."""
    options = raw.csv_options()
    if files_per_batch:
        options["maxFilesPerTrigger"] = str(files_per_batch)
    lines = raw.with_origin(
        spark.readStream.schema(raw.raw_schema(RAW_TICK))
        .options(**options)
        .csv(f"{root}/{pattern}")
        .select("*", "_metadata")
    ).withColumn("_size", F.col("_metadata.file_size"))

    def store(batch: DataFrame, number: int) -> None:
        arrived = batch.groupBy("path").agg(F.max("_size").alias("size"))
        known = stores.read_or_empty(spark, catalog_folder, CATALOG)
        named = importing.wanted_files(ids.with_path_parts(arrived), rules)
        files = listed(files_to_import(named, known).select("path", "size"))
        ticks = raw.shaped(batch, RAW_TICK, rules.bad_rows).join(files.select("path"), "path", "left_semi")
        importing.store_files(spark, ticks, files, tick_folder, catalog_folder, rules)

    (
        lines.writeStream.foreachBatch(store)
        .option("checkpointLocation", progress_folder)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
