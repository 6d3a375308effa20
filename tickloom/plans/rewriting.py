"""Jobs that change what is stored: mapped files, retracted files, features of sessions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickloom.operators import catalog
from tickloom.operators.userfuncs import Frame, map_files
from tickloom.plans.importing import register
from tickloom.plans.sessions import STORED_SPLIT, read_splits, retract_splits
from tickloom.schema import CATALOG
from tickloom.session import listed, scratch
from tickloom.sources import raw, stores

# Columns the store itself relies on; a mapped file keeps the first two.
OWN_COLUMNS = ["path", "seq", "day", "category", "month", "market"]
MAPPING = "mapping"


def _catalog_rows(spark: SparkSession, catalog_folder: str, paths: DataFrame) -> DataFrame:
    files = stores.read_or_empty(spark, catalog_folder, CATALOG)
    return files.join(paths.select("path"), "path", "left_semi").select(*CATALOG.names)


def map_stored_files(
    spark: SparkSession,
    tick_folder: str,
    catalog_folder: str,
    files: DataFrame,
    func: Callable[[Iterator[Frame]], Iterator[Frame]],
    schema: StructType | str,
) -> DataFrame:
    """Run a function over the stored ticks of each file of ``files`` (``path``) and store
    what it returns in their place; returns the catalog.

    The function sees a file batch by batch with all stored columns and returns rows of
    ``schema``, which has ``path`` and ``seq``. It keeps each file's rows; else nothing is
    changed. Columns it leaves out are null from then on, columns it adds become columns
    of the store, null in all other files. The files' catalog rows get the number of
    their columns and the next version.

    Files bear the tag ``mapping`` while their ticks are replaced. Where a broken run
    has left it, they may or may not be mapped, and mapping them again is an error until
    the tag is removed. Files without stored ticks are passed over."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    missing = [c for c in OWN_COLUMNS[:2] if c not in schema.names]
    if missing:
        raise ValueError(f"a mapped file keeps {missing}")
    chosen = listed(stores.partitions_of(files))
    stored = stores.near(stores.read_ticks(spark, tick_folder, stores.tick_schema(spark, tick_folder)), chosen)
    ticks = stored.join(chosen.select("path"), "path", "left_semi").select(*stored.columns)
    with scratch(map_files(ticks, func, schema)) as mapped:
        sizes = mapped.groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
        with scratch(sizes) as found, scratch(_catalog_rows(spark, catalog_folder, found)) as rows:
            before = ticks.groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
            moved = before.unionAll(found).groupBy("path", "rows").count().filter("count <> 2")
            if not moved.isEmpty():
                raise ValueError(f"ticks would change their file: {moved.first()['path']}")
            doubtful = rows.filter(F.array_contains("tags", MAPPING)).first()
            if doubtful:
                raise RuntimeError(f"a broken run may have mapped {doubtful['path']}")
            register(catalog.add_tag(rows, MAPPING), catalog_folder)
            stores.replace_ticks(raw.with_file_columns(mapped), tick_folder)
            made = len([c for c in schema.names if c not in OWN_COLUMNS])
            done = rows.withColumns(
                {"column_num": F.lit(made), "zip_ver": F.coalesce(F.col("zip_ver"), F.lit(0)) + 1}
            )
            register(done, catalog_folder)
    return stores.read_or_empty(spark, catalog_folder, CATALOG)


def retract_files(
    spark: SparkSession,
    files: DataFrame,
    tick_folder: str,
    catalog_folder: str,
    session_folder: str | None = None,
    split_folder: str | None = None,
    forget: bool = False,
) -> DataFrame:
    """Delete the stored ticks of some files, their sessions and rows in the split catalog
    where folders for these are given, and their store path in the catalog, or with
    ``forget`` their rows there too; returns the catalog.

    The catalog goes last, so that a run that breaks is completed by another."""
    doomed = listed(files.select("path").distinct())
    if session_folder and split_folder:
        retract_splits(spark, doomed, None, session_folder, split_folder)
    stores.retract_ticks(spark, tick_folder, stores.tick_schema(spark, tick_folder), doomed)
    rows = _catalog_rows(spark, catalog_folder, doomed)
    if forget:
        register(rows.limit(0), catalog_folder, gone=doomed)
    else:
        if split_folder:
            rows = catalog.remove_tag(rows, "splited").withColumn("doc_num", F.lit(0))
        with scratch(catalog.mark_retracted(rows, doomed).select(*CATALOG.names)) as marked:
            register(marked, catalog_folder)
    return stores.read_or_empty(spark, catalog_folder, CATALOG)


def _split_rows(spark: SparkSession, split_folder: str, slices: DataFrame) -> DataFrame:
    splits = read_splits(spark, split_folder)
    return splits.join(slices, stores.FEATURE_KEYS, "left_semi").select(*STORED_SPLIT.names)


def _replace_splits(rows: DataFrame, split_folder: str) -> None:
    keys = stores.FEATURE_KEYS
    stores.replace_rows(rows.select(*STORED_SPLIT.names), split_folder, ["file_day"], keys, keys)


def save_feature(
    spark: SparkSession, rows: DataFrame, name: str, at: Column, feature_folder: str, split_folder: str
) -> DataFrame:
    """Store the rows of a feature by slice (``path``, ``day``, ``time_type``) and note its
    name, number and time in the slices' rows of the split catalog; returns these.

    A slice that is not in the catalog is an error before anything is stored. A feature
    that is saved again takes the place of its old rows and is not counted twice."""
    with scratch(rows) as new:
        slices = listed(new.select(*stores.FEATURE_KEYS).distinct())
        own = _split_rows(spark, split_folder, slices)
        stranger = slices.join(own, stores.FEATURE_KEYS, "left_anti").first()
        if stranger:
            raise LookupError(f"no such slice: {tuple(stranger)}")
        stores.write_feature(new, feature_folder, name)
        known = F.array_contains(F.coalesce("feature_files", F.array().cast("array<string>")), name)
        marked = catalog.register_feature(own, name, at, ~known).withColumn("feature_time", at)
        _replace_splits(marked, split_folder)
    return _split_rows(spark, split_folder, slices)


def reset_features(spark: SparkSession, slices: DataFrame, feature_folder: str, split_folder: str) -> DataFrame:
    """Delete the stored features of some slices and empty their lists in the split
    catalog; returns these rows. The catalog goes last. Features are as many as there
    are names, each with columns of its own."""
    doomed = listed(slices.select(*stores.FEATURE_KEYS).distinct())
    own = _split_rows(spark, split_folder, doomed)
    names = own.select(F.explode("feature_files").alias("name")).distinct().collect()
    for name in sorted(r["name"] for r in names):
        stores.retract_feature(spark, feature_folder, name, doomed)
    _replace_splits(catalog.reset_features(own), split_folder)
    return _split_rows(spark, split_folder, doomed)
