"""Raw tick files: listing, scanning and their path columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tickloom.functions import ids
from tickloom.operators.quality import FAILED
from tickloom.schema import RAW_TICK, RAW_TICK_LEGACY

GLOB = "*/*/*/*/*/*/*.spt"
_BAD = "_bad"

# Columns the older import keeps, to which it adds subID.
LEGACY_KEPT = """
InstrumentID MarketID LastPrice LastVolume hhmmss UpdateTime
AskPrice1 AskVolume1 BidPrice1 BidVolume1 OpenInterest Turnover AvePrice
HighestPrice LowestPrice OpenPrice
""".split()


def months_glob(first: str, last: str) -> str:
    """Pattern of the files of the months (yyyymm) from ``first`` to ``last``. A listing by
    it does not look into the folders of any other month, so a regular import need not
    list the archive."""
    start, end = (int(m[:4]) * 12 + int(m[4:]) - 1 for m in (first, last))
    if start > end:
        raise ValueError(f"{first} is after {last}")
    months = ",".join(f"{m // 12:04d}{m % 12 + 1:02d}" for m in range(start, end + 1))
    return f"*/*/*/*/*/{{{months}}}/*.spt"


def relative_path(uri: Column) -> Column:
    """The last seven segments of a file address."""
    return F.array_join(F.slice(F.split(uri, "/"), -7, 7), "/")


def list_files(spark: SparkSession, root: str, pattern: str = GLOB) -> DataFrame:
    """Files under ``root`` with their path columns, size and address (``uri``)."""
    files = spark.read.format("binaryFile").load(f"{root}/{pattern}")
    listed = files.select(
        relative_path(F.col("path")).alias("path"), F.col("length").alias("size"), F.col("path").alias("uri")
    )
    return ids.with_path_parts(listed)


def raw_schema(layout: T.StructType) -> T.StructType:
    return T.StructType([*layout.fields, T.StructField(_BAD, T.StringType())])


def csv_options() -> dict[str, str]:
    """Read every line whole, so that lines of the wrong width are noticed even
    where few columns are used."""
    return {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _BAD,
        "columnPruning": "false",
        "enforceSchema": "true",
    }


def with_origin(lines: DataFrame) -> DataFrame:
    """Add the file a line came from and where its block starts."""
    return lines.select(
        "*",
        relative_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def shaped(lines: DataFrame, layout: T.StructType, bad_rows: str = "skip") -> DataFrame:
    """Typed ticks with their position in the file.

    A position is the start of the file's block plus the row number of the task,
    which grows along the file: a task reads no more rows than a block has bytes.
    Short lines keep what they have. Long lines are dropped, or fail their file
    with ``bad_rows="fail_file"``; so do times that do not parse, which otherwise
    become null."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return typed(lines, layout, bad_rows).withColumn("seq", F.col("_block") + row).select(
        *layout.names, "path", "seq", FAILED
    )


def typed(lines: DataFrame, layout: T.StructType, bad_rows: str = "skip") -> DataFrame:
    """Ticks of lines with all that ``with_origin`` adds, without positions."""
    if bad_rows not in ("skip", "fail_file"):
        raise ValueError(f"unknown bad_rows: {bad_rows}")
    # The reader wants a data column used beside the bad line: the first stands in.
    line = F.coalesce(_BAD, layout.names[0])
    fields = F.length(line) - F.length(F.replace(line, F.lit(","), F.lit(""))) + 1
    too_long = F.coalesce(fields > len(layout), F.lit(False))
    t = F.col("UpdateTime").try_cast("timestamp_ntz")
    if bad_rows == "skip":
        lines = lines.filter(~too_long)
        failed = F.lit(False)
    else:
        failed = too_long | (t.isNull() & F.col("UpdateTime").isNotNull())
    return lines.withColumn(FAILED, failed).withColumn("UpdateTime", t)


def scan(
    spark: SparkSession,
    root: str,
    pattern: str = GLOB,
    bad_rows: str = "skip",
    layout: T.StructType = RAW_TICK,
) -> DataFrame:
    """Raw ticks of all matching files."""
    return scan_files(spark, [f"{root}/{pattern}"], bad_rows, layout)


def scan_files(
    spark: SparkSession, files: list[str], bad_rows: str = "skip", layout: T.StructType = RAW_TICK
) -> DataFrame:
    """Raw ticks of the named files and of no others."""
    lines = spark.read.schema(raw_schema(layout)).options(**csv_options()).csv(files)
    return shaped(with_origin(lines), layout, bad_rows)


def scan_legacy(spark: SparkSession, root: str, pattern: str = GLOB, bad_rows: str = "skip") -> DataFrame:
    """Ticks of the older 41-column files, with the columns its import keeps."""
    ticks = scan(spark, root, pattern, bad_rows, RAW_TICK_LEGACY)
    return ticks.select(
        *LEGACY_KEPT, ids.sub_id(F.col("InstrumentID")).alias("subID"), "path", "seq", FAILED
    )


def with_file_columns(ticks: DataFrame) -> DataFrame:
    """Market, product, month and day of the file a tick came from. What the row
    itself says of its market and contract may differ and is left as it is."""
    parts = F.split(F.col("path"), "/")
    return ticks.withColumns(
        {
            "market": F.element_at(parts, -6).try_cast("int"),
            "category": F.element_at(parts, -5),
            "month": F.element_at(parts, -2),
            "day": F.split_part(F.element_at(parts, -1), F.lit("."), F.lit(1)),
        }
    )
