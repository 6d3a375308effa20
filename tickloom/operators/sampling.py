"""Pages, samples and chunks of ordered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.operators.ordered import pieces

# Rows a task may hold to pick from, and parts in which tasks meet.
HELD = 100_000
PARTS = 32


def page(df: DataFrame, order: list[str], number: int, pages: int | None = None, size: int | None = None) -> DataFrame:
    """One page, counted from 0. Counts along the order tell where a page lies; only the
    pieces it touches are ordered, so the last is as cheap as the first."""
    cut = pieces(df, order)
    if size is None:
        size = cut.total // (pages or 1) + 1
    first, end = number * size, (number + 1) * size
    touched = (F.col("_offset") < end) & (F.col("_offset") + F.col("_n") > first)
    idx = F.col("idx")
    return cut.numbered(where=touched).filter((idx >= first) & (idx < end)).drop("idx")


def lowest(df: DataFrame, n: int, draw: list[str], by: list[str] = ()) -> DataFrame:
    """The ``n`` rows of each group that come first by ``draw``.

    One scan: a task passes on ``n`` rows of a group at most, and tasks meet in
    ``PARTS`` parts before the parts meet, so a hot group is not one task's."""
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
    near = Window.partitionBy(*by, "_part").orderBy(*draw)
    some = df.withColumn("_part", part).withColumn("_n", F.row_number().over(near)).filter(F.col("_n") <= n)
    some = some.drop("_part", "_n")
    if not by:
        return some.orderBy(*draw).limit(n)
    last = Window.partitionBy(*by).orderBy(*draw)
    return some.withColumn("_n", F.row_number().over(last)).filter(F.col("_n") <= n).drop("_n")


def random_rows(df: DataFrame, n: int, seed: int = 0, key: list[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows at random, or all if there are fewer; the same rows however
    the table is partitioned.

    A row draws the checksum of the seed and its ``key`` (default: all columns), and
    the lowest ``n`` draws win; rows alike in their key are interchangeable. Up to
    ``HELD`` rows are found in one scan. For more, draws are counted by their first
    digits, which tells where the ``n``-th falls; only the rows that begin like it have
    to be ordered."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in key or df.columns]
    drawn = df.withColumn("_draw", F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)))
    if n <= HELD:
        return lowest(drawn, n, ["_draw"]).drop("_draw")
    head = F.substring("_draw", 1, 4)
    below = 0
    for start, rows in drawn.groupBy(head.alias("head")).count().orderBy("head").collect():
        if below + rows >= n:
            first = drawn.filter(head < start)
            last = drawn.filter(head == start).orderBy("_draw").limit(n - below)
            return first.unionByName(last).drop("_draw")
        below += rows
    return df


def systematic_sample(df: DataFrame, order: list[str], size: int, omit: bool = False) -> DataFrame:
    """Rows at a fixed step; ``omit`` takes as many as are left over by ``size``. Pieces
    of the order without any of them are not ordered."""
    cut = pieces(df, order)
    size = cut.total - size if omit else size
    if size <= 0:
        return df.limit(0)
    step = (cut.total + 1) / size
    if step <= 1:
        return df
    idx, width, offset = F.col("idx"), F.lit(step), F.col("_offset")
    touched = F.floor(F.ceil(offset / width) * width) <= offset + F.col("_n")
    rows = cut.numbered(where=touched)
    return rows.filter(F.floor(F.ceil(idx / width) * width) == idx).drop("idx")


def strided_chunks(df: DataFrame, order: list[str], pages: int) -> DataFrame:
    """Deal rows to ``pages`` chunks in turn: ``chunk_id`` and position."""
    cut = pieces(df, order)
    count = max(1, min(pages or 1, cut.total))
    return cut.numbered().withColumn("chunk_id", F.pmod(F.col("idx"), F.lit(count)))


def strided_chunks_by_size(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """Deal rows to as many chunks as full groups of ``size`` there are."""
    if not size:
        raise ValueError("size must not be zero")
    cut = pieces(df, order)
    count = max(1, cut.total // max(1, min(size, cut.total)))
    return cut.numbered().withColumn("chunk_id", F.pmod(F.col("idx"), F.lit(count)))
