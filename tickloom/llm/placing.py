"""Running positions over groups of any size, and columns that cannot clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def packed(df: DataFrame, keep: list[str] | None = None) -> Column:
    """The kept columns (default: all) as one struct, so that working columns
    cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in (df.columns if keep is None else keep)])


def with_text(df: DataFrame, keep: list[str] | None, text: str, body: Column) -> tuple[list[Column], str]:
    """The kept columns as ``row`` and, unless they hold the text, ``body``; and where
    tasks find the text, so that none is sent twice."""
    names = df.columns if keep is None else keep
    if text in names and df.schema[text].dataType.typeName() == "string":
        return [packed(df, keep).alias("row")], f"row.{text}"
    return [packed(df, keep).alias("row"), body.alias("body")], "body"


def unpacked(df: DataFrame, row: str, outputs: list[str]) -> DataFrame:
    """The struct's columns and the outputs; an output replaces a column of its
    name."""
    taken = {c.lower() for c in outputs}
    kept = [f for f in df.schema[row].dataType.names if f.lower() not in taken]
    return df.select(*[F.col(f"`{row}`.`{f}`") for f in kept], *outputs)


def placed(df: DataFrame, group: str, cell: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over the rows of the group before each row, in
    the order of (cell, order).

    Rows are summed per cell, cells are added up per group, and rows only within
    their cell: no task holds a group, as long as ``cell`` cuts it finely."""
    sums = df.groupBy(group, cell).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(group, cell, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy(group, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(bases, [group, cell])
        .withColumn(name, F.col("_base") + F.coalesce(F.sum(value).over(within), F.lit(0)))
        .drop("_base")
    )
