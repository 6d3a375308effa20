"""Running values and row numbers over ordered groups of any size.

A window over a group runs in one task. Groups up to ``MAX_GROUP_ROWS`` take
that way. Once any group is larger, groups are cut into pieces along their
order: by day, hour or minute where the order starts with a time and such pieces
are small enough, else by range partitioning, which splits anything. Each piece
is scanned on its own and what the earlier pieces of the group amount to, one
small row per group and piece, is joined in.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions import times
from tickloom.session import listed, staged

MAX_GROUP_ROWS = 5_000_000
PIECE_ROWS = 250_000
# A piece may hold so many times the rows aimed at.
MAX_SPREAD = 20


def group_extent(df: DataFrame, keys: list[str]) -> int:
    """Rows of the largest group."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def order_key(order: list[str], value: Column | None = None) -> Column:
    """Order of a row for ``min_by``/``max_by``; null where ``value`` is null, so
    that such rows are skipped."""
    key = F.struct(*order)
    return key if value is None else F.when(value.isNotNull(), key)


_RUNNING = {
    "max": F.max,
    "min": F.min,
    "sum": F.sum,
    "last": lambda c: F.last(c, ignorenulls=True),
    "first": lambda c: F.first(c, ignorenulls=True),
}

_JOINED = {
    "max": F.greatest,
    "min": F.least,
    "sum": lambda before, here: F.when(before.isNull(), here).otherwise(
        before + F.coalesce(here, F.lit(0))
    ),
    "last": lambda before, here: F.coalesce(here, before),
    "first": lambda before, here: F.coalesce(before, here),
}


def _total(kind: str, value: Column, order: list[str]) -> Column:
    if kind == "last":
        return F.max_by(value, order_key(order, value))
    if kind == "first":
        return F.min_by(value, order_key(order, value))
    return _RUNNING[kind](value)


def _cut(df: DataFrame, keys: list[str], order: list[str], max_rows: int) -> DataFrame:
    """Number the pieces of every group in ``_piece``, growing along the order.

    Pieces of time follow from the row alone. Range bounds come from a sample,
    so the rows are written down with the piece they fell into."""
    if df.schema[order[0]].dataType.typeName() in ("timestamp", "timestamp_ntz"):
        for width in (times.DAY, times.HOUR, times.MINUTE):
            pieces = df.withColumn("_piece", times.bin_start(times.micros(F.col(order[0])), width))
            if group_extent(pieces, [*keys, "_piece"]) <= max_rows:
                return pieces
    ranged = df.repartitionByRange(*keys, *order)
    return staged(ranged.withColumn("_piece", F.spark_partition_id()))


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, tuple[str, Column]],
    max_group_rows: int = MAX_GROUP_ROWS,
    extent: int | None = None,
) -> DataFrame:
    """Add a value over all rows of the group up to the current one.

    ``values`` maps a new column to ``(kind, expression)`` with kind ``max``,
    ``min``, ``sum``, ``last`` or ``first``; nulls are skipped. ``order`` must be
    a total order within a group. ``extent`` gives the rows of the largest group
    where they are known already.
    """
    if (group_extent(df, keys) if extent is None else extent) <= max_group_rows:
        upto = (
            Window.partitionBy(*keys)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return df.withColumns({n: _RUNNING[k](v).over(upto) for n, (k, v) in values.items()})

    inputs = df.withColumns({f"_in_{n}": v for n, (_, v) in values.items()})
    pieces = _cut(inputs, keys, order, max_group_rows)
    upto = (
        Window.partitionBy("_piece", *keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = pieces.withColumns(
        {f"_here_{n}": _RUNNING[k](F.col(f"_in_{n}")).over(upto) for n, (k, _) in values.items()}
    )
    totals = pieces.groupBy("_piece", *keys).agg(
        *[_total(k, F.col(f"_in_{n}"), order).alias(f"_sum_{n}") for n, (k, _) in values.items()]
    )
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        F.col("_piece").alias("_p"),
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[_RUNNING[k](F.col(f"_sum_{n}")).over(earlier).alias(f"_before_{n}") for n, (k, _) in values.items()],
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys],
        F.col("_piece").eqNullSafe(F.col("_p")),
    )
    return local.join(before, same, "left").select(
        *df.columns,
        *[
            _JOINED[k](F.col(f"_before_{n}"), F.col(f"_here_{n}")).alias(n)
            for n, (k, _) in values.items()
        ],
    )


@dataclass(frozen=True)
class Pieces:
    """Rows cut along their order into numbered pieces (``_piece``), with the rows of each
    (``_n``) and of all before it (``_offset``)."""

    rows: DataFrame
    order: list[str]
    sizes: DataFrame
    total: int

    def numbered(self, name: str = "idx", where: Column | None = None) -> DataFrame:
        """Add the position of a row, from 0. ``where`` tells by ``_offset`` and ``_n``
        which pieces are wanted; no others are ordered."""
        wanted = self.sizes if where is None else self.sizes.filter(where)
        within = Window.partitionBy("_piece").orderBy(*self.order)
        position = F.col("_offset") + F.row_number().over(within) - 1
        columns = [c for c in self.rows.columns if c != "_piece"]
        return self.rows.join(wanted.select("_piece", "_offset"), "_piece").select(*columns, position.alias(name))


def _number(df: DataFrame, column: str) -> Column | None:
    """A time or whole number as a number in the same order."""
    kind = df.schema[column].dataType.typeName()
    if kind == "timestamp_ntz":
        return times.micros(F.col(column))
    return F.col(column).cast("long") if kind in ("byte", "short", "integer", "long") else None


def pieces(df: DataFrame, order: list[str], max_rows: int = PIECE_ROWS) -> Pieces:
    """Cut ``df`` along the total order ``order`` into pieces of at most about
    ``max_rows``.

    The first column of the order, a time or whole number, is cut into equal stretches,
    as many as the rows ask for, and a count tells how many rows each has. The pieces
    follow from the rows alone, so nothing is written but the counts. Where stretches
    are too uneven, and for other types, a range partitioning cuts the rows; its bounds
    come from a sample, so the rows are then written down once."""
    value = _number(df, order[0])
    if value is None:
        return _ranged(df, order)
    low, high, total = df.agg(F.min(value), F.max(value), F.count(F.lit(1))).first()
    if not total or low is None:
        return _sized(df.withColumn("_piece", F.lit(0).cast("long")), order)
    # Nulls come first and make a piece of their own.
    if high - low >= 1 << 62:
        return _ranged(df, order)
    width = max(1, -(-(high - low + 1) // -(-total // max_rows)))
    piece = F.coalesce(F.call_function("div", value - F.lit(low), F.lit(width)), F.lit(-1)).cast("long")
    found = _sized(df.withColumn("_piece", piece), order)
    most = found.sizes.agg(F.max("_n")).first()[0]
    return found if most <= MAX_SPREAD * max_rows else _ranged(df, order)


def _sized(rows: DataFrame, order: list[str]) -> Pieces:
    counts = staged(rows.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n")))
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = listed(counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    return Pieces(rows, order, sizes, sizes.agg(F.sum("_n")).first()[0] or 0)


def _ranged(df: DataFrame, order: list[str]) -> Pieces:
    rows = df.repartitionByRange(*order).withColumn("_piece", F.spark_partition_id().cast("long"))
    return _sized(staged(rows), order)


def with_index(df: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """Add the position of a row, from 0, in the total order ``order``."""
    return pieces(df, order).numbered(name)
