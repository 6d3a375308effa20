"""Row filters: washing, file kinds, tags, keyword filters, sessions."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql import types as T

from tickloom.functions import ids, times
from tickloom.schema import DOMINANT_KIND, INDEX_KIND, MAX_DATE, MIN_DATE


def in_dates(t: Column, low: str = MIN_DATE, high: str = MAX_DATE) -> Column:
    """Strictly between two dates; false for a missing time."""
    lo, hi = F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz")
    return F.coalesce((t > lo) & (t < hi), F.lit(False))


def has_volume(volume: Column) -> Column:
    return F.coalesce(volume >= 0, F.lit(False))


def wash(ticks: DataFrame, low: str = MIN_DATE, high: str = MAX_DATE) -> DataFrame:
    """Drop ticks outside the dates or without a volume of at least zero."""
    lo, hi = F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz")
    t = F.col("UpdateTime")
    return ticks.filter((t > lo) & (t < hi) & (F.col("LastVolume") >= 0))


def of_kind(
    df: DataFrame,
    skip_kinds: tuple[str, ...] = (INDEX_KIND, DOMINANT_KIND),
    markets: list[int] | None = None,
    skip_markets: list[int] | None = None,
) -> DataFrame:
    """Keep files or ticks by series kind and market."""
    kept = df
    if skip_kinds:
        kept = kept.filter(~ids.kind(ids.sub_id(F.col("InstrumentID"))).isin(*skip_kinds))
    if markets is not None:
        kept = kept.filter(F.col("MarketID").isin(*markets))
    if skip_markets:
        kept = kept.filter(~F.col("MarketID").isin(*skip_markets))
    return kept


def without_tags(tags: str, unwanted: list[str]) -> Column:
    """None of the tags present; true for a row that has no tag list."""
    found = F.arrays_overlap(F.col(tags), F.array(*[F.lit(t) for t in unwanted]))
    return ~F.coalesce(found, F.lit(False))


def _any_of(column: Column, is_list: bool, values: list) -> Column:
    """Null, which a filter takes for false, where the value is missing."""
    named = [v for v in values if v is not None]
    hit = F.lit(False)
    if named and is_list:
        hit = F.arrays_overlap(column, F.array(*[F.lit(v) for v in named]))
    elif named:
        hit = column.isin(*named)
    return hit | column.isNull() if len(named) < len(values) else hit


def _equals(column: Column, field_type: T.DataType, value: Any) -> Column:
    if value is None:
        return column.isNull()
    if isinstance(value, (list, tuple)):
        wanted = F.array(*[F.lit(v) for v in value]).cast(field_type)
        return column.eqNullSafe(wanted)
    if isinstance(field_type, T.ArrayType):
        return F.coalesce(F.array_contains(column, value), F.lit(False))
    return column.eqNullSafe(F.lit(value))


def keyword_condition(df: DataFrame, **wanted: Any) -> Column:
    """A condition from ``field``, ``field__in``, ``field__nin``, ``field__ne``
    and ``field__exists`` keywords. A missing value equals None, is different
    from any value and is in no list without None; a scalar matches a list field
    that contains it."""
    condition = F.lit(True)
    for word, value in wanted.items():
        field, _, op = word.rpartition("__")
        if op not in ("in", "nin", "ne", "exists"):
            field, op = word, "eq"
        column, field_type = F.col(field), df.select(field).schema[0].dataType
        is_list = isinstance(field_type, T.ArrayType)
        if op == "eq":
            rule = _equals(column, field_type, value)
        elif op == "ne":
            rule = ~_equals(column, field_type, value)
        elif op == "exists":
            rule = column.isNotNull() if value else column.isNull()
        else:
            rule = _any_of(column, is_list, list(value))
            rule = ~F.coalesce(rule, F.lit(False)) if op == "nin" else rule
        condition = condition & rule
    return condition


def filter_by(df: DataFrame, **wanted: Any) -> DataFrame:
    return df.filter(keyword_condition(df, **wanted))


def first_match(df: DataFrame, order: list[str], **wanted: Any) -> Row | None:
    """The first row, in the given order, that matches the keywords."""
    return filter_by(df, **wanted).orderBy(*order).limit(1).first()


def in_tradable_time(ticks: DataFrame, time: str = "UpdateTime") -> DataFrame:
    return ticks.filter(times.tradable(F.col(time)))


def in_session(ticks: DataFrame, choice: str) -> DataFrame:
    """``am_pm`` keeps the three day sessions, ``night`` the night."""
    if choice not in ("am_pm", "night"):
        raise ValueError(f"unknown session choice: {choice}")
    wanted = times.DAY_SESSIONS if choice == "am_pm" else ("night",)
    return ticks.filter(F.col("time_type").isin(*wanted))
