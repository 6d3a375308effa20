"""Grouped count tables: computing, refreshing and upserting them."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators.filters import filter_by, keyword_condition
from tickloom.operators.sampling import random_rows

SRC = ["source", "subsource"]
CAT = ["category", "subcategory", "input_tag"]
SRC_CAT = SRC + CAT


def doc_statics(
    df: DataFrame,
    fields: dict[str, str | None],
    where: dict | None = None,
    unwind: list[str] | None = None,
    sum_field: str | None = None,
    preserve_null: bool = True,
    sample_size: int = 0,
    sort: bool = True,
    seed: int = 0,
) -> DataFrame:
    """Count, or sum of a field, per combination of fields.

    ``fields`` maps a field to its name in the result; without one, dots of a
    nested field become ``__``. List fields named in ``unwind`` count once per
    element, and rows without elements count too while ``preserve_null``.
    Groups whose first field is empty, zero or missing are left out."""
    rows = filter_by(df, **(where or {}))
    if sample_size:
        rows = random_rows(rows, sample_size, seed)
    names = {field: name or field.replace(".", "__") for field, name in fields.items()}
    rows = rows.select(
        *[F.col(field).alias(name) for field, name in names.items()],
        *([F.col(sum_field).alias("_summed")] if sum_field else []),
    )
    for field in unwind or []:
        if field not in names:
            raise ValueError(f"{field} is unwound but not counted")
        split = F.explode_outer if preserve_null else F.explode
        rows = rows.withColumn(names[field], split(names[field]))
    total = F.coalesce(F.sum("_summed"), F.lit(0)) if sum_field else F.count(F.lit(1))
    counted = rows.groupBy(*names.values()).agg(total.alias("count"))
    first = next(iter(names.values()))
    kept = counted.filter(_truthy(counted, first))
    return kept.orderBy(F.desc("count"), *names.values()) if sort else kept


def _truthy(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.typeName()
    c = F.col(name)
    empty = {"string": c == "", "boolean": ~c, "array": F.size(c) == 0}.get(kind)
    if empty is None:
        numeric = kind in ("byte", "short", "integer", "long", "float", "double", "decimal")
        empty = c == 0 if numeric else F.lit(False)
    return c.isNotNull() & ~empty


def group_counts(df: DataFrame, keys: list[str], **wanted) -> DataFrame:
    """Rows per combination of keys, most frequent first; keywords left at None
    do not restrict."""
    asked = {k: v for k, v in wanted.items() if v}
    counts = filter_by(df, **asked).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), *keys)


def notes_count(df: DataFrame, notes: list[str] | None = None) -> DataFrame:
    """Rows per note. By default every row with notes takes part, otherwise the
    rows that carry one of the given notes, with all notes they carry."""
    if notes:
        rows = filter_by(df, notes_key__in=notes)
    else:
        rows = df.filter(F.col("notes_key").isNotNull() & (F.size("notes_key") > 0))
    return doc_statics(rows, {"notes_key": "note"}, unwind=["notes_key"], preserve_null=False)


def refreshed_notes(old: DataFrame, df: DataFrame, notes: list[str] | None = None) -> DataFrame:
    """Note counts computed anew, of all notes or of the given ones."""
    new = notes_count(df, notes)
    if not notes:
        return new
    return old.filter(~F.col("note").isin(*notes)).unionByName(new.filter(F.col("note").isin(*notes)))


def name_counts(df: DataFrame, kind: str) -> DataFrame:
    """Rows per source or category that has a name."""
    if kind not in ("source", "category"):
        raise ValueError(f"unknown kind: {kind}")
    named = df.filter(F.col(kind).isNotNull() & (F.col(kind) != ""))
    return named.groupBy(F.col(kind).alias("name")).agg(F.count(F.lit(1)).alias("count"))


def dataset_counts(
    datasets: DataFrame, rows: DataFrame, key: str = "dataset", only: Any = None
) -> DataFrame:
    """Every dataset with its number of rows, zero where it has none; with
    ``only`` the others keep the count they have."""
    chosen = F.lit(True) if only is None else F.col(key) == only
    counts = rows.filter(chosen).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    new = F.coalesce("_n", F.lit(0).cast("long"))
    kept = F.col("count") if "count" in datasets.columns else F.lit(None).cast("long")
    joined = datasets.join(counts, key, "left")
    return joined.withColumn("count", F.when(chosen, new).otherwise(kept)).drop("_n")


def refreshed(old: DataFrame, new: DataFrame, **scope) -> DataFrame:
    """Replace the rows that match the scope by new ones; with no scope all."""
    asked = {k: v for k, v in scope.items() if v}
    kept = old.filter(~keyword_condition(old, **asked))
    return kept.unionByName(new)


def upserted(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows of both tables by key, taking the new values where there are any."""
    left = old.select(*keys, *[F.col(v).alias(f"_old_{v}") for v in values], F.lit(True).alias("_o"))
    right = new.select(*keys, *[F.col(v).alias(f"_new_{v}") for v in values], F.lit(True).alias("_n"))
    joined = left.join(right, keys, "full")
    return joined.select(
        *keys,
        *[F.when(F.col("_n"), F.col(f"_new_{v}")).otherwise(F.col(f"_old_{v}")).alias(v) for v in values],
    )


def count_upsert(table: DataFrame, rows: DataFrame, kind: str, value: str) -> DataFrame:
    """Set the count of one source or category, adding it if it is new."""
    if kind not in ("source", "category") or not value:
        raise ValueError(f"cannot update {kind!r} with {value!r}")
    count = filter_by(rows, **{kind: value}).agg(F.count(F.lit(1)).alias("count"))
    others = table.filter(~F.col("name").eqNullSafe(F.lit(value)))
    return others.unionByName(count.withColumn("name", F.lit(value)))


def replace_by_key(old: DataFrame, new: DataFrame, scope: DataFrame) -> DataFrame:
    """Drop the old rows of every key in scope, also of keys with no new rows,
    and add the new ones."""
    keys = scope.columns
    return old.join(scope.distinct(), keys, "left_anti").unionByName(new)


def with_made_up_rows(tables: dict[str, DataFrame], count: int = 100, **values) -> dict[str, DataFrame]:
    """Add one row of the given values to each of the three count tables."""
    wanted = {"src_stat": SRC, "cat_stat": CAT, "src_cat_stat": SRC_CAT}
    grown = dict(tables)
    for name, keys in wanted.items():
        row = {k: values.get(k) for k in keys} | {"count": count}
        spark = tables[name].sparkSession
        schema = ", ".join(f"{k} string" for k in keys) + ", count bigint"
        grown[name] = tables[name].unionByName(spark.createDataFrame([row], schema))
    return grown


def update_related(
    tables: dict[str, DataFrame],
    rows: DataFrame,
    regen: bool = False,
    source: str | None = None,
    subsource: str | None = None,
    category: str | None = None,
    subcategory: str | None = None,
    input_tag: str | None = None,
) -> dict[str, DataFrame]:
    """Refresh the count tables the given values touch; with ``regen`` all five,
    scoped to the values where there are any."""
    src = {"source": source, "subsource": subsource}
    cat = {"category": category, "subcategory": subcategory, "input_tag": input_tag}
    out = dict(tables)
    if regen:
        out["source"] = name_counts(rows, "source")
        out["category"] = name_counts(rows, "category")
    else:
        if source:
            out["source"] = count_upsert(out["source"], rows, "source", source)
        if category:
            out["category"] = count_upsert(out["category"], rows, "category", category)

    def refresh(name: str, keys: list[str], scope: dict) -> None:
        out[name] = refreshed(out[name], group_counts(rows, keys, **scope), **scope)

    if regen or any(src.values()):
        refresh("src_stat", SRC, src)
    if regen or any(cat.values()):
        refresh("cat_stat", CAT, cat)
    if regen or any(src.values()) or any(cat.values()):
        refresh("src_cat_stat", SRC_CAT, src | cat)
    return out


def distinct_values(df: DataFrame, column: str, **wanted) -> DataFrame:
    return filter_by(df, **wanted).select(column).distinct()


def unwound(df: DataFrame, column: str, preserve_null: bool = True) -> DataFrame:
    split = F.explode_outer if preserve_null else F.explode
    return df.withColumn(column, split(column))


def symmetric_difference(left: Column, right: Column) -> Column:
    """Values in exactly one of two arrays."""
    return F.array_union(F.array_except(left, right), F.array_except(right, left))


def concat(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
