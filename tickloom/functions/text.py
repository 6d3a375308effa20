"""Text forms of sizes, durations and catalog rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unit names.
SIZE_UNITS = "B KB MB GB TB PB EB ZB YB".split()
TIME_UNITS = "s ms us ns".split()


def _one_decimal(value: Column) -> Column:
    return F.bround(value, 1).cast("string")


def size_text(size: Column, batch: int = 1024) -> Column:
    """Size with its unit; a size below the batch keeps its whole number."""
    last = len(SIZE_UNITS) - 1
    text = F.concat(_one_decimal(size / F.lit(1024.0**last)), F.lit(SIZE_UNITS[last]))
    for power in range(last - 1, -1, -1):
        shown = _one_decimal(size / F.lit(1024.0**power) if power else size)
        fits = size <= F.lit(float(batch) * 1024.0**power)
        text = F.when(fits, F.concat(shown, F.lit(SIZE_UNITS[power]))).otherwise(text)
    return F.when(size.isNull() | (size == 0), F.lit("0")).otherwise(text)


def duration_text(seconds: Column) -> Column:
    """Duration in the first unit in which it exceeds one."""
    last = len(TIME_UNITS) - 1
    text = F.concat(_one_decimal(seconds * F.lit(1000**last)), F.lit(TIME_UNITS[last]))
    for power in range(last - 1, -1, -1):
        scaled = seconds * F.lit(1000**power) if power else seconds
        shown = F.concat(_one_decimal(scaled), F.lit(TIME_UNITS[power]))
        text = F.when(scaled > 1, shown).otherwise(text)
    return F.when(seconds.isNull() | (seconds == 0), F.lit("")).otherwise(text)


def tags_text(tags: Column) -> Column:
    """Tags as a list of quoted names."""
    quoted = F.transform(tags, lambda t: F.concat(F.lit("'"), t, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
