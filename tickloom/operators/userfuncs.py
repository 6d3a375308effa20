"""User functions over files, rows and groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import StructType


Frame = pd.DataFrame
HELD_ROWS = 100_000


def page_number() -> int:
    """Within a user function, the number of the task it runs in."""
    return TaskContext.get().partitionId()


def _same_rows(func: Callable[[Frame], Frame]) -> Callable[[Frame], Frame]:
    def run(frame: Frame) -> Frame:
        out = func(frame)
        if len(out) != len(frame):
            raise ValueError(f"row count changed from {len(frame)} to {len(out)}")
        return out

    return run


def whole(func: Callable[[Frame], Frame]) -> Callable[[Iterator[Frame]], Iterator[Frame]]:
    """A function of all rows of a group at once as one of its batches."""

    def run(frames: Iterator[Frame]) -> Iterator[Frame]:
        yield func(pd.concat(frames, ignore_index=True))

    return run


def map_batches(df: DataFrame, func: Callable[[Frame], Frame], schema: StructType | str) -> DataFrame:
    """Run a function of single rows over Arrow batches; it keeps the row count."""
    checked = _same_rows(func)

    def run(frames: Iterator[Frame]) -> Iterator[Frame]:
        for frame in frames:
            yield checked(frame)

    return df.mapInPandas(run, schema)


def map_files(
    df: DataFrame,
    func: Callable[[Iterator[Frame]], Iterator[Frame]],
    schema: StructType | str,
    keys: list[str] = ["path"],
) -> DataFrame:
    """Run a function over the batches of each file; it keeps the row count. A file
    of any size passes through batch by batch; ``whole`` makes such a function of one
    that needs all rows at once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = made = 0

        def counted() -> Iterator[Frame]:
            nonlocal seen
            for frame in frames:
                seen += len(frame)
                yield frame

        for out in func(counted()):
            made += len(out)
            yield out
        if made != seen:
            raise ValueError(f"row count changed from {seen} to {made}")

    return df.groupBy(*keys).applyInPandas(run, schema)


def map_rows(
    df: DataFrame,
    func: Callable[[Frame], Frame],
    schema: StructType | str,
    where: Column | None = None,
    init_task: Callable[[], None] | None = None,
    after_batch: Callable[[], None] | None = None,
) -> DataFrame:
    """Run a function over batches of the rows that pass ``where``, with one call
    before a task's first batch and one after each batch."""

    def run(frames: Iterator[Frame]) -> Iterator[Frame]:
        if init_task is not None:
            init_task()
        for frame in frames:
            yield func(frame)
            if after_batch is not None:
                after_batch()

    return (df if where is None else df.filter(where)).mapInPandas(run, schema)


def each_row(
    df: DataFrame,
    func: Callable[[Frame], None],
    where: Column | None = None,
    init: Callable[[], None] | None = None,
    init_task: Callable[[], None] | None = None,
    after_batch: Callable[[], None] | None = None,
) -> int:
    """Run a function for its side effects, after one call on the driver; returns
    the rows it has seen. A task that is repeated repeats its side effects."""
    if init is not None:
        init()

    def seen(frame: Frame) -> Frame:
        func(frame)
        return pd.DataFrame({"n": [len(frame)]})

    counts = map_rows(df, seen, "n bigint", where, init_task, after_batch)
    return counts.agg({"n": "sum"}).first()[0] or 0


def map_groups(
    df: DataFrame,
    keys: list[str],
    func: Callable[[Iterator[Frame]], Iterator[Frame]],
    schema: StructType | str,
) -> DataFrame:
    """Run a function over the batches of each group, of any size."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from func(frames)

    return df.groupBy(*keys).applyInPandas(run, schema)


def fold_groups(
    df: DataFrame,
    keys: list[str],
    partial: Callable[[Frame], Frame],
    merge: Callable[[Frame], Frame],
    schema: StructType | str,
) -> DataFrame:
    """Run a function over groups of any size. ``partial`` shrinks a batch to a
    row per group, ``merge`` shrinks such rows to a row per group; it is applied
    within each task before the shuffle and once more after it. A task passes on
    what it holds whenever that grows beyond ``HELD_ROWS`` groups."""

    def shrink(frames: Iterator[Frame]) -> Iterator[Frame]:
        held: Frame | None = None
        for frame in frames:
            rows = partial(frame)
            held = rows if held is None else merge(pd.concat([held, rows], ignore_index=True))
            if len(held) > HELD_ROWS:
                yield held
                held = None
        if held is not None:
            yield held

    shrunk = df.mapInPandas(shrink, schema)
    return shrunk.groupBy(*keys).applyInPandas(merge, schema)
