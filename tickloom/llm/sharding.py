"""Sharding by a minimax contiguous partition of ordered text groups."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.placing import packed, placed, unpacked
from tickloom.session import staged

ORDER_BITS = 16
CELLS = 4096
OUTPUTS = ["size", "text_crc32", "shard", "slot"]


def last_cuts(ends: list[int], shards: int, capacity: int) -> list[int] | None:
    """Cut positions of the greedy check: every shard takes groups while they
    fit. None if ``shards`` do not hold all groups. ``ends`` are running sizes."""
    cuts, filled = [], 0
    for _ in range(shards):
        cut = bisect_right(ends, filled + capacity)
        cuts.append(cut)
        filled = ends[cut - 1] if cut else 0
    return cuts if cuts[-1] == len(ends) else None


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """The smallest largest shard of any cut of the ordered groups."""
    ends = list(accumulate(sizes))
    if not ends:
        return 0
    low, high = max(max(sizes), -(-ends[-1] // shards)), ends[-1]
    while low < high:
        middle = (low + high) // 2
        if last_cuts(ends, shards, middle) is None:
            low = middle + 1
        else:
            high = middle
    return low


def even_cuts(sizes: list[int], shards: int) -> list[int]:
    """Where each shard but the first begins: no shard is above the smallest
    capacity, and within it every cut lies as near to the remaining average as the
    shards behind it can bear."""
    ends = list(accumulate(sizes))
    if not ends:
        return [0] * (shards - 1)
    capacity = smallest_capacity(sizes, shards)
    earliest, left = [], ends[-1]
    for _ in range(shards - 1):
        first = bisect_left([0, *ends], left - capacity)
        earliest.append(first)
        left = ends[first - 1] if first else 0
    cuts, start = [], 0
    for behind, first in zip(range(shards - 1, 0, -1), reversed(earliest), strict=True):
        filled = ends[start - 1] if start else 0
        aim = filled + (ends[-1] - filled) / (behind + 1)
        cut = bisect_left(ends, aim) + 1
        if cut >= 2 and aim - ends[cut - 2] <= ends[min(cut, len(ends)) - 1] - aim:
            cut -= 1
        start = max(first, start, min(cut, bisect_right(ends, filled + capacity)))
        cuts.append(start)
    return cuts


def shard(
    docs: DataFrame,
    shards: int = 40,
    text: str = "text",
    overhead: int = 16,
    keep: list[str] | None = None,
    tie: str = "doc_id",
) -> DataFrame:
    """Shard and slot of every row, sizes in bytes near equal, equal texts together.

    Texts are ordered by a hash. Its first 16 bits make the atomic groups, so equal
    texts are never parted and the ordered list of group sizes has at most 65,536
    entries whatever the input; only that list reaches the driver, where the
    smallest capacity is searched and the cuts are made. Rows then find their shard
    by comparing with the cuts, and their slot by counting within cells.

    A row is ``overhead`` plus the UTF-8 bytes of its text; a null text has no
    bytes and a null ``text_crc32``, and is a group of its own. Empty texts are
    texts. An empty table gives no rows; with fewer groups than shards some shards
    stay empty. Slots follow ``tie`` within cells; rows alike in all of it are
    interchangeable. ``keep`` names the columns returned besides the outputs
    (default: all); an input column named like an output is replaced."""
    body = F.col(f"`{text}`")
    hashed = F.xxhash64(body.isNull(), body)
    rows = staged(
        docs.select(
            packed(docs, keep).alias("row"),
            (F.coalesce(F.octet_length(body), F.lit(0)) + overhead).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.shiftrightunsigned(hashed, 64 - ORDER_BITS).cast("int").alias("position"),
            F.col(f"`{tie}`").alias("tie"),
        )
    )
    sums = rows.groupBy("position").agg(F.sum("size")).orderBy("position").collect()
    starts = even_cuts([r[1] for r in sums], shards)
    positions = [r[0] for r in sums] + [1 << ORDER_BITS]
    found = rows.withColumn("shard", _shard_of(F.col("position"), [positions[i] for i in starts]))
    cell = F.pmod(F.xxhash64("tie", "text_crc32", "size"), F.lit(CELLS)).cast("int")
    slotted = placed(
        found.withColumn("cell", cell), "shard", "cell", ["tie", "text_crc32", "size"], F.lit(1).cast("long"), "slot"
    )
    return unpacked(slotted, "row", OUTPUTS)


def _shard_of(position: Column, starts: list[int]) -> Column:
    """Number of cuts at or below a position."""
    if not starts:
        return F.lit(0)
    cuts = F.array(*[F.lit(s) for s in starts])
    return F.size(F.filter(cuts, lambda c: c <= position))
