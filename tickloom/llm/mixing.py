"""Mixing sources to target weights along a low-discrepancy schedule."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.placing import packed, placed
from tickloom.session import staged

WEIGHTS = (5, 2, 1)
WORD = "[^\\x20\\x09-\\x0D]+"
MAX_REPEATS = 3
BLOCK_WORDS = 2048
CELLS = 4096
SLOT_CELL = 1 << 16
GOLDEN = 0.6180339887498949
WIDE_STEP = 1 << 20


def targets(sizes: list[int], weights: list[int]) -> list[float]:
    """Words each source should give: all words shared by weight, no source above
    three times its own, the excess shared again among the others."""
    goal: dict[int, Fraction] = {}
    while True:
        open_ = [i for i in range(len(sizes)) if i not in goal]
        rest = sum(sizes) - sum(goal.values())
        share = {i: rest * Fraction(weights[i], sum(weights[j] for j in open_)) for i in open_}
        above = [i for i in open_ if share[i] > MAX_REPEATS * sizes[i]]
        if not above:
            return [float(goal.get(i, share.get(i, 0))) for i in range(len(sizes))]
        goal |= {i: Fraction(MAX_REPEATS * sizes[i]) for i in above}


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def golden_points(slot: Column) -> Column:
    """Fractional parts of multiples of the golden ratio. The slot is split so that
    no product grows beyond what a double holds finely."""
    wide = (WIDE_STEP * GOLDEN) % 1.0
    high, low = F.floor(slot / WIDE_STEP), F.pmod(slot, F.lit(WIDE_STEP))
    return F.pmod(high * F.lit(wide) + (low + 1) * F.lit(GOLDEN), F.lit(1.0))


def schedule(spark, quotas: list[int]) -> DataFrame:
    """Slots in order: ``slot``, source number ``src`` and the rank of the slot
    among those of its source. Each source gets exactly its quota: the points give
    every source its share to within a few slots, surplus slots are left out and
    missing ones follow at the end."""
    total = sum(quotas)
    bounds, filled = [], 0
    for quota in quotas:
        filled += quota
        bounds.append(filled / max(total, 1))
    cumulative = F.array(*[F.lit(b) for b in bounds[:-1]]) if len(bounds) > 1 else F.array().cast("array<double>")
    point = golden_points(F.col("slot"))
    drawn = spark.range(total).select(F.col("id").alias("slot"), point.alias("point")).select(
        "slot",
        F.size(F.filter(cumulative, lambda b: b <= F.col("point"))).alias("src"),
        F.floor(F.col("slot") / SLOT_CELL).alias("cell"),
    )
    counts = dict(drawn.groupBy("src").count().collect())
    ranked = placed(drawn, "src", "cell", ["slot"], F.lit(1).cast("long"), "rank").drop("cell")
    quota = F.array(*[F.lit(q).cast("long") for q in quotas])
    kept = ranked.filter(F.col("rank") < F.element_at(quota, F.col("src") + 1))
    missing, at = [], total
    for src, q in enumerate(quotas):
        for rank in range(counts.get(src, 0), q):
            missing.append((at, src, rank))
            at += 1
    late = spark.createDataFrame(missing, "slot long, src int, rank long")
    return kept.select("slot", "src", "rank").unionByName(late)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    block_words: int = BLOCK_WORDS,
    text: str = "text",
    source: str = "source",
    keep: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The mix and the documents it draws on.

    The documents of a source stand in a shuffled line (by hash) that is repeated
    end to end and cut into blocks of ``block_words`` words. Golden-ratio points
    mapped through the cumulative targets deal slots to sources; the n-th slot of a
    source takes its n-th block, the last one only up to the target. So a source
    gives its target, rounded to whole words, and no word is given more than three
    times. The same rows give the same mix on every run.

    Returns pieces (``slot``, ``src``, ``start``, ``first_word``, ``words``: words
    of one document in one slot) and documents (``row``: the kept columns,
    ``src``, ``start``, ``size``, ``source_size``, ``target``). ``src`` and
    ``start`` say where in its source's line a document stands.

    Null and empty texts have no words, stay among the documents and give no
    pieces. A null source is a source of its own and comes last. Repeated rows are
    rows. An empty table gives no rows. The list of sources, each of which has a
    weight, is held by the driver; documents never are."""
    spark = docs.sparkSession
    body, name = F.col(f"`{text}`"), F.col(f"`{source}`").cast("string")
    sized = staged(
        docs.select(
            packed(docs, keep).alias("row"),
            name.alias("source"),
            words_of(body).alias("size"),
            F.xxhash64(packed(docs)).alias("shuffle"),
        )
    )
    found = sized.groupBy("source").agg(F.sum("size")).collect()
    totals = sorted(found, key=lambda r: (r[0] is None, [ord(c) for c in r[0] or ""]))
    sizes = [r[1] for r in totals]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))])
    planned = [min(round(g), MAX_REPEATS * s) for g, s in zip(goal, sizes, strict=True)]
    listed = spark.createDataFrame(
        [(i, r[0], r[1], g, p) for i, (r, g, p) in enumerate(zip(totals, goal, planned, strict=True))],
        "src int, source string, source_size long, target double, planned long",
    )
    joined = sized.join(F.broadcast(listed), sized["source"].eqNullSafe(listed["source"])).drop("source")
    cell = F.shiftrightunsigned("shuffle", 52).cast("int")
    lined = placed(
        joined.withColumn("cell", cell), "src", "cell", ["shuffle", "size"], F.col("size"), "start"
    ).drop("cell", "shuffle")
    slots = schedule(spark, [-(-p // block_words) for p in planned])
    pieces = _pieces(lined, block_words).join(slots, ["src", "rank"])
    return pieces.select("slot", "src", "start", "size", "first_word", "words"), lined


def _pieces(lined: DataFrame, block: int) -> DataFrame:
    """Documents of the repeated line, cut at block borders."""
    start, size, length = F.col("start"), F.col("size"), F.col("source_size")
    rounds = F.ceil(F.col("planned") / length)
    turn = F.when((size > 0) & (rounds > 0), F.sequence(F.lit(0).cast("long"), rounds - 1))
    turned = lined.drop("row").withColumn("turn", F.explode(turn))
    low = F.col("turn") * length + start
    bounded = turned.select(
        "src", "start", "size", low.alias("low"), F.least(low + size, F.col("planned")).alias("high")
    ).filter("low < high")
    ranks = F.sequence(F.floor(F.col("low") / block), F.floor((F.col("high") - 1) / block))
    cut = bounded.withColumn("rank", F.explode(ranks))
    first = F.greatest("low", F.col("rank") * block)
    last = F.least("high", (F.col("rank") + 1) * block)
    return cut.select(
        "src", "rank", "start", "size", (first - F.col("low")).alias("first_word"), (last - first).alias("words")
    )


def taken(pieces: DataFrame, lined: DataFrame) -> DataFrame:
    """Documents with the words the mix takes of each."""
    sums = pieces.groupBy("src", "start", "size").agg(F.sum("words").alias("taken"))
    return lined.join(sums, ["src", "start", "size"], "left").select(
        "row", "src", "start", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )
