"""Large groups take the split path; its results equal the plain window's."""

import math

import pytest
from pyspark.sql import functions as F

from tickloom.operators import backtest, ordered, quality, sampling
from tickloom.sources import shared_tables as tables

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key; some values are missing."""
    n = F.col("id")
    return spark.range(3000).select(
        F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (n % 40).cast("string"))).alias("key"),
        (F.hash(n) % 500).alias("at"),
        n.alias("seq"),
        F.when(n % 7 != 0, F.hash(n + 1) % 1000).alias("v"),
    )



def running_values():
    return {f"r_{kind}": (kind, F.col("v")) for kind in ("max", "min", "sum", "last", "first")}


def test_split_path_equals_window(spark, skewed):
    plain = ordered.running(skewed, ["key"], ["at", "seq"], running_values())
    split = ordered.running(skewed, ["key"], ["at", "seq"], running_values(), max_group_rows=100)
    assert "_piece" not in split.columns
    assert rows(plain) == rows(split)


def test_split_path_keeps_rows_without_key(spark, skewed):
    keyed = skewed.withColumn("key", F.when(F.col("key") != "hot", F.col("key")))
    plain = ordered.running(keyed, ["key"], ["at", "seq"], running_values())
    split = ordered.running(keyed, ["key"], ["at", "seq"], running_values(), max_group_rows=100)
    assert rows(plain) == rows(split)


def test_hot_group_is_spread(spark, skewed):
    split = ordered.running(skewed, ["key"], ["at", "seq"], running_values(), max_group_rows=100)
    plan = split._jdf.queryExecution().toString()
    assert "_piece" in plan
    pieces = skewed.repartitionByRange(8, "key", "at", "seq").withColumn("p", F.spark_partition_id())
    assert pieces.filter("key = 'hot'").select("p").distinct().count() > 1


def test_index_counts_from_zero_in_order(spark, skewed):
    numbered = ordered.with_index(skewed, ["at", "seq"]).orderBy("idx").collect()
    assert [r.idx for r in numbered] == list(range(3000))
    assert [(r["at"], r.seq) for r in numbered] == sorted((r["at"], r.seq) for r in numbered)


@pytest.mark.parametrize("op", ["buy", "sell"])
def test_trailing_stop_split_path(spark, op):
    paths = tables.price_paths(spark, SF).withColumn("trade_id", F.col("trade_id") % 3)
    plain = backtest.trailing_stop(paths, op, 0.02)
    split = backtest.trailing_stop(paths, op, 0.02, max_group_rows=50)
    assert rows(plain) == rows(split)


def test_trailing_stop_against_a_loop(spark):
    paths = tables.price_paths(spark, SF)
    by_trade = {}
    for r in paths.orderBy("trade_id", "ts", "seq").collect():
        by_trade.setdefault(r.trade_id, []).append(r.LastPrice)
    want = {}
    for trade, prices in by_trade.items():
        entry, high, out = prices[0], 0.0, prices[-1]
        for price in prices:
            high = max(high, price)
            if price <= high * (1 - 0.02) - (high - entry) * 0.2:
                out = price
                break
        want[trade] = (entry, out)
    got = backtest.trailing_stop(paths, "buy", 0.02).collect()
    assert {r.trade_id: (r.entry_price, r.exit_price) for r in got} == want
    assert all(r.exit_price in by_trade[r.trade_id] for r in got)


def test_running_high_low_split_path(spark):
    paths = tables.price_paths(spark, SF).withColumn("trade_id", F.lit(1))
    plain = backtest.running_high_low(paths, ["trade_id"], ["ts", "seq"])
    split = backtest.running_high_low(paths, ["trade_id"], ["ts", "seq"], max_group_rows=50)
    assert rows(plain) == rows(split)


def test_one_instant_is_split_too(spark):
    """Pieces of time cannot split rows of a single instant; ranges can."""
    now = F.lit("2024-01-01").cast("timestamp_ntz")
    paths = tables.price_paths(spark, SF).withColumns({"trade_id": F.lit(1), "ts": now})
    plain = backtest.running_high_low(paths, ["trade_id"], ["ts", "seq"])
    split = backtest.running_high_low(paths, ["trade_id"], ["ts", "seq"], max_group_rows=50)
    assert "staged-" in split._jdf.queryExecution().toString()
    assert rows(plain) == rows(split)


def test_open_interest_repair_split_path(spark):
    ticks = tables.ticks(spark, SF).withColumn("InstrumentID", F.lit("AG9999"))
    plain = quality.repair_open_interest(ticks)
    split = quality.repair_open_interest(ticks, max_group_rows=50)
    assert rows(plain) == rows(split)
    assert plain.filter("OpenInterest > 100000000").count() == 0


def test_describe_split_path_and_pandas(spark):
    ticks = tables.ticks(spark, SF)
    plain = quality.describe(ticks, ["LastPrice", "Turnover"])
    split = quality.describe(ticks.repartition(5), ["LastPrice", "Turnover"])
    quartiles = ["InstrumentID", "field", "count", "min", "p25", "p50", "p75", "max"]
    assert rows(plain.select(*quartiles)) == rows(split.select(*quartiles))
    frame = ticks.select("InstrumentID", "LastPrice", "Turnover").toPandas()
    for r in plain.collect():
        want = frame[frame.InstrumentID == r.InstrumentID][r.field].describe()
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%")):
            assert r[ours] == pytest.approx(want[theirs], rel=1e-9)


# --- samples -------------------------------------------------------------------


def by_fixed_step(n, size, omit=False):
    size = n - size if omit else size
    if size <= 0:
        return []
    step = (n + 1) / size
    if step <= 1:
        return list(range(n))
    return [int(j * step) for j in range(size + 1) if j * step < n]


@pytest.mark.parametrize("size,omit", [(0, False), (1, False), (7, False), (40, False), (99, False), (100, False), (101, False), (500, False), (30, True), (100, True)])
def test_systematic_sample(spark, size, omit):
    df = spark.range(100).repartition(5)
    got = sampling.systematic_sample(df, ["id"], size, omit)
    assert sorted(r.id for r in got.collect()) == by_fixed_step(100, size, omit)


@pytest.mark.parametrize("pages", [0, 1, 3, 10, 50])
def test_strided_chunks(spark, pages):
    df = spark.range(20).repartition(3)
    got = {}
    for r in sampling.strided_chunks(df, ["id"], pages).orderBy("id").collect():
        got.setdefault(r.chunk_id, []).append(r.id)
    n = max(1, min(pages or 1, 20))
    assert got == {i: list(range(20))[i::n] for i in range(n)}


def test_strided_chunks_by_size(spark):
    df = spark.range(20)
    assert sampling.strided_chunks_by_size(df, ["id"], 6).select("chunk_id").distinct().count() == 3
    assert sampling.strided_chunks_by_size(df, ["id"], 50).select("chunk_id").distinct().count() == 1
    with pytest.raises(ValueError):
        sampling.strided_chunks_by_size(df, ["id"], 0)


def test_pages_partition_the_rows(spark):
    df = spark.range(103).repartition(4)
    seen = [sorted(r.id for r in sampling.page(df, ["id"], p, pages=4).collect()) for p in range(4)]
    assert [len(s) for s in seen] == [26, 26, 26, 25]
    assert sum(seen, []) == list(range(103))


@pytest.mark.parametrize("n", [1, 50, 400, 2000])
def test_random_rows_exact(spark, n):
    found = [
        sorted(r.id for r in sampling.random_rows(spark.range(1000).repartition(p), n, seed=3).collect())
        for p in (1, 4)
    ]
    assert found[0] == found[1] and len(set(found[0])) == min(n, 1000)


# --- positions and ranks ------------------------------------------------------------


@pytest.mark.parametrize("max_rows", [1, 40, 10_000])
def test_pieces_number_rows_without_a_copy(spark, skewed, max_rows):
    cut = ordered.pieces(skewed.repartition(7), ["at", "seq"], max_rows)
    numbered = cut.numbered().orderBy("idx").collect()
    assert cut.total == 3000 and [r.idx for r in numbered] == list(range(3000))
    assert [(r["at"], r.seq) for r in numbered] == sorted((r["at"], r.seq) for r in numbered)
    if max_rows > 1:
        assert "staged" not in cut.rows._jdf.queryExecution().toString()


def test_pieces_of_times_nulls_texts_and_nothing(spark):
    n = F.col("id")
    rows_ = spark.range(500).select(
        F.when(n % 9 != 0, F.timestamp_micros(n * n * 1_000_003).cast("timestamp_ntz")).alias("t"),
        F.when(n % 5 != 0, F.md5(n.cast("string"))).alias("s"),
        (n * 2**53 - 2**62).alias("wide"),
        n,
    )
    for order in (["t", "id"], ["s", "id"], ["wide"], ["id"]):
        for max_rows in (30, 1000):
            got = ordered.pieces(rows_, order, max_rows).numbered().orderBy("idx").select("id").collect()
            assert got == rows_.orderBy(*order).select("id").collect()
    assert ordered.pieces(rows_.limit(0), ["t", "id"]).numbered().count() == 0


def test_only_touched_pieces_are_ordered(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PIECE_ROWS", 50)
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("id"))
    cut = ordered.pieces(df, ["id"], 50)
    assert cut.sizes.count() == 20
    for number in (0, 3, 9, 10):
        got = sorted(r.id for r in sampling.page(df, ["id"], number, size=100).collect())
        assert got == list(range(number * 100, min(1000, number * 100 + 100)))
    for size in (1, 7, 99, 1000, 2000):
        step = 1001 / size
        want = [i for i in range(1000) if step <= 1 or math.floor(math.ceil(i / step) * step) == i]
        assert len(sampling.systematic_sample(df, ["id"], size).collect()) == len(want)


def test_lowest_of_each_group(spark, skewed):
    drawn = skewed.withColumn("draw", F.xxhash64("seq"))
    got = {(r.key, r.seq) for r in sampling.lowest(drawn.repartition(50), 5, ["draw"], ["key"]).collect()}
    want = {}
    for r in drawn.orderBy("draw").collect():
        want.setdefault(r.key, []).append(r.seq)
    assert got == {(k, s) for k, seqs in want.items() for s in seqs[:5]}


def test_sample_beyond_what_tasks_hold(spark, monkeypatch):
    small = rows(sampling.random_rows(spark.range(2000), 300, seed=5))
    monkeypatch.setattr(sampling, "HELD", 10)
    assert rows(sampling.random_rows(spark.range(2000), 300, seed=5)) == small


@pytest.mark.parametrize("cells", [1, 3, 1024])
def test_values_at_ranks_of_odd_columns(spark, monkeypatch, cells):
    monkeypatch.setattr(quality, "CELLS", cells)
    inf, nan = float("inf"), float("nan")
    columns = {
        "ties": [5.0] * 9 + [None, 1.0, 5.0],
        "one": [None] * 11 + [3.5],
        "wide": [-1.7e308, 1.7e308, 0.0, 5e-324, 1.0, -1.0, 2.0, 1e300, -1e300, 1e-300, None, 7.0],
        "ends": [-inf, inf, 1.0, 2.0, 3.0, 4.0, inf, inf, 5.0, 6.0, -inf, 7.0],
        "nans": [nan, 1.0, 2.0, nan, 4.0, 3.0, None, 0.0, -0.0, 9.0, 8.0, nan],
        "none": [None] * 12,
    }
    data = [("a", *v) for v in zip(*columns.values(), strict=True)]
    df = spark.createDataFrame(data, "InstrumentID string, " + ", ".join(f"{c} double" for c in columns))
    long = df.unpivot("InstrumentID", list(columns), "field", "value").filter("value IS NOT NULL")
    ends = long.groupBy("InstrumentID", "field").agg(F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    wanted = ends.select("InstrumentID", "field", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("rank"), "low", "high")
    found = quality.values_at(df, list(columns), "InstrumentID", wanted).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r.field, []).append(r.value)
    for field, values in columns.items():
        want = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
        assert [str(v + 0.0) for v in got.get(field, [])] == [str(v + 0.0) for v in want]
