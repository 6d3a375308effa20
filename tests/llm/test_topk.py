import math
import random

from pyspark.sql import functions as F

from tickloom.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int, score string, rank string, id string, asks string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "s", "r", "i", "a") for i, v in rows], SCHEMA)


def whole(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, k=5):
    used = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if whole(v)]
    queries = {}
    for (i, v), raw in zip(used, [v for _, v in rows if whole(v)], strict=True):
        if i is not None and i % 50 == 0:
            queries[i] = min(queries.get(i, (raw, v)), (raw, v))
    out = []
    for q, (_, own) in queries.items():
        scored = [(-sum(a * b for a, b in zip(own, v)), (i is None, i or 0), i) for i, v in used if i != q and len(v) == len(own)]
        out += [(q, n + 1, i, -s) for n, (s, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(spark, rows, **options):
    return sorted(tuple(r) for r in topk.search(frame(spark, rows), F.col("vec_id") % 50 == 0, **options).collect())


def test_matches_brute_force(spark):
    draw = random.Random(2)
    rows = [(i, [draw.gauss(0, 1) * (1 + i % 3) for _ in range(20)]) for i in range(700)]
    for options in ({}, {"dims": 3}, {"block_queries": 4}, {"dims": 64}):
        assert found(spark, rows, **options) == brute(rows)


def test_ties_repeats_odd_vectors(spark):
    same = [0.5, -0.25, 0.125]
    rows = [(i, same) for i in range(120)] + [(50, [1.0, 1.0, 1.0]), (7, same), (7, same), (None, same), (None, [9.0, 9.0, 9.0])]
    rows += [(200, None), (201, [1.0, None, 2.0]), (202, [1.0, float("nan"), 2.0]), (203, [float("inf"), 0.0, 0.0])]
    rows += [(250, [1.0, 2.0]), (251, [3.0, 4.0]), (300, []), (301, [])]
    assert found(spark, rows) == brute(rows)


def test_components_beyond_doubles(spark):
    rows = [(0, [1e6, 1.0, 2.0]), (1, [1e7 + 0.5, 1.0, 3.0]), (2, [1e7 + 0.5, 1.0, 4.0]), (3, [-1e7, 0.0, 0.0])]
    assert found(spark, rows) == brute(rows)


def test_nothing(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, [(1, [1.0]), (2, [1.0])]) == []
