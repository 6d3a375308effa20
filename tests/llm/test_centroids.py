import hashlib
import math
import random

import numpy as np

from tickloom.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, row string, cluster string, distance int, id string, vector int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "r", "c", 1, "i", 2) for i, v in rows], SCHEMA)


def brute(rows, clusters, rounds, dims):
    def usable(v):
        return v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)

    used = [(i, [math.floor(256 * x) for x in v], v) for i, v in rows if usable(v)]

    def draw(row):
        name = "2:" + ("" if row[0] is None else str(row[0]))
        return hashlib.sha256(name.encode()).hexdigest(), row[2]

    centres = [v for _, v, _ in sorted(used, key=draw)[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v, _ in used:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [
            [sum(x) // len(groups[k]) for x in zip(*groups[k], strict=True)] if k in groups else c
            for k, c in enumerate(centres)
        ]
    last = [(i, *nearest(v)) for i, v, _ in used]
    inertia = {}
    for _, gap, k in last:
        inertia[k] = inertia.get(k, 0) + gap
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    out = [(i, k, gap, inertia[k], sum(inertia.values()), digest[k]) for i, gap, k in last]
    return sorted(out, key=lambda r: (r[0] is None, r))


def found(spark, rows, clusters, rounds, dims):
    out = centroids.cluster(frame(spark, rows), clusters, rounds, dims=dims, keep=["vec_id", "cluster"])
    assert out.columns == ["vec_id", *centroids.OUTPUTS]
    return sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0] is None, r))


def test_matches_brute_force(spark):
    draw = random.Random(4)
    rows = [(i, [draw.gauss(i % 4, 1) for _ in range(5)]) for i in range(300)]
    for clusters, rounds in ((12, 4), (1, 2), (300, 1), (7, 0)):
        assert found(spark, rows, clusters, rounds, 5) == brute(rows, clusters, rounds, 5)


def test_ties_repeats_odd_vectors(spark):
    draw = random.Random(5)
    grid = [[draw.choice([-0.5, 0.0, 0.5]) for _ in range(3)] for _ in range(80)]
    rows = list(enumerate(grid)) + [(3, grid[9]), (3, grid[9]), (None, grid[1]), (None, None), (90, [])]
    rows += [(91, [1.0, None, 2.0]), (92, [1.0, float("nan"), 2.0]), (93, [float("-inf"), 0.0, 0.0]), (94, [1.0, 2.0])]
    for clusters in (3, 20):
        assert found(spark, rows, clusters, 3, 3) == brute(rows, clusters, 3, 3)


def test_wide_components(spark):
    rows = [(i, [1e6 * (i % 5) + i, -1e6 * (i % 3)]) for i in range(40)]
    assert found(spark, rows, 6, 3, 2) == brute(rows, 6, 3, 2)


def test_nothing(spark):
    assert found(spark, [], 4, 2, 3) == []
    assert found(spark, [(1, None), (2, [1.0])], 4, 2, 3) == []
    assert found(spark, [(1, [1.0, 2.0, 3.0])], 4, 2, 3) == brute([(1, [1.0, 2.0, 3.0])], 4, 2, 3)


def test_tree_prunes_and_keeps_ties():
    draw = np.random.default_rng(1)
    middles = draw.integers(-5000, 5000, (20, 4))
    centres = np.repeat(middles, 5, 0) + draw.integers(-40, 40, (100, 4))
    points = np.concatenate([centres, centres[::-1], np.repeat(middles, 3, 0)])
    tree = centroids.Tree.of(centres)
    opened = []
    measure = centroids.squared
    centroids.squared = lambda p, c: opened.append(len(p)) or measure(p, c)
    try:
        best, gap = tree.nearest(points)
    finally:
        centroids.squared = measure
    every = ((points[:, None] - centres[None]) ** 2).sum(2)
    assert (gap == every.min(1)).all() and (best == every.argmin(1)).all()
    assert sum(opened) < every.size / 2
