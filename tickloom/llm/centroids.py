"""Centroid clustering with a vantage-point tree over the centroids."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tickloom.llm.placing import packed, unpacked
from tickloom.session import staged

CLUSTERS = 40
ROUNDS = 5
SCALE = 256
DIMS = 64
SEED = "2"
CELLS = 1 << 21
# Below this, 64-bit sums of squared differences cannot overflow; slightly loose bounds
# keep rounding from pruning a nearest centroid.
SAFE = 1 << 26
LOOSE = 1e-9
OUTPUTS = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def usable(vector: Column, dims: int) -> Column:
    """``dims`` components, none null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dims) & ~bad, F.lit(False))


def whole(flat: np.ndarray, dims: int, scale: int) -> np.ndarray:
    """Integer vectors, a row each; Python integers where 64 bits might not do."""
    floors = np.floor(scale * flat.astype(np.float64)).reshape(-1, dims)
    if np.abs(floors).max(initial=0) < SAFE:
        return floors.astype(np.int64)
    return np.array([[int(x) for x in row] for row in floors], object).reshape(-1, dims)


def squared(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = points - centre
    return (gap * gap).sum(1)


def fits(points: np.ndarray) -> np.ndarray:
    """As 64-bit integers if sums of squares stay exact, else as they are."""
    return points.astype(np.int64) if np.abs(points).max(initial=0) < SAFE else points


@dataclass
class Tree:
    """Vantage points in the order of their making, the root first. Node ``n`` holds
    centroid ``point[n]``. ``near[n]`` and ``far[n]`` are its subtrees (-1: none), of
    which ``reach`` gives the least and the largest distance from the point."""

    centres: np.ndarray
    point: np.ndarray
    near: np.ndarray
    far: np.ndarray
    reach: np.ndarray

    @classmethod
    def of(cls, centres: np.ndarray) -> Tree:
        """Split the rest of every node at the median distance from its point."""
        count = len(centres)
        point, near, far = (np.full(count, -1) for _ in range(3))
        reach = np.zeros((count, 4))
        todo, made = [(np.arange(count), None, 0)], 0
        while todo:
            members, parent, side = todo.pop()
            node, made = made, made + 1
            if parent is not None:
                (near, far)[side][parent] = node
            point[node], rest = members[0], members[1:]
            if not len(rest):
                continue
            away = np.sqrt(squared(centres[rest], centres[members[0]]).astype(np.float64))
            order = np.argsort(away, kind="stable")
            cut = (len(rest) + 1) // 2
            for s, part in enumerate((order[:cut], order[cut:])):
                if len(part):
                    reach[node, 2 * s : 2 * s + 2] = away[part].min(), away[part].max()
                    todo.append((rest[part], node, s))
        return cls(centres, point, near, far, reach)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid (ties: the smaller number) and squared distance of each
        row.

        Every row opens its own nodes, the one with the least bound first, until no
        bound is within the radius of the best found. Rows that open the same node
        are measured together. Bounds are inclusive, so a tie is always looked at."""
        kind = np.result_type(vectors, self.centres)
        best, found = np.full(len(vectors), -1), np.zeros(len(vectors), kind)
        step = max(1, CELLS // max(1, len(self.point)))
        for low in range(0, len(vectors), step):
            rows = slice(low, low + step)
            best[rows], found[rows] = self._search(vectors[rows], kind)
        return best, found

    def _search(self, vectors: np.ndarray, kind) -> tuple[np.ndarray, np.ndarray]:
        rows, nodes = len(vectors), len(self.point)
        bound = np.full((rows, nodes), np.inf)
        bound[:, 0] = 0
        best, found = np.full(rows, nodes), np.zeros(rows, kind)
        radius = np.full(rows, np.inf)
        active = np.arange(rows)
        while len(active):
            opened = bound[active].argmin(1)
            order = np.argsort(opened, kind="stable")
            edges = np.flatnonzero(np.diff(opened[order], prepend=-1, append=nodes))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                self._open(int(opened[order[a]]), active[order[a:b]], vectors, bound, best, found, radius)
            active = active[bound[active].min(1) <= radius[active]]
        return best, found

    def _open(self, node: int, rows, vectors, bound, best, found, radius) -> None:
        centre = int(self.point[node])
        gap = squared(vectors[rows], self.centres[centre])
        better = (best[rows] == len(self.point)) | (gap < found[rows])
        better |= (gap == found[rows]) & (centre < best[rows])
        won = rows[better]
        best[won], found[won] = centre, gap[better]
        away = np.sqrt(gap.astype(np.float64))
        radius[won] = away[better] * (1 + LOOSE)
        above = bound[rows, node]
        bound[rows, node] = np.inf
        for child, (low, high) in ((self.near[node], self.reach[node, :2]), (self.far[node], self.reach[node, 2:])):
            if child >= 0:
                least = np.maximum(low - away, away - high) - LOOSE * (away + high)
                bound[rows, child] = np.maximum(above, least)


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    id: str = "vec_id",
    vector: str = "embedding",
    dims: int = DIMS,
    scale: int = SCALE,
    seed: str = SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """Cluster integer vectors around ``clusters`` centroids in ``rounds`` rounds.

    Components are scaled and rounded down. Centroids start as the vectors whose ids,
    behind ``seed`` and a colon, have the smallest sha256. Each round sends a
    vantage-point tree over the centroids to the tasks, assigns every vector to the
    nearest centroid (ties: the smaller number) and replaces centroids by the rounded
    down means of their vectors; those without vectors stay. All arithmetic that
    decides is on integers. Vectors stay where they are: a task passes on one sum and
    count per centroid and dimension, and only those totals, ``clusters * dims``
    numbers, reach the driver. Each round reads the vectors once.

    Vectors that are null, of another length, or hold null or non-finite components
    are left out. Rows alike in their id start centroids in the order of their
    vectors; a null id counts as an empty text there. Repeated rows count each. Fewer
    vectors than ``clusters`` give as many centroids; an empty table gives no rows.
    Distances and their sums must fit 64 bits. Returns the kept columns and
    ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``;
    a column named like an output is replaced."""
    spark = vectors.sparkSession
    rows = vectors.select(
        packed(vectors, keep).alias("row"),
        F.col(f"`{id}`").cast("long").alias("id"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    ).filter(usable(F.col("vector"), dims))
    centres = fits(_first(rows, clusters, seed, dims, scale))
    if not len(centres):
        return unpacked(_finished(spark, rows, centres, dims, scale), "row", OUTPUTS)
    for _ in range(rounds):
        centres = fits(_moved(spark, rows, centres, dims, scale))
    return unpacked(_finished(spark, rows, centres, dims, scale), "row", OUTPUTS)


def _first(rows: DataFrame, clusters: int, seed: str, dims: int, scale: int) -> np.ndarray:
    """The vectors with the smallest hashes, at most ``clusters``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    drawn = rows.select(F.sha2(name, 256).alias("draw"), "vector").orderBy("draw", "vector").limit(clusters)
    flat = np.array([x for row in drawn.collect() for x in row["vector"]], np.float64)
    return whole(flat, dims, scale)


def _batch_vectors(batch: pa.RecordBatch, dims: int, scale: int) -> np.ndarray:
    return whole(batch.column("vector").flatten().to_numpy(zero_copy_only=False), dims, scale)


def _moved(spark: SparkSession, rows: DataFrame, centres: np.ndarray, dims: int, scale: int) -> np.ndarray:
    """Centroids after one round."""
    sent = spark.sparkContext.broadcast(Tree.of(centres))
    sums = rows.select("vector").mapInArrow(_summer(sent, dims, scale), "cluster int, dim int, n long, total string")
    wide = F.col("total").cast("decimal(38,0)")
    found = sums.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(wide).alias("total"))
    moved = np.array(centres, object)
    for row in found.collect():
        moved[row["cluster"], row["dim"]] = int(row["total"]) // row["n"]
    sent.destroy()
    return moved


def _summer(sent: Broadcast, dims: int, scale: int):
    """Per task and centroid: how many vectors it is nearest to, and their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = sent.value
        count = len(tree.point)
        totals, counts = np.zeros((count, dims), object), np.zeros(count, np.int64)
        for batch in batches:
            points = _batch_vectors(batch, dims, scale)
            near, _ = tree.nearest(points)
            counts += np.bincount(near, minlength=count)
            order = np.argsort(near, kind="stable")
            some, first = np.unique(near[order], return_index=True)
            if len(some):
                totals[some] += np.add.reduceat(points[order], first)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(some, dims), pa.int32()),
                pa.array(np.tile(np.arange(dims), len(some)), pa.int32()),
                pa.array(np.repeat(counts[some], dims), pa.int64()),
                pa.array([str(x) for x in totals[some].ravel()], pa.string()),
            ],
            names=["cluster", "dim", "n", "total"],
        )

    return run


def _finished(spark: SparkSession, rows: DataFrame, centres: np.ndarray, dims: int, scale: int) -> DataFrame:
    """Every vector's last cluster with the sums of distances and the digest of the
    centroid, of which there are as many as centroids."""
    schema = StructType([rows.schema["row"], StructField("cluster", IntegerType()), StructField("distance", LongType())])
    if len(centres):
        sent = spark.sparkContext.broadcast(Tree.of(centres))
        placed = staged(rows.select("row", "vector").mapInArrow(_placer(sent, dims, scale), schema))
    else:
        placed = spark.createDataFrame([], schema)
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    inertia = {r["cluster"]: r["cluster_inertia"] for r in sums.collect()}
    texts = [",".join(str(int(x)) for x in centre) for centre in centres]
    facts = [(k, inertia[k], sum(inertia.values()), texts[k]) for k in sorted(inertia)]
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, components string")
    named = known.withColumn("centroid_sha256", F.sha2("components", 256)).drop("components")
    return placed.join(F.broadcast(named), "cluster")


def _placer(sent: Broadcast, dims: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, found = sent.value.nearest(_batch_vectors(batch, dims, scale))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(near, pa.int32()), pa.array([int(x) for x in found], pa.int64())],
                names=["row", "cluster", "distance"],
            )

    return run
