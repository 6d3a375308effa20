"""Exact top-k by columnar branch and bound."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

K = 5
SCALE = 256
BLOCK_QUERIES = 16384
TILE_QUERIES = 64
DIMS = 8
BATCH_ROWS = 8192
NO_ID = np.iinfo(np.int64).max
EXACT = float(1 << 52)
PARTIAL = "query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """No null, no null component, none that is not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(scale * values.astype(np.float64))


def matrices(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and integer vectors of a batch, as one dimension after another, for each
    length of vector; a null id becomes the largest."""
    ids = batch.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
    lists = batch.column("vector")
    sizes = np.diff(lists.offsets.to_numpy())
    flat = scaled(lists.flatten().to_numpy(zero_copy_only=False), scale)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        places = starts[rows][None, :] + np.arange(size)[:, None]
        yield ids[rows], flat[places]


def norms_behind(columns: np.ndarray, dims: int) -> np.ndarray:
    """For each vector the length of what lies behind the first 0, dims, 2 dims, ...
    dimensions, rounded up a little."""
    squares = np.square(columns)
    edges = range(0, columns.shape[0], dims)
    parts = np.array([squares[e : e + dims].sum(0) for e in edges]).reshape(-1, columns.shape[1])
    behind = np.cumsum(parts[::-1], 0)[::-1]
    return np.sqrt(np.vstack([behind, np.zeros((1, columns.shape[1]))])) * (1 + 1e-9)


class Queries:
    """A block of queries of one length: columns, remaining lengths, best so far."""

    def __init__(self, ids: np.ndarray, columns: np.ndarray, k: int, dims: int) -> None:
        self.ids, self.columns, self.k, self.dims = ids, columns, k, dims
        self.behind = norms_behind(columns, dims)
        self.largest = float(np.abs(columns).max(initial=0))
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * len(ids)
        self.floor = np.full(len(ids), -np.inf)

    def search(self, ids: np.ndarray, columns: np.ndarray) -> None:
        size = columns.shape[0]
        if size * self.largest * float(np.abs(columns).max(initial=0)) >= EXACT:
            self._search_wide(ids, columns)
            return
        behind = norms_behind(columns, self.dims)
        for low in range(0, len(self.ids), TILE_QUERIES):
            tile = slice(low, low + TILE_QUERIES)
            head = self.columns[: self.dims, tile].T @ columns[: self.dims]
            step = min(1, len(behind) - 1)
            bound = head + np.outer(self.behind[step, tile], behind[step])
            alive = bound >= self.floor[tile, None]
            for q in np.flatnonzero(alive.any(1)):
                self._refine(low + q, np.flatnonzero(alive[q]), head[q], ids, columns, behind)

    def _refine(self, q, alive, head, ids, columns, behind) -> None:
        """Add one block of dimensions after the other for the candidates that can
        still reach the k-th best score, and let the others go."""
        score = head[alive]
        for step, at in enumerate(range(self.dims, columns.shape[0], self.dims), 2):
            part = slice(at, at + self.dims)
            score = score + self.columns[part, q] @ columns[part, alive]
            keep = score + self.behind[step, q] * behind[step, alive] >= self.floor[q]
            if not keep.all():
                alive, score = alive[keep], score[keep]
            if not len(alive):
                return
        self._offer(q, ids[alive], score)

    def _search_wide(self, ids: np.ndarray, columns: np.ndarray) -> None:
        """Components too large for exact doubles: whole numbers of any size."""
        whole = np.array([[int(x) for x in row] for row in columns], object).reshape(columns.shape)
        for q in range(len(self.ids)):
            mine = np.array([int(x) for x in self.columns[:, q]], object)
            self._offer(q, ids, mine @ whole if len(mine) else np.zeros(len(ids), object))

    def _offer(self, q: int, ids: np.ndarray, score: np.ndarray) -> None:
        others = ids != self.ids[q]
        held, best = self.best[q]
        ids, score = np.concatenate([held, ids[others]]), np.concatenate([best, score[others]])
        if len(ids) > 4 * self.k:  # ties with the k-th stay
            least = np.partition(score, len(score) - self.k)[len(score) - self.k]
            ids, score = ids[score >= least], score[score >= least]
        order = np.lexsort((ids, -score))[: self.k]
        self.best[q] = ids[order], score[order]
        if len(order) == self.k:
            self.floor[q] = float(score[order[-1]])


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    block_queries: int = BLOCK_QUERIES,
    dims: int = DIMS,
) -> DataFrame:
    """The ``k`` largest integer inner products of every query with all other rows.

    Components are scaled and rounded down. Queries go out in blocks of bounded
    size; each block makes one pass over the vectors, which stay where they are.
    A task holds its candidates dimension by dimension and adds ``dims`` dimensions
    at a time; what is still to come is bounded by the product of the remaining
    lengths, so candidates that cannot reach the query's k-th score so far are
    dropped. The k best of each task meet in one ranking per query.

    Ties go to the smaller id, a null id (never a query) comes last. Vectors that
    are null or hold null or non-finite components take no part; vectors of another
    length than the query's are no candidates of it; between vectors without
    components every score is 0. A query's own rows, all those
    of its id, are left out; if an id has several vectors, the least is the query.
    Repeated rows count each. Scores must fit 64 bits. Fewer than ``k`` candidates
    give fewer rows; an empty table gives none."""
    spark = vectors.sparkSession
    whole = vectors.select(
        F.col(f"`{id}`").cast("long").alias("id"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter(usable(F.col("vector")))
    asking = whole.filter("asks AND id IS NOT NULL").groupBy("id").agg(F.min("vector").alias("vector"))
    found = None
    for block in _blocks(asking, block_queries):
        sent = spark.sparkContext.broadcast(block)
        part = whole.select("id", "vector").mapInArrow(_searcher(sent, k, scale, dims), PARTIAL)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], PARTIAL)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _blocks(asking: DataFrame, limit: int) -> Iterator[pa.Table]:
    """Queries in blocks of ``limit``; the driver holds one at a time."""
    held = []
    for row in asking.toLocalIterator():
        held.append((row["id"], row["vector"]))
        if len(held) == limit:
            yield _table(held)
            held = []
    if held:
        yield _table(held)


def _table(rows: list[tuple[int, list[float]]]) -> pa.RecordBatch:
    ids, vectors = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(vectors, pa.list_(pa.float64()))], names=["id", "vector"]
    )


def _searcher(sent, k: int, scale: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, Queries] = {}
        for ids, columns in matrices(sent.value, scale):
            blocks[columns.shape[0]] = Queries(ids, columns, k, dims)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                for ids, columns in matrices(batch.slice(at, BATCH_ROWS), scale):
                    if columns.shape[0] in blocks:
                        blocks[columns.shape[0]].search(ids, columns)
        for block in blocks.values():
            yield from block_rows(block)

    return run


def block_rows(block: Queries) -> Iterator[pa.RecordBatch]:
    counts = [len(ids) for ids, _ in block.best]
    if not sum(counts):
        return
    ids = np.concatenate([ids for ids, _ in block.best])
    scores = [int(s) for _, score in block.best for s in score]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(block.ids, counts), pa.int64()),
            pa.array(ids, pa.int64(), mask=ids == NO_ID),
            pa.array(scores, pa.int64()),
        ],
        names=["query_id", "vec_id", "score"],
    )
