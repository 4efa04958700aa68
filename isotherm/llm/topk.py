"""Exact top-k inner-product search by ball trees, one per shard of the candidates.

A shard's vectors form a binary tree of balls. For a query and a ball the inner
product is at most ``q.centre + |q| * radius``. A query visits the leaves of a
shard in order of that bound and stops when it is below its current k-th score.
The k-th score is shared: a first round over one shard per query gives every
query a k-th score, which bounds the search in all shards.

Queries and shards are packed into blocks of fixed size, and each pair of a query
block and a shard is one row; no group is collected, and vectors are never
broadcast, only the names of the first round's shards, at most one per slot. A
shard's rows come one after the other, so that its tree is built once per task.

Defined cases: null vectors and vectors with null or non-finite components take
no part; equal scores go to the smaller id; rows that repeat an id are
candidates each on its own, but not of a query with that id; with fewer
than k candidates all are returned; vectors of unequal length, and components
too large for an exact result (a score of 2**53 or more), are an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isotherm.llm.frames import stored, width

SHARD_ROWS, QUERY_ROWS, LEAF_ROWS, SCALE = 8192, 1024, 128, 256


class BallTree:
    """Leaves of a binary tree over vectors, each with centre and radius."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.leaves, todo = [], [np.arange(len(vectors))]
        while todo:
            rows = todo.pop()
            points = vectors[rows]
            centre = points.mean(0)
            distance = ((points - centre) ** 2).sum(1)
            if len(rows) <= LEAF_ROWS or not distance.max() > 0:
                self.leaves += [rows[i : i + LEAF_ROWS] for i in range(0, len(rows), LEAF_ROWS)]
                continue
            pole = points[distance.argmax()]
            other = points[((points - pole) ** 2).sum(1).argmax()]
            side = points @ (other - pole)
            cut = np.argsort(side, kind="stable")
            todo += [rows[cut[: len(cut) // 2]], rows[cut[len(cut) // 2 :]]]
        self.centres = np.array([vectors[rows].mean(0) for rows in self.leaves])
        self.radii = np.array(
            [np.sqrt(((vectors[rows] - c) ** 2).sum(1).max()) for rows, c in zip(self.leaves, self.centres, strict=True)]
        )
        self.vectors, self.ids = vectors, ids

    def search(self, queries: np.ndarray, own: np.ndarray, best_score: np.ndarray, best_id: np.ndarray) -> None:
        """Improve each query's best scores (descending, ids ascending among equals) in place."""
        norms = np.sqrt((queries**2).sum(1))
        bounds = queries @ self.centres.T + norms[:, None] * self.radii
        bounds += 1e-6 * (1 + np.abs(bounds))  # rounding must not hide a candidate
        order = np.argsort(-bounds, axis=1, kind="stable")
        active = np.arange(len(queries))
        for turn in range(len(self.leaves)):
            leaf = order[active, turn]
            going = bounds[active, leaf] >= best_score[active, -1]
            active, leaf = active[going], leaf[going]
            if not len(active):
                return
            for number in np.unique(leaf):
                asking, rows = active[leaf == number], self.leaves[number]
                self._improve(asking, queries[asking] @ self.vectors[rows].T, self.ids[rows], own, best_score, best_id)

    @staticmethod
    def _improve(asking, scores, ids, own, best_score, best_id) -> None:
        k = best_score.shape[1]
        scores[own[asking][:, None] == ids[None]] = -np.inf
        all_scores = np.concatenate([best_score[asking], scores], 1)
        all_ids = np.concatenate([best_id[asking], np.broadcast_to(ids, scores.shape)], 1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        best_score[asking] = np.take_along_axis(all_scores, order, 1)
        best_id[asking] = np.take_along_axis(all_ids, order, 1)


def whole_vectors(rows: DataFrame, vector_col: str, scale: int = SCALE) -> DataFrame:
    """``vec_id, vector``: components as floor(scale * x); vectors with a missing or non-finite component are left out."""
    vector = F.col(vector_col)
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    found = rows.where(F.col("vec_id").isNotNull() & vector.isNotNull() & usable)
    return found.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("vector"))


def _blocks(rows: DataFrame, most: int, name: str) -> DataFrame:
    """Rows packed per task into blocks: ``(name, ids, vectors)`` as binary."""
    schema = pa.schema([("ids", pa.binary()), ("vectors", pa.binary())])

    def block(ids: list, vectors: list) -> pa.RecordBatch:
        packed = [np.array(ids, np.int64).tobytes(), np.array(vectors, np.float64).astype("<f8").tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in packed], schema=schema)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            vectors += batch.column(1).to_pylist()
            while len(ids) >= most:
                yield block(ids[:most], vectors[:most])
                ids, vectors = ids[most:], vectors[most:]
        if ids:
            yield block(ids, vectors)

    return rows.mapInArrow(task, "ids binary, vectors binary").withColumn(name, F.monotonically_increasing_id())


def _searched(row: dict, k: int, tree: BallTree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, best scores and their ids of one query block in one shard."""
    query_ids, queries = _unpacked(row["query_ids"], row["query_vectors"])
    if queries.shape[1] != tree.vectors.shape[1]:
        raise ValueError("vectors of unequal length")
    if np.abs(queries).max(initial=0) * np.abs(tree.vectors).max(initial=0) * queries.shape[1] >= 2**53:
        raise ValueError("components are too large for exact scores")
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    best = np.full((len(queries), k), -np.inf)
    if row.get("kth") is not None:
        # The shared k-th score stands in for the places that this shard has not filled yet.
        best[:] = np.array(row["kth"])[:, None]
    tree.search(queries, query_ids, best, best_id)
    return query_ids, best, best_id


def _unpacked(ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, np.int64)
    return found, np.frombuffer(data, "<f8").reshape(len(found), -1)


def _each_pair(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[tuple]:
    held, tree = None, None
    for batch in batches:
        for row in batch.to_pylist():
            if held != row["shard"]:
                ids, vectors = _unpacked(row["ids"], row["vectors"])
                held, tree = row["shard"], BallTree(vectors, ids)
            yield row["block"], *_searched(row, k, tree)


def _first_shards(blocks: DataFrame, shards: DataFrame) -> DataFrame:
    """``blocks`` with one ``shard`` each, dealt over those that are the first of their slot.

    At most one row per slot reaches the driver, whatever the number of shards.
    """
    first = shards.groupBy("slot").agg(F.min("shard").alias("shard")).select("shard").collect()
    offered = blocks.sparkSession.createDataFrame([(n, row["shard"]) for n, row in enumerate(first)], "turn long, shard long")
    turn = F.pmod(F.xxhash64("block"), F.lit(max(len(first), 1)).cast("long"))
    return blocks.withColumn("turn", turn).join(offered, "turn").drop("turn")


def top_k(rows: DataFrame, is_query: Column, k: int = 5, vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` candidates of highest integer inner product of each query.

    ``rows`` has ``vec_id`` and the vectors; all are candidates but for a query's
    own id. A repeated id is one query, with its smallest vector.
    """
    usable = whole_vectors(rows, vector_col, scale)
    asked = whole_vectors(rows.where(is_query), vector_col, scale).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    slots = 4 * width(rows)
    shards = stored(_blocks(usable, SHARD_ROWS, "shard"), "shards")
    shards = shards.withColumn("slot", F.pmod(F.xxhash64("shard"), F.lit(slots)))
    blocks = stored(_blocks(asked, QUERY_ROWS, "block"), "queries").withColumnsRenamed({"ids": "query_ids", "vectors": "query_vectors"})

    def first_round(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, best, _ in _each_pair(batches, k):
            columns = [pa.array([block]), pa.array([best[:, -1].tolist()], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "kth"])

    def all_shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, query_ids, best, best_id in _each_pair(batches, k):
            found = best_id != np.iinfo(np.int64).max
            found &= best > -np.inf
            columns = [np.broadcast_to(query_ids[:, None], best.shape)[found], best_id[found], best[found].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    # A merge join gives all rows of one row on its left before the next one's.
    merged = shards.hint("merge")
    one_each = merged.drop("slot").join(_first_shards(blocks, shards), "shard")
    kth = one_each.mapInArrow(first_round, "block long, kth array<double>")
    bounded = stored(blocks.hint("merge").join(kth, "block"), "bounds")
    asking = bounded.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))))
    found = merged.join(asking, "slot").mapInArrow(all_shards, "query_id long, vec_id long, score long")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
