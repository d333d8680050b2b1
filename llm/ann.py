"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample; every vector is then filed under the leaf it descends to. A
query walks the tree with a priority queue of nodes by distance and so meets the leaves in the order
of promise. How many leaves it visits is calibrated: visits widen until the neighbours of some sample
queries, found by brute force over all rows, lie in the visited leaves as often as wanted. Visits and
vectors meet by leaf; a large leaf is cut into pieces, so no task holds more than one piece.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import mixed, written

SAMPLE_ROWS = 16_384
BRANCHES = 8
LEAF_POINTS = 48
CALIBRATION_QUERIES = 128
PIECE_ROWS = 2048


@dataclass
class Tree:
    """Centres of all nodes, the children of each, and the leaf number of those without any."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: list[int]

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def file(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector, going to the nearest child (ties: the first) at every level."""
        out = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
                continue
            nearest = _nearest(vectors[rows], self.centres[below])
            todo.extend((child, rows[nearest == i]) for i, child in enumerate(below) if (nearest == i).any())
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order: the nearest waiting node is opened next."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                yield self.leaf[node]
                continue
            apart = ((self.centres[below] - query) ** 2).sum(axis=1)
            for child, distance in zip(below, apart.tolist(), strict=True):
                heapq.heappush(queue, (distance, child))


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    # |v|^2 is the same for all centres.
    return ((centres**2).sum(axis=1) - 2 * vectors @ centres.T).argmin(axis=1)


def grow(sample: np.ndarray, branches: int = BRANCHES, leaf_points: int = LEAF_POINTS, seed: int = 5) -> Tree:
    """Hierarchical k-means over distinct sample vectors."""
    points = np.unique(sample.astype(np.float64), axis=0)
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    centres = [points.mean(axis=0) if len(points) else np.zeros(dim)]
    children: list[list[int]] = [[]]
    todo = [(0, points)]
    while todo:
        node, own = todo.pop()
        if len(own) <= leaf_points:
            continue
        middle = own[rng.choice(len(own), min(branches, len(own)), replace=False)]
        for _ in range(10):
            label = _nearest(own, middle)
            middle = np.stack([own[label == i].mean(axis=0) if (label == i).any() else middle[i] for i in range(len(middle))])
        label = _nearest(own, middle)
        parts = [(middle[i], own[label == i]) for i in range(len(middle)) if (label == i).any()]
        if len(parts) < 2:
            continue
        for centre, part in parts:
            children[node].append(len(centres))
            todo.append((len(centres), part))
            centres.append(centre)
            children.append([])
    leaf, n = [], 0
    for below in children:
        leaf.append(-1 if below else n)
        n += not below
    return Tree(np.array(centres), children, leaf)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector`` of the rows that take part: an id, and finite components that are not all zero."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).select(
        F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("vector")
    )


def _best(ids: np.ndarray, points: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """``(query_id, id, distance)`` of the ``k`` nearest points of each query, own id left out."""
    found = []
    block = max(1, 2_000_000 // max(1, points.size))
    for at in range(0, len(queries), block):
        some = queries[at : at + block]
        apart = np.sqrt(((some[:, None, :] - points[None]) ** 2).sum(axis=2))
        apart[query_ids[at : at + block][:, None] == ids[None]] = np.inf
        for row, q in zip(apart, query_ids[at : at + block].tolist(), strict=True):
            # All points as near as the k-th take part in the ordering: ties go by id.
            near = np.flatnonzero(row <= np.partition(row, k - 1)[k - 1]) if len(row) > k else np.arange(len(row))
            near = near[np.lexsort((ids[near], row[near]))][:k]
            near = near[np.isfinite(row[near])]
            found.append((np.full(len(near), q), ids[near], row[near]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _within(found, k: int, limit: dict[int, float]):
    """Pairs no farther than the limit of their query, which full lists of ``k`` tighten."""
    query_ids, ids, scores = found
    starts = np.flatnonzero(np.concatenate([[True], query_ids[1:] != query_ids[:-1]])) if len(query_ids) else []
    most = np.empty(len(query_ids))
    for lo, hi in zip(starts, [*starts[1:], len(query_ids)], strict=True):
        query = int(query_ids[lo])
        if hi - lo == k:
            limit[query] = min(limit.get(query, np.inf), float(scores[hi - 1]))
        most[lo:hi] = limit.get(query, np.inf)
    keep = scores <= most
    return query_ids[keep], ids[keep], scores[keep]


def _distinct(ids: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, first = np.unique(ids, return_index=True)
    return ids[first], points[first]


_PAIRS = "query_id long, id long, score double"


def _pairs(found) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["query_id", "id", "score"])


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    recall: float = 0.97,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The ``k`` nearest found rows of each query row: ``query_id, rank, vec_id, score``.

    ``is_query`` makes a condition of the id column; every other row is a candidate. Vectors that are
    NULL, zero, or hold a NULL or non-finite component take no part, nor do those without an id or
    of another length than most (ties: the longest). Rows that repeat an id count once, and a
    query's own id is no candidate. Distances are Euclidean, in double precision on the given
    vectors, ties to the smaller id. With ``k`` candidates or fewer all are returned; no usable
    rows, no result. Other columns are ignored.

    The tree is fitted on about ``sample_rows`` vectors chosen by a hash of the id (at most twice as
    many), and calibrated with ``CALIBRATION_QUERIES`` of them against all rows. All else covers
    every row.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    schema = "query_id long, rank int, vec_id long, score double"
    lengths = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    dim, total = lengths
    rows = rows.filter(F.size("vector") == dim)
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample_rows / total))
    taken = rows.filter(share).limit(2 * sample_rows).toArrow()
    sample = np.array(taken.column("vector").to_pylist(), np.float64).reshape(-1, dim)
    sample_ids = np.array(taken.column("id").to_pylist(), np.int64)
    order = np.argsort(sample_ids, kind="stable")
    sample, sample_ids = sample[order], sample_ids[order]
    tree = grow(sample) if len(sample) else Tree(np.zeros((1, dim)), [[]], [0])

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.array(batch.column("vector").to_pylist(), np.float64).reshape(-1, dim)
            raw = [p.tobytes() for p in points]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(tree.file(points)), pa.array(raw, pa.binary())], names=["id", "leaf", "vector"]
            )

    index = written(rows.mapInArrow(file, "id long, leaf long, vector binary"), "ann-index")
    counts = np.zeros(tree.leaves, np.int64)
    for leaf, n in index.groupBy("leaf").count().collect():
        counts[leaf] = n
    visits = _calibrated(index, tree, sample_ids, sample, dim, k, recall)
    pieces = np.maximum(1, -(-counts // PIECE_ROWS))
    # Pieces of all leaves are numbered through.
    offsets = np.cumsum(pieces) - pieces

    def to_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            leaf = batch.column("leaf").to_numpy()
            piece = offsets[leaf] + (mixed(ids.astype(np.uint64)) % pieces[leaf].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece), pa.array(np.zeros(len(ids), np.int32)), batch.column("id"), batch.column("vector")],
                names=["piece", "kind", "id", "vector"],
            )

    def to_visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("vector").to_pylist()
            for query, data in zip(batch.column("id").to_pylist(), raw, strict=True):
                seen, met, out = 0, 0, []
                for leaf in tree.visits(np.frombuffer(data, np.float64)):
                    out.extend(range(offsets[leaf], offsets[leaf] + pieces[leaf]))
                    seen, met = seen + 1, met + counts[leaf]
                    # At least as many candidates as wanted, beside the query itself.
                    if seen >= visits and met > k:
                        break
                n = len(out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out, pa.int64()), pa.array([1] * n, pa.int32()), pa.array([query] * n, pa.int64()), pa.array([data] * n, pa.binary())],
                    names=["piece", "kind", "id", "vector"],
                )

    shape = "piece long, kind int, id long, vector binary"
    queries = index.filter(is_query(F.col("id"))).dropDuplicates(["id"])
    meeting = (
        index.mapInArrow(to_pieces, shape)
        .union(queries.mapInArrow(to_visits, shape))
        .repartition("piece")
        .sortWithinPartitions("piece", "kind")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Within a piece its vectors come first; queries then pass by batch after batch.
        current, ids, points = None, [], []
        # No neighbour lies beyond the k-th best that one piece has shown; farther pairs are not sent.
        limit: dict[int, float] = {}
        for batch in batches:
            piece = batch.column("piece").to_numpy()
            kind = batch.column("kind").to_numpy()
            own = batch.column("id").to_numpy()
            data = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.float64).reshape(-1, dim)
            cuts = np.flatnonzero((np.diff(piece) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(piece)], strict=True):
                if lo == hi:
                    continue
                if piece[lo] != current:
                    current, ids, points = piece[lo], [], []
                if kind[lo] == 0:
                    ids.append(own[lo:hi])
                    points.append(data[lo:hi])
                elif ids:
                    one_ids, one_points = _distinct(np.concatenate(ids), np.concatenate(points))
                    ids, points = [one_ids], [one_points]
                    yield _pairs(_within(_best(one_ids, one_points, own[lo:hi], data[lo:hi], k), k, limit))

    pairs = meeting.mapInArrow(meet, _PAIRS).groupBy("query_id", "id").agg(F.min("score").alias("score"))
    return _ranked(pairs, k).select("query_id", F.col("rank").cast("int"), F.col("id").alias("vec_id"), "score")


def _calibrated(index: DataFrame, tree: Tree, ids: np.ndarray, sample: np.ndarray, dim: int, k: int, recall: float) -> int:
    """The number of leaves to visit, widened until the wanted share of true neighbours is met."""
    if not len(ids):
        return tree.leaves
    ids, first = np.unique(ids, return_index=True)
    chosen = np.argsort(mixed(ids.astype(np.uint64)), kind="stable")[:CALIBRATION_QUERIES]
    query_ids, queries = ids[chosen], sample[first][chosen]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.float64).reshape(-1, dim)
            own, leaf = batch.column("id").to_numpy(), batch.column("leaf").to_numpy()
            for at in range(0, len(own), PIECE_ROWS):
                part = slice(at, at + PIECE_ROWS)
                # An id that is repeated with other vectors may have several leaves; one is kept.
                one_ids, first_at = np.unique(own[part], return_index=True)
                found = _best(one_ids, points[part][first_at], query_ids, queries, k)
                leaves = leaf[part][first_at][np.searchsorted(one_ids, found[1])]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, found), pa.array(leaves)], names=["query_id", "id", "score", "leaf"]
                )

    nearest = _ranked(index.mapInArrow(scan, _PAIRS + ", leaf long"), k).select("query_id", "leaf").collect()
    orders = {int(q): {leaf: i for i, leaf in enumerate(tree.visits(v))} for q, v in zip(query_ids, queries, strict=True)}
    needed = np.sort([orders[q][leaf] + 1 for q, leaf in nearest])
    visits = 1
    while len(needed) and np.searchsorted(needed, visits, side="right") < recall * len(needed) and visits < tree.leaves:
        visits = min(tree.leaves, visits + max(1, visits // 8))
    return visits
