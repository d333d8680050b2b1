"""Hard negatives by angular triangle filtering, with exact integer scores.

The angle is a metric on directions. Each row stores its angles to some reference directions and is
filed under a cell: the nearest reference and a slice of the angle to it. For an anchor at angle
``a`` to a reference and rows at angles ``b`` in ``[low, high]`` the angle between them is at least the
gap of ``a`` to that interval and at most ``a + high`` (or its reflection), for every reference; cosines of
the tightest bounds times the norms, widened for rounding, bound every score of a cell. Only cells whose
bounds reach the anchor's window are visited, and inside a cell only rows whose own angle can
reach it are scored.

What an anchor needs at least is learnt beforehand from a bounded sample of rows; it only saves work. Cells
are many rows cut into pieces, so no task holds more than one piece; anchors stream past it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import mixed, written

REFERENCES = 16
SLICES = 32
SAMPLE_ROWS = 2048
PIECE_COMPONENTS = 1 << 19
# Integer components beyond this count as it, so that a score of 16 384 components fits a long.
MOST = 1 << 24
# Angles are kept in double precision; bounds are widened far beyond their rounding.
SLACK = 1e-6


def _scores(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Exact inner products of the integer rows of ``one`` and ``two``."""
    if not one.size or not two.size:
        return np.zeros((len(one), len(two)), np.int64)
    most = float(np.abs(one).max()) * float(np.abs(two).max()) * one.shape[1]
    if most < 2**53:
        return (one.astype(np.float64) @ two.astype(np.float64).T).astype(np.int64)
    return one.astype(np.int64) @ two.astype(np.int64).T


def _directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    return vectors / np.where(norms > 0, norms, 1)[:, None], norms


def references(sample: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Directions of the sample far from one another: each next one is farthest from those chosen."""
    directions, norms = _directions(np.unique(sample, axis=0))
    directions = directions[norms > 0]
    if not len(directions):
        return np.eye(1, sample.shape[1])
    chosen = [0]
    closest = directions @ directions[0]
    while len(chosen) < min(count, len(directions)):
        chosen.append(int(closest.argmin()))
        closest = np.maximum(closest, directions @ directions[chosen[-1]])
    return directions[chosen]


def angles(vectors: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles to every reference, and the norms; a zero vector, which has no direction, gets right angles."""
    directions, norms = _directions(vectors)
    return np.arccos(np.clip(directions @ refs.T, -1, 1)), norms


def cells(turned: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Cell of each row: the nearest reference and the slice of the angle to it; zero vectors have the last."""
    nearest = turned.argmin(axis=1)
    part = np.minimum((turned[np.arange(len(turned)), nearest] * (SLICES / np.pi)).astype(np.int64), SLICES - 1)
    return np.where(norms > 0, nearest * SLICES + part, turned.shape[1] * SLICES)


def cosine_bounds(turned: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest cosine between one direction and rows whose angles lie in ``[low, high]`` by reference."""
    nearest = np.maximum(np.maximum(low - turned, turned - high), 0).max(axis=-1) - SLACK
    farthest = np.minimum(turned + high, 2 * np.pi - turned - low).min(axis=-1) + SLACK
    return np.cos(np.minimum(farthest, np.pi)), np.cos(np.maximum(nearest, 0))


def score_bounds(turned, norm, low, high, least, most) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores with rows of these angles and of norms in ``[least, most]``, safe from rounding."""
    down, up = cosine_bounds(turned, low, high)
    widened = lambda x, sign: x + sign * (1 + 1e-9 * np.abs(x))
    return widened(norm * np.minimum(down * least, down * most), -1), widened(norm * np.maximum(up * least, up * most), 1)


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id."""
    near = np.arange(len(scores))
    if len(near) > k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def _matrix(column: pa.Array, dim: int, kind=np.int32) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def usable(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """``id, label, v`` of the rows that take part, one for each id."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = lambda c: F.floor(F.least(F.greatest(scale * c.cast("double"), F.lit(-float(MOST))), F.lit(float(MOST))))
    kept = rows.filter(F.col(id_col).isNotNull() & x.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.transform(x, whole).cast("array<int>").alias("v")
    )
    return kept.filter("label IS NOT NULL").groupBy("id").agg(F.min(F.struct("label", "v")).alias("row")).select("id", "row.*")


def mine(
    rows: DataFrame,
    is_anchor: Callable[[Column], Column],
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 3,
    floor: int = 50,
    ceiling: int = 95,
    scale: int = 256,
) -> DataFrame:
    """Hard negatives: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A component ``x`` becomes ``floor(scale * x)``; a score is the integer inner product with the anchor, higher
    first, ties to the smaller id. Anchors are rows whose id satisfies ``is_anchor``. An anchor's
    positives are its first ``positives`` other rows of the same label; for each of them come the first
    ``negatives`` rows of other labels whose score lies between ``floor`` and ``ceiling`` percent of the
    positive's. Fewer are returned where there are fewer; a positive with a negative score has none.
    ``label`` is an expression over ``rows`` (default: its column ``label``).

    Rows with a NULL id, label or vector, or a NULL or non-finite component take no part. Of rows that share
    an id the one with the smallest label, then the smallest vector, counts. A shorter vector is filled up with zeros.
    Integers beyond 2**24 count as 2**24. Equal vectors are ordered by id. No usable rows, no result; other columns are
    ignored. The references come from a sample of about ``SAMPLE_ROWS`` rows by a hash of the id.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    plain = written(usable(rows, id_col, vector_col, F.col("label") if label is None else label, scale), "negatives-rows")
    total, dim = plain.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not total:
        return spark.createDataFrame([], schema)
    dim = max(1, dim)

    def dense(column: pa.Array) -> np.ndarray:
        if len(column) and (np.asarray(column.value_lengths()) == dim).all():
            return column.flatten().to_numpy().reshape(-1, dim)
        return np.array([v + [0] * (dim - len(v)) for v in column.to_pylist()], np.int32).reshape(-1, dim)

    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE_ROWS / total))
    taken = plain.filter(share).limit(2 * SAMPLE_ROWS).toArrow().sort_by("id").combine_chunks()
    seen = dense(taken["v"].combine_chunks()) if taken.num_rows else np.zeros((0, dim), np.int32)
    seen_ids, seen_labels = taken["id"].to_numpy(), taken["label"].to_numpy()
    refs = references(seen if len(seen) else np.zeros((1, dim), np.int32))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = dense(batch.column("v"))
            turned, norms = angles(v, refs)
            pack = lambda part: pa.array([row.tobytes() for row in part], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pack(v.astype(np.int32)), pack(turned), pa.array(norms), pa.array(cells(turned, norms))],
                names=["id", "label", "v", "angles", "norm", "cell"],
            )

    filed_shape = "id long, label long, v binary, angles binary, norm double, cell long"
    index = written(plain.mapInArrow(file, filed_shape), "negatives-index")

    def extents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, count, least, most = {}, {}, {}, {}, {}
        for batch in batches:
            turned, cell = _matrix(batch.column("angles"), len(refs), np.float64), batch.column("cell").to_numpy()
            norm = batch.column("norm").to_numpy()
            for c in np.unique(cell).tolist():
                own = cell == c
                low[c] = np.minimum(turned[own].min(axis=0), low.get(c, np.inf))
                high[c] = np.maximum(turned[own].max(axis=0), high.get(c, -np.inf))
                least[c], most[c] = min(norm[own].min(), least.get(c, np.inf)), max(norm[own].max(), most.get(c, 0.0))
                count[c] = count.get(c, 0) + int(own.sum())
        found = [(c, r, float(low[c][r]), float(high[c][r]), float(least[c]), float(most[c]), count[c]) for c in low for r in range(len(refs))]
        names = ["cell", "ref", "low", "high", "least", "most", "members"]
        yield pa.RecordBatch.from_pylist(
            [dict(zip(names, row, strict=True)) for row in found],
            schema=pa.schema([("cell", pa.int64()), ("ref", pa.int32())] + [(n, pa.float64()) for n in names[2:6]] + [("members", pa.int64())]),
        )

    # At most REFERENCES * SLICES + 1 cells: a table of fixed size.
    sums = index.mapInArrow(extents, "cell long, ref int, low double, high double, least double, most double, members long")
    table = sums.groupBy("cell", "ref").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("least").alias("least"), F.max("most").alias("most"), F.sum("members").alias("members")
    ).orderBy("cell", "ref").toPandas()
    by_ref = lambda name: table[name].to_numpy().reshape(-1, len(refs))
    cell_ids, low, high = by_ref("cell")[:, 0], by_ref("low"), by_ref("high")
    least, most, members = by_ref("least")[:, 0], by_ref("most")[:, 0], by_ref("members")[:, 0]
    pieces = np.maximum(1, -(-members // max(1, PIECE_COMPONENTS // dim)))
    offsets = np.cumsum(pieces) - pieces

    shape = "piece long, kind int, id long, label long, v binary, angles binary, norm double, goals binary"

    def to_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            at = np.searchsorted(cell_ids, batch.column("cell").to_numpy())
            piece = offsets[at] + (mixed(ids.astype(np.uint64)) % pieces[at].astype(np.uint64)).astype(np.int64)
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece), pa.array(np.zeros(n, np.int32)), *(batch.column(c) for c in ("id", "label", "v", "angles", "norm")), pa.nulls(n, pa.binary())],
                names=["piece", "kind", "id", "label", "v", "angles", "norm", "goals"],
            )

    def visits(goal: Callable) -> Callable:
        """Anchors sent to the pieces whose score bounds meet ``goal``: a list of score windows per anchor."""

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                v, turned = _matrix(batch.column("v"), dim), _matrix(batch.column("angles"), len(refs), np.float64)
                norm, own_ids, own_labels = (batch.column(c).to_numpy() for c in ("norm", "id", "label"))
                sampled = _scores(v, seen)
                for i in range(batch.num_rows):
                    windows = goal(batch, i, own_ids[i], own_labels[i], sampled[i])
                    if not len(windows):
                        continue
                    # An angle of a zero vector says nothing: all cosines are possible, times a norm of zero.
                    bottom, top = score_bounds(turned[i], norm[i], low, high, least, most)
                    bottom, top = np.where(most > 0, bottom, -1.0), np.where(most > 0, top, 1.0)
                    met = (top >= windows[:, 0].min()) & (bottom <= windows[:, 1].max())
                    out = np.concatenate([np.arange(offsets[c], offsets[c] + pieces[c]) for c in np.flatnonzero(met)] or [np.zeros(0, np.int64)])
                    n = len(out)
                    same = lambda c: pa.array([batch.column(c)[i].as_py()] * n, batch.schema.field(c).type)  # noqa: E731, B023
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out, pa.int64()), pa.array(np.ones(n, np.int32)), *(same(c) for c in ("id", "label", "v", "angles", "norm")),
                         pa.array([windows.astype(np.float64).tobytes()] * n, pa.binary())],
                        names=["piece", "kind", "id", "label", "v", "angles", "norm", "goals"],
                    )

        return send

    def meet(alike: bool, k: int) -> Callable:
        """The first ``k`` rows of the same (else: another) label in each window of an anchor, piece by piece."""

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, held, piece_rows = None, [], None
            for batch in batches:
                piece, kind = batch.column("piece").to_numpy(), batch.column("kind").to_numpy()
                cuts = np.flatnonzero((np.diff(piece) != 0) | (np.diff(kind) != 0)) + 1
                for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(piece)], strict=True):
                    if lo == hi:
                        continue
                    if piece[lo] != current:
                        current, held, piece_rows = piece[lo], [], None
                    part = batch.slice(lo, hi - lo)
                    if kind[lo] == 0:
                        held.append(part)
                    elif held:
                        piece_rows = piece_rows or _sorted_piece(held, dim, len(refs))
                        found = _search(piece_rows, part, dim, len(refs), alike, k)
                        if found.num_rows:
                            yield found

        return scan

    def passed(anchors: DataFrame, goal: Callable, alike: bool, k: int) -> DataFrame:
        meeting = index.mapInArrow(to_pieces, shape).union(anchors.mapInArrow(visits(goal), shape))
        together = meeting.repartition("piece").sortWithinPartitions("piece", "kind")
        pairs = together.mapInArrow(meet(alike, k), "anchor_id long, goal int, id long, score long")
        order = Window.partitionBy("anchor_id", "goal").orderBy(F.desc("score"), "id")
        return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    def wants_positives(batch, i, own_id, own_label, sampled) -> np.ndarray:
        # As many sampled rows of the label as wanted are a lower bound of the last positive's score.
        known = np.sort(sampled[(seen_labels == own_label) & (seen_ids != own_id)])
        return np.array([[known[-positives] if len(known) >= positives else -np.inf, np.inf]])

    def wants_negatives(batch, i, own_id, own_label, sampled) -> np.ndarray:
        others = sampled[seen_labels != own_label]
        windows = []
        for p in batch.column("scores")[i].as_py():
            down, up = _window(p, floor, ceiling)
            known = np.sort(others[(others >= down) & (others <= up)])
            windows.append([known[-negatives] if len(known) >= negatives else down, up])
        return np.array(windows)

    anchors = index.filter(is_anchor(F.col("id")))
    near = written(passed(anchors, wants_positives, True, positives).select("anchor_id", "id", "score", "rank"), "negatives-positives")
    goals = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("found"))
    ready = anchors.join(goals, anchors["id"] == goals["anchor_id"]).select(*anchors.columns, F.col("found.score").alias("scores"))
    hard = passed(ready, wants_negatives, False, negatives)
    wanted = near.select("anchor_id", (F.col("rank") - 1).alias("goal"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(wanted, ["anchor_id", "goal"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _window(score: int, floor: int, ceiling: int) -> tuple[int, int]:
    """Least and greatest integer between ``floor`` and ``ceiling`` percent of ``score``."""
    return -(-floor * score // 100), ceiling * score // 100


def _sorted_piece(held: list[pa.RecordBatch], dim: int, refs: int) -> dict[str, np.ndarray]:
    """The rows of a piece by their angle to the nearest reference of the piece's first row."""
    rows = pa.Table.from_batches(held).combine_chunks()
    one = lambda name: rows[name].combine_chunks()
    turned, norm = _matrix(one("angles"), refs, np.float64), rows["norm"].to_numpy()
    ref = int(turned[0].argmin())
    order = np.lexsort((rows["id"].to_numpy(), turned[:, ref]))
    out = {"id": rows["id"].to_numpy()[order], "label": rows["label"].to_numpy()[order], "v": _matrix(one("v"), dim)[order]}
    return out | {"angle": turned[order, ref], "ref": ref, "norm": norm[order], "most": float(norm.max())}


def _search(rows: dict, anchors: pa.RecordBatch, dim: int, refs: int, alike: bool, k: int) -> pa.RecordBatch:
    v, turned = _matrix(anchors.column("v"), dim), _matrix(anchors.column("angles"), refs, np.float64)[:, rows["ref"]]
    ids, labels, norms = (anchors.column(c).to_numpy() for c in ("id", "label", "norm"))
    goals = [np.frombuffer(g, np.float64).reshape(-1, 2) for g in anchors.column("goals").to_pylist()]
    # The widest angle at which a row of the piece can still reach an anchor's lowest window.
    need = np.array([g[:, 0].min() for g in goals])
    reach = norms * rows["most"]
    cosine = np.where(reach > 0, (need - 1) / np.where(reach > 0, reach, 1) - 1e-9, -1.0)
    apart = np.where((cosine > -1) & (reach > 0), np.arccos(np.clip(cosine, -1, 1)), np.pi) + SLACK
    # No angle to a reference tells anything about a zero vector; its piece is scored whole.
    apart = np.where(rows["most"] > 0, apart, 4.0)
    start = np.searchsorted(rows["angle"], turned - apart)
    stop = np.searchsorted(rows["angle"], turned + apart, side="right")
    out = []
    order = np.argsort(start, kind="stable")
    for at in range(0, len(order), 64):
        some = order[at : at + 64]
        lo, hi = int(start[some].min()), int(stop[some].max())
        if lo >= hi:
            continue
        scores = _scores(v[some], rows["v"][lo:hi])
        for row, i in zip(scores, some.tolist(), strict=True):
            same = rows["label"][lo:hi] == labels[i]
            fit = np.flatnonzero(same & (rows["id"][lo:hi] != ids[i]) if alike else ~same)
            for number, (down, up) in enumerate(goals[i]):
                inside = fit[(row[fit] >= down) & (row[fit] <= up)]
                best = inside[_first(rows["id"][lo:hi][inside], row[inside], k)]
                out.append((np.full(len(best), ids[i]), np.full(len(best), number, np.int32), rows["id"][lo:hi][best], row[best]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, t) for t in (np.int64, np.int32, np.int64, np.int64)]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["anchor_id", "goal", "id", "score"])


ORACLE = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS alike, r.vec_id AS other, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
ranked AS (
  SELECT p.*, s.other AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other)::INTEGER AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
