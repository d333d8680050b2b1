"""Near-duplicate sets by a join in the Jaccard metric: Voronoi regions, triangle windows, exact tests.

The Jaccard distance is a metric, so a document within ``r`` of another is no farther than ``r`` more
from any pivot. Almost all documents are at distance 1 from one another, though, and documents as
pivots would tell nothing apart. So the first pivots are the sets of a single shingle. All that a document holds are
equally near; a fixed order of the shingles (crowded ones last) breaks the tie, and the document's own region is that of
its first shingle. A partner within ``r`` lacks at most ``floor(r * n)`` of its ``n`` shingles, so
the regions of that many further shingles are the boundary window it is copied to. The window is widened a
little (``_margin``): linked documents then share not one region but ``min(margin)`` of them, which the pairs of
small regions must show before any set is fetched.

Every document is first tested against the smallest document of its regions; regions whose documents that
has connected are done. In small open regions, pairs of different components whose sizes lie within the window of the empty pivot
and that share enough regions are tested. A crowded open region gets documents as pivots: it is
joined recursively, each document going to its nearest pivot and to every pivot not farther
than ``2 r`` more, until a region is small, connected, or no longer shrinks; then its pairs within the pivots' windows
are tested. A region too large for a task meets itself in pairs of blocks. All tests are on full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import by_key, components, likely, marked, shingle_sets, spread_join, tidy, written

# The most crowded shingles come last in the order of pivots; this many at most, from this crowd on.
CROWDED = 1 << 16
CROWD = 16
# Open regions up to this size form pairs; larger ones are joined as regions.
SMALL = 64
BLOCK_SHINGLES = 1 << 19
BLOCK_MEMBERS = 2048
PIVOTS = 8
LEAF = 32


def _margin(n):
    return 1 + n // 16


def _window(n: int, percent: int) -> int:
    """Number of first shingles in whose regions a set of ``n`` must be."""
    return min(n, (100 - percent) * n // 100 + _margin(n))


def ordered_window(shingles: np.ndarray, crowded: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a sorted set: by hash, those in ``crowded`` (sorted) after all others."""
    wanted = _window(len(shingles), percent)
    if not len(crowded):
        return shingles[:wanted]
    late = crowded[np.minimum(np.searchsorted(crowded, shingles), len(crowded) - 1)] == shingles
    first = shingles[~late][:wanted]
    return np.concatenate([first, shingles[late][: wanted - len(first)]])


def _longs(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int32)
    values = np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def profiles(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Set size, digest and the window of first shingles, by hash alone, of each row of ``id, text``."""

    @tidy
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            sizes, digests, low = [], [], []
            for found in shingle_sets(raw, width):
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                low.append(found[: _window(len(found), percent)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), _longs(low)], names=["id", "n", "digest", "low"]
            )

    return texts.mapInArrow(profile, "id long, n long, digest binary, low array<long>")


def _unfolded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each first shingle."""
    for batch in batches:
        low = batch.column("low")
        size = np.asarray(low.value_lengths())
        columns = [pa.array(np.repeat(batch.column(c).to_numpy(), size)) for c in ("first", "n")]
        yield pa.RecordBatch.from_arrays([*columns, low.flatten()], names=["id", "n", "pivot"])


def full_sets(texts: DataFrame, ids: DataFrame, crowded: np.ndarray, width: int, percent: int) -> DataFrame:
    """``id, n, shingles, folds, pivots`` of the rows whose id is in ``ids``, written.

    ``folds`` are the leading 16 bits of each hash, in order.
    """

    @tidy
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            # Sets leave in small batches: they are larger than their texts.
            for at in range(0, len(raw), 256):
                sets = list(shingle_sets(raw[at : at + 256], width))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(at, 256),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                        pa.array([(s >> np.uint64(48)).astype(np.uint16).tobytes() for s in sets], pa.binary()),
                        _longs([ordered_window(s, crowded, percent) for s in sets]),
                    ],
                    names=["id", "n", "shingles", "folds", "pivots"],
                )

    wanted = texts.filter(F.col("text").isNotNull()).join(ids, "id", "left_semi")
    return written(wanted.mapInArrow(shingle, "id long, n long, shingles binary, folds binary, pivots array<long>"), "jaccard-sets")


def _close(n_a: Column, n_b: Column, percent: int) -> Column:
    """Sizes that allow a link."""
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def _set(value: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint64)


def _in_common(one: np.ndarray, two: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    at = np.minimum(np.searchsorted(two, one), len(two) - 1)
    return int((two[at] == one).sum())


def _numbered(folds: np.ndarray) -> np.ndarray:
    """Equal folds told apart by their number, so that a multiset becomes a set."""
    return (folds.astype(np.int64) << 32) + np.arange(len(folds)) - np.searchsorted(folds, folds)


def _compared(pairs: DataFrame, sets: DataFrame, column: str, percent: int, name: str) -> DataFrame:
    """The pairs ``a, b`` whose sets in ``column`` are close enough; many pairs may share one ``a``."""
    # Few sets are in a pair; the others are not shuffled.
    side = lambda s: likely(sets.select(F.col("id").alias(s), F.col(column).alias(f"s_{s}")), pairs, s)
    centres = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("pairs"), F.min("b").alias("one")).join(side("a"), "a")
    both = spread_join(pairs.join(side("b"), "b"), centres, "a", "b", "one", "pairs")
    read = _set if column == "shingles" else lambda value: _numbered(np.frombuffer(value.as_buffer(), np.uint16))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("s_a"), batch.column("s_b"), strict=True):
                one, two = read(x), read(y)
                common = _in_common(one, two)
                keep.append(100 * common >= percent * (len(one) + len(two) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return written(both.mapInArrow(compare, "a long, b long").distinct(), name)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are close enough.

    Folding can only bring sets closer, so folded sets, a quarter of the bytes, rule most pairs out first.
    """
    near = _compared(written(pairs.select("a", "b"), "jaccard-pairs"), sets, "folds", percent, "jaccard-near")
    return _compared(near, sets, "shingles", percent, "jaccard-links")


class Region:
    """Documents of a region with their sets, and what is connected among them."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray, sides: np.ndarray, percent: int):
        self.n = np.array([len(s) for s in sets])
        codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
        self.codes = np.split(codes, np.cumsum(self.n)[:-1])
        self.mark = np.zeros(int(codes.max()) + 1, bool)
        self.labels, self.sides, self.percent = labels, sides, percent
        self.radius = 1 - percent / 100
        self.up: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, label: int) -> int:
        while (above := self.up.get(label, label)) != label:
            label = above
        return label

    def shared(self, i: int, rows: np.ndarray, flat: np.ndarray | None = None) -> np.ndarray:
        """Number of shingles that row ``i`` shares with each of ``rows``."""
        flat = np.concatenate([self.codes[j] for j in rows]) if flat is None else flat
        self.mark[self.codes[i]] = True
        starts = np.cumsum(self.n[rows]) - self.n[rows]
        found = np.add.reduceat(self.mark[flat].astype(np.int64), starts)
        self.mark[self.codes[i]] = False
        return found

    def test(self, i: int, rows: np.ndarray, common: np.ndarray) -> None:
        for j in rows[100 * common >= self.percent * (self.n[i] + self.n[rows] - common)].tolist():
            x, y = self.root(int(self.labels[i])), self.root(int(self.labels[j]))
            if x != y:
                self.up[max(x, y)] = min(x, y)
                self.links.append((i, j))

    def roots(self, rows: np.ndarray) -> np.ndarray:
        names, local = np.unique(self.labels[rows], return_inverse=True)
        return np.array([self.root(x) for x in names.tolist()])[local]

    def join(self, rows: np.ndarray) -> None:
        """Link whatever among ``rows`` is close and not connected yet."""
        if len(np.unique(self.roots(rows))) < 2:
            return
        if len(rows) <= LEAF:
            self.pairs(rows, np.zeros((1, len(rows))))
            return
        flat = np.concatenate([self.codes[j] for j in rows])
        apart, at = [], 0
        for _ in range(PIVOTS):
            common = self.shared(int(rows[at]), rows, flat)
            self.test(int(rows[at]), rows, common)
            apart.append(1 - common / (self.n[rows[at]] + self.n[rows] - common))
            # The next pivot is the document farthest from those before.
            at = int(np.min(apart, axis=0).argmax())
        apart = np.array(apart)
        near = apart.min(axis=0)
        for one in apart:
            region = one <= near + 2 * self.radius + 1e-9
            if region.sum() > 0.8 * len(rows):
                # Regions no longer shrink: the windows of the pivots are left.
                self.pairs(rows, apart)
                return
        for one in apart:
            if (one == near).any():
                self.join(rows[one <= near + 2 * self.radius + 1e-9])

    def pairs(self, rows: np.ndarray, apart: np.ndarray) -> None:
        for k, i in enumerate(rows.tolist()):
            later = np.arange(k + 1, len(rows))
            small, large = np.minimum(self.n[rows[later]], self.n[i]), np.maximum(self.n[rows[later]], self.n[i])
            fits = (100 * small >= self.percent * large) & (self.sides[rows[later]] != self.sides[i])
            fits &= (np.abs(apart[:, later] - apart[:, k : k + 1]) <= self.radius + 1e-9).all(axis=0)
            later = later[fits]
            if len(later):
                later = later[self.roots(rows[later]) != self.root(int(self.labels[i]))]
            if len(later):
                self.test(i, rows[later], self.shared(i, rows[later]))


def region_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between different components of a region; ``members`` has ``pivot, id, label``.

    ``sets`` has ``id, n, shingles``. Members are dealt to tasks first, and then get their sets.
    """
    near = likely(sets.select("id", "n", "shingles"), members, "id")
    sizes = near.groupBy("id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    load = members.join(sizes, "id").groupBy("pivot").agg(F.sum("n").alias("shingles"), F.sum("texts").alias("members"))
    blocks = F.greatest(F.ceil(F.col("shingles") / BLOCK_SHINGLES), F.ceil(F.col("members") / BLOCK_MEMBERS)).cast("int")
    dealt = (
        members.join(load.select("pivot", blocks.alias("blocks")), "pivot")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("place", F.xxhash64("pivot", F.least("block", "other"), F.greatest("block", "other")))
        .select("place", "id", "label", "block", "other")
        .join(near.select("id", "shingles"), "id")
        .repartition("place")
        .sortWithinPartitions("place")
    )

    @tidy
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_key(batches, "place"):
            ids, labels, block, other = (rows.column(c).to_numpy() for c in ("id", "label", "block", "other"))
            # Pairs within a block are tested where it meets itself: there every row is a side of its own.
            sides = np.where(block == other, np.arange(len(ids)) + len(ids), block)
            sides = np.unique(sides, return_inverse=True)[1]
            region = Region([_set(v) for v in rows.column("shingles")], labels, sides, percent)
            region.join(np.arange(len(ids)))
            if region.links:
                a, b = np.array(region.links).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(ids[a], ids[b])), pa.array(np.maximum(ids[a], ids[b]))], names=["a", "b"]
                )

    return written(dealt.mapInArrow(link, "a long, b long").distinct(), "jaccard-links")


def near_sets(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Words are runs of other characters than blank, tab, line and page ends, with A-Z in lower case. A document's
    set holds its distinct runs of ``width`` words; a shorter text is one shingle as a whole. Two documents
    link if ``100 * |A and B| >= percent * |A or B|``; a component is whatever links connect, named by its
    smallest id. No link is missed. NULL, empty and blank texts have an empty set and are linked with nothing. A row
    without an id is in no component (NULL). Rows that repeat an id are rows of their own with the same
    name: as long as that id is the smallest of its equal sets, whatever is linked to one of its texts
    is linked to all. An empty table gives no rows; other columns are ignored.
    """
    if not 50 < percent <= 100 or not 1 <= width <= 5:
        raise ValueError("percent must be in 51..100 and width in 1..5")
    texts = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = written(profiles(texts, width, percent), "jaccard-profiles")
    filled = rows.filter("n > 0 AND id IS NOT NULL")
    # Equal sets are one class, which goes on as its smallest id.
    first = F.min("id").alias("first")
    classes = filled.groupBy("digest").agg(first, F.count(F.lit(1)).alias("members"))
    # Sets alone in their class, most of them, need not be shuffled to be one.
    told = marked(filled, classes.filter("members > 1"), "digest")
    alone = told.filter("NOT _marked").select(F.col("id").alias("first"), "n", "low")
    equal = told.filter("_marked").groupBy("digest").agg(first, F.any_value("n").alias("n"), F.any_value("low").alias("low"))
    low = alone.unionByName(equal.drop("digest")).mapInArrow(_unfolded, "id long, n long, pivot long")
    # Most first shingles are in one set alone, so counts shuffled by themselves would be as many; counted in place, they are shuffled once.
    crowds = low.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("pivot")))
    met = written(crowds.filter("members > 1"), "jaccard-met")
    # Linked documents share at least as many first shingles as the smaller margin, in whatever order.
    least = F.expr(f"1 + (n * {percent} + 99) div 100 div 16")
    candidates = written(met.groupBy("id", "n").count().filter(F.col("count") >= least).select("id").distinct(), "jaccard-candidates")
    again = met.join(candidates, "id", "left_semi").groupBy("pivot").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > CROWD)
    most = again.orderBy(F.desc("members"), "pivot").limit(CROWDED).select("pivot").toArrow()
    crowded = np.sort(most.column("pivot").to_numpy().view(np.uint64))
    sets = full_sets(texts, candidates, crowded, width, percent)

    placed = sets.select("id", "n", F.posexplode("pivots").alias("place", "pivot"))
    digest = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), F.col("id"))).alias(f"digest{seed}")
    # A region's rows are smaller than its sums, of which each task would send its own.
    regions = placed.select("pivot", "id", "n").repartition("pivot").groupBy("pivot").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("id", "n")).alias("low"), digest(1), digest(2))
    # Regions with the same documents are one.
    once = regions.filter("members > 1").groupBy("members", "low", "digest1", "digest2").agg(F.min("pivot").alias("pivot"), F.count(F.lit(1)).alias("weight"))
    joined = placed.join(once.drop("digest1", "digest2"), "pivot")
    able = joined.groupBy("id", "n").agg(F.sum("weight").alias("met")).filter(F.col("met") >= least).select("id").distinct()
    shared = written(joined.join(able, "id", "left_semi"), "jaccard-regions")

    # Of a pair's shingles before one that both have in their windows, the shared ones are among those counted; the
    # others are in one of the two alone, and a linked pair has few of them.
    unlike = lambda n_a, n_b: F.floor((100 - percent) * (n_a + n_b) / (100 + percent) + 1e-6)
    stars = shared.filter(F.col("low.id") < F.col("id")).filter(_close(F.col("n"), F.col("low.n"), percent))
    best = (
        stars.groupBy("id", "n", "low").agg(F.sum("weight").alias("weight"), F.max("place").alias("place"))
        .filter(F.col("place") + 1 - F.col("weight") <= unlike(F.col("n"), F.col("low.n")))
        .groupBy(F.col("id").alias("b")).agg(F.max_by("low.id", F.struct("weight", -F.col("low.id"))).alias("a"))
    )
    links = verified(best, sets, percent)
    found = components(links)
    labelled = shared.join(found, "id", "left").select("pivot", "members", "weight", "place", "id", "n", F.coalesce("component", "id").alias("label"))
    mixed = labelled.groupBy("pivot").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least < most").select("pivot")
    apart = written(labelled.join(mixed, "pivot", "left_semi"), "jaccard-open")

    few = apart.filter(F.col("members") <= SMALL)
    one, two = few.alias("one"), few.alias("two")
    near = (F.col("one.id") < F.col("two.id")) & (F.col("one.label") != F.col("two.label")) & _close(F.col("one.n"), F.col("two.n"), percent)
    pairs = one.join(two, (F.col("one.pivot") == F.col("two.pivot")) & near).groupBy(F.col("one.id").alias("a"), F.col("two.id").alias("b"))
    # A pair that shares a larger region too is tested there; any other must share enough of these.
    likely = pairs.agg(
        F.sum("one.weight").alias("weight"), F.max(F.col("one.place") + F.col("two.place")).alias("place"), F.min("one.n").alias("n_a"), F.min("two.n").alias("n_b")
    ).filter("weight >= 1 + LEAST(n_a, n_b) div 16").filter(F.col("place") + 2 - 2 * F.col("weight") <= unlike(F.col("n_a"), F.col("n_b")))
    links = links.union(verified(likely, sets, percent))
    many = apart.filter(F.col("members") > SMALL).select("pivot", "id", "label").distinct()
    links = links.union(region_links(many, sets, percent))

    found = components(links)
    named = classes.join(found.withColumnRenamed("id", "first"), "first", "left").select(
        "digest", "first", "members", F.coalesce("component", "first").alias("component")
    )
    # Empty sets share a digest but no class.
    whole = rows.select("id", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest"))
    joined = spread_join(whole, named, "digest", "id", "first", "members", "left")
    return joined.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
    )
