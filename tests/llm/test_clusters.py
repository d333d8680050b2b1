"""Centroid rounds, the Jaccard join and hard negatives against brute force on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from llm import centroids, common, hard_negatives, jaccard_join

VECTORS = "vec_id long, embedding array<float>, label int, cluster string, id string, v int, score double, rank int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "c", "i", 1, 0.5, 2) for i, v, y in rows], VECTORS)


def _finite(v, dim=None):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (dim is None or len(v) == dim)


def _vectors(dim: int, n: int = 300):
    rng = np.random.default_rng(dim)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=dim) * 0.2], int(rng.integers(4))) for i in range(n)]
    one = rows[7][1]
    rows += [(n + i, one, i % 4) for i in range(60)]
    rows += [(1000, None, 1), (1001, [None] * dim, 1), (1002, [float("nan")] * dim, 1), (1003, [float("inf")] * dim, 1)]
    rows += [(1004, [], 1), (1005, [0.0] * dim, 2), (1050, [0.0] * dim, 2), (1007, one[: dim - 1], 1), (1008, one, None), (None, one, 1)]
    return rows


def _rounds(rows, dim, k, rounds, scale, seed):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v, _ in rows if _finite(v, dim)]
    named = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in named[:k]]
    assign = lambda: [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres)) for _, v in kept]
    for _ in range(rounds):
        groups = {}
        for (_, v), (_, j) in zip(kept, assign(), strict=True):
            groups.setdefault(j, []).append(v)
        centres = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(centres)]
    last = assign()
    sums = {}
    for d, j in last:
        sums[j] = sums.get(j, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((str(i), j, d, sums[j], sum(sums.values()), digest[j]) for (i, _), (d, j) in zip(kept, last, strict=True))


def test_centroid_rounds(spark):
    rows = _vectors(5) + [(3, [0.1] * 5, 0), (3, [0.2] * 5, 1), (11, [0.1] * 5, 0)]
    got = centroids.cluster(_frame(spark, rows).repartition(3), dim=5, k=8, rounds=4)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == _rounds(rows, 5, 8, 4, 1024, 3)


def test_centroids_few_and_extreme(spark):
    assert centroids.cluster(_frame(spark, [])).count() == 0
    few = [(i, [0.25 * i] * 3, 0) for i in range(3)]
    got = centroids.cluster(_frame(spark, few), dim=3, rounds=2)
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == _rounds(few, 3, 8, 2, 1024, 3)
    # Components beyond the bound count as it; nothing overflows.
    far = centroids.cluster(_frame(spark, [(1, [3e38, -3e38], 0), (2, [3e38, 3e38], 0)]), dim=2, k=1, rounds=1).collect()
    assert {r.distance for r in far} == {(1 << 27) ** 2}
    nameless = centroids.cluster(_frame(spark, [(None, [1.0, 2.0], 0)]), dim=2).collect()
    assert [tuple(r) for r in nameless] == [(None,) * 6]


def _mined(rows, is_anchor, positives=5, negatives=3):
    best = {}
    for i, v, y in rows:
        if i is not None and y is not None and _finite(v):
            one = (y, [math.floor(256 * float(x)) for x in v])
            best[i] = min(best.get(i, one), one)
    out = []
    for a in filter(is_anchor, best):
        scored = [(-sum(p * q for p, q in zip(best[a][1], v, strict=False)), i, y == best[a][0]) for i, (y, v) in best.items() if i != a]
        scored.sort()
        for minus, p, _ in [s for s in scored if s[2]][:positives]:
            fits = [(-m, n) for m, n, alike in scored if not alike and 50 * -minus <= 100 * -m <= 95 * -minus][:negatives]
            out += [(a, p, r, n, -minus, s) for r, (s, n) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("piece", [64, 1 << 19])
def test_hard_negatives(spark, monkeypatch, piece):
    monkeypatch.setattr(hard_negatives, "PIECE_COMPONENTS", piece)
    rows = _vectors(8) + [(3, [0.1] * 8, 0), (3, [0.2] * 8, 1), (11, [0.1] * 8, 0), (1011, [3e38] * 8, 1), (1012, [-3e38] * 8, 1)]
    clipped = [(i, None if v is None else [x if x is None else max(-65536.0, min(65536.0, x)) if math.isfinite(x) else x for x in v], y) for i, v, y in rows]
    got = hard_negatives.mine(_frame(spark, rows).repartition(3), lambda c: c % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = _mined(clipped, lambda i: i % 10 == 0)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_hard_negatives_empty(spark):
    assert hard_negatives.mine(_frame(spark, []), lambda c: c % 10 == 0).count() == 0
    assert hard_negatives.mine(_frame(spark, [(1, None, 1), (10, [], 1), (20, [0.0], 1)]), lambda c: c % 10 == 0).count() == 0
    # One label only has positives and no negatives.
    assert hard_negatives.mine(_frame(spark, [(i, [1.0, 0.5], 1) for i in range(30)]), lambda c: c % 10 == 0).count() == 0


def test_score_bounds_hold():
    rng = np.random.default_rng(4)
    rows, anchors = rng.integers(-300, 300, (400, 6)), rng.integers(-300, 300, (50, 6))
    refs = hard_negatives.references(rows, 5)
    turned, norms = hard_negatives.angles(rows, refs)
    scores = hard_negatives._scores(anchors, rows)
    cell = hard_negatives.cells(turned, norms)
    for angle, norm, exact in zip(*hard_negatives.angles(anchors, refs), scores, strict=True):
        for c in np.unique(cell):
            own = cell == c
            low, high = turned[own].min(axis=0)[None], turned[own].max(axis=0)[None]
            down, up = hard_negatives.score_bounds(angle, norm, low, high, norms[own].min(), norms[own].max())
            assert down[0] <= exact[own].min() and exact[own].max() <= up[0]


DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, n int, low int, pivot int, members int"


def _texts():
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(3000)}"
    make = lambda n: [word() for _ in range(n)]
    texts = [None, "", " \n\t ", "one", "One two THREE", "one  two\nthree", "a" * 500, "é x y z ü"]
    for share in (0.003, 0.01, 0.02, 0.04):
        base = make(150)
        texts += [" ".join(word() if rng.random() < share else w for w in base) for _ in range(25)]
    passage = make(60)
    texts += [" ".join(make(rng.randrange(5, 40)) + passage + make(20)) for _ in range(30)]
    drift = make(220)
    texts += [" ".join(drift[i : i + 160]).upper() for i in range(0, 60, 3)]
    texts += [" ".join(make(3000))] * 3 + [" ".join(drift), " ".join(drift + ["x"])]
    return texts


def _sets(texts, width):
    fold = lambda t: re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")
    found = []
    for t in texts:
        words = re.findall("[^\x20\x09-\x0D]+", fold(t))
        found.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    return found


def test_components_of_many_tasks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    up = {end: end for edge in edges for end in edge if edge[0] != edge[1]}
    for _ in up:
        for a, b in edges:
            if a != b:
                up[a] = up[b] = min(up[a], up[b])
    frame = spark.createDataFrame(edges, "a long, b long").repartition(9)
    for held in (common.FOREST_EDGES, 40):
        # The rounds over all tasks are taken where one task may not hold all edges.
        monkeypatch.setattr(common, "FOREST_EDGES", held)
        got = [(r.id, r.component) for r in common.components(frame).collect()]
        assert len(got) == len(up) and dict(got) == up
    assert common.components(frame.filter("a = b")).collect() == []


def _components(texts, width, percent):
    sets = _sets(texts, width)
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for b in range(len(sets)):
        for a in range(b):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return [(d, len(s), root(d)) for d, s in enumerate(sets)]


@pytest.mark.parametrize(("small", "crowd", "block"), [(64, 16, 2048), (1, 2, 2048), (1, 16, 7)])
def test_jaccard_regions(spark, monkeypatch, small, crowd, block):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    monkeypatch.setattr(jaccard_join, "BLOCK_MEMBERS", block)
    texts = _texts()
    docs = spark.createDataFrame([(i, t, "en", None, 0, "q", 1, 2, 3, 4) for i, t in enumerate(texts)], DOCS).repartition(3)
    for width, percent in ((4, 85), (4, 60)):
        got = jaccard_join.near_sets(docs, width=width, percent=percent).collect()
        assert sorted(map(tuple, got)) == _components(texts, width, percent)


def test_jaccard_odd_rows(spark):
    rows = [(None, "a b c d e"), (None, None), (5, "a b c d e"), (5, "a b c d e"), (9, "A B C D E"), (7, "other words than those"), (7, "")]
    docs = spark.createDataFrame([(i, t, "en", None, 0, "q", 1, 2, 3, 4) for i, t in rows], DOCS)
    got = sorted(map(str, map(tuple, jaccard_join.near_sets(docs).collect())))
    want = [(None, 2, None), (None, 0, None), (5, 2, 5), (5, 2, 5), (9, 2, 5), (7, 1, 7), (7, 0, 7)]
    assert got == sorted(map(str, want))
    assert jaccard_join.near_sets(docs.limit(0)).count() == 0


def test_regions_with_several_texts_of_an_id(spark, monkeypatch):
    """Members are dealt by the size of all their sets and get every one of them, without the sets of others."""
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 1 << 62, 60)).astype(np.uint64)
    near = [np.sort(np.append(base, np.uint64(i))) for i in range(4)]
    other = np.unique(rng.integers(0, 1 << 62, 60)).astype(np.uint64)
    rows = [(0, other), (0, near[0]), (1, near[1]), (2, near[2]), (3, other), (9, near[3])]
    sets = spark.createDataFrame([(i, len(s), bytearray(s.tobytes())) for i, s in rows], "id long, n long, shingles binary")
    members = spark.createDataFrame([(p, i, i) for p in (7, 8) for i in range(4)], "pivot long, id long, label long")
    for block in (2048, 2):
        monkeypatch.setattr(jaccard_join, "BLOCK_MEMBERS", block)
        links = {tuple(r) for r in jaccard_join.region_links(members, sets, 85).collect()}
        assert links <= {(0, 1), (0, 2), (0, 3), (1, 2)}
        found = common.components(spark.createDataFrame(list(links), "a long, b long")).collect()
        assert {(r.id, r.component) for r in found} == {(i, 0) for i in range(4)}


def test_likely_rows_hold_all_of_the_keys(spark, monkeypatch):
    rows = spark.range(10_000).select((F.col("id") * 7919).alias("id"))
    keys = rows.limit(100).union(rows.limit(10))
    wanted = {r.id for r in keys.collect()}
    found = [r.id for r in common.likely(rows, keys, "id").collect()]
    assert wanted <= set(found) and len(found) == len(set(found)) < 200
    # A full map loses no row either.
    monkeypatch.setattr(common, "MAP_BITS", 128)
    assert wanted <= {r.id for r in common.likely(rows, keys, "id").collect()}
    assert common.marked(rows, keys, "id").count() == 10_000
    assert common.likely(rows, keys.limit(0), "id").count() == 0


def test_written_tables_leave_no_shuffle(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    blocks = lambda: {name for f in map(str, _items(disk.getAllFiles())) if (name := f.rpartition("/")[2]).startswith("shuffle_")}
    setting = spark.conf.get(common._CLEANUP, "false")
    before = blocks()
    table = common.written(spark.range(10_000).repartition(5, "id"), "test-shuffles")
    for _ in range(40):
        left = blocks() - before
        if not left:
            break
        time.sleep(0.25)
    assert not left and table.count() == 10_000 and spark.conf.get(common._CLEANUP, "false") == setting


def _items(seq):
    at = seq.iterator()
    while at.hasNext():
        yield at.next()


def test_region_recursion():
    rng = random.Random(2)
    groups = [[rng.randrange(10**6) for _ in range(80)] for _ in range(12)]
    sets = [np.unique(np.array([rng.randrange(10**6) if rng.random() < 0.1 else x for x in g], np.uint64)) for g in groups for _ in range(15)]
    region = jaccard_join.Region(sets, np.arange(len(sets)), np.arange(len(sets)), 85)
    region.join(np.arange(len(sets)))
    close = lambda a, b: 100 * len(a & b) >= 85 * len(a | b)
    plain = [set(s.tolist()) for s in sets]
    for i in range(len(sets)):
        for j in range(i):
            assert not close(plain[i], plain[j]) or region.root(i) == region.root(j)
    assert all(close(plain[i], plain[j]) for i, j in region.links)


def test_queries_are_registered(spark):
    names = {"op11_centroid_rounds", "op12_jaccard_regions", "op13_angular_negatives"}
    assert names <= contract.queries().keys()
    sf = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    names = [r.doc_id for r in texts]
    want = [(names[d], n, names[root]) for d, n, root in _components([r.text for r in texts], 4, 85)]
    assert sorted(map(tuple, contract.queries()["op12_jaccard_regions"](spark, sf).collect())) == want
