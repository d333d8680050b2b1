"""Near-duplicate documents by HyperMinHash.

The distinct 5-word shingles of a text are dealt to 128 buckets by the leading bits of their hash. Of
each bucket's smallest remaining hash a register keeps the number of leading zeros and the ten bits
after the first one; an empty bucket borrows from others in a fixed pseudo-random order. Bands
of four registers propose candidate pairs, the share of equal registers, corrected for those equal by
chance, estimates their similarity, and the full sets decide.

Equal sets form one class and go on as one. Within a band's bucket every class is first paired with
the smallest only. Once those links have been verified and connected, buckets that still hold several
components propose a spanning forest of their most similar pairs. What is still apart then is tested
on full sets inside blocks of bounded size, which return the links found, not the pairs tested. So a
bucket of thousands of near copies costs about as many pairs as it has members, and no link that
connects two components is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import by_key, components, mixed, shingle_sets, spread_join, tidy, written
from llm.jaccard_join import Region

REGISTERS = 128
MANTISSA = 10
BAND = 4
BANDS = REGISTERS // BAND
PROBES = 64
BLOCK = 512
# Standard deviations that an estimate may lie below the threshold and still be verified.
MARGIN = 5.0

_BORROW = np.random.default_rng(31).integers(0, REGISTERS, (REGISTERS, PROBES))
_SHIFT = np.uint64(57)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The 128 registers of a non-empty sorted set of shingle hashes."""
    bucket = (shingles >> _SHIFT).astype(np.int64)
    # Hashes are sorted, so the first of a bucket is its smallest.
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    filled = np.zeros(REGISTERS, bool)
    filled[bucket[first]] = True
    rest = (shingles[first] << np.uint64(7)) | np.uint64(1)
    zeros = 63 - np.floor(np.log2(rest.astype(np.float64))).astype(np.int64)
    zeros = np.clip(zeros, 0, 62).astype(np.uint64)
    mantissa = ((rest << zeros) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    registers = np.zeros(REGISTERS, np.uint16)
    registers[bucket[first]] = ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)
    empty = np.flatnonzero(~filled)
    if len(empty):
        probes = _BORROW[empty]
        hit = filled[probes]
        source = np.where(hit.any(axis=1), probes[np.arange(len(empty)), hit.argmax(axis=1)], bucket[first[0]])
        registers[empty] = registers[source]
    return registers


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One key per band: its four 16-bit registers are 64 bits, mixed with the band's number."""
    words = np.ascontiguousarray(registers).view(np.uint64).reshape(len(registers), BANDS)
    return mixed(mixed(words) + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def chance(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Probability that two registers of unrelated sets of these sizes are equal.

    The smallest of ``k`` uniform values has ``i`` leading zeros with probability
    ``(1 - 2**-(i+1))**k - (1 - 2**-i)**k`` read downwards; mantissas agree once in 2**10.
    """
    edges = 2.0 ** -np.arange(0, 58)
    k_a = np.maximum(1.0, n_a / REGISTERS)[:, None]
    k_b = np.maximum(1.0, n_b / REGISTERS)[:, None]
    tail = lambda k: np.diff((1 - edges[None]) ** k, axis=1)
    return (tail(k_a) * tail(k_b)).sum(axis=1) / 2**MANTISSA


def estimate(equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity from the number of equal registers, corrected for collisions."""
    by_chance = chance(n_a, n_b)
    return np.clip((equal / REGISTERS - by_chance) / (1 - by_chance), 0, 1)


def plausible(equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Pairs whose sizes allow the similarity and whose estimate does not exclude it."""
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    wanted = percent / 100
    # Fewer shingles than registers give fewer independent registers.
    spread = np.sqrt(wanted * (1 - wanted) / np.minimum(REGISTERS, small))
    return (100 * small >= percent * large) & (estimate(equal, n_a, n_b) >= wanted - MARGIN * spread)


_PROFILE = "id long, n long, digest binary, registers binary"


def profiles(documents: DataFrame) -> DataFrame:
    """Set size, digest and registers of each row of ``id, text``; an empty set has no registers."""

    @tidy
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            sizes, digests, registers = [], [], []
            for found in shingle_sets(texts):
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                registers.append(sketch(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(registers, pa.binary())],
                names=["id", "n", "digest", "registers"],
            )

    return documents.select("id", "text").mapInArrow(profile, _PROFILE)


def _bands(nodes: DataFrame) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key = band_keys(_registers(batch.column("registers"))).ravel()
                ids = np.repeat(batch.column("id").to_numpy(), BANDS)
                band = np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(band), pa.array(ids)], names=["bucket", "band", "id"])

    return nodes.select("id", "registers").mapInArrow(keys, "bucket long, band int, id long")


def _registers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _plausible_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``a, b, similar`` of the pairs that the registers do not exclude."""
    side = lambda s: nodes.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("registers").alias(f"r_{s}"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                equal = (_registers(batch.column("r_a")) == _registers(batch.column("r_b"))).sum(axis=1)
                n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
                out = pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(estimate(equal, n_a, n_b))], names=["a", "b", "similar"]
                )
                yield out.filter(pa.array(plausible(equal, n_a, n_b, percent)))

    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    return sized.mapInArrow(look, "a long, b long, similar double")


def _sets(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, shingles`` of the rows whose id is in ``ids``, written; an id with several texts has several."""

    @tidy
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            # Sets leave in small batches: they are larger than their texts.
            for at in range(0, len(texts), 256):
                raw = [s.tobytes() for s in shingle_sets(texts[at : at + 256])]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, 256), pa.array(raw, pa.binary())], names=["id", "shingles"])

    wanted = documents.filter(F.col("text").isNotNull()).join(ids, "id", "left_semi")
    return written(wanted.mapInArrow(shingle, "id long, shingles binary"), "shingle-sets")


def _linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """The exact test on two sorted sets."""
    if not len(one) or not len(two):
        return False
    at = np.minimum(np.searchsorted(two, one), len(two) - 1)
    both = int((two[at] == one).sum())
    return 100 * both >= percent * (len(one) + len(two) - both)


def _set(value: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint64)


def verified(pairs: DataFrame, documents: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full shingle sets are as similar as wanted."""
    pairs = written(pairs.select("a", "b"), "pairs")
    sets = _sets(documents, pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("s_a"), batch.column("s_b"), strict=True)
            keep = [_linked(_set(x), _set(y), percent) for x, y in sides]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda s: sets.select(F.col("id").alias(s), F.col("shingles").alias(f"s_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(compare, "a long, b long").distinct()


def _spanning(left: np.ndarray, right: np.ndarray, component: np.ndarray) -> list[tuple[int, int]]:
    """The pairs, in their order, that connect components not connected before."""
    names, local = np.unique(component, return_inverse=True)
    label, apart, out = np.arange(len(names)), len(names), []
    for at in range(0, len(left), 1 << 13):
        i, j = left[at : at + (1 << 13)], right[at : at + (1 << 13)]
        open_pairs = label[local[i]] != label[local[j]]
        for x, y in zip(i[open_pairs].tolist(), j[open_pairs].tolist(), strict=True):
            one, two = label[local[x]], label[local[y]]
            if one != two:
                label[label == two] = one
                out.append((x, y))
                apart -= 1
        if apart == 1:
            break
    return out


def _open_members(shared: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets that hold several components, with their registers."""
    label = F.coalesce("component", "id").alias("component")
    placed = shared.select("bucket", "band", "id").join(found, "id", "left").select("bucket", "band", "id", label)
    apart = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    return placed.join(apart.select("bucket"), "bucket", "left_semi").join(nodes, "id").dropDuplicates(["bucket", "id"])


def _blocked_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` that tie the components of each bucket together.

    ``members`` has ``bucket, band, id, n, registers, component``. A bucket of more than ``BLOCK``
    members is dealt into blocks by a hash of the id, and every two blocks meet once; no task
    holds more than two blocks. Of the plausible pairs of different components, each looked at
    in the first band where it agrees, a block proposes a spanning forest by falling estimate. If
    ``members`` also has ``shingles``, it tests pairs on the full sets instead, passes over
    those that earlier ones have connected, and returns those that hold.
    """
    exact = "shingles" in members.columns
    sizes = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = (
        members.join(sizes, "bucket")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("place", F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")))
        .drop("bucket", "blocks")
        .repartition("place")
        .sortWithinPartitions("place")
    )

    @tidy
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_key(batches, "place"):
            rows = rows.sort_by("id").combine_chunks()
            ids, n, component, block, other, band = (
                rows.column(c).to_numpy() for c in ("id", "n", "component", "block", "other", "band")
            )
            registers = _registers(rows.column("registers"))
            # A band's registers as one number.
            words = registers.view(np.uint64).reshape(len(registers), BANDS)
            region = None
            if exact:
                # Which rows meet is settled below; all sides differ.
                region = Region([_set(v) for v in rows.column("shingles")], component, np.arange(len(ids)), percent)
            left, right, similar = [], [], []
            for i in range(len(ids) - 1):
                # Pairs within a block are formed where it meets itself.
                apart = component[i + 1 :] != component[i]
                if block[i] != other[i]:
                    apart &= block[i + 1 :] != block[i]
                if not apart.any():
                    continue
                apart &= (words[i + 1 :] == words[i]).argmax(axis=1) == band[i]
                later = i + 1 + np.flatnonzero(apart)
                if exact and len(later):
                    later = later[region.roots(later) != region.root(int(component[i]))]
                if not len(later):
                    continue
                equal = (registers[later] == registers[i]).sum(axis=1)
                sizes_i = np.full(len(later), n[i])
                good = plausible(equal, n[later], sizes_i, percent)
                if exact:
                    if good.any():
                        region.test(i, later[good], region.shared(i, later[good]))
                    continue
                left.append(np.full(int(good.sum()), i))
                right.append(later[good])
                similar.append(estimate(equal[good], n[later][good], sizes_i[good]))
            if exact:
                out = [(ids[i], ids[j]) for i, j in region.links]
            elif left:
                left, right = np.concatenate(left), np.concatenate(right)
                order = np.argsort(-np.concatenate(similar), kind="stable")
                out = [(ids[i], ids[j]) for i, j in _spanning(left[order], right[order], component)]
            else:
                out = []
            if out:
                a, b = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(pairs, "a long, b long").distinct()


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Words are runs of other characters than blank, tab, line and page ends, with A-Z in lower case. A
    document's set holds its distinct runs of five words; a shorter text is one shingle as a whole. Two
    documents are linked if ``100 * |A and B| >= percent * |A or B|``; a component is whatever links
    connect, named by its smallest id, and that document is kept. NULL, empty and blank texts have
    an empty set and are linked with nothing. A row without an id is in no component (NULL) and kept.
    Rows that repeat an id are rows of their own with the same name: as long as that id is the
    smallest of its equal sets, whatever is linked to one of its texts is linked to all. An empty table
    gives no rows; other columns are ignored.
    """
    texts = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = written(profiles(texts), "minhash")
    filled = rows.filter("n > 0 AND id IS NOT NULL")
    classes = filled.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("members"))
    heads = classes.select(F.col("digest"), F.col("first").alias("id"))
    nodes = written(filled.join(heads, ["digest", "id"], "left_semi").select("id", "n", "registers"), "minhash-nodes")
    bands = _bands(nodes)
    crowded = bands.groupBy("bucket", "band").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a < z").drop("z")
    shared = written(bands.join(crowded, ["bucket", "band"]).distinct(), "minhash-buckets")
    stars = shared.filter("a < id").select("a", F.col("id").alias("b")).distinct()
    likely = _plausible_pairs(stars, nodes, percent)
    # First the most similar of a class's star centres.
    best = likely.groupBy("b").agg(F.max_by("a", F.struct("similar", -F.col("a"))).alias("a"))
    found = components(written(verified(best, texts, percent), "links"))
    # Then what ties the components of a bucket together by estimate, and at last, on full sets, every
    # plausible pair that is still apart. What is connected goes on as one edge per document.
    known = lambda found: found.select(F.col("id").alias("a"), F.col("component").alias("b"))
    apart = _open_members(shared, nodes, found)
    likely = written(verified(_blocked_pairs(apart, percent), texts, percent), "links")
    found = components(known(found).union(likely))
    apart = written(_open_members(shared, nodes, found), "apart")
    sets = _sets(texts, apart.select("id").distinct())
    found = components(known(found).union(_blocked_pairs(apart.join(sets, "id"), percent)))
    named = classes.join(found.withColumnRenamed("id", "first"), "first", "left").select(
        "digest", "first", "members", F.coalesce("component", "first").alias("component")
    )
    # Empty sets share a digest but no class.
    whole = rows.select("id", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest"))
    joined = spread_join(whole, named, "digest", "id", "first", "members", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return joined.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


