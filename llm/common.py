"""What several operators share: tables, written intermediate results, and word hashes in numpy."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import configure, workspace

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Of the map of keys that is broadcast, in 64 bits a row.
MAP_BITS = 1 << 23
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def tidy(function: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """``function`` for tasks with large arrays: its worker, which waits for the next task, gives the memory back."""

    def run(*args) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(*args)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def one_blas_thread() -> None:
    """Matrix products of this worker in its own thread: a task holds one core, and the threads OpenBLAS
    starts by itself only wait on each other over small products, burning CPU for little time."""
    with open("/proc/self/maps") as maps:
        paths = {line.split()[-1] for line in maps if "openblas" in line and ".so" in line}
    for path in paths:
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads"):
            setter = getattr(library, name, None)
            if setter is not None:
                setter(ctypes.c_int(1))
                break


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a table in the shared folder: computed once, safe from lost executors.

    The shuffles that made them are dropped as soon as the table stands, not when the driver collects garbage.
    """
    spark, folder = df.sparkSession, workspace(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)


def marked(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_marked``: true where ``key`` is among those of ``keys``, and by chance for few others.

    A map of ``MAP_BITS`` bits of the keys' hashes is broadcast, so no row is shuffled and the map is bounded.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(MAP_BITS))
    word = F.expr("_bit div 64").alias("_word")
    bits = keys.select(bit.alias("_bit")).groupBy(word).agg(F.expr("bit_or(shiftleft(1L, CAST(_bit % 64 AS INT)))").alias("_bits"))
    placed = rows.withColumn("_bit", bit).select("*", word).join(F.broadcast(bits), "_word", "left")
    hit = F.expr("COALESCE(getbit(_bits, CAST(_bit % 64 AS INT)) = 1, FALSE)")
    return placed.withColumn("_marked", hit).drop("_word", "_bit", "_bits")


def likely(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The ``rows`` whose ``key`` is among those of ``keys``, and few others: what need not be shuffled to be joined goes."""
    return marked(rows, keys, key).filter("_marked").drop("_marked")


def word_count(text: Column) -> Column:
    """Number of words of a text; a missing text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def byte_chunks(texts: list[bytes], limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` of about ``limit`` bytes; a longer text has a range of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


# Odd multipliers and byte codes of the polynomial hash, all modulo 2**64.
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
_CODES = np.random.default_rng(20240917).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base``: those known, times the next one, are as many again."""
    powers = np.ones(n, np.uint64)
    known, factor = 1, int(base)
    while known < n:
        more = min(known, n - known)
        np.multiply(powers[:more], np.uint64(factor), out=powers[known : known + more])
        known, factor = known + more, factor * factor % (1 << 64)
    return powers


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte range ``data[start:end]``, equal for equal bytes wherever they stand."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * _powers(_FACTOR, len(data)), out=total[1:])
    back = _powers(_INVERSE, len(data) + 1)
    length = (ends - starts).astype(np.uint64)
    return mixed((total[ends] - total[starts]) * back[starts] + length * np.uint64(0xD6E8FEB86659FD93))


# Places hashed at once, so that the arrays stay in the cache.
_BLOCK = 1 << 15


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """``range_hashes`` of every ``width`` bytes in a row."""
    n = max(0, len(data) - width + 1)
    out = np.empty(n, np.uint64)
    forth, back = _powers(_FACTOR, min(n, _BLOCK) + width - 1), _powers(_INVERSE, min(n, _BLOCK))
    total = np.zeros(len(forth) + 1, np.uint64)
    length = np.uint64(width * 0xD6E8FEB86659FD93 % (1 << 64))
    for lo in range(0, n, _BLOCK):
        codes = _CODES[data[lo : lo + len(forth)]]
        codes *= forth[: len(codes)]
        np.cumsum(codes, out=total[1 : len(codes) + 1])
        some = total[width : len(codes) + 1] - total[: len(codes) + 1 - width]
        some *= back[: len(some)]
        some += length
        out[lo : lo + len(some)] = mixed(some)
    return out


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and the number of words of each text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        data = _LOWER[data]
    blank = _BLANK[data]
    before = np.ones(len(data), bool)
    before[1:] = blank[:-1]
    starts = np.flatnonzero(~blank & before)
    # A word ends at the first blank after its start; the last byte is a blank.
    ends = np.flatnonzero(blank & ~before)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    counts = np.bincount(np.searchsorted(np.cumsum(lengths), starts, side="right"), minlength=len(texts))
    return range_hashes(data, starts, ends), counts


SHINGLE = 5
_PLACE = np.random.default_rng(77).integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of the shingles of ``width`` (at most 5) words of each text, words lower-cased in A-Z.

    A text of fewer words has its whole sequence as the only shingle; no words, no shingles.
    """
    for first, last in byte_chunks(texts):
        words, counts = word_hashes(texts[first:last])
        at = np.cumsum(counts) - counts
        sums = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for j in range(width):
            sums += words[j : j + len(sums)] * _PLACE[j]
        sums = mixed(sums)
        for start, n in zip(at.tolist(), counts.tolist(), strict=True):
            if n >= width:
                yield np.unique(sums[start : start + n - width + 1])
            elif n:
                short = (words[start : start + n] * _PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)
                yield mixed(np.array([short], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.Table]]:
    """Consecutive rows that share ``key``, gathered over batches of a partition sorted by it."""
    current, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            if held and keys[lo] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = int(keys[lo])
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield current, pa.Table.from_batches(held)


def spread_join(rows: DataFrame, groups: DataFrame, key: str, salt_on: str, member: str, size: str, how: str = "inner", salts: int = 16) -> DataFrame:
    """Join each row to its group by ``key`` where one group may hold a third of all rows.

    Rows of a group spread over ``salts`` tasks by a hash of their column ``salt_on``. A group of one
    row (``size`` is 1) is sent to the task of that row alone, which has the value ``member``.
    """
    salt = lambda name: F.pmod(F.xxhash64(name), F.lit(salts)).cast("int")
    everywhere = F.sequence(F.lit(0), F.lit(salts - 1))
    spread = groups.withColumn("_salt", F.explode(F.when(F.col(size) > 1, everywhere).otherwise(F.array(salt(member)))))
    return rows.withColumn("_salt", salt(salt_on)).join(spread.drop(size), [key, "_salt"], how).drop("_salt")


FOREST_EDGES = 1 << 18


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges ``u, v`` of a task as forests: every end but the smallest of its tree, with that one.

    A forest covers up to ``FOREST_EDGES`` edges, so a task's memory is bounded.
    """
    up: dict[int, int] = {}

    def root(end: int) -> int:
        while up[end] != end:
            up[end] = end = up[up[end]]
        return end

    def flush() -> pa.RecordBatch:
        below = [end for end in up if up[end] != end]
        out = pa.RecordBatch.from_arrays([pa.array(below, pa.int64()), pa.array([root(end) for end in below], pa.int64())], names=["u", "v"])
        up.clear()
        return out

    seen = 0
    for batch in batches:
        for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            up.setdefault(a, a)
            up.setdefault(b, b)
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
        seen += batch.num_rows
        if seen >= FOREST_EDGES:
            yield flush()
            seen = 0
    if up:
        yield flush()


def _tangled(edges: DataFrame) -> bool:
    """Whether some end has two parents, or a parent of its own and children."""
    roles = edges.union(edges.select("v", F.lit(None).cast("long")))
    counts = roles.groupBy("u").agg(F.count("v").alias("parents"), F.count(F.lit(1)).alias("places"))
    return not counts.filter("parents > 1 OR (parents = 1 AND places > 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every end of ``edges`` (``a, b``): the smallest id it is connected to.

    Edges become forests task by task, where they lie, then in as few tasks as hold ``FOREST_EDGES`` of
    their edges each. If one task holds them all, its forest is the result. Else large-star and
    small-star rounds follow: every node hands its larger, then its smaller neighbours to the smallest
    node it knows, until every node has its root as the only neighbour. Each round is written to the
    shared folder.
    """
    ends = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    local = written(ends.mapInArrow(_forest, "u long, v long"), "components")
    tasks = max(1, -(-local.count() // FOREST_EDGES))
    now = written(local.coalesce(tasks).mapInArrow(_forest, "u long, v long"), "components")
    if tasks > 1:
        now = _starred(written(now.distinct(), "components"))
    root = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(root)


def _starred(now: DataFrame) -> DataFrame:
    """Edges ``u, v`` from every node to its root, by large-star and small-star rounds."""
    while _tangled(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Edges point from the larger to the smaller end throughout.
        large = large.union(now.groupBy("u").agg(F.min("v").alias("v"))).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        kept = lowest.select("u", F.col("m").alias("v"))
        handed = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(kept.union(handed).distinct(), "components")
    return now
