"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A sketch has three tables of six cells. Each distinct paragraph digest falls into one cell of each table,
which keeps a count, the XOR of its digests and the XOR of their check values. Subtracting the sketches
of two versions cancels what they share; a cell that holds one digest alone gives it away, and
taking it out of its other cells frees further ones, until the sketch is empty and all differing
digests are known. If it is not, the digests are dealt to four sketches by fresh hashes and tried
again, and so on for those that fail: a larger sketch on failure, whose work grows in
proportion to the paragraphs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions.let import let
from llm.common import written

TABLES, WIDTH = 3, 6
CELLS = TABLES * WIDTH
FIRST_ID = -(1 << 63)


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs (its lines)."""
    return F.array_distinct(F.transform(F.split(text, "\n"), lambda p: F.xxhash64(p)))


def _slot(h: Column, cell: Column) -> Column:
    """Whether a digest with hash ``h`` falls into this cell: 16 bits of the hash serve each table."""
    bits = F.shiftrightunsigned(h, 0).bitwiseAND(0xFFFF)
    second = F.shiftrightunsigned(h, 16).bitwiseAND(0xFFFF)
    third = F.shiftrightunsigned(h, 32).bitwiseAND(0xFFFF)
    chosen = F.when(cell < WIDTH, bits).when(cell < 2 * WIDTH, second).otherwise(third)
    return chosen % WIDTH == cell % WIDTH


def sketch(keys: Column, level: Column) -> Column:
    """The cells ``c, k, x`` of an array of digests; ``level`` makes the hashes of a retry fresh."""
    empty = F.struct(F.lit(0).alias("c"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("x"))
    hashed = F.transform(keys, lambda d: F.struct(d.alias("d"), F.xxhash64(d, level).alias("h")))

    def cell(entries: Column, j: Column) -> Column:
        return F.aggregate(
            F.filter(entries, lambda e: _slot(e["h"], j)),
            empty,
            lambda s, e: F.struct((s["c"] + 1).alias("c"), s["k"].bitwiseXOR(e["d"]).alias("k"), s["x"].bitwiseXOR(e["h"]).alias("x")),
        )

    return let(hashed, lambda entries: F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda j: cell(entries, j)))


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(
        left,
        right,
        lambda a, b: F.struct((a["c"] - b["c"]).alias("c"), a["k"].bitwiseXOR(b["k"]).alias("k"), a["x"].bitwiseXOR(b["x"]).alias("x")),
    )


def peel(cells: Column, level: Column, most: Column) -> Column:
    """The differing digests as ``d, sign`` (1: only in the first), or NULL if some stay hidden.

    At most ``most`` digests can differ, and no more than there are cells can come out.
    """
    none = F.expr("cast(array() as array<struct<d:bigint,sign:int>>)")
    start = F.struct(cells.alias("cells"), none.alias("found"))

    def take(state: Column) -> Column:
        pure = F.filter(state["cells"], lambda c: (F.abs(c["c"]) == 1) & (F.xxhash64(c["k"], level) == c["x"]))

        def without(one: Column) -> Column:
            rest = F.transform(
                state["cells"],
                lambda c, j: F.when(
                    _slot(one["x"], j),
                    F.struct((c["c"] - one["c"]).alias("c"), c["k"].bitwiseXOR(one["k"]).alias("k"), c["x"].bitwiseXOR(one["x"]).alias("x")),
                ).otherwise(c),
            )
            more = F.array(F.struct(one["k"].alias("d"), one["c"].alias("sign")))
            return F.struct(rest.alias("cells"), F.concat(state["found"], more).alias("found"))

        return let(F.get(pure, F.lit(0)), lambda one: F.when(one.isNull(), state).otherwise(without(one)))

    steps = F.slice(F.sequence(F.lit(1), F.lit(CELLS)), F.lit(1), F.least(most, F.lit(CELLS)).cast("int"))
    done = F.aggregate(steps, start, lambda state, _: take(state))
    clear = lambda s: F.forall(s["cells"], lambda c: (c["c"] == 0) & (c["k"] == 0) & (c["x"] == 0))
    return let(done, lambda s: F.when(clear(s), s["found"]))


def as_text(cells: Column) -> Column:
    """A sketch as one string, cell by cell."""
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(":", F.hex(c["c"]), F.hex(c["k"]), F.hex(c["x"]))), " ")


def differences(pairs: DataFrame) -> DataFrame:
    """How many digests differ: ``row, differing`` for rows ``row, left, right`` (arrays of digests).

    Level after level, only what did not come out goes on, dealt to four sketches each.
    """
    level = 0
    both = F.array_union("left", "right")
    sized = pairs.withColumn("most", F.size(both))
    found = peel(subtract(sketch(F.col("left"), F.lit(0)), sketch(F.col("right"), F.lit(0))), F.lit(0), F.col("most"))
    tried = written(sized.select("row", "left", "right", found.alias("found")), "peeled")
    settled = tried.filter("found IS NOT NULL").select("row", F.size("found").cast("long").alias("differing"))
    side = lambda name, flag: tried.filter("found IS NULL").select(
        "row", F.lit(0).cast("long").alias("part"), F.lit(flag).alias("mine"), F.explode(name).alias("d")
    )
    hidden = side("left", True).unionByName(side("right", False))
    while not hidden.isEmpty():
        level += 1
        seed = F.lit(level)
        # Another hash than the one that places the digests.
        part = F.xxhash64("part", F.pmod(F.xxhash64("d", F.lit(-level)), F.lit(4)))
        grouped = (
            hidden.withColumn("part", part)
            .groupBy("row", "part")
            .agg(
                F.sort_array(F.collect_list(F.when(F.col("mine"), F.col("d")))).alias("left"),
                F.sort_array(F.collect_list(F.when(~F.col("mine"), F.col("d")))).alias("right"),
            )
            .withColumn("most", F.size(both))
        )
        # More than twice as many as cells: no use in trying.
        found = F.when(
            F.col("most") <= 2 * CELLS,
            peel(subtract(sketch(F.col("left"), seed), sketch(F.col("right"), seed)), seed, F.col("most")),
        )
        tried = written(grouped.select("row", "part", "left", "right", found.alias("found")), "peeled")
        settled = settled.unionByName(
            tried.filter("found IS NOT NULL").select("row", F.size("found").cast("long").alias("differing"))
        )
        again = tried.filter("found IS NULL")
        hidden = again.select("row", "part", F.lit(True).alias("mine"), F.explode("left").alias("d")).unionByName(
            again.select("row", "part", F.lit(False).alias("mine"), F.explode("right").alias("d"))
        )
    return settled.groupBy("row").agg(F.sum("differing").alias("differing"))


def following(ids: DataFrame) -> DataFrame:
    """``id, next``: the next smaller id of each distinct id; the smallest is followed by the largest."""
    ranges = written(
        ids.select("id").distinct().repartitionByRange("id").sortWithinPartitions("id").withColumn("part", F.spark_partition_id()),
        "id-ranges",
    )
    # One row per range.
    ends = ranges.groupBy("part").agg(F.max("id").alias("top"))
    before = ends.select("part", F.lag("top").over(Window.orderBy("part")).alias("below"), F.max("top").over(Window.partitionBy()).alias("last"))
    inside = F.lag("id").over(Window.partitionBy("part").orderBy("id"))
    return ranges.withColumn("inside", inside).join(before, "part").select("id", F.coalesce("inside", "below", "last").alias("next"))


def edited(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, edited, left, right, after``: each text, its edited version, and the digests of both
    and of the next document's text. Texts are shuffled once; the next document sends what is needed."""
    texts = documents.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    lengths = texts.groupBy("id").agg(F.max(F.length("text")).alias("longest"))
    links = following(texts).join(lengths, "id").select(F.col("id").alias("to"), F.col("next").alias("id"), "longest")
    sent = (
        texts.join(links, "id")
        .select("to", F.struct(F.expr("substring(text, 1, longest div 3)").alias("start"), digests(F.col("text")).alias("after")).alias("sent"))
        .groupBy("to")
        .agg(F.min("sent").alias("sent"))
        .withColumnRenamed("to", "id")
    )
    changed = F.expr("concat(substring(text, 1, length(text) - length(text) div 3), substring(sent.start, 1, length(text) div 3))")
    return (
        texts.join(sent, "id")
        .withColumn("edited", changed)
        .select(
            F.when(F.col("id") != FIRST_ID, F.col("id")).alias("id"),
            "text",
            "edited",
            digests(F.col("text")).alias("left"),
            digests(F.col("edited")).alias("right"),
            F.col("sent.after").alias("after"),
        )
    )


def likeness(n: Column, m: Column, differing: Column) -> Column:
    """Shared digests by all digests of two sets of ``n`` and ``m``."""
    return (n + m - differing) / (n + m + differing)


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``.

    The edited text replaces the last third of the code points (rounded down) by as many from the
    start of the next document in descending order of id, or by all it has; after the last comes the
    first. NULL texts are empty, and an empty text is one empty paragraph. A missing id comes last
    in the order. Among rows of the next id the smallest start serves. Likeness is the share of
    paragraph digests in common, 1 for equal texts, and exact: it comes from peeling. An empty table
    gives no rows; repeated rows stay; other columns are ignored.
    """
    rows = written(
        edited(documents, id_col, text_col).select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            F.length("text").cast("long").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            as_text(sketch(F.col("left"), F.lit(0))).alias("fingerprint"),
            as_text(sketch(F.col("right"), F.lit(0))).alias("edited_fingerprint"),
            "left",
            "right",
            "after",
        ),
        "fingerprints",
    )
    # Two comparisons per row: an even number for the edited text, an odd one for the next.
    pairs = rows.select((2 * F.col("row")).alias("row"), "left", "right").unionByName(
        rows.select((2 * F.col("row") + 1).alias("row"), "left", F.col("after").alias("right"))
    )
    counted = differences(pairs).select(
        F.expr("row div 2").alias("row"), (F.col("row") % 2).alias("which"), "differing"
    )
    per_row = counted.groupBy("row").agg(
        F.sum(F.when(F.col("which") == 0, F.col("differing"))).alias("edited_by"),
        F.sum(F.when(F.col("which") == 1, F.col("differing"))).alias("next_by"),
    )
    n = F.size("left")
    return rows.join(per_row, "row").select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(n, F.size("right"), F.col("edited_by")).alias("near_edited"),
        likeness(n, F.size("after"), F.col("next_by")).alias("near_next"),
    )
