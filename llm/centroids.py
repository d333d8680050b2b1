"""Centroid clustering in exact integers, in Spark's own expressions.

Components become integers once. In each round ``zip_with`` and ``aggregate`` give the inner product of
a vector with each centroid, a literal array, and with the two squared norms the squared distance;
``array_min`` over structs of distance and number picks the centroid, ties to the smaller number. The
new centroids come from one sum per component, grouped by centroid, which every task adds up before the
shuffle: a round moves a row per task and centroid, however many vectors one centroid has. Only the
centroids pass the driver.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import written

# Integer components beyond this count as it: 64 squares of a difference then fit a long.
MOST = 1 << 27


def _literal(numbers: list[int | None]) -> Column:
    """A literal array of longs; None stays NULL."""
    return F.expr(f"array({', '.join('NULL' if n is None else f'{n}L' for n in numbers)})").cast("array<bigint>")


def _dot(one: Column, two: Column) -> Column:
    return F.aggregate(F.zip_with(one, two, lambda a, b: a * b), F.lit(0).cast("long"), lambda total, x: total + x)


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """``vec_id, v, square`` of the vectors with ``dim`` finite components: integers and their squared norm."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = lambda c: F.floor(F.least(F.greatest(scale * c.cast("double"), F.lit(-float(MOST))), F.lit(float(MOST))))
    kept = vectors.filter(x.isNotNull() & (F.size(x) == dim) & finite)
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, whole).cast("array<bigint>").alias("v")).withColumn(
        "square", _dot(F.col("v"), F.col("v"))
    )


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``vectors`` with ``nearest``, a struct of the squared ``distance`` and the ``cluster``."""
    found = []
    for number, centroid in enumerate(centroids):
        apart = F.col("square") - 2 * _dot(F.col("v"), _literal(centroid)) + F.lit(sum(c * c for c in centroid)).cast("long")
        found.append(F.struct(apart.alias("distance"), F.lit(number).alias("cluster")))
    return vectors.withColumn("nearest", F.array_min(F.array(*found)))


def moved(vectors: DataFrame, centroids: list[list[int]], dim: int) -> list[list[int]]:
    """The floors of the componentwise means of each centroid's vectors; one without any stays."""
    sums = [F.expr(f"sum(v[{i}]) AS s{i}") for i in range(dim)]
    own = assigned(vectors, centroids).select(F.col("nearest.cluster").alias("cluster"), "v")
    out = list(centroids)
    for row in own.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"), *sums).collect():
        out[row["cluster"]] = [row[f"s{i}"] // row["members"] for i in range(dim)]
    return out


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dim: int = 64,
    k: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    seed: int = 3,
) -> DataFrame:
    """One row per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Kept are vectors of ``dim`` components, none NULL or non-finite; a component ``x`` becomes
    ``floor(scale * x)``. Centroids start as the ``k`` kept vectors with the smallest SHA-256 (lowercase
    hex) of ``seed:id``. Each round assigns every vector to the nearest centroid (squared distance, ties
    to the smaller number) and replaces a centroid that has vectors by the floors of their means. A
    last assignment gives the result; ``inertia`` sums the distances over all, ``centroid_sha256`` is the
    digest of the final centroid's integers joined by commas.

    Rows that repeat an id or a vector are rows of their own; of equal ids the smaller vector starts
    first. A row without an id is assigned like others but starts no centroid. Fewer than ``k`` rows give
    as many centroids; if no row can start one, clusters, distances and digests are NULL. An empty
    table gives no rows; other columns are ignored. Integers beyond 2**27 count as 2**27, and an
    inertia beyond a long is NULL.
    """
    rows = written(integer_vectors(vectors, id_col, vector_col, dim, scale), "centroid-vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = rows.filter("vec_id IS NOT NULL").select(order.alias("order"), "v").orderBy("order", "v").limit(k).collect()
    centroids = [list(row["v"]) for row in starts]
    if not centroids:
        return rows.selectExpr(
            "vec_id", "CAST(NULL AS int) AS cluster", "CAST(NULL AS bigint) AS distance",
            "CAST(NULL AS bigint) AS cluster_inertia", "CAST(NULL AS bigint) AS inertia", "CAST(NULL AS string) AS centroid_sha256",
        )
    for _ in range(rounds):
        centroids = moved(rows, centroids, dim)
    final = assigned(rows, centroids).select("vec_id", "nearest.cluster", "nearest.distance")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {row["cluster"]: int(row["s"]) for row in final.groupBy("cluster").agg(total.alias("s")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    place = F.col("cluster") + 1
    return final.select(
        "vec_id",
        "cluster",
        "distance",
        F.element_at(_literal([fits(sums.get(i, 0)) for i in range(len(centroids))]), place).alias("cluster_inertia"),
        F.lit(fits(sum(sums.values()))).cast("long").alias("inertia"),
        F.element_at(F.array(*map(F.lit, digests)), place).alias("centroid_sha256"),
    )


def _sql(rounds: int = 10) -> str:
    """The rounds as one chain of common table expressions."""
    steps = [
        """kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        """c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM
  (SELECT sha256('3:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT 8))""",
    ]
    pairs = "k.vec_id, k.v, c.c, list_inner_product(k.v, k.v) - 2 * list_inner_product(k.v, c.v) + list_inner_product(c.v, c.v) AS d"
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (SELECT vec_id, v, c, d FROM (SELECT {pairs} FROM kept k CROSS JOIN c{i} c)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)"""
        )
        if i < rounds:
            steps.append(
                f"""m{i} AS MATERIALIZED (SELECT c, list(m ORDER BY i) AS v FROM (SELECT c, i, floor(sum(x) / count(*)) AS m
  FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS i FROM a{i}) GROUP BY c, i) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN m{i} m ON m.c = o.c)"""
            )
    last = f"""
SELECT vec_id, a.c::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(list_transform(c.v, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.c"""
    return "WITH " + ",\n".join(steps) + last


ORACLE = _sql()
