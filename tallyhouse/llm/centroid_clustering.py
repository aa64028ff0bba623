"""Integer k-means with centroids as literals of JVM-native expressions.

Vectors become whole numbers and are written once. Every round is one scan: ``zip_with``
and ``aggregate`` give the inner product with each literal centroid, ``array_min`` over
structs of (distance, number) takes the nearest, and one generated sum per component,
combined before the shuffle, gives the next centroids. Only the sums of the k clusters
reach the driver, whatever the number of rows. A squared distance is
|v|^2 - 2 v.c + |c|^2, whose first term is stored and whose last is a literal.

Defined results: vectors that are null, of another size, or hold a null or a non-finite
component take no part. Rows that share an id are vectors of their own; rows without an
id take part, but start a centroid only where ids run out. Of equal hashes the smaller
vector starts first. With fewer vectors than ``k`` there are as many centroids as vectors.
Components beyond +-``FARTHEST`` count as that number, and distances and inertias beyond
64 bits are given as the largest 64-bit number.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import query
from tallyhouse.llm.common import Stages

DIMENSIONS = 64
SCALE = 256
K = 40
ROUNDS = 5
SEED = 2
#: Squared distances of 38 digits hold differences between components up to this.
FARTHEST = 6e17
LARGEST = (1 << 63) - 1


def usable(vector: Column, dimensions: int) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & fine, F.lit(False))


def whole_numbers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(FARTHEST)), F.lit(-FARTHEST))))


def nearest(centroids: list[list[int]], number: str) -> Column:
    """(distance, cluster) of the nearest centroid for columns ``v`` and ``square``.

    The optimizer folds the centroids into one literal array of structs.
    """
    rows = [{"c": c, "square": sum(x * x for x in c), "i": i} for i, c in enumerate(centroids)]
    choices = F.from_json(F.lit(json.dumps(rows)), f"array<struct<c:array<{number}>,square:{number},i:int>>")

    def distance(choice: Column) -> Column:
        products = F.zip_with("v", choice["c"], lambda a, b: (a * b).cast(number))
        inner = F.aggregate(products, F.lit(0).cast(number), lambda s, x: (s + x).cast(number))
        return choice["square"] - inner * 2 + F.col("square")

    return F.array_min(F.transform(choices, lambda c: F.struct(distance(c).alias("distance"), c["i"].alias("cluster"))))


def capped(number: int | None) -> int:
    return min(int(number or 0), LARGEST)


def cluster(
    vectors: DataFrame, vec_id: str, vector: str, k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED
) -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster, distance, cluster_inertia and inertia of every usable vector, and the final centroids."""
    stages = Stages(vectors.sparkSession)
    kept = stages.write(
        "vectors",
        vectors.where(usable(F.col(vector), dimensions)).select(F.col(vec_id).alias("vec_id"), whole_numbers(F.col(vector), scale).alias("v")),
    )
    peak = kept.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0
    # the largest sum of squared differences must fit
    number = "long" if dimensions * (2 * peak) ** 2 <= LARGEST else "decimal(38,0)"
    rows = kept.withColumn("v", F.col("v").cast(f"array<{number}>"))
    square = F.aggregate("v", F.lit(0).cast(number), lambda s, x: (s + (x * x).cast(number)).cast(number))
    rows = stages.write("squares", rows.withColumn("square", square))
    stages.drop("vectors")

    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    centroids = [[int(x) for x in r["v"]] for r in rows.select("v", named.alias("h")).orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()]
    for _ in range(rounds if centroids else 0):
        sums = [F.expr(f"sum(v[{j}]) AS s{j}") for j in range(dimensions)]
        assigned = rows.select("v", nearest(centroids, number)["cluster"].alias("cluster"))
        for r in assigned.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
            centroids[r["cluster"]] = [int(r[f"s{j}"]) // r["n"] for j in range(dimensions)]
    best = nearest(centroids, number) if centroids else F.lit(None).cast("struct<distance:long,cluster:int>")
    chosen = rows.select("vec_id", best.alias("best")).select(
        "vec_id", F.col("best.cluster").alias("cluster"), F.least("best.distance", F.lit(LARGEST)).cast("long").alias("distance")
    )
    chosen = stages.write("chosen", chosen)
    stages.drop("squares")
    inertia = {r["cluster"]: int(r["s"]) for r in chosen.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    by_cluster = F.array(*[F.lit(capped(inertia.get(i))) for i in range(len(centroids))]).cast("array<long>")
    result = chosen.withColumn("cluster_inertia", F.get(by_cluster, F.col("cluster"))).withColumn(
        "inertia", F.lit(capped(sum(inertia.values()))).cast("long")
    )
    return result, centroids


def _round(n: int) -> str:
    """SQL: assign to the centroids c{n - 1}, then move them to c{n}."""
    return f"""
, a{n} AS (
  SELECT vec_id, v, d, cluster FROM (
    SELECT vec_id, v, cluster, {_DISTANCE} AS d, row_number() OVER (PARTITION BY row ORDER BY {_DISTANCE}, cluster) AS place
    FROM kept, c{n - 1}
  ) WHERE place = 1
), m{n} AS (
  SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c FROM (
    SELECT cluster, j, sum(v[j]) AS s, count(*) AS n FROM a{n}, range(1, {DIMENSIONS + 1}) AS r(j) GROUP BY cluster, j
  ) GROUP BY cluster
), c{n} AS (SELECT cluster, coalesce(m{n}.c, c{n - 1}.c) AS c FROM c{n - 1} LEFT JOIN m{n} USING (cluster))"""


_DISTANCE = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"

SQL = f"""
WITH kept AS (
  SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v) - 1 AS INTEGER) AS cluster, v AS c
  FROM kept QUALIFY cluster < {K}
){"".join(_round(n) for n in range(1, ROUNDS + 2))}
SELECT vec_id, cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS + 1} JOIN c{ROUNDS} USING (cluster)
"""


@query("op13_centroid_clustering", SQL)
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered, centroids = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    digests = [F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids]
    return clustered.withColumn("centroid_sha256", F.get(F.array(*digests).cast("array<string>"), F.col("cluster")))
