"""Centroid clustering by sort-means.

Every round orders the other centroids by their distance from each centroid. A vector is scanned from the centroid
it was assigned to: the others come in that order, and the scan stops at the first that lies strictly beyond twice the vector's distance
from its own centroid, as neither it nor any later one can be nearer, nor as near. So the result is that of a
comparison with all centroids, ties to the smaller number included. A round is one pass over the vectors, which carry their
assignment along, and one sum by cluster, of which a task gives one row per cluster; the driver holds the centroids alone.

Defined results: vectors that are null, have other than `dims` components or hold null or non-finite ones are
dropped, as are those with a component of 65536 or more on either side, whose squared distances need not fit in a long.
Of equal vec_ids the smaller vector comes first among the first centroids, null vec_ids come last; repeated rows are rows of their
own. With fewer than k vectors there are that many centroids. A cluster without vectors keeps its centroid. An
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm.common import cut, small_batches, table
from siltlake.llm.vectors import component_sums, integers, matrix, squared, whole

CLUSTERS, ROUNDS, DIMS, SEED = 8, 10, 64, 3
STATE = "vec_id long, v array<int>, cluster int, distance long"


def scan(x: np.ndarray, was: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest center of each row, its squared distance, and how many distances were taken. was: the rows' centers before."""
    between = squared(centers, centers)
    best, own = was.copy(), ((x - centers[was]) ** 2).sum(1)
    near, looked = own.copy(), len(x)
    for a in range(len(centers)):
        rows = np.flatnonzero(was == a)
        for c in (c for c in np.argsort(between[a], kind="stable").tolist() if c != a):
            rows = rows[between[a, c] <= 4 * own[rows]]  # beyond twice the distance: its square beyond four times the square
            if not len(rows):
                break
            far = ((x[rows] - centers[c]) ** 2).sum(1)
            looked += len(rows)
            better = (far < near[rows]) | ((far == near[rows]) & (c < best[rows]))
            near[rows[better]], best[rows[better]] = far[better], c
    return best, near, looked


def assign(centers: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, near, _ = scan(matrix(batch["v"], centers.shape[1]), batch["cluster"].to_numpy(), centers)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["v"], pa.array(best, pa.int32()), pa.array(near)], ["vec_id", "v", "cluster", "distance"])

    return run


def sums_by_cluster(k: int, dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, inertia = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            cluster = batch["cluster"].to_numpy()
            np.add.at(counts, cluster, 1)
            np.add.at(sums, cluster, matrix(batch["v"], dims))
            np.add.at(inertia, cluster, batch["distance"].to_numpy())
        c = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(counts[c]), pa.array(sums[c].tolist(), pa.list_(pa.int64())), pa.array(inertia[c])], ["cluster", "n", "sums", "inertia"])

    return run


def by_cluster(state: DataFrame, k: int, dims: int) -> dict[int, tuple[int, list[int], int]]:
    """Count, component sums and inertia of each cluster that has vectors."""
    found = state.mapInArrow(sums_by_cluster(k, dims), "cluster long, n long, sums array<long>, inertia long")
    return {r["cluster"]: (r["n"], r["sums"], r["inertia"]) for r in component_sums(found, ["cluster"], dims, F.sum("inertia").alias("inertia")).collect()}  # k rows at most


def sort_means(df: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, v, cluster, distance) of each vector kept, and the final centroids."""
    spark = df.sparkSession
    small_batches(spark)
    vector = F.col("embedding")
    kept = df.where(whole(vector) & (F.size(vector) == dims)).select(F.col("vec_id").cast("long").alias("vec_id"), integers(vector).alias("v"), F.lit(0).alias("cluster"))
    state = cut(kept)
    first = state.orderBy(F.asc_nulls_last(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)), "v").select("v").limit(k).collect()  # k rows
    if not first:
        return spark.createDataFrame([], STATE), []
    centers = np.array([r["v"] for r in first], np.int64)
    for n in range(rounds + 1):
        state = cut(state.mapInArrow(assign(centers), STATE))
        if n < rounds:
            centers = centers.copy()
            for c, (count, sums, _) in by_cluster(state, len(centers), dims).items():
                centers[c] = [s // count for s in sums]
    return state, centers.tolist()


def op12_sort_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, centers = sort_means(table(spark, sf_dir, "embeddings"))
    found = by_cluster(state, len(centers), DIMS) if centers else {}
    total = sum(inertia for _, _, inertia in found.values())
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    about = spark.createDataFrame([(c, found[c][2], total, shas[c]) for c in sorted(found)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # CLUSTERS rows


def oracle_sql(k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, seed: int = SEED) -> str:
    def nearest(n: int) -> str:
        far = "list_dot_product(v, v) - 2 * list_dot_product(v, c) + list_dot_product(c, c)"
        return f"a{n} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, min({{'d': ({far})::BIGINT, 'e': entry}}) AS m FROM k, b{n} GROUP BY vec_id)"

    steps = [
        f"k AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"b0 AS MATERIALIZED (SELECT entry, v AS c FROM (SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS entry FROM k) WHERE entry < {k})",
    ]
    for n in range(rounds):
        steps += [
            nearest(n),
            f"s{n} AS (SELECT m.e AS e, i, sum(v[i]::BIGINT) AS t, count(*) AS n FROM a{n}, range(1, {dims + 1}) r(i) GROUP BY ALL)",
            f"b{n + 1} AS MATERIALIZED (SELECT b.entry, coalesce(any_value(g.c), any_value(b.c)) AS c FROM b{n} b LEFT JOIN (SELECT e, list(((t - ((t % n) + n) % n) // n)::DOUBLE ORDER BY i) AS c FROM s{n} GROUP BY e) g ON b.entry = g.e GROUP BY b.entry)",
        ]
    steps += [nearest(rounds), f"h AS (SELECT entry, sha256(string_agg(c[i]::BIGINT::VARCHAR, ',' ORDER BY i)) AS h FROM b{rounds}, range(1, {dims + 1}) r(i) GROUP BY entry)"]
    return f"WITH {', '.join(steps)} SELECT vec_id, m.e::INTEGER AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.e))::BIGINT AS cluster_inertia, (sum(m.d) OVER ())::BIGINT AS inertia, h AS centroid_sha256 FROM a{rounds} JOIN h ON m.e = entry"
