"""k-means over integer vectors, written in JVM expressions only.

Every component x becomes the integer floor(scale * x), so all sums and distances are exact and
the result does not depend on how rows are dealt to tasks. In a round `zip_with` and `aggregate`
give the squared distance of a vector to each centroid, which stand in the plan as literal
arrays; `array_min` over (distance, number) structs chooses the cluster, the smaller number on
ties; and one sum per component and cluster, added up in the tasks before anything is shuffled,
gives the next centroids. A round sends `k` rows of sums to the driver, whatever the input's size,
and the shuffle carries `k` rows a task, so a cluster with most of the rows is no hot spot. Once
no centroid moves, the rounds left would change nothing and are not run.

Cases: rows whose vector is null, has another length, or holds a null, NaN or infinite
component are left out. Integers beyond 2**27 in size are set to that bound, so that a distance
fits 64 bits. Centroids start as the `k` kept vectors with the smallest SHA-256 of
`<seed>:<id>` (a null id hashes as an empty one; equal ids go by their vectors); fewer kept
vectors make fewer clusters, none an empty result. A centroid without vectors stays where it is.
Repeated rows stay repeated. A sum of distances that exceeds 64 bits is null. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from presslens.sources.storage import write_table

LIMIT = 1 << 27  # so that 4096 squared differences fit 64 bits


def integer_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): kept rows with their components as long integers."""
    x = F.col(vec_col)
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.filter((F.size(x) == dims) & sound)
    bounded = lambda c: F.greatest(F.least(c.cast("double") * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))
    return kept.select(
        F.col(id_col).alias("vec_id"), F.transform(x, lambda c: F.floor(bounded(c)).cast("long")).alias("v")
    )


def _literal(centroid: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{c}L' for c in centroid)})")


def squared_distance(vector: Column, centroid: list[int]) -> Column:
    """Exact squared Euclidean distance to a literal centroid."""
    squares = F.zip_with(vector, _literal(centroid), lambda x, c: (x - c) * (x - c))
    return F.aggregate(squares, F.lit(0).cast("long"), lambda total, s: total + s)


def nearest(vector: Column, centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid, the smaller number on ties."""
    choices = (
        F.struct(squared_distance(vector, c).alias("distance"), F.lit(i).alias("cluster"))
        for i, c in enumerate(centroids)
    )
    return F.array_min(F.array(*choices))


def _first_centroids(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = kept.select("v", F.sha2(name, 256).alias("h")).orderBy("h", "v").limit(k)
    return [list(r.v) for r in chosen.collect()]


def _moved(kept: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """Floors of the means; Python's division floors towards minus infinity, as wanted."""
    sums = [F.expr(f"sum(v[{i}]) AS s{i}") for i in range(dims)]
    placed = kept.select("v", nearest(F.col("v"), centroids)["cluster"].alias("cluster"))
    out = list(centroids)
    for row in placed.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        out[row.cluster] = [row[f"s{i}"] // row.n for i in range(dims)]
    return out


def clustered(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector."""
    if k < 1 or dims < 1 or dims > 4096:
        raise ValueError("k must be positive and dims between 1 and 4096")
    kept = write_table(integer_vectors(vectors, dims, scale, id_col, vec_col), "integer-vectors")
    centroids = _first_centroids(kept, k, seed)
    for _ in range(rounds if centroids else 0):
        before, centroids = centroids, _moved(kept, centroids, dims)
        if centroids == before:
            break
    best = nearest(F.col("v"), centroids or [[0] * dims])
    placed = kept.select("vec_id", best.alias("best")).select("vec_id", "best.cluster", "best.distance")
    placed = write_table(placed, "clustered")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {r.cluster: int(r.s) for r in sums}
    whole = sum(inertia.values())
    fits = lambda x: F.lit(x if x < 1 << 63 else None).cast("long")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    own = [fits(inertia.get(i, 0)) for i in range(len(centroids))] or [fits(0)]
    at = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1)
    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        at(own).alias("cluster_inertia"),
        fits(whole).alias("inertia"),
        at([F.lit(d) for d in digests] or [F.lit("")]).alias("centroid_sha256"),
    )
