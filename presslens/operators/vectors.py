"""Bounds, exact nearest neighbours, sampling and k-means over vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import FloatType

from presslens.functions.vectors import l2_normalise, layer_norm
from presslens.operators.dedup import keep_first
from presslens.operators.ranking import sample_n
from presslens.sources.storage import write_table

# A side is broadcast only if its vectors were counted to take at most this many bytes.
BROADCAST_BYTES = 64 << 20
# Vectors of a block, and aimed at in a cell of the base, when both sides are larger.
GRID_ROWS = 16_384
CELL_ROWS = 4_096
# Bytes that the centres of all cells may take together; they are sent to every task.
CENTRE_BYTES = 16 << 20
# Distance cells computed at a time inside a task.
_CELLS = 1_000_000
# Rows of a shipped base that a task holds in double precision at a time.
_BASE_ROWS = 16_384


def normalise_vectors(df: DataFrame, vector: str, out: str | None = None) -> DataFrame:
    """Layer norm over the dimensions, then length 1."""
    return df.withColumn(out or vector, l2_normalise(layer_norm(F.col(vector))))


def mean_pooling(
    df: DataFrame, keys: list[str], vector: str, mask: str | None = None, out: str = "pooled"
) -> DataFrame:
    """Masked mean of token vectors per key."""
    kept = df.filter(F.col(mask) > 0) if mask else df
    cells = kept.select(*keys, F.posexplode(F.col(vector).cast("array<double>")).alias("_i", "_x"))
    means = cells.groupBy(*keys, "_i").agg(F.avg("_x").alias("_m"))
    # One entry per dimension, so the list is as long as a vector.
    ordered = F.array_sort(F.collect_list(F.struct("_i", "_m")))
    return means.groupBy(*keys).agg(F.transform(ordered, lambda s: s["_m"]).alias(out))


def vector_bounds(df: DataFrame, vector: str) -> DataFrame:
    """(dim, low, high) over all vectors, with map-side minima and maxima."""
    cells = df.select(F.posexplode(F.col(vector)).alias("dim", "_x"))
    return cells.groupBy("dim").agg(F.min("_x").alias("low"), F.max("_x").alias("high"))


def _matrix(series: pd.Series, kind: type = np.float64) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=kind) for v in series])


def _nearest(points: np.ndarray, base: np.ndarray, base_ids: np.ndarray, k: int):
    """Per point (distances, ids) of its k nearest base vectors, ties by id.

    The matrix product of centred vectors finds who can be among the k, with a slack that
    covers its rounding error; their distances are then recomputed from differences, so
    cancellation cannot change the order.
    """
    k = min(k, len(base))
    middle = base.mean(axis=0)
    centred = base - middle
    base_norms = (centred**2).sum(axis=1)
    error = 4 * np.finfo(np.float64).eps * (base.shape[1] + 8)
    step = max(1, _CELLS // len(base))
    for start in range(0, len(points), step):
        piece = points[start : start + step]
        moved = piece - middle
        norms = (moved**2).sum(axis=1)
        rough = norms[:, None] + base_norms[None, :] - 2.0 * moved @ centred.T
        # Centring rounds each coordinate by an ulp of its original size.
        shift = np.abs(piece).max(initial=0.0) + np.abs(base).max(initial=0.0)
        far = np.sqrt(norms) + np.sqrt(base_norms.max())
        slack = error * (far + shift * np.finfo(np.float64).eps) * (far + shift)
        bars = np.partition(rough, k - 1, axis=1)[:, k - 1] + slack
        for row, bar, point in zip(rough, bars, piece):
            near = np.flatnonzero(row <= bar)
            exact = ((base[near] - point) ** 2).sum(axis=1)
            order = np.lexsort((base_ids[near], exact))[:k]
            yield exact[order], base_ids[near][order]


def _nearest_by_blocks(points: np.ndarray, base: np.ndarray, base_ids: np.ndarray, k: int) -> list:
    """_nearest, the base taken in blocks, so that memory beside the shipped base is bounded."""
    best: list = []
    for at in range(0, len(base), _BASE_ROWS):
        block = base[at : at + _BASE_ROWS].astype(np.float64)
        found = list(_nearest(points, block, base_ids[at : at + _BASE_ROWS], k))
        if best:
            pairs = zip(best, found)
            both = [(np.concatenate([d, e]), np.concatenate([i, j])) for (d, i), (e, j) in pairs]
            found = [(d[o], i[o]) for d, i in both for o in [np.lexsort((i, d))[:k]]]
        best = found
    return best


def euclidean_exact(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distance matrix from differences, a few rows at a time: relative errors stay tiny."""
    out = np.empty((len(points), len(centres)))
    step = max(1, _CELLS // max(1, centres.size))
    for at in range(0, len(points), step):
        diff = points[at : at + step, None, :] - centres[None, :, :]
        out[at : at + step] = np.sqrt((diff**2).sum(axis=2))
    return out


def _neighbour_frame(query_id: str, ids: np.ndarray, found: list) -> pd.DataFrame:
    return pd.DataFrame(
        {
            query_id: np.repeat(ids, [len(d) for d, _ in found]),
            "neighbour_id": np.concatenate([i for _, i in found]),
            "distance": np.concatenate([d for d, _ in found]),
            "rank": np.concatenate([np.arange(1, len(d) + 1) for d, _ in found]),
        }
    )


def _id_type(df: DataFrame, id_col: str) -> str:
    return df.schema[id_col].dataType.simpleString()


def sound_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is neither null nor holds a null, NaN or infinite element."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter(F.col(vector).isNotNull() & finite)


def _of_one_length(df: DataFrame, vector: str) -> tuple[DataFrame, int, int]:
    """Sound rows of the most frequent length (the longer on a tie), that length and their number."""
    sound = sound_vectors(df, vector).withColumn("_dims", F.size(vector)).filter("_dims > 0")
    counts = sound.groupBy("_dims").agg(F.count("*").alias("n"))
    most = counts.orderBy(F.desc("n"), F.desc("_dims")).limit(1).first()
    if most is None:
        return sound.drop("_dims"), 0, 0
    return sound.filter(F.col("_dims") == most["_dims"]).drop("_dims"), most["_dims"], most["n"]


def _is_small(df: DataFrame, dims: int) -> bool:
    rows = BROADCAST_BYTES // (8 * max(1, dims))
    return df.limit(rows + 1).count() <= rows


def _shipped(df: DataFrame, id_col: str, vector: str):
    """Broadcast variable of a side whose size has been checked; floats stay floats."""
    rows = df.select(id_col, vector).toPandas()
    single = isinstance(df.schema[vector].dataType.elementType, FloatType)
    matrix = _matrix(rows[vector], np.float32 if single else np.float64) if len(rows) else np.empty((0, 0))
    return df.sparkSession.sparkContext.broadcast((rows[id_col].to_numpy(), matrix))


def _merge_top_k(found: DataFrame, query_id: str, k: int) -> DataFrame:
    order = Window.partitionBy(query_id).orderBy("distance", "neighbour_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def knn(
    queries: DataFrame, base: DataFrame, query_id: str, base_id: str, vector: str, k: int
) -> DataFrame:
    """(query_id, neighbour_id, distance, rank): exact k nearest by squared L2, ties by id.

    A small base is sent to the query rows and needs no shuffle. Few queries are sent to
    the base rows; each task keeps k per query and a top-k merges them. Two large sides meet in
    cells of the base that bounds leave for a query. Vectors that are null or hold a null, NaN
    or infinite element take no part on either side, nor do those of another length than most
    sound base vectors. Query ids should be unique.
    """
    base, dims, n_base = _of_one_length(base, vector)
    queries = sound_vectors(queries, vector).filter(F.size(vector) == dims)
    schema = (
        f"`{query_id}` {_id_type(queries, query_id)}, "
        f"neighbour_id {_id_type(base, base_id)}, distance double, rank int"
    )
    if n_base * dims * 8 <= BROADCAST_BYTES:
        shared = _shipped(base, base_id, vector)

        def search_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, matrix = shared.value
            for batch in batches:
                if len(batch) and len(ids):
                    found = _nearest_by_blocks(_matrix(batch[vector]), matrix, ids, k)
                    yield _neighbour_frame(query_id, batch[query_id].to_numpy(), found)

        return queries.select(query_id, vector).mapInPandas(search_rows, schema)
    if _is_small(queries, dims):
        shared = _shipped(queries, query_id, vector)

        def search_base(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, matrix = shared.value
            best = None
            for batch in batches:
                if not len(batch) or not len(ids):
                    continue
                found = _nearest(matrix.astype(np.float64), _matrix(batch[vector]), batch[base_id].to_numpy(), k)
                near = _neighbour_frame(query_id, ids, list(found))
                best = near if best is None else pd.concat([best, near])
                best = best.sort_values([query_id, "distance", "neighbour_id"])
                best = best.groupby(query_id, sort=False).head(k)
            if best is not None:
                yield best

        found = base.select(F.col(base_id), vector).mapInPandas(search_base, schema)
        return _merge_top_k(found, query_id, k)
    cells = _Cells(base, base_id, vector, dims, n_base)
    return cells.search(queries, query_id, k, schema)


class _Cells:
    """The base in cells around sampled centres, each with the distances of its nearest and
    farthest member from the centre.

    By the triangle inequality a member x of a cell with centre c and ring [low, high] is at
    least max(d(q, c) - high, low - d(q, c)) away from q. A query first visits the cells of the
    least bounds that hold k vectors between them. The k-th distance found there is an upper
    bound, and only cells whose lower bound does not exceed it are visited in the second round;
    the others, with their vectors, are neither copied nor compared. The centres are a sample of
    bounded size; they decide the work, not the result.
    """

    def __init__(self, base: DataFrame, base_id: str, vector: str, dims: int, n_base: int):
        self.base_id, self.vector = base_id, vector
        n_cells = max(1, min(-(-n_base // CELL_ROWS), CENTRE_BYTES // (8 * dims)))
        sample = sample_n(base.select(base_id, vector), [base_id], n_cells).toPandas()
        centres = _matrix(sample[vector])
        shared = base.sparkSession.sparkContext.broadcast(centres)

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    apart = euclidean_exact(_matrix(batch[vector]), shared.value)
                    batch["_cell"] = apart.argmin(axis=1)
                    batch["_far"] = apart.min(axis=1)
                    yield batch

        kind = base.schema[vector].dataType.simpleString()
        schema = f"`{base_id}` {_id_type(base, base_id)}, `{vector}` {kind}, _cell bigint, _far double"
        placed = base.select(base_id, vector).mapInPandas(assign, schema)
        self.placed = write_table(placed, "cells")
        rings = self.placed.groupBy("_cell").agg(
            F.count("*").alias("n"), F.min("_far").alias("low"), F.max("_far").alias("high")
        )
        stats = rings.toPandas().sort_values("_cell")  # a row per centre at most
        # Cells that hold no vector (equal centres) have nothing to visit.
        self.numbers = stats["_cell"].to_numpy()
        self.sizes, self.low, self.high = (stats[c].to_numpy() for c in ("n", "low", "high"))
        self.centres = base.sparkSession.sparkContext.broadcast(centres[self.numbers])

    def _router(self, query_id: str, k: int):
        """First round (no `_bar`): cells that hold k vectors. Second: the rest within the bar."""
        vector, numbers, sizes, low, high = self.vector, self.numbers, self.sizes, self.low, self.high
        centres = self.centres

        def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                apart = euclidean_exact(_matrix(batch[vector]), centres.value)
                bound = np.maximum(np.maximum(apart - high, low - apart), 0.0)
                # Roundings of the distances must not lift a bound over a true distance.
                bound = np.maximum(bound - 1e-9 * (apart + high), 0.0)
                order = np.lexsort((apart, bound), axis=1)
                held = np.cumsum(sizes[order], axis=1)
                first = np.zeros(bound.shape, bool)
                np.put_along_axis(first, order, held - sizes[order] < k, axis=1)
                if "_bar" in batch:
                    bar = np.sqrt(batch["_bar"].to_numpy(np.float64))[:, None] * (1 + 1e-12)
                    wanted = ~first & ((bound <= bar) | np.isnan(bar))
                else:
                    wanted = first
                row, cell = np.nonzero(wanted)
                out = batch[[query_id, vector]].iloc[row].reset_index(drop=True)
                out["_cell"] = numbers[cell]
                yield out

        return route

    def _meet(self, routed: DataFrame, query_id: str, k: int, schema: str) -> DataFrame:
        """Neighbours in the cells that queries were routed to, in blocks of bounded size."""
        base_id, vector = self.base_id, self.vector
        whole = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
        needed = routed.groupBy("_cell").agg(F.ceil(F.count("*") / GRID_ROWS).alias("_rows"))
        blocks = [(int(c), int(-(-n // GRID_ROWS))) for c, n in zip(self.numbers, self.sizes)]
        cols = routed.sparkSession.createDataFrame(blocks, "_cell bigint, _cols bigint")
        needed = write_table(needed.join(cols, "_cell"), "needed-cells")
        left = routed.join(needed, "_cell").withColumns(
            {
                "_row": F.pmod(F.xxhash64(query_id), F.col("_rows")),
                "_col": F.explode(whole(F.col("_cols"))),
            }
        )
        right = self.placed.select(base_id, vector, "_cell").join(needed, "_cell").withColumns(
            {
                "_row": F.explode(whole(F.col("_rows"))),
                "_col": F.pmod(F.xxhash64(base_id), F.col("_cols")),
            }
        )

        def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(b):
                return pd.DataFrame(columns=[query_id, "neighbour_id", "distance", "rank"])
            found = _nearest(_matrix(a[vector]), _matrix(b[vector]), b[base_id].to_numpy(), k)
            return _neighbour_frame(query_id, a[query_id].to_numpy(), list(found))

        key = ["_cell", "_row", "_col"]
        met = left.drop("_rows", "_cols").groupBy(*key).cogroup(right.drop("_rows", "_cols").groupBy(*key))
        return _merge_top_k(met.applyInPandas(compare, schema), query_id, k)

    def search(self, queries: DataFrame, query_id: str, k: int, schema: str) -> DataFrame:
        rows = write_table(queries.select(query_id, self.vector), "queries")
        kind = queries.schema[self.vector].dataType.simpleString()
        routed = f"`{query_id}` {_id_type(queries, query_id)}, `{self.vector}` {kind}, _cell bigint"
        route = self._router(query_id, k)
        first = write_table(rows.mapInPandas(route, routed), "routed")
        near = write_table(self._meet(first, query_id, k, schema), "neighbours")
        bars = near.filter(F.col("rank") == k).select(F.col(query_id), F.col("distance").alias("_bar"))
        open_ = rows.join(bars, query_id, "left")  # without k vectors so far there is no bar
        second = write_table(open_.mapInPandas(route, routed), "routed")
        more = self._meet(second, query_id, k, schema)
        return _merge_top_k(near.unionByName(more), query_id, k)


def diagonal_points(df: DataFrame, vector: str, n: int) -> DataFrame:
    """(point, vector): n evenly spaced points on the line from the low to the high corner."""
    bounds = vector_bounds(df, vector)
    ordered = F.array_sort(F.collect_list(F.struct("dim", "low", "high")))
    corners = bounds.agg(ordered.alias("_b"))  # one entry per dimension
    share = F.col("point") / max(n - 1, 1)
    line = F.transform(
        "_b",
        lambda b: b["low"].cast("double") + (b["high"].cast("double") - b["low"].cast("double")) * share,
    )
    points = corners.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return points.select("point", line.alias(vector))


def sample_diagonal(
    df: DataFrame, id_col: str, vector: str, n: int = 200, dedup: list[str] | None = None
) -> DataFrame:
    """Distinct rows nearest to n points across the occupied space."""
    near = knn(diagonal_points(df, vector, n), df, "point", id_col, vector, 1)
    ids = near.select(F.col("neighbour_id").alias(id_col)).distinct()
    picked = df.join(F.broadcast(ids), id_col, "left_semi")  # at most n ids
    return keep_first(picked, dedup, [id_col]) if dedup else picked


def sample_kmeans(
    df: DataFrame, id_col: str, vector: str, k: int = 200, seed: int = 0
) -> DataFrame:
    """The row nearest to each centre of a k-means fitted on all rows with a sound vector of the
    most frequent length; no rows where there are none."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    known, dims, _ = _of_one_length(df, vector)
    if not dims:
        return df.limit(0)
    features = known.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    features = features.persist()  # read once for all rounds
    model = KMeans(k=k, seed=seed).fit(features)
    features.unpersist()
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    points = df.sparkSession.createDataFrame(centres, f"centre int, `{vector}` array<double>")
    near = knn(points, df, "centre", id_col, vector, 1)
    ids = near.select(F.col("neighbour_id").alias(id_col)).distinct()
    return df.join(F.broadcast(ids), id_col, "left_semi")  # at most k ids


def euclidean(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distance matrix by a matrix product, centred so that little is cancelled."""
    middle = centres.mean(axis=0)
    p, c = points - middle, centres - middle
    squares = (p**2).sum(axis=1)[:, None] + (c**2).sum(axis=1)[None, :] - 2.0 * p @ c.T
    return np.sqrt(np.maximum(squares, 0.0))


def kmeans_custom(
    df: DataFrame,
    id_col: str,
    vector: str,
    k: int,
    max_iter: int = 100,
    tol: float = 1e-4,
    distance: Callable[[np.ndarray, np.ndarray], np.ndarray] = euclidean,
    vector_fn: Callable[[np.ndarray], np.ndarray] | None = None,
    seed: int = 42,
) -> DataFrame:
    """(id, cluster) of Lloyd's algorithm under any distance.

    distance(points, centres) returns a matrix, vector_fn maps a matrix of raw vectors.
    Each round ships k centres, sums per task and cluster, and returns k rows. A cluster
    that loses all its members keeps its centre. Rows without a sound vector of the most frequent
    length (see knn) get no cluster; an empty table gives none.
    """
    transform = vector_fn or (lambda m: m)
    known, dims, _ = _of_one_length(df, vector)
    label_schema = f"`{id_col}` {_id_type(df, id_col)}, cluster int"
    if not dims:
        return df.sparkSession.createDataFrame([], label_schema)
    start = sample_n(known, [id_col], k, seed).select(vector).collect()  # k rows
    centres = transform(np.array([r[0] for r in start], dtype=np.float64))
    if len(centres) < k:
        raise ValueError("fewer rows than clusters")
    rows = known.select(id_col, vector)
    rounds = rows.persist()  # read once for all rounds

    def assign(matrix: np.ndarray, current: np.ndarray) -> np.ndarray:
        return distance(transform(matrix), current).argmin(axis=1)

    def partial_sums(current: np.ndarray):
        def run(batches):
            sums = np.zeros_like(current)
            counts = np.zeros(k, dtype=np.int64)
            for batch in batches:
                if batch.empty:
                    continue
                matrix = _matrix(batch[vector])
                chosen = assign(matrix, current)
                np.add.at(sums, chosen, transform(matrix))
                counts += np.bincount(chosen, minlength=k)
            yield pd.DataFrame({"cluster": np.arange(k), "n": counts, "total": list(sums)})

        return run

    for _ in range(max_iter):
        parts = rounds.mapInPandas(
            partial_sums(centres), "cluster int, n bigint, total array<double>"
        )
        cells = parts.select("cluster", "n", F.posexplode("total").alias("i", "x"))
        merged = (
            cells.groupBy("cluster", "i")
            .agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
            .filter("n > 0")
            .collect()  # k times the dimension
        )
        moved = centres.copy()
        for r in merged:
            moved[r["cluster"], r["i"]] = r["x"] / r["n"]
        shift = np.linalg.norm(moved - centres)
        centres = moved
        if shift < tol:
            break

    rounds.unpersist()
    final = centres

    def label(batches):
        for batch in batches:
            if not batch.empty:
                chosen = assign(_matrix(batch[vector]), final)
                yield pd.DataFrame({id_col: batch[id_col], "cluster": chosen.astype(np.int32)})

    return rows.mapInPandas(label, label_schema)
