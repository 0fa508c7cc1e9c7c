"""Exact k-means over integer vectors: bounds remember the second-nearest centroid, and few centroids are looked at.

Every vector carries, from round to round, its centroid, its second-nearest centroid, an upper bound on its
distance to the first and a lower bound on that to all others.  Centroids that move loosen the bounds.  Only
where they overlap, the vector is compared anew: from the closer of the two remembered centroids the others come
by falling nearness, and the search ball (distance to that centroid plus distance to the second-best so far)
shrinks with every better one found.  What is inside the ball is compared by exact squared distances in
integers; bounds are floats rounded to the safe side, so ties are found and go to the smaller number.

Each round is one pass over a table in the shared folder, written anew with its bounds, and one grouped sum of
``k * dims`` values.  Only centroids (``k * dims`` integers) are on the driver and go with the tasks.

Defined results: a vector that is null, has another length, or holds a null or a value that is not finite is not
kept.  A null id counts as empty text when starting centroids are drawn and stays null in the result; equal ids draw by their components.
Repeated rows are vectors of their own.  Fewer than ``k`` vectors give as many centroids.  An empty table gives no
rows.  Other columns are left out, so their names can't clash.  Components beyond the width in which squared
distances fit 64 bits (2**27 for 64 dimensions) are an error, as is a sum beyond 64 bits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riffle.llm.common import give_back, materialize, table
from riffle.llm.registry import query
from riffle.session import discard

ROWS_AT_ONCE = 4096
#: Wider than any rounding of the few float operations between two bounds.
SLACK = 1e-12
_STATE = "x array<bigint>, cluster int, second int, upper double, lower double"
_NAMES = [f.split()[0] for f in _STATE.split(", ")]


def integer_vectors(df: DataFrame, vector: str = "embedding", dims: int = 64, scale: int = 64, id: str = "vec_id") -> DataFrame:
    """Rows (id, x) of the vectors with ``dims`` finite components, each as floor(scale * component)."""
    finite = F.forall(vector, lambda e: F.coalesce(F.abs(e.cast("double")) < float("inf"), F.lit(False)))
    kept = df.where((F.size(vector) == dims) & finite)
    most = float(math.isqrt((1 << 61) // dims))

    def whole(e: Column) -> Column:
        y = F.floor(e.cast("double") * F.lit(float(scale)))
        return F.when(F.abs(e.cast("double")) * float(scale) < most, y).otherwise(F.raise_error(F.lit("component too large for 64-bit distances")).cast("bigint"))

    return kept.select(F.col(id).alias("id"), F.transform(vector, whole).alias("x"))


def starting_centroids(vectors: DataFrame, k: int, seed: str = "1") -> np.ndarray:
    """The ``k`` vectors whose id has the smallest sha256 after ``seed:``; a top-k of fixed size."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(key, "x").limit(k).select("x").collect()
    return np.array([r.x for r in rows], dtype=np.int64)


class Search:
    """Centroids with what a search needs: neighbours of each by distance, and half the way to the nearest."""

    def __init__(self, centroids: np.ndarray, moved: np.ndarray | None = None):
        self.centroids, self.k = centroids, len(centroids)
        gap = np.sqrt(((centroids[:, None] - centroids[None]) ** 2).sum(2).astype(np.float64)) * (1 - SLACK)
        np.fill_diagonal(gap, -1.0)  # each comes first among its own neighbours
        self.order = np.argsort(gap, axis=1, kind="stable")
        self.gap = np.take_along_axis(gap, self.order, axis=1)
        self.half = self.gap[:, 1] / 2 if self.k > 1 else np.full(self.k, np.inf)
        moved = np.zeros(self.k) if moved is None else moved
        self.moved = moved
        by_way = np.argsort(-moved, kind="stable")
        #: how far the farthest-moving other centroid went
        self.others = np.full(self.k, moved[by_way[0]])
        if self.k > 1:
            self.others[by_way[0]] = moved[by_way[1]]
        self.compared = 0

    def distance(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Squared distances in integers."""
        self.compared += len(x)
        step = x - self.centroids[which]
        return np.einsum("ij,ij->i", step, step)

    def assign(self, x, cluster, second, upper, lower):
        """New (cluster, second, upper, lower) of vectors whose bounds held for the centroids before they moved."""
        cluster, second, upper, lower = cluster.copy(), second.copy(), upper.copy(), lower.copy()
        upper = (upper + self.moved[cluster]) * (1 + SLACK)
        lower = (lower - self.others[cluster]) * np.where(lower > self.others[cluster], 1 - SLACK, 1 + SLACK)
        open_ = np.flatnonzero(~(upper < np.maximum(lower, self.half[cluster])))
        if len(open_):
            near = self.distance(x[open_], cluster[open_])
            upper[open_] = np.sqrt(near.astype(np.float64)) * (1 + SLACK)
            still = ~(upper[open_] < np.maximum(lower[open_], self.half[cluster[open_]]))
            open_, near = open_[still], near[still]
        if len(open_) and self.k > 1:
            cluster[open_], second[open_], near, far = self._search(x[open_], cluster[open_], second[open_], near)
            upper[open_] = np.sqrt(near.astype(np.float64)) * (1 + SLACK)
            lower[open_] = np.sqrt(far.astype(np.float64)) * (1 - SLACK)
        return cluster, second, upper, lower

    def _search(self, x, best, second, near):
        far = self.distance(x, second)
        swap = (far < near) | ((far == near) & (second < best))
        best, second = np.where(swap, second, best), np.where(swap, best, second)
        near, far = np.where(swap, far, near), np.where(swap, near, far)
        start, known = best.copy(), second.copy()
        radius = np.sqrt(near.astype(np.float64)) * (1 + SLACK)  # from the vector to where the search starts
        going = np.arange(len(x))
        for place in range(1, self.k):
            ball = radius[going] + np.sqrt(far[going].astype(np.float64)) * (1 + SLACK)
            going = going[~(self.gap[start[going], place] > ball)]
            if not len(going):
                break
            other = self.order[start[going], place]
            fresh = other != known[going]  # the second one is measured already
            at, other = going[fresh], other[fresh]
            d = self.distance(x[at], other)
            first = (d < near[at]) | ((d == near[at]) & (other < best[at]))
            next_ = ~first & ((d < far[at]) | ((d == far[at]) & (other < second[at])))
            far[at] = np.where(first, near[at], np.where(next_, d, far[at]))
            second[at] = np.where(first, best[at], np.where(next_, other, second[at]))
            near[at], best[at] = np.where(first, d, near[at]), np.where(first, other, best[at])
        return best, second, near, far


def _state(ids: pa.Array, x: np.ndarray, cluster, second, upper, lower) -> pa.RecordBatch:
    ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
    columns = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())), pa.array(cluster.astype(np.int32)), pa.array(second.astype(np.int32)), pa.array(upper), pa.array(lower)]
    return pa.RecordBatch.from_arrays([ids, *columns], names=["id", *_NAMES])


def _components(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _round(state: DataFrame, centroids: np.ndarray, moved: np.ndarray | None, last: bool = False) -> DataFrame:
    """One pass: new assignments with bounds, or after the last round the assignments with exact distances."""
    dims = centroids.shape[1]
    kind = state.schema["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids, moved)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                x = _components(part.column(1), dims)
                n = len(x)
                if part.num_columns > 2:
                    bounds = [part.column(i).to_numpy() for i in range(2, 6)]
                else:  # nothing known yet: any two centroids, and bounds that hold for all
                    bounds = [np.zeros(n, np.int32), np.full(n, min(1, search.k - 1), np.int32), np.full(n, np.inf), np.full(n, -np.inf)]
                cluster, second, upper, lower = search.assign(x, *bounds)
                if last:
                    columns = [part.column(0), pa.array(cluster.astype(np.int32)), pa.array(search.distance(x, cluster))]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance"])
                else:
                    yield _state(part.column(0), x, cluster, second, upper, lower)
        give_back()

    fields = "cluster int, distance bigint" if last else _STATE
    return state.mapInArrow(run, T.StructType([kind, *T._parse_datatype_string(fields).fields]))


def moved_centroids(state: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Componentwise floor(sum / count) of every centroid's vectors, empty ones as they were; and how far each went."""
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(centroids.shape[1])]
    new = centroids.copy()
    for r in state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        new[r.cluster] = [s // r.n for s in r[2:]]
    return new, np.sqrt(((new - centroids) ** 2).sum(1).astype(np.float64)) * (1 + SLACK)


def cluster(df: DataFrame, k: int = 16, rounds: int = 3, vector: str = "embedding", id: str = "vec_id", dims: int = 64, scale: int = 64, seed: str = "1") -> tuple[DataFrame, np.ndarray]:
    """Rows (id, cluster, distance) of every kept vector after ``rounds`` moves, in the shared folder; and the final centroids."""
    state = materialize(integer_vectors(df, vector, dims, scale, id))
    centroids, moved = starting_centroids(state, k, seed), None
    if not len(centroids):
        return state.select(F.col("id").alias(id), F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), centroids.reshape(0, dims)
    for _ in range(rounds):
        after = materialize(_round(state, centroids, moved))
        discard(state)
        state = after
        centroids, moved = moved_centroids(state, centroids)
    out = materialize(_round(state, centroids, moved, last=True))
    discard(state)
    return out.withColumnRenamed("id", id), centroids


def _oracle(k: int = 16, rounds: int = 3) -> str:
    parts = [
        "v as (select row_number() over () as r, vec_id, list_transform(embedding, lambda e: cast(floor(64 * cast(e as double)) as bigint)) as x "
        "from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda e: isfinite(e))) = 64)",
        f"c0 as (select row_number() over (order by sha256('1:' || vec_id)) - 1 as c, x as y from v qualify c < {k})",
    ]
    for n in range(rounds + 1):
        parts += [
            f"d{n} as (select r, vec_id, x, c, list_sum(list_transform(list_zip(x, y), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d from v, c{n})",
            f"a{n} as (select * from d{n} qualify row_number() over (partition by r order by d, c) = 1)",
            f"u{n} as (select c, unnest(range(1, 65)) as i, unnest(x) as e from a{n})",
            f"s{n} as (select c, i, sum(e) as s, count(*) as n from u{n} group by c, i)",
            f"m{n} as (select c, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as y from s{n} group by c)",
            f"c{n + 1} as (select c{n}.c, coalesce(m{n}.y, c{n}.y) as y from c{n} left join m{n} using (c))",
        ]
    return "with " + ",\n".join(parts) + (
        f"\nselect vec_id, cast(c as int) as cluster, cast(d as bigint) as distance, cast(sum(d) over (partition by c) as bigint) as cluster_inertia, "
        f"cast(sum(d) over () as bigint) as inertia, sha256(array_to_string(c{rounds}.y, ',')) as centroid_sha256 from a{rounds} join c{rounds} using (c)"
    )


@query("op11_centroid_clusters", _oracle())
def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kept vector's cluster after three moves of sixteen centroids, with exact inertia and centroid digests."""
    rows, centroids = cluster(table(spark, sf_dir, "embeddings"))
    per_cluster = rows.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()  # as many rows as centroids
    total = sum(r.n for r in per_cluster)
    made = [(r.cluster, r.n, hashlib.sha256(",".join(map(str, centroids[r.cluster].tolist())).encode()).hexdigest()) for r in per_cluster]
    about = spark.createDataFrame(made, "cluster int, cluster_inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("bigint").alias("inertia"), "centroid_sha256"
    )
