"""Exact k-means with ns-bounds: bounds on distances that are loosened by the norm of a centroid's total displacement.

Each vector remembers, for every centroid, the exact squared distance of its last evaluation and the round of it. The history of
all centroids is kept (rounds x k x components, sent to every task), so a remembered distance ``d`` to centroid j from round r
bounds today's distance by ``d - |c_j(now) - c_j(r)|`` and ``d + |c_j(now) - c_j(r)|``. The displacement is the norm between the two
positions, not the sum of the moves in between, so bounds stay as tight as the history allows. A vector whose upper bound to its own
centroid is below all lower bounds keeps its centroid without an evaluation. Otherwise its own distance is evaluated, then every
centroid whose lower bound isn't above it, in whole numbers; ties go to the smaller number. Bounds are compared with a margin for
rounding, so the result is that of plain Lloyd rounds.

Components are whole numbers, so sums and distances are exact and do not depend on the order of rows. A round reads and writes the
state as a table in the shared folder; sums per centroid are made in each task and added by Spark, and k rows reach the driver.
A group of equal vectors needs no special care: no step brings rows of one vector or one cluster together.

Cases: vectors that are null, of another length or with a null or non-finite component are left out; integers saturate at
``LIMIT`` so that every squared distance fits a long; with fewer than ``k`` vectors there are fewer centroids; an empty centroid
stays; equal rows get equal results; ties of the starting order go to the smaller vector; an empty table gives no rows; other
columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import read, stored

COMPONENTS = 64
K = 16
ROUNDS = 3
LIMIT = 1 << 27
#: Relative and absolute margin for the rounding of square roots and norms (both below 2^32).
MARGIN = 1e-6
STATE = "vec_id long, x array<int>, cluster int, far array<long>, seen array<int>, n_distances long"
TYPES = pa.schema([
    ("vec_id", pa.int64()), ("x", pa.list_(pa.int32())), ("cluster", pa.int32()), ("far", pa.list_(pa.int64())),
    ("seen", pa.list_(pa.int32())), ("n_distances", pa.int64()),
])


def whole_vectors(embeddings: DataFrame, components: int = COMPONENTS, scale: int = 64) -> DataFrame:
    """Rows (vec_id, x) of the usable vectors, each component as floor(scale * component)."""
    v = F.col("embedding").cast("array<double>")
    usable = (F.size(v) == components) & F.forall(v, lambda e: e.isNotNull() & (F.abs(e) < float("inf")))

    def whole(e):
        return F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), e * scale))).cast("int")

    return embeddings.where(F.coalesce(usable, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, whole).alias("x"))


def starts(vectors: DataFrame, k: int = K, seed: int = 1) -> np.ndarray:
    """The k vectors with the smallest hash of seed and id, in hash order."""
    named = vectors.select("x", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256).alias("h"))
    rows = named.orderBy("h", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to one centroid."""
    d = x - c
    return (d * d).sum(1)


def matrix(column: pa.ListArray, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1), kind))


def assign(x: np.ndarray, cluster: np.ndarray, far: np.ndarray, seen: np.ndarray, history: np.ndarray, finish: bool):
    """New clusters of a block of vectors under the last centroids of the history; ``far`` and ``seen`` are brought up to date.

    ``far[i, j]`` is the exact squared distance of vector i to centroid j in round ``seen[i, j]``, -1 for never. With ``finish`` the distance to
    the own centroid is evaluated for all. Returns the clusters and the number of distances evaluated for each vector.
    """
    now, k = len(history) - 1, history.shape[1]
    each, rows = np.arange(k), np.arange(len(x))
    moved = np.sqrt(((history[now] - history).astype(np.float64) ** 2).sum(2))  # round x centroid: norms of total displacements
    cost = np.zeros(len(x), np.int64)

    def evaluate(i: np.ndarray, j: int) -> None:
        far[i, j], seen[i, j] = squared(x[i], history[now, j]), now
        cost[i] += 1

    drift = moved[np.maximum(seen, 0), each]
    lower = np.where(seen < 0, -np.inf, np.sqrt(np.maximum(far, 0)) - drift)
    upper = np.where(seen[rows, cluster] < 0, np.inf, np.sqrt(np.maximum(far[rows, cluster], 0)) + drift[rows, cluster])
    lower[rows, cluster] = np.inf
    open_ = upper * (1 + MARGIN) + MARGIN >= lower.min(1)
    for j in each:
        evaluate(np.flatnonzero((open_ | finish) & (cluster == j) & (seen[:, j] != now)), j)
    upper = np.sqrt(far[rows, cluster])
    near = open_[:, None] & (lower <= (upper * (1 + MARGIN) + MARGIN)[:, None])
    for j in each:
        evaluate(np.flatnonzero(near[:, j]), j)
    near[rows, cluster] = True
    best = np.where(near, far, np.iinfo(np.int64).max).argmin(1).astype(np.int32)  # the first of equal distances
    return best, cost


def first_state(vectors: DataFrame, k: int) -> DataFrame:
    empty = F.array_repeat(F.lit(-1), k)
    return vectors.select("vec_id", "x", F.lit(0).alias("cluster"), empty.cast("array<long>").alias("far"), empty.alias("seen"), F.lit(0).cast("long").alias("n_distances"))


def stepped(state: DataFrame, history: np.ndarray, finish: bool) -> DataFrame:
    k, width = history.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, far, seen = (matrix(b.column(c), w, t) for c, w, t in (("x", width, np.int64), ("far", k, np.int64), ("seen", k, np.int32)))
            best, cost = assign(x, b.column("cluster").to_numpy().astype(np.int32), far, seen, history, finish)
            total = pa.array(b.column("n_distances").to_numpy() + cost, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("x"), pa.array(best, pa.int32()), lists(far, pa.int64()), lists(seen, pa.int32()), total], schema=TYPES
            )

    return state.mapInArrow(run, STATE)


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of each cluster; empty clusters keep their centroid."""
    k, width = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for b in batches:
            x, cluster = matrix(b.column("x"), width, np.int64), b.column("cluster").to_numpy()
            count += np.bincount(cluster, minlength=k)
            for j in np.unique(cluster):
                total[j] += x[cluster == j].sum(0)
        some = np.flatnonzero(count)
        if len(some):
            yield pa.RecordBatch.from_pydict({"cluster": pa.array(some, pa.int32()), "n": count[some], "total": lists(total[some], pa.int64())})

    parts = state.select("x", "cluster").mapInArrow(sums, "cluster int, n long, total array<long>")
    added = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    )
    out = centroids.copy()
    for r in added.collect():  # one row for each centroid
        out[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return out


def clustered(vectors: DataFrame, centroids: np.ndarray, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The state after ``rounds`` updates and a last assignment, and the history of centroids."""
    history = centroids[None]
    state = first_state(vectors, len(centroids))
    for r in range(rounds + 1):
        state = stored(stepped(state, history, r == rounds))
        if r < rounds:
            history = np.concatenate([history, means(state, history[-1])[None]])
    return state, history


def summary(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Per vector its cluster, squared distance, the sums over its cluster and over all, and its centroid's digest."""
    spark, k = state.sparkSession, len(centroids)
    rows = state.select("vec_id", "cluster", F.col("far")[F.col("cluster")].alias("distance"), "n_distances")
    names = [(j, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for j, c in enumerate(centroids)]
    most = F.lit(str((1 << 63) - 1)).cast("decimal(38,0)")
    per = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("s"))
    sums = {r["cluster"]: int(r["s"]) for r in per.select("cluster", F.col("s").cast("decimal(38,0)").alias("s")).collect()}  # k rows
    cap = lambda v: min(v, (1 << 63) - 1)  # noqa: E731  a sum beyond a long is given as the largest long
    whole = cap(sum(sums.values()))
    named = spark.createDataFrame(
        [(j, cap(sums.get(j, 0)), whole, h) for j, h in names], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return rows.join(F.broadcast(named), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_distances"
    )


def op13_centroids(spark: SparkSession, root: str) -> DataFrame:
    vectors = stored(whole_vectors(read(spark, root, "embeddings")))
    first = starts(vectors)
    if not len(first):
        return summary(first_state(vectors, 1), np.zeros((1, COMPONENTS), np.int64)).drop("n_distances")
    state, history = clustered(vectors, first)
    return summary(state, history[-1]).drop("n_distances")


def _round(t: int) -> str:
    nearest = f"""a{t} AS MATERIALIZED (SELECT rid, any_value(vec_id) AS vec_id, any_value(x) AS x, min({{'d': list_sum(list_transform(
      list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'j': cluster}}) AS best FROM v CROSS JOIN c{t} GROUP BY rid)"""
    mean = f"""c{t + 1} AS MATERIALIZED (SELECT o.cluster, coalesce(m.c, o.c) AS c FROM c{t} o LEFT JOIN (
      SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
        SELECT best.j AS cluster, i, sum(x[i])::BIGINT AS s, count(*)::BIGINT AS n FROM a{t}, range(1, {COMPONENTS + 1}) r(i) GROUP BY ALL)
      GROUP BY cluster) m ON m.cluster = o.cluster)"""
    return nearest if t == ROUNDS else f"{nearest},\n{mean}"


SQL = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
    list_transform(embedding, lambda e: greatest(-{LIMIT}, least({LIMIT}, floor(64 * e::DOUBLE)))::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda e: isfinite(e::DOUBLE))) = {COMPONENTS}),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), x) - 1)::INTEGER AS cluster, x AS c
  FROM v QUALIFY cluster < {K}),
{", ".join(_round(t) for t in range(ROUNDS + 1))},
s AS (SELECT best.j AS cluster, sum(best.d) AS total FROM a{ROUNDS} GROUP BY ALL)
SELECT vec_id, best.j AS cluster, best.d AS distance, s.total::BIGINT AS cluster_inertia, (SELECT sum(total) FROM s)::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN s ON s.cluster = best.j JOIN c{ROUNDS} ON c{ROUNDS}.cluster = best.j
"""
