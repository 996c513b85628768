"""Near-duplicate embeddings by collision counting on sorted projections.

Equal vectors of one label are one class first. Vectors are dealt over random cells: in each of several tables a vector's cell is
the signs of its products with a few random directions, so that a cell stays small however many vectors a label has.
Within a cell the vectors are sorted along many one-dimensional projections; around each vector a window is laid on each
sorted projection, and the windows that another vector falls into are counted. Pairs with enough collisions are
verified by their cosine in double precision.

Calibration: for a pair exactly at the threshold the distance d of its unit vectors is known, a projection differs by a
normal number with deviation d, and a sign differs with probability angle / pi. The window is the one that such a pair meets
with probability ``MEET``, the count is the largest that it reaches with probability ``REACH``, and the number of tables is
the smallest with which some table shows it with probability ``RECALL``. Closer pairs are found more surely.

A cell with more than ``MOST`` classes is split into blocks, and each pair of blocks is a group of its own, so no group
outgrows two blocks. Only verified pairs leave a task.

Cases: vectors that are null, empty, zero, or hold a null or non-finite component, and those with a null label, link with
nothing and are kept; vectors of different lengths do not link; equal rows are vectors of their own and link; a pair at the
threshold links; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import components, read, stored
from .simhash import whole_groups

THRESHOLD = 0.93
PROJECTIONS = 32
MEET, REACH, RECALL = 0.9, 0.995, 0.999
#: Classes that a cell should have, and beyond which it is split into blocks.
CELL, MOST = 256, 2048


def window(threshold: float) -> float:
    from statistics import NormalDist

    return NormalDist().inv_cdf((1 + MEET) / 2) * math.sqrt(2 - 2 * threshold)


def needed() -> int:
    """The largest count that a pair at the threshold reaches with probability ``REACH``."""
    tail, n = 0.0, PROJECTIONS
    for k in range(n, -1, -1):
        tail += math.comb(n, k) * MEET**k * (1 - MEET) ** (n - k)
        if tail >= REACH:
            return k
    return 0


def shape(classes: int, threshold: float) -> tuple[int, int]:
    """Signs and tables for a label with so many classes."""
    signs = max(0, math.ceil(math.log2(max(1, classes) / CELL)))
    meet = (1 - math.acos(threshold) / math.pi) ** signs * REACH
    return signs, 1 if not signs else math.ceil(math.log(1 - RECALL) / math.log(1 - meet))


def candidates(x: np.ndarray, mine: np.ndarray, other: np.ndarray, half: float, least: int, seed: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of unit vectors with at least ``least`` window collisions; from ``mine`` into ``other``."""
    axes = np.random.default_rng(seed).standard_normal((x.shape[1], PROJECTIONS))
    p = x @ axes
    order = [np.argsort(p[other, k], kind="stable") for k in range(PROJECTIONS)]
    lines = [p[other, k][order[k]] for k in range(PROJECTIONS)]
    for lo in range(0, len(mine), 256):
        q = mine[lo : lo + 256]
        count = np.zeros((len(q), len(other)), np.int16)
        row = np.arange(len(q))
        for k in range(PROJECTIONS):
            edge = np.zeros((len(q), len(other) + 1), np.int8)
            np.add.at(edge, (row, np.searchsorted(lines[k], p[q, k] - half, side="left")), 1)
            np.add.at(edge, (row, np.searchsorted(lines[k], p[q, k] + half, side="right")), -1)
            count[:, order[k]] += np.cumsum(edge, axis=1, dtype=np.int8)[:, :-1]
        i, j = np.nonzero(count >= least)
        yield q[i], other[j]


def links(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (a, b, size_a, size_b) of classes (rep, size, label, vector, dim) whose cosine reaches the threshold."""
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    known = classes.join(sizes, ["label", "dim"])
    half, least = window(threshold), needed()
    kind = "<f4" if "float" in classes.schema["vector"].dataType.simpleString() else "<f8"

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for (dim, n), d in b.groupby(["dim", "n"]):
                x = np.stack([np.asarray(v, np.float64) for v in d["vector"]])
                signs, tables = shape(int(n), threshold)
                raw = [v.astype(kind).tobytes() for v in x]
                for t in range(tables):
                    plane = np.random.default_rng([11, int(dim), t]).standard_normal((int(dim), max(1, signs)))
                    cell = ((x @ plane > 0) @ (1 << np.arange(max(1, signs), dtype=np.int64))) if signs else np.zeros(len(x), np.int64)
                    yield pd.DataFrame({"label": d["label"].to_numpy(), "dim": dim, "t": t, "cell": cell, "rep": d["rep"].to_numpy(), "size": d["size"].to_numpy(), "vector": raw})

    dealt = known.mapInPandas(cells, "label long, dim int, t int, cell long, rep long, size long, vector binary")
    key = ["label", "dim", "t", "cell"]
    crowded = known.select("label", "dim", "rep", "n", "vector", "size").mapInPandas(cells, dealt.schema).groupBy(*key).count().where(F.col("count") > MOST)
    blocks = crowded.select(*key, F.ceil(F.col("count") / MOST).cast("int").alias("blocks"))
    placed = dealt.join(blocks, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    paired = placed.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *key, F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "rep", "size", "vector"
    )
    group = [*key, "i", "j"]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in whole_groups(batches, group, 20_000):
            for (_, dim, t, cell, i, j), g in d.groupby(group):
                if len(g) < 2:
                    continue
                x = np.frombuffer(b"".join(g["vector"]), kind).reshape(len(g), int(dim)).astype(np.float64)
                x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])  # by a power of two: exact, and squares stay in range
                norm = np.sqrt((x * x).sum(1))
                rep, size, own = g["rep"].to_numpy(), g["size"].to_numpy(), g["own"].to_numpy()
                mine, other = np.flatnonzero(own == i), np.flatnonzero(own == j)
                for a, b in candidates(x / norm[:, None], mine, other, half, least, [13, int(dim), int(t)]):
                    if i == j:
                        a, b = a[a < b], b[a < b]
                    good = np.concatenate([np.einsum("ij,ij->i", x[a[k : k + 65536]], x[b[k : k + 65536]]) for k in range(0, len(a), 65536)] or [np.zeros(0)]) / (norm[a] * norm[b]) >= threshold
                    a, b = a[good], b[good]
                    swap = rep[a] > rep[b]
                    a, b = np.where(swap, b, a), np.where(swap, a, b)
                    yield pd.DataFrame({"a": rep[a], "b": rep[b], "size_a": size[a], "size_b": size[b]})

    found = paired.repartition(*[F.col(c) for c in group]).sortWithinPartitions(*group)
    return found.mapInPandas(verify, "a long, b long, size_a long, size_b long").distinct()


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) for rows (vec_id, embedding, label), one for each."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size("vector") > 0) & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = v.withColumn("usable", usable)
    classes = stored(
        rows.where("usable").groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
        .where("rep is not null").withColumn("dim", F.size("vector"))
    )
    pairs = stored(links(classes, threshold))
    both = pairs.select(F.col("a").alias("rep"), F.col("size_b").alias("n")).unionByName(pairs.select(F.col("b").alias("rep"), F.col("size_a").alias("n")))
    degree = both.groupBy("rep").agg(F.sum("n").alias("n"))
    found = components(pairs.select("a", "b")).withColumnsRenamed({"node": "rep"})
    known = classes.join(degree, "rep", "left").join(found, "rep", "left").select(
        "label", "vector", F.lit(True).alias("usable"), (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    out = rows.join(known, ["label", "vector", "usable"], "left")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op5_embedding_dedup(spark: SparkSession, root: str) -> DataFrame:
    return near_vectors(read(spark, root, "embeddings"))


SQL = f"""
WITH RECURSIVE v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
fine AS MATERIALIZED (SELECT *, sqrt(list_inner_product(e, e)) AS norm FROM v WHERE label IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda x: isfinite(x))) = len(e) AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (SELECT a.row AS a, b.row AS b, b.vec_id AS other FROM fine a JOIN fine b ON a.label = b.label AND len(a.e) = len(b.e) AND a.row <> b.row
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= {THRESHOLD}),
reach AS (SELECT row, row AS r FROM v UNION SELECT reach.row, link.b FROM reach JOIN link ON link.a = reach.r)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE link.a = v.row) AS n_links, min(o.vec_id) AS component_id, v.vec_id = min(o.vec_id) AS kept
FROM v JOIN reach ON reach.row = v.row JOIN v o ON o.row = reach.r GROUP BY v.row, v.vec_id
"""
