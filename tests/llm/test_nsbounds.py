import hashlib
import random

import numpy as np
import pytest
from conftest import DATA

from bazaarmill.llm import nsbounds as m

SCHEMA = "vec_id long, embedding array<float>, label int, x int, far int, seen int, cluster int"
NAMES = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def lloyd(rows, k=16, rounds=3):
    """Plain rounds in whole numbers, every distance evaluated."""
    vectors = []
    for vec_id, e, *_ in rows:
        if e is not None and len(e) == 64 and all(v is not None and np.isfinite(v) for v in e):
            vectors.append((vec_id, [int(max(-m.LIMIT, min(m.LIMIT, np.floor(64 * float(np.float32(v)))))) for v in e]))
    named = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), x) for i, x in vectors)
    centroids = [x for _, x in named[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))

    for r in range(rounds + 1):
        got = [nearest(x) for _, x in vectors]
        if r < rounds:
            for j in range(len(centroids)):
                mine = [x for (_, x), (_, c) in zip(vectors, got) if c == j]
                if mine:
                    centroids[j] = [sum(col) // len(mine) for col in zip(*mine)]
    most = (1 << 63) - 1
    inertia = {j: min(most, sum(d for d, c in got if c == j)) for j in range(len(centroids))}
    whole = min(most, sum(d for d, _ in got))
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], whole, sha[c]) for (i, _), (d, c) in zip(vectors, got)), key=str)


def found(spark, rows, **kw):
    vectors = m.whole_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3))
    first = m.starts(vectors, kw.get("k", m.K))
    state, history = m.clustered(vectors, first, kw.get("rounds", m.ROUNDS))
    return sorted((tuple(r) for r in m.summary(state, history[-1]).select(*NAMES).collect()), key=str)


def vector(rng, spread=1.0, centre=0.0):
    return [float(np.float32(centre + rng.uniform(-spread, spread))) for _ in range(64)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(i, vector(rng, 0.3, (i % 5) / 4), i % 3, 1, 2, 3, 4) for i in range(240)]
    same = vector(rng)
    out += [(1000 + i, same, 1, 1, 2, 3, 4) for i in range(100)]
    ties = [1.0] + [0.0] * 63
    out += [(2000 + i, [v * (1 if i % 2 else -1) for v in ties], 1, 1, 2, 3, 4) for i in range(20)]
    out += [(2020, [0.0] * 64, None, 1, 2, 3, 4), (7, out[7][1], 0, 1, 2, 3, 4), (None, vector(rng), 1, 1, 2, 3, 4)]
    out += [(3000, None, 1, 1, 2, 3, 4), (3001, [1.0] * 63, 1, 1, 2, 3, 4), (3002, [None] + [1.0] * 63, 1, 1, 2, 3, 4), (3003, [], 1, 1, 2, 3, 4)]
    out += [(3004, [float("nan")] + [1.0] * 63, 1, 1, 2, 3, 4), (3005, [float("-inf")] + [1.0] * 63, 1, 1, 2, 3, 4)]
    return out


@pytest.mark.parametrize("rounds", [0, 3, 9])
def test_against_plain_rounds(spark, rows, rounds):
    assert found(spark, rows, rounds=rounds) == lloyd(rows, rounds=rounds)


def test_far_components_saturate(spark, rows):
    far = [(5000, [3e38] * 64, 1, 1, 2, 3, 4), (5001, [-3e38] * 64, 1, 1, 2, 3, 4), (5002, [5e6] * 64, 1, 1, 2, 3, 4)]
    assert found(spark, rows[:60] + far) == lloyd(rows[:60] + far)


def test_few_and_no_vectors(spark, rows):
    assert found(spark, rows[:5]) == lloyd(rows[:5])
    assert found(spark, rows[:1]) == lloyd(rows[:1])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = m.op13_centroids(spark, str(tmp_path))
    assert got.columns == NAMES and got.count() == 0


def test_query_against_sql(spark, con):
    got = m.op13_centroids(spark, DATA)
    assert got.columns == NAMES
    want = con.execute(f"SELECT {', '.join(NAMES)} FROM ({m.SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_total_displacement_not_summed_drifts():
    """Centroids that went away and came back need no evaluation; the sum of their moves would ask for one."""
    x = np.array([[0, 0], [10, 0]], np.int64)
    home, away = np.array([[1, 0], [9, 0]]), np.array([[100, 0], [-100, 0]])
    far, seen = np.full((2, 2), -1, np.int64), np.full((2, 2), -1, np.int32)
    cluster, cost = m.assign(x, np.zeros(2, np.int32), far, seen, np.array([home]), False)
    assert cluster.tolist() == [0, 1] and cost.tolist() == [2, 2]
    again, cost = m.assign(x, cluster, far, seen, np.array([home, away, home]), False)
    assert again.tolist() == [0, 1] and cost.tolist() == [0, 0]
    _, cost = m.assign(x, cluster, far, seen, np.array([home, away, home + [[0, 1], [0, 0]]]), False)
    assert cost.sum() == 0  # a small total move is still within the bounds
    moved, cost = m.assign(x, cluster, far, seen, np.array([home, home, away]), False)
    assert moved.tolist() == [0, 0] and cost.sum() > 0
    assert far[0].tolist() == [100**2, 100**2]


def test_bounds_save_evaluations(spark):
    rng = random.Random(9)
    centres = [vector(rng, 4.0) for _ in range(16)]
    rows = [(i, [c + rng.uniform(-0.1, 0.1) for c in centres[i % 16]], 1, 1, 2, 3, 4) for i in range(400)]
    vectors = m.whole_vectors(spark.createDataFrame(rows, SCHEMA))
    state, _ = m.clustered(vectors, m.starts(vectors), 6)
    per_vector = state.agg(m.F.avg("n_distances")).first()[0]
    assert per_vector < 0.6 * 16 * 7  # of 16 distances in each of 7 assignments
