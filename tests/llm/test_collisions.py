import math

import numpy as np
import pytest

from bazaarmill.llm import collisions as c


def vectors(n=120, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((12, dim))
    rows = []
    for i in range(n):
        v = base[i % 12] + rng.standard_normal(dim) * rng.choice([0.05, 0.25, 2.0])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(i % 3) if i % 10 else None))
    rows += [(n, rows[1][1], rows[1][2]), (n + 1, rows[1][1], rows[1][2]), (n + 2, None, 1), (n + 3, [0.0] * dim, 1), (n + 4, [math.nan] * dim, 1)]
    rows += [(n + 5, [1.0, None, *[0.0] * (dim - 2)], 1), (n + 6, [], 1), (n + 7, [1.0, 2.0], 1), (n + 8, [2.0, 4.0], 1), (n + 9, [math.inf] * dim, 1)]
    return rows


def plain(rows, threshold):
    from llm_cases import groups

    x = [None if v is None else np.array([math.nan if y is None else y for y in v], np.float64) for _, v, _ in rows]
    fine = [v is not None and len(v) and np.isfinite(v).all() and v.any() and r[2] is not None for v, r in zip(x, rows)]
    pairs = []
    for i in range(len(rows)):
        for j in range(i):
            if fine[i] and fine[j] and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]):
                if x[i] @ x[j] / math.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= threshold:
                    pairs.append((i, j))
    root, degree = groups(len(rows), pairs), [0] * len(rows)
    for i, j in pairs:
        degree[i] += 1
        degree[j] += 1
    return sorted((rows[i][0], degree[i], rows[root[i]][0], root[i] == i) for i in range(len(rows)))


@pytest.mark.parametrize("cell,most", [(256, 2048), (8, 2048), (256, 7)])
def test_links(spark, cell, most, monkeypatch):
    monkeypatch.setattr(c, "CELL", cell)
    monkeypatch.setattr(c, "MOST", most)
    rows = vectors()
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, cell string, rep int")
    want = plain(rows, c.THRESHOLD)
    got = sorted(map(tuple, c.near_vectors(frame).collect()))
    assert sum(w[1] for w in want) > 50
    missed = sum(w[1] for w in want) - sum(g[1] for g in got)
    assert 0 <= missed <= 0.01 * sum(w[1] for w in want)
    if not missed:
        assert got == want


def test_calibration():
    assert c.needed() < c.PROJECTIONS
    for n in (10, 1000, 10**5, 10**7):
        signs, tables = c.shape(n, c.THRESHOLD)
        assert 1 - (1 - (1 - math.acos(c.THRESHOLD) / math.pi) ** signs * c.REACH) ** tables >= min(c.RECALL, c.REACH)
        assert n / 2**signs <= c.CELL


def test_empty(spark):
    assert c.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_extreme_numbers_link_like_any_other(spark):
    rng = np.random.default_rng(8)
    base, other = rng.standard_normal(16), rng.standard_normal(16)
    rows = [(i, [float(v) for v in x * f], 1) for i, (x, f) in enumerate([(base, 1.0), (base, 1e200), (base, 1e-200), (base, 1e300), (other, 1e200), (other, 5e-290)])]
    got = c.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(0, 3, 0), (1, 3, 0), (2, 3, 0), (3, 3, 0), (4, 1, 4), (5, 1, 4)]
