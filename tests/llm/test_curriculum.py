import collections

import pytest

from llm_cases import docs, none, rows  # noqa: F401  fixtures

from bazaarmill.llm import curriculum as c


def plain_targets(sizes: dict, share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full, total = set(), share * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / sum(weight[r] for r in rest) for s in names}
        over = {s for s in rest if target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def sized(docs):
    return docs.select("doc_id", "source", c.size_of().alias("size"))


def test_targets_and_taken(docs, rows):
    got = c.assign(sized(docs)).toPandas()
    assert len(got) == len(rows)
    size = collections.Counter()
    for r in rows:
        size[r[3]] += len((r[1] or "").encode().split())
    want = plain_targets(size)
    for source, part in got.groupby("source", dropna=False):
        name = None if source != source else source
        assert part["source_size"].iloc[0] == size[name]
        assert part["target"].iloc[0] == pytest.approx(want[name])
        edge = max((s for s in part["size"] if s * 100 <= size[name]), default=part["size"].max())
        assert abs((part["size"] * part["copies"]).sum() - want[name]) <= max(edge, part["size"].max()) / 2 + 1
    assert got["copies"].max() <= 2
    assert (got["times"].map(len) == got["copies"]).all()
    assert all(0 <= t <= 1 for x in got["times"] for t in x)


def test_reruns_agree(docs):
    a, b = (sorted(map(str, c.assign(sized(docs.repartition(n))).collect())) for n in (2, 5))
    assert a == b


def test_time_inverts_the_integrated_schedule(spark):
    for schedule in c.SCHEDULES:
        for share in (0.0, 0.1, 0.5, 0.9, 1.0):
            t = spark.range(1).select(c.time_of(c.F.lit(share), schedule)).first()[0]
            area = [0.0, 0.0]
            steps = 20_000
            for k in range(steps):
                x = (k + 0.5) / steps
                for (t0, r0), (t1, r1) in zip(schedule, schedule[1:]):
                    if t0 <= x <= t1:
                        area[1] += r0 + (r1 - r0) * (x - t0) / (t1 - t0)
                        area[0] += (r0 + (r1 - r0) * (x - t0) / (t1 - t0)) * (x < t)
                        break
            assert area[0] / area[1] == pytest.approx(share, abs=1e-3)


def test_training_order_repeats_and_keeps_columns(docs):
    got = c.training_order(docs)
    assert got.columns == docs.columns
    want = c.assign(sized(docs)).selectExpr("sum(copies)").first()[0]
    assert got.count() == want


def test_empty(none):
    assert c.assign(sized(none)).count() == 0
    assert c.training_order(none).count() == 0


def test_order_is_by_time(spark):
    from conftest import DATA

    times = [r["first_time"] for r in c.op2_curriculum(spark, DATA).collect() if r["first_time"] is not None]
    assert times == sorted(times)
