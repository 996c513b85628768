import random

import numpy as np
import pytest
from conftest import DATA

from llm_cases import docs, none, rows  # noqa: F401  fixtures

from bazaarmill.llm import ranking as m

LABELS = "doc_id long, quality int, toxic int, mark int, text string, f int, score double"


def marked(spark, pairs):
    return spark.createDataFrame([(d, q, 0, 9, "not this text", 1, 0.5) for d, q in pairs], LABELS)


def test_held_out_accuracy(spark):
    got = m.op12_quality(spark, DATA)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality")
    held = got.join(labels, "doc_id").where("held_out").toPandas()
    assert len(held) > 10 and (held["predicted"] == held["quality"]).mean() > 0.95
    rows = got.toPandas()
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert rows["score"].between(0, 1).all() and ((rows["score"] >= 0.3) == (rows["predicted"] == 1)).all()


def test_ranks_shouting_below_prose(spark, docs, rows):
    """Labels that follow one property of the form; unlabelled texts are ranked by it."""
    rng = random.Random(1)
    made = []
    for i in range(120):
        text = " ".join(rng.choice(["reading", "water", "house", "light", "from"]) for _ in range(40)) + "."
        made.append((1000 + i, text.upper() if i % 3 == 0 else text, "en", "s", 1, 1, 2, 3, 4, 0.5, 6, "x"))
    table = docs.unionByName(docs.sparkSession.createDataFrame(made, docs.schema))
    labels = marked(spark, [(1000 + i, 0 if i % 3 == 0 else 1) for i in range(90)] + [(1000, 0), (None, 1), (1001, None), (1002, 7), (99_999, 1)])
    model = m.fit(table, labels)
    assert model[0] == "ranked"
    got = {r["doc_id"]: r["s"] for r in table.where("doc_id >= 1090").select("doc_id", m.scorer(spark, model).alias("s")).collect()}
    assert all((got[1000 + i] >= m.CUT) == (i % 3 != 0) for i in range(90, 120))
    every = table.select("text", m.scorer(spark, model).alias("s")).collect()
    assert all(0 <= r["s"] <= 1 for r in every)
    assert len({r["s"] for r in every if not r["text"]}) == 1  # null and empty alike
    again = m.fit(table, labels)
    assert np.array_equal(model[1], again[1]) and model[2] == again[2]


def test_other_columns_are_not_inputs(spark, docs, rows):
    labels = marked(spark, [(r[0], i % 2) for i, r in enumerate(rows[:40])])
    model = m.fit(docs, labels)
    a = docs.select("text", m.scorer(spark, model).alias("s")).collect()
    b = docs.withColumn("lang", m.F.lit("x")).withColumn("source", m.F.lit("y")).withColumn("doc_id", m.F.lit(1)).select("text", m.scorer(spark, model).alias("s")).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_one_label_and_none(spark, docs, none):
    only = m.fit(docs, marked(spark, [(0, 1), (1, 1), (2, 1)]))
    assert only[0] == "constant" and only[2] == 0.8
    assert [r["s"] for r in docs.limit(3).select(m.scorer(spark, only).alias("s")).collect()] == [0.8] * 3
    assert m.fit(docs, marked(spark, []))[2] == 0.5
    both_unknown = m.fit(docs, marked(spark, [(77_777, 0), (88_888, 1)]))
    assert both_unknown[0] == "constant" and both_unknown[2] == 0.5
    assert none.select(m.scorer(spark, only).alias("s")).count() == 0


def test_document_marked_both_ways_and_copies(spark, docs):
    labels = marked(spark, [(7, 0), (7, 1), (8, 1), (9, 0), (7, 1)])
    kind, w, cut = m.fit(docs, labels)
    assert kind == "ranked" and np.isfinite(w).all() and np.isfinite(cut)


@pytest.mark.parametrize("sizes", [(1, 1), (5, 1), (1, 5), (40, 13), (13, 40), (2000, 700)])
def test_pairs_cover_both_sides(sizes):
    i, j = m.preference_pairs(*sizes)
    assert len(i) == len(j) == m.PAIRS * max(sizes)
    assert set(i) == set(range(sizes[0])) and set(j) == set(range(sizes[1]))


def test_weights_order_pairs():
    """The learned scores put a clear majority of pairs in the order of a known linear quality."""
    rng = np.random.default_rng(0)
    x, true = rng.normal(size=(400, 6)), np.array([2.0, -1, 0.5, 0, 0, 1])
    good = x @ true > 0
    w = m.rank_weights(x[good], x[~good])
    assert np.corrcoef(x @ w, x @ true)[0, 1] > 0.9


def test_quantile_cut():
    scores, weights = np.array([3.0, 1.0, 2.0, 10.0]), np.array([1.0, 1.0, 1.0, 1.0])
    assert m.quantile_cut(scores, weights, 0.5) == 2.5
    assert m.quantile_cut(scores, weights, 0.25) == 1.5
    assert m.quantile_cut(scores, np.array([1.0, 6.0, 1.0, 2.0]), 0.6) == 1.5


def test_pieces_do_not_change_features(monkeypatch):
    text = "Some WORDS, and Straße 12\nlines!! lines!!\n\n" * 50
    want = m.features(text)
    monkeypatch.setattr(m, "PIECE", 7)
    assert np.allclose(m.features(text), want)
    assert m.features(None).tolist() == m.features("").tolist()


def test_learns_from_every_labelled_document(spark, docs):
    """Documents that only the last of many labels name change the model and its threshold; all pairs are compared."""
    rng = random.Random(4)
    words = ["reading", "water", "house", "light", "from", "Stone", "1862", "...", "AND"]
    made = [(i, " ".join(rng.choice(words[: 5 + i % 5]) for _ in range(rng.randint(3, 9)))) for i in range(6_000)]
    table = spark.createDataFrame(made, "doc_id long, text string").repartition(4)
    marks = [(i, int(i % 5 < 3) ^ (i % 17 == 0)) for i in range(6_000)]
    kind, w, cut = m.fit(table, marked(spark, marks))
    x = np.array([m.features(t) for _, t in made], np.float64)
    mark = np.array([q for _, q in marks])
    s = x @ w
    better, worse = s[mark == 1], s[mark == 0]
    assert kind == "ranked" and cut == pytest.approx(m.quantile_cut(s, np.ones(len(s)), (mark == 0).mean()), abs=1e-9)
    lost = 1 / (1 + np.exp(better[:, None] - worse[None, :]))  # the slope over all pairs vanishes at the model
    slope = -lost.mean(1) @ x[mark == 1] / len(better) + lost.mean(0) @ x[mark == 0] / len(worse) + m.PENALTY * w
    assert np.linalg.norm(slope) < 3 * m.SHORT


def test_threshold_narrows_to_the_same_cut(spark, monkeypatch):
    monkeypatch.setattr(m, "INTERVALS", 4)
    monkeypatch.setattr(m, "FEW", 3)
    rng = np.random.default_rng(3)
    for s in (rng.normal(size=200), rng.integers(0, 6, 200).astype(float), np.full(200, 1.5)):
        mark = np.sort(rng.integers(0, 2, 200))
        rows = spark.createDataFrame(list(zip(mark.tolist(), s.tolist())), "mark int, s double")
        for share in (0.0, 0.3, 0.71, 1.0):
            weight = (1.0, 1.25)
            assert m.threshold(rows, weight, share) == m.quantile_cut(s, np.array(weight)[mark], share)
