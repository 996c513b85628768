"""Scores against a plain evaluation with dictionaries; probabilities of a history sum to one."""

import collections
import math
import zlib

import numpy as np
import pytest

from llm_cases import docs, none, rows  # noqa: F401  fixtures

from bazaarmill.llm import katz


def plain(rows, order):
    crc = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 10
    texts = [(d, [*(t or "").encode().lower().split(), None]) for d, t in rows]
    train = [t for d, t in texts if crc(d)]
    count = {m: collections.Counter(tuple(t[i - m + 1 : i + 1]) for t in train for i in range(m - 1, len(t))) for m in range(1, order + 1)}
    stats = {}
    for m, c in count.items():
        n = np.zeros(katz.TOP + 2, int)
        for v in c.values():
            if v <= katz.TOP + 1:
                n[v] += 1
        stats[m] = katz.Discounts(n, sum(c.values()), len(c))
    kept = lambda m, c: float(stats[m].kept(np.array([c]))[0])
    after = {m: collections.defaultdict(list) for m in range(2, order + 1)}
    for m in after:
        for g, c in count[m].items():
            after[m][g[:-1]].append((g, c))
    total = stats[1].total
    mass = sum(kept(1, c) for c in count[1].values())
    whole = total if total - mass > 1e-9 else total + 1
    one = {g: kept(1, c) / whole for g, c in count[1].items()}

    def history(m, h):
        c, k = sum(x for _, x in after[m][h]), sum(kept(m, x) for _, x in after[m][h])
        t = c if c - k > 1e-9 else c + 1
        low = sum(p(g[-1], g[1:-1]) for g, _ in after[m][h])
        return t, (1 - k / t) / max(1 - low, 1e-15)

    def p(w, h):
        if not h:
            return one.get((w,), 1 - mass / whole)
        m = len(h) + 1
        if h not in after[m]:
            return p(w, h[1:])
        t, a = history(m, h)
        c = count[m].get((*h, w), 0)
        return kept(m, c) / t if c else a * p(w, h[1:])

    kinds = [g[0] for g in count[1]]
    sums = [sum(p(w, h) for w in kinds) + p(object(), h) for h in list(after[order])[:10]]
    out = []
    for d, t in texts:
        score = sum(math.log10(p(t[i], tuple(t[max(0, i - order + 1) : i]))) for i in range(len(t)))
        base = sum(math.log10((count[1].get((w,), 0) + 0.1) / (total + 0.1 * (len(count[1]) + 1))) for w in t)
        out.append((d, crc(d) == 0, len(t), sum((w,) in count[1] for w in t), total, base, score))
    return out, sums


@pytest.mark.parametrize("order", [2, 3])
def test_scores(docs, rows, order, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_WORDS", 500)  # many blocks
    short = [(r[0], r[1][:3000] if r[1] else r[1]) for r in rows]
    frame = docs.sparkSession.createDataFrame([(a, b, 1, 2) for a, b in short], "doc_id long, text string, m int, v0 int").repartition(3)
    want, sums = plain(short, order)
    assert all(abs(s - 1) < 1e-9 for s in sums)
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:5], round(r[5], 6))
    got = sorted((tuple(r) for r in katz.katz_scores(frame, order).collect()), key=key)
    for a, b in zip(sorted(want, key=key), got, strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], abs=1e-6)


def test_better_than_base_on_held_out(spark):
    from conftest import DATA

    got = katz.op1_katz(spark, DATA).where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert got[0] > got[1]


def test_empty_and_untrained(spark, none):
    assert katz.katz_scores(none).count() == 0
    only = spark.createDataFrame([(d, "a b") for d in range(200) if zlib.crc32(str(d).encode()) % 10 == 0], "doc_id long, text string")
    assert {(r["score"], r["train_tokens"], r["n_known"]) for r in katz.katz_scores(only).collect()} == {(0.0, 0, 0)}


def test_discounts_take_something():
    d = katz.Discounts(np.array([0, 10, 6, 3, 2, 1, 1]), 50, 23)
    assert all(0 < x <= 1 for x in d.d[1:])
    odd = katz.Discounts(np.array([0, 0, 3, 0, 0, 0, 9]), 60, 12)
    assert odd.d[2] == 0.75


def test_only_histories_that_meet_others_are_sent(spark, tmp_path, monkeypatch):
    """Order 3 in three passes; what occurs once stays in its block, unless the model is kept."""
    root = f"{tmp_path}/run"
    monkeypatch.setattr(katz, "run_root", lambda _: root)
    train = [d for d in range(60) if zlib.crc32(str(d).encode()) % 10]
    held = next(d for d in range(99) if zlib.crc32(str(d).encode()) % 10 == 0)
    texts = [(d, f"x{d} y{d} the same") for d in train] + [(held, f"x{train[0]} y{train[0]} z")]
    frame = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: tuple(r) for r in katz.katz_scores(frame).collect()}
    for r in plain(texts, 3)[0]:
        assert got[r[0]][:5] == r[:5] and got[r[0]][5:] == pytest.approx(r[5:], abs=1e-9)
    (run,) = (tmp_path / "run" / "llm").iterdir()
    assert {x.name for x in run.iterdir()} == {"counts", "histories"}
    assert not list(run.glob("*/kind=model"))
    sent = spark.read.parquet(f"{run}/histories").where("m = 3").select("v0").collect()
    # "the same", and the pair that a held-out document repeats; the other pairs stand once
    assert sum(len(katz.unpacked(r["v0"], np.uint64)) for r in sent) == 2

    model = f"{tmp_path}/model"
    assert {r["doc_id"]: tuple(r) for r in katz.katz_scores(frame, folder=model).collect()} == got
    kept = spark.read.parquet(f"{model}/histories").where("kind = 'model' and m = 3").select("v0").collect()
    # per document (x y), (y the); one (the same) for all
    assert sum(len(katz.unpacked(r["v0"], np.uint64)) for r in kept) == 2 * len(train) + 1


@pytest.mark.parametrize("most", [300, 1 << 62])
def test_distinct(most):
    code = np.random.default_rng(1).integers(0, 300, 1000).astype(np.uint64)
    u, first, number = katz.distinct(code, most)
    assert list(u) == sorted(set(code.tolist())) and (u[number] == code).all()
    assert [code.tolist().index(x) for x in u] == first.tolist()
    assert [len(x) for x in katz.distinct(code[:0], most)] == [0, 0, 0]


def test_words_of_a_block():
    import pyarrow as pa

    from bazaarmill.llm.common import words

    texts = ["", " ", "A b\t\x0bB\n", "\x1c\x85\u00a0 É é", "a" * 50, "b \x00 b"]
    b = katz.Block.of(list(range(6)), pa.array(texts, pa.large_string()), 10)
    assert b.size.tolist() == [len(words(t)) + 1 for t in texts]
    from xxhash import xxh64_intdigest

    assert b.vocabulary[b.word].tolist() == [xxh64_intdigest(w, 1) for t in texts for w in (*words(t), b"\n")]
    again = katz.Block.unpack(b.pack())
    assert (again.word == b.word).all() and (again.vocabulary == b.vocabulary).all() and (np.diff(b.vocabulary) > 0).all()


@pytest.mark.parametrize("a", [np.zeros(0), np.array([0.25, 3.5, 0.25, 0.0]), np.array([5, 1 << 63, 0], np.uint64)])
def test_coded_arrays_come_back(a):
    assert katz.decoded(katz.coded(a), a.dtype).tolist() == a.tolist()


@pytest.mark.parametrize("more, asking", [([], 0), ([" c"] * 30, None), (["held"], 1)])
def test_sums_go_to_blocks_that_need_them(spark, tmp_path, monkeypatch, more, asking):
    """A repeated history is answered where an unseen word follows it, or only frequent ones; before, wherever it stood."""
    monkeypatch.setattr(katz, "run_root", lambda _: f"{tmp_path}/run")
    monkeypatch.setattr(katz, "BLOCK_WORDS", 20)
    train = [d for d in range(150) if zlib.crc32(str(d).encode()) % 10]
    held = next(d for d in range(99) if zlib.crc32(str(d).encode()) % 10 == 0)
    texts = [(d, f"a b x{d}") for d in train[:60]] + [(d, f"a b{x}") for d, x in zip(train[60:], more) if x != "held"]
    texts += [(held, "a b z")] * ("held" in more)
    got = {r["doc_id"]: tuple(r) for r in katz.katz_scores(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)).collect()}
    for r in plain(texts, 3)[0]:
        assert got[r[0]][:5] == r[:5] and got[r[0]][5:] == pytest.approx(r[5:], abs=1e-9)
    (run,) = (tmp_path / "run" / "llm").iterdir()
    counts = spark.read.parquet(f"{run}/counts").where("kind = 'answer' and m = 3")
    assert counts.select("block").distinct().count() > 5
    if asking is not None:
        sent = spark.read.schema(katz.REPLIES).parquet(f"{run}/histories").where("kind = 'answer' and m = 3").select("v1").collect()
        assert sum(len(katz.decoded(r["v1"], np.float64)) for r in sent) == asking


def test_counts_go_in_two_writes_but_never_to_an_older_model(spark, tmp_path):
    from pyspark.errors import AnalysisException

    frame = spark.createDataFrame([(d, "a b c d") for d in range(20)], "doc_id long, text string")
    katz.katz_scores(frame, folder=f"{tmp_path}/model").count()
    counts = spark.read.parquet(f"{tmp_path}/model/counts").where("kind = 'model'")
    assert {r["m"] for r in counts.select("m").distinct().collect()} == {1, 2, 3}
    writes = {p.name.split("-c000")[0].split("-", 2)[2] for p in (tmp_path / "model" / "counts").rglob("part-*.parquet")}
    assert len({w.split(".")[0] for w in writes}) == 2  # the shorter n-grams, then the longest
    with pytest.raises(AnalysisException):
        katz.katz_scores(frame, folder=f"{tmp_path}/model")
