import numpy as np
import pytest
import xxhash
from llm_cases import docs, groups, none, rows  # noqa: F401  fixtures

from bazaarmill.llm import simhash as s


def plain(text):
    w = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_clusters(docs, rows):
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in s.clusters(s.stored(s.fingerprints(docs))).collect())
    own = sorted({(r[0], plain(r[1])) for r in rows if r[0] is not None})
    root = groups(len(own), [(i, j) for i in range(len(own)) for j in range(i) if (own[i][1] ^ own[j][1]).bit_count() <= 3])
    of = {own[i][0]: own[root[i]][0] for i in range(len(own))}
    for doc, fp, component in got:
        if doc >= 0:
            assert (doc, fp, component) == (doc, dict(own)[doc], of[doc])
    assert len(got) == len(rows)


@pytest.mark.parametrize("hot", [10**6, 3])
def test_trie_join_finds_all_links(spark, hot):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flip = lambda: np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)
    k = np.unique(np.concatenate([base, *[base ^ flip() ^ flip() for _ in range(25)]]))
    want = {(i, j) for i in range(len(k)) for j in range(i + 1, len(k)) if int(k[i] ^ k[j]).bit_count() <= 3}
    got = {(i, j) for a, b in s.trie_walk(k, np.array([0]), np.array([len(k)]), 3) for i, j in zip(a.tolist(), b.tolist())}
    assert got == want
    edges = s.near_pairs(spark.createDataFrame([(int(x), i) for i, x in enumerate(k.view(np.int64))], "fp long, rep long"), 3, hot).collect()
    assert groups(len(k), [tuple(e) for e in edges]) == groups(len(k), want)


def test_long_fronts_are_walked_in_parts(monkeypatch):
    monkeypatch.setattr(s, "FRONT", 5)
    k = np.unique(np.random.default_rng(2).integers(0, 1 << 10, 300, dtype=np.uint64))
    got = sorted((i, j) for a, b in s.trie_walk(k, np.array([0]), np.array([len(k)]), 2) for i, j in zip(a.tolist(), b.tolist()))
    assert got == [(i, j) for i in range(len(k)) for j in range(i + 1, len(k)) if int(k[i] ^ k[j]).bit_count() <= 2]


def test_stage_keeps_one_of_each_group(docs):
    kept = s.simhash_stage(docs.sparkSession, docs, "")
    of = {r["doc_id"]: r["component_id"] for r in s.clusters(s.stored(s.fingerprints(docs))).collect()}
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted({v for v in of.values() if v is not None})
    assert sum(r["doc_id"] is None for r in kept.collect()) == 1


def test_components(spark):
    from bazaarmill.llm.common import components

    pairs = [(i, i + 1) for i in range(40)] + [(100, 50 + i) for i in range(30)] + [(200, 200), (7, 6), (6, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{50 + i: 50 for i in range(30)}, 100: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty(none):
    assert s.clusters(s.stored(s.fingerprints(none))).count() == 0
