import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st

from llm_cases import none  # noqa: F401  fixtures

from bazaarmill.llm import suffixes as x


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_suffix_array(s):
    assert x.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def plain(docs, length=100):
    first: dict[bytes, tuple] = {}
    for d, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            k = b[i : i + length]
            first[k] = min(first.get(k, (d, i)), (d, i))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < (d, i):
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


def texts():
    rng = random.Random(3)
    part = ["".join(rng.choice("abé ") for _ in range(rng.randint(60, 300))) for _ in range(12)]
    out: list[tuple] = []
    for d in range(110):
        t = "".join(rng.choice(part) if rng.random() < 0.6 else "".join(rng.choice("abcdef ") for _ in range(rng.randint(1, 90))) for _ in range(rng.randint(0, 8)))
        if d % 17 == 0:
            t = "a" * rng.randint(90, 400)
        if d % 23 == 0:
            t = "xyz" * rng.randint(30, 100) + t
        if d % 19 == 3:
            t = None
        if d % 13 == 5 and out:
            t = out[-1][1]
        out.append((d, t))
    return [*out, out[20], out[21], (5000, "é" * 20_000)]


@pytest.mark.parametrize("hot,long,block", [(20_000, 2_000, 9_000), (3, 2_000, 9_000), (20_000, 30, 10**7)])
def test_against_plain(spark, hot, long, block, monkeypatch):
    monkeypatch.setattr(x, "BLOCK_BYTES", block)
    monkeypatch.setattr(x, "LONG", long)
    docs = texts()
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, block int, part int").repartition(3)
    got = x.repeats(frame, hot=hot).drop("spans").collect()
    assert sorted(map(tuple, got)) == plain(docs)


def test_null_ids_and_empty(spark, none):
    rows = [(None, "q" * 50 + "r" * 80), (1, "q" * 50 + "r" * 80), (2, "")]
    got = {r["doc_id"]: r["n_removed"] for r in x.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {None: 0, 1: 130, 2: 0}
    assert x.repeats(none).count() == 0


def test_query(spark):
    from conftest import DATA

    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, x.op10_suffix_dedup(spark, DATA).collect())) == plain(docs)
