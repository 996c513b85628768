import hashlib
import random
import zlib

import pytest
from conftest import DATA

from bazaarmill.llm import prefixtrie as m

SCHEMA = "conv_id long, turn long, role string, text string, depth long, k0 string, n_convs int, block int"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """The trie, plainly: every prefix of every rebuilt conversation."""
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    for c, turns in own.items():
        digest = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).digest()
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], digest(x[1], x[2])))
        own[c] = [(r, t) for _, r, t in turns]
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        kids = children.get(p, [])
        leaves[p] = sum(leaves[k] for k in kids) or 1
        saved[p] = sum(saved[k] for k in kids) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if paths[c] == p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = m.trie(*m.rebuilt(m.turns_of(df)))
    assert got.columns == NAMES
    return sorted((tuple(r) for r in got.collect()), key=str)


def conversation(c, turns, start=0):
    return [(c, start + i, "user" if i % 2 == 0 else "assistant", t, 1, "x", 2, 3) for i, t in enumerate(turns)]


@pytest.fixture(scope="module")
def deep():
    """Nested, copied and branching conversations of up to 70 turns, which pass several blocks."""
    rng = random.Random(3)
    long = [f"turn {i} é" + "x" * (i % 5) for i in range(70)]
    rows = []
    for c in range(0, 60, 5):
        cut, same = rng.randint(0, 70), rng.randint(0, 70)
        rows += conversation(c, long[:cut])
        rows += conversation(c + 1, long)
        rows += conversation(c + 2, long[:same] + [f"other {i % 4}" for i in range(70 - same)])
        rows += conversation(c + 3, [rng.choice("ab") for _ in range(rng.randint(1, 20))])
        rows += conversation(c + 4, long[:20] + ["end"])
    return rows


def test_against_brute_force(spark, deep):
    assert found(spark, deep) == brute(deep)


def test_cases(spark):
    rows = conversation(10, ["a", "b", "c"]) + conversation(11, ["a", None, ""]) + conversation(12, ["a"])
    rows += [(13, None, None, "first", 1, "x", 2, 3), (13, 0, "user", "later", 1, "x", 2, 3), (13, 0, "user", "later", 1, "x", 2, 3)]
    rows += [(None, 0, "user", "nobody's", 1, "x", 2, 3), (14, 5, "b", "same turn", 1, "x", 2, 3), (14, 5, "a", "same turn", 1, "x", 2, 3)]
    rows += conversation(23, ["no base"] * 9) + conversation(27, ["y"]) + conversation(3, ["q" * 50_000])
    rows += [(c, 0, "user", "hello", 1, "x", 2, 3) for c in range(100, 160)]
    assert found(spark, rows) == brute(rows)


def test_turnless_and_empty(spark):
    lonely = next(c for c in range(1001, 2000) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = conversation(lonely, ["left out"])  # its base is absent and it has no turn after the first h
    assert found(spark, rows) == brute(rows) == [(lonely, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lonely).encode()).hexdigest())]
    assert found(spark, [] + [(None, 0, "user", "x", 1, "x", 2, 3)]) == []


def test_query_against_sql(spark, con):
    got = sorted((tuple(r) for r in m.op11_prefix_trie(spark, DATA).collect()), key=str)
    assert got == sorted(con.execute(f"SELECT {', '.join(NAMES)} FROM ({m.SQL})").fetchall(), key=str)


def test_packed_ids_give_the_same_digest(spark, monkeypatch):
    rows = [(c, 0, "user", "hello", 1, "x", 2, 3) for c in range(0, 3000, 5)]
    want = brute(rows)
    monkeypatch.setattr(m, "PACK", 7)
    assert found(spark, rows) == want
