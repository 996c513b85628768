import hashlib
import re

from llm_cases import docs, none, rows  # noqa: F401  fixtures

from bazaarmill.llm import decontaminate as d

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def cut(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, items, window=10):
    patterns = {}
    for i, t in items:
        w = cut(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            patterns.setdefault(tuple(w[k : k + window]), set()).add(i)
    out = []
    for doc, text in rows:
        w, hit, who = tuple(cut(text)), set(), set()
        for size in {len(p) for p in patterns}:
            for k in range(len(w) - size + 1):
                if w[k : k + size] in patterns:
                    who |= patterns[w[k : k + size]]
                    hit.update(range(k, k + size))
        out.append((doc, len(w), len(hit), sorted(x for x in who if x is not None)))
    return sorted(out, key=str)


def items_of(rows):
    texts = [r[1] for r in rows if r[1]]
    return [(1, texts[3]), (2, texts[3]), (30, "Where is it?"), (4, None), (5, ""), (6, "the"), (None, "over the Straße"), (7, texts[10].upper()), (7, texts[10].upper())]


def test_hits(spark, docs, rows):
    items = items_of(rows)
    bench = spark.createDataFrame([(a, b, "x") for a, b in items], "item_id long, text string, doc_id string")
    want = plain([(r[0], r[1]) for r in rows], items)
    for most in (d.MOST_WORDS, 12):
        got = d.scan(docs, bench, most_words=most).collect()
        assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], sorted(r["items"])) for r in got), key=str) == want


def test_spans_are_places_in_the_original(spark):
    text = "Say: THE  Quick-brown fox.. (jumps) über 5 lazy dogs, now!"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "the quick brown"), (2, "Über 5 LAZY")], "item_id long, text string")
    got = d.scan(docs, bench).first()
    found = [text[a:b] for a, b in zip(got["spans"][::2], got["spans"][1::2])]
    # only A-Z are lower-cased, so a capital Ü is another letter
    assert found == ["THE  Quick-brown"]


def test_empty(spark, docs, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert d.scan(docs, bench).where("n_hit > 0").count() == 0
    assert d.scan(none, bench).count() == 0


def test_query(spark):
    from conftest import DATA

    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    want = [(a, b, c, len(w), hashlib.sha256(",".join(sorted(map(str, w))).encode()).hexdigest(), c > 0) for a, b, c, w in plain(docs, items)]
    assert sorted(map(tuple, d.op4_decontaminate(spark, DATA).collect())) == sorted(want)
    assert any(w[5] for w in want)


def test_stage_drops_only_hits(spark):
    from conftest import DATA

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = d.decontaminate_stage(spark, docs, DATA)
    bad = {r["doc_id"] for r in d.op4_decontaminate(spark, DATA).where("contaminated").collect()}
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - bad


def test_blocks_come_one_at_a_time(spark, docs, rows, monkeypatch):
    items = items_of(rows)
    bench = spark.createDataFrame([(a, b) for a, b in items], "item_id long, text string")
    n, blocks = d.item_blocks(bench, 40)
    assert n >= 4
    sizes = [len(x) for x in blocks]
    assert len(sizes) == n and sum(sizes) == len({(a, b) for a, b in items if b is not None})
    whole = d.with_hits(docs, bench, "_found").select("doc_id", "_found").collect()
    split = d.with_hits(docs, bench, "_found", most_words=40).select("doc_id", "_found").collect()
    plain_rows = lambda x: sorted(str((r["doc_id"], r["_found"]["n_words"], r["_found"]["n_hit"], sorted(r["_found"]["items"]), r["_found"]["spans"])) for r in x)
    assert plain_rows(whole) == plain_rows(split)


def test_an_automaton_is_built_once_in_a_worker(spark):
    from bazaarmill.llm.common import kept_in_worker

    made = []
    for key in ("a", "a", "b", "b", "a"):
        assert kept_in_worker(key, lambda k=key: made.append(k) or k) == key
    assert made == ["a", "b", "a"]
