import functools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from llm_cases import docs, none, rows  # noqa: F401  fixtures

from bazaarmill.llm import tokenids as t

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [2]


def test_pieces_give_the_library_ids(library, monkeypatch):
    texts = [
        "  lead", "trail ", "a  b", "a\nb c", "a \n b", " ", "", "x  y", "it's don't we'll", "1.5 a2b 3x", "\n\n a", "é  è", 'A.B C-D (x) "q".', "<|endoftext|> a",
        "word, word. word? word's \"word\" (word) word...", "naïve façade Größe 東京 спасибо 😀 ok", "tab\there and  there", "a" * 5000,
    ]
    pieces = t.Pieces(PATH)
    for _ in range(2):
        assert [x.tolist() for x in pieces.ids(texts)] == [library.encode(x, add_special_tokens=False).ids for x in texts]
    monkeypatch.setattr(t, "CACHE", 0)  # only pieces that came more than once stay
    assert [x.tolist() for x in pieces.ids(texts)] == [library.encode(x, add_special_tokens=False).ids for x in texts]


@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "a", "word", ".", "\n", "é", "  "]), max_size=12).map("".join))
@settings(max_examples=300, deadline=None)
def test_added_tokens_as_in_the_library(text):
    pieces = _pieces()
    assert pieces.ids([text, "other " + text])[0].tolist() == pieces.tok.encode(text, add_special_tokens=False).ids


@functools.cache
def _pieces():
    return t.Pieces(PATH)


def test_added_token_has_its_id(library):
    text = "a <|endoftext|> b"
    assert t.Pieces(PATH).ids([text])[0].tolist() == ids_of(library, text)[:-1] == [64, 220, 50256, 275]


def test_round_trip(docs, rows, library):
    got = t.token_file(docs, PATH).collect()
    want = sorted(((-1 if r[0] is None else r[0]), ids_of(library, r[1])) for r in rows)
    got = sorted(((-1 if r["doc_id"] is None else r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist(), r["start"]) for r in got)
    assert [g[:2] for g in got] == want
    at = 0
    for r in sorted(got, key=lambda g: g[2]):
        assert r[2] == at
        at += len(r[1])
    assert [g[0] for g in sorted(got, key=lambda g: g[2])] == sorted(g[0] for g in got)


def test_query(spark, library):
    from conftest import DATA

    docs = sorted(tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect())
    want, at = [], 0
    for d, text in docs:
        ids = np.array(ids_of(library, text), "<u4")
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, t.op8_token_ids(spark, DATA).collect())) == want


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 200), st.integers(1, 10**9), min_size=1, max_size=80), st.integers(7, 12))
def test_code_lengths(counts, most):
    lengths = t.code_lengths(counts, most)
    assert set(lengths) == set(counts)
    assert max(lengths.values()) <= most
    total = sum(2.0**-n for n in lengths.values())
    assert total <= 1
    if len(counts) > 1:
        assert total == 1


def test_unlimited_lengths_are_huffman():
    import heapq

    counts = {i: (i * 37) % 101 + 1 for i in range(60)}
    heap, cost = [(n, 0) for n in counts.values()], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap)[0] + heapq.heappop(heap)[0]
        cost += a
        heapq.heappush(heap, (a, 0))
    lengths = t.code_lengths(counts, 30)
    assert sum(counts[i] * n for i, n in lengths.items()) == cost


def test_bits_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 255, 256, 257, 3000):
        ids = np.minimum(rng.geometric(0.05, n), 90).astype(np.uint32)
        u, c = np.unique(ids, return_counts=True)
        order, size, code = t.canonical(t.code_lengths(dict(zip(u.tolist(), c.tolist())), 18))
        table = np.zeros(100, np.uint64)
        table[order] = (code << np.uint64(6)) | size.astype(np.uint64)
        bits, start, _ = t.pack(ids, table)
        back = np.ones(1 << 18, np.int64)
        for i, s, x in zip(order.tolist(), size.tolist(), code.tolist()):
            back[x << (18 - s) : (x + 1) << (18 - s)] = i * 64 + s
        assert (t.unpack(bits, -(-n // 256) * 256, start[::256], 256, 18, back)[:n] == ids).all()


def test_empty(none):
    assert t.token_file(none, PATH).count() == 0


def test_short_documents_take_no_more_room_than_their_ids():
    """A block of very short documents: each has a checkpoint, and none is opened to a full lane."""
    import tracemalloc

    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 8, 50_000)
    ids = rng.integers(0, 50, int(sizes.sum()))
    lengths = t.code_lengths({i: int(n) for i, n in enumerate(np.bincount(ids))}, 18)
    order, size, code = t.canonical(lengths)
    table = np.zeros(50, np.uint64)
    table[order] = (code << np.uint64(6)) | size.astype(np.uint64)
    back = np.ones(1 << 18, np.int64)
    for i, n, c in zip(order.tolist(), size.tolist(), code.tolist()):
        back[c << (18 - n) : (c + 1) << (18 - n)] = i * 64 + n
    bits, begin, total, local = t.pack_all(ids, sizes, table)
    assert (local[np.cumsum(sizes) - sizes] == 0).all() and total.sum() == size[np.argsort(order)][ids].sum()
    tracemalloc.start()
    got = t.unpack_lanes(bits, 8 * begin, sizes, 18, back)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got == ids).all() and peak < 60 * len(ids)


def test_plain_pieces_are_merged_together(library, monkeypatch):
    """Letters, digits, marks and line feeds need no call each; what the splitting parts stays apart."""
    texts = ["one two.three, four\nfive. (Größe) a1b2 $5,000 x_y/z?q=2 Straße\nÄ 3½ a×b don't l'été a\n\nb <|endoftext|>x " + "ab." * 300, "a " + "q9" * 40 + " b"]
    pieces = t.Pieces(PATH)
    calls = []
    real = pieces.merged
    monkeypatch.setattr(pieces, "merged", lambda p: calls.append(p) or real(p))
    assert [x.tolist() for x in pieces.ids(texts)] == [library.encode(x, add_special_tokens=False).ids for x in texts]
    assert {"two.three,", "four\nfive.", "a1b2", "Straße\nÄ"} <= set(calls[0]) and not {"3½", "a×b", "don't", "a\n\nb"} & set(calls[0])
