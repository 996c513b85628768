"""Katz backoff language model: trained and evaluated on the same stored blocks of documents.

P(w|h) = d(c) c(hw) / C(h) for a seen n-gram, else alpha(h) P(w|h'), where h' drops the first word of h. d is the Good-Turing
discount of counts up to ``TOP``; alpha(h) shares what the discounts of h's followers leave among the words not seen after
h, so that each history's probabilities sum to 1 over the vocabulary and one unknown word. A history whose followers are all
above ``TOP`` leaves nothing; its total is raised by one. Words of a document have at most the words before them in the same
document as history.

Texts become blocks of a few million words with words as 64-bit hashes. A block's distinct n-grams with their training counts are
sorted by key and dealt over ranges of the key space. Per range the counts are added up over all blocks, and each block gets the
counts of the n-grams it asked for. The first block with an n-gram in its training part owns it and adds it once to its
history's sums, which are dealt, added and answered the same way, for all orders together: what shorter histories give to a sum
is the same factor for the whole sum, so only kept counts are added. C(h) needs no sum: the end closes each document, so a
history has as many followers as it occurs. alpha(h) is asked for only by a block where h stands before an unseen word, thus in a
held-out document; and whether h has a follower up to ``TOP`` only by a block that has none itself. Owners give what
somebody may ask for: all of a history that stands in a held-out document, else a frequent one's followers up to ``TOP``.
A word or history as frequent as can be is one key in a block, however often it stands there, so no range grows with it.
Counts, sums and backoff weights cover all training documents.

With ``folder`` the model stays there as tables of counts and of histories' sums (``kind=model``, partitioned by order and
range); owners give all they have then.

Cases: a null or empty text is the end token alone; equal documents count as often as they occur; without training documents
every word is the unknown word, with probability 1; rows with a null ``doc_id`` belong to the fold of the empty text; an
empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import freeze, run_root
from .common import read, remainder
from .tokenids import trim

ORDER = 3
TOP = 5
BLOCK_WORDS = 1_500_000
OWNED = np.uint64(1 << 63)
HELD = np.uint64(1 << 62)
NOTHING = 1e-9


def packed(a: np.ndarray) -> bytes:
    """An array by byte planes, compressed: small numbers take little."""
    import pyarrow as pa

    a = np.ascontiguousarray(a)
    return len(a).to_bytes(8, "little") + pa.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes(), "zstd", asbytes=True)


def unpacked(b: bytes, kind) -> np.ndarray:
    import pyarrow as pa

    n, size = int.from_bytes(b[:8], "little"), np.dtype(kind).itemsize
    raw = pa.decompress(b[8:], n * size, "zstd", asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(size, n).T.copy().view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unpacked(b, np.uint64), dtype=np.uint64)


def coded(a: np.ndarray) -> bytes:
    """An array; of floats, which are sums of a few amounts, the distinct ones and their numbers."""
    if a.dtype != np.float64:
        return packed(a)
    u, number = np.unique(a, return_inverse=True)
    head = packed(u)
    return len(head).to_bytes(8, "little") + head + packed(number.astype(np.uint32))


def decoded(b: bytes, kind) -> np.ndarray:
    if kind != np.float64:
        return unpacked(b, kind)
    n = 8 + int.from_bytes(b[:8], "little")
    return unpacked(b[8:n], kind)[unpacked(b[n:], np.uint32)]


def follow(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of a history's n-gram with one more word."""
    x = history * np.uint64(0x9E3779B97F4A7C15) + word
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def distinct(code: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values of ``code`` (below ``most``) in ascending order, where each stands first, and each place's number among them."""
    bits = len(code).bit_length()
    if most.bit_length() + bits > 64:
        return np.unique(code, return_index=True, return_inverse=True)
    s = np.sort(code << np.uint64(bits) | np.arange(len(code), dtype=np.uint64))  # one sort of numbers, far faster than an argsort
    at = (s & np.uint64((1 << bits) - 1)).astype(np.int64)
    s >>= np.uint64(bits)
    new = np.flatnonzero(np.diff(s, prepend=~s[:1]))
    number = np.empty(len(code), np.int32)
    number[at] = np.repeat(np.arange(len(new), dtype=np.int32), np.diff(new, append=len(s)))
    return s[new], at[new], number


@dataclass
class Block:
    """Documents as word numbers. ``vocabulary`` has each number's hash, in ascending order."""

    ids: list
    held: np.ndarray
    size: np.ndarray
    word: np.ndarray
    vocabulary: np.ndarray

    @classmethod
    def of(cls, ids: list, texts, divisor: int) -> Block:
        """``texts`` is an Arrow array of large strings without nulls."""
        import pyarrow as pa
        import pyarrow.compute as pc
        from xxhash import xxh64_intdigest

        # exactly A-Z and exactly the six white-space bytes; white space at either end leaves an empty word
        cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        first = cut.offsets.to_numpy().astype(np.int64)
        found = cut.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
        number, first = found.indices.to_numpy(), first - first[0]
        spelled = found.dictionary.cast(pa.large_binary()).to_pylist()
        full = np.ones(len(number), bool) if b"" not in spelled else number != spelled.index(b"")
        upto = np.concatenate([[0], np.cumsum(full)])[first]
        size = np.diff(upto) + 1  # with the end
        end = np.cumsum(size) - 1
        word = np.full(int(size.sum()), len(spelled), np.int64)
        inside = np.ones(len(word), bool)
        inside[end] = False
        word[inside] = number[full]
        hashed = np.fromiter((xxh64_intdigest(w, 1) for w in (*spelled, b"\n")), np.uint64, len(spelled) + 1)
        order = np.argsort(hashed, kind="stable")
        if b"" in spelled:
            order = order[order != spelled.index(b"")]
        rank = np.zeros(len(hashed), np.int32)
        rank[order] = np.arange(len(order))
        held = np.array([remainder(i, divisor) == 0 for i in ids], bool)
        return cls(ids, held, size, rank[word], hashed[order])

    def pack(self) -> bytes:
        """Frequent words get small numbers here."""
        common = np.argsort(-np.bincount(self.word, minlength=len(self.vocabulary)), kind="stable").astype(np.int32)
        rank = np.empty(len(common), np.int32)
        rank[common] = np.arange(len(common))
        return pickle.dumps((self.ids, self.held, self.size, packed(rank[self.word]), packed(common), packed_keys(self.vocabulary)))

    @classmethod
    def unpack(cls, b: bytes) -> Block:
        ids, held, size, word, common, vocabulary = pickle.loads(b)
        return cls(ids, held, size, unpacked(common, np.int32)[unpacked(word, np.int32)], unpacked_keys(vocabulary))


class Grams:
    """The distinct n-grams of a block by order, and where they stand.

    Of order m: ``key``, ``sorted`` (numbers in ascending order of keys), ``place`` where one ends, ``number`` of the n-gram there;
    above 1 also ``history`` and ``lower``, the numbers of the n-grams of the order below without the last and without the first word.
    """

    def __init__(self, block: Block, order: int):
        self.block, n = block, len(block.word)
        word, kinds = block.word, len(block.vocabulary)
        nth = (np.arange(n) - np.repeat(np.cumsum(block.size) - block.size, block.size)).astype(np.int32)
        self.key, self.sorted = {1: block.vocabulary}, {1: np.arange(kinds, dtype=np.int32)}
        self.place, self.number = {1: np.arange(n, dtype=np.int32)}, {1: word}
        self.history, self.lower = {}, {}
        before = self.number[1]  # the n-gram of the order below that ends at a place
        for m in range(2, order + 1):
            place = np.flatnonzero(nth >= m - 1).astype(np.int32)
            code = before[place - 1].astype(np.uint64) * np.uint64(kinds) + word[place].astype(np.uint64)
            u, first, number = distinct(code, max(1, len(self.key[m - 1]) * kinds))
            del code
            history = u // np.uint64(kinds)
            self.history[m] = history.astype(np.int32)
            self.lower[m] = before[place[first]]
            self.key[m] = follow(self.key[m - 1][self.history[m]], block.vocabulary[(u - history * np.uint64(kinds)).astype(np.int32)])
            self.sorted[m] = np.argsort(self.key[m]).astype(np.int32)
            self.place[m], self.number[m] = place, number.astype(np.int32)
            before = np.zeros(n, np.int32)
            before[place] = number

    def asks(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys in ascending order, and twice the training count, one more if it stands in a held-out document."""
        held = np.repeat(self.block.held, self.block.size)[self.place[m]]
        n, at = len(self.key[m]), self.sorted[m]
        trained = np.bincount(self.number[m], ~held, n).astype(np.uint32)
        return self.key[m][at], (trained * np.uint32(2) + (np.bincount(self.number[m], held, n) > 0))[at].astype(np.uint32)


@dataclass
class Discounts:
    """Good-Turing discounts of one order, and its totals."""

    n: np.ndarray  # counts of counts, at index r the n-grams seen r times, to TOP + 1
    total: int
    kinds: int
    d: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n = self.n.astype(float)
        self.d = np.ones(TOP + 2)
        self.d[0] = 0
        rest = (TOP + 1) * n[TOP + 1] / n[1] if n[1] else 1.0
        for r in range(1, TOP + 1):
            x = ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) if n[r] and rest < 1 else -1.0
            self.d[r] = x if 0 < x < 1 else (r - 0.5) / r  # counts too odd for the estimate: half a count off

    def kept(self, counts: np.ndarray) -> np.ndarray:
        """What is left of counts."""
        return self.d[np.minimum(counts, TOP + 1)] * counts


def blocks_of(docs: DataFrame, divisor: int) -> DataFrame:
    """The packed blocks and their numbers. A block is part of one input partition."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        number, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0

        def block():
            b = Block.of([i for x in ids for i in x.to_pylist()], pa.concat_arrays(texts), divisor)
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([b.pack()], pa.binary())], ["block", "state"])

        for b in batches:
            text = b.column("text").cast(pa.large_string()).fill_null("")
            most = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False) // 6 + 1)
            at = 0
            while at < len(text):
                done = int(most[at - 1]) if at else 0
                to = min(int(np.searchsorted(most, done + BLOCK_WORDS - held)) + 1, len(text))
                ids.append(b.column("doc_id").slice(at, to - at))
                texts.append(text.slice(at, to - at))
                held, at = held + int(most[to - 1]) - done, to
                if held >= BLOCK_WORDS:
                    yield block()
                    number, ids[:], texts[:], held = number + 1, [], [], 0
                    trim()
        if ids:
            yield block()
        ids, texts = [], []
        trim()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "block long, state binary")


def dealt(m: int, number: int, keys: np.ndarray, values: list[np.ndarray], bits: int) -> pd.DataFrame:
    """Sorted keys and their values in rows for ``2 ** bits`` ranges of the key space."""
    edge = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    rows = [(m, r, number, packed_keys(keys[a:b]), *[coded(v[a:b]) for v in values]) for r, (a, b) in enumerate(zip(edge.tolist(), edge[1:].tolist())) if b > a]
    return pd.DataFrame(rows, columns=["m", "part", "block", "keys", *[f"v{i}" for i in range(len(values))]])


ASKS = "m int, part int, block long, keys binary, v0 binary, v1 binary, v2 binary"
REPLIES = f"kind string, {ASKS}"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
COLUMNS = ["kind", "m", "part", "block", "keys", "v0", "v1", "v2"]


def answered(folder: str, asks: DataFrame, reply, spark: SparkSession, mode: str = "error") -> DataFrame:
    """Runs ``reply`` once for each range and stores answers, statistics and model; gives the stored table.

    What was shuffled for it is dropped with the end of the write.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        asks.groupBy("m", "part").applyInPandas(reply, REPLIES).write.mode(mode).partitionBy("kind", "m").option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(REPLIES).parquet(folder)


def reply_counts(d: pd.DataFrame, keep: bool) -> pd.DataFrame:
    """Adds up the counts of one range."""
    d = d.sort_values("block", kind="stable")
    keys = [unpacked_keys(k) for k in d["keys"]]
    asked = np.concatenate([unpacked(v, np.uint32) for v in d["v0"]])
    u, back = np.unique(np.concatenate(keys), return_inverse=True)
    counts = (asked >> np.uint32(1)).astype(np.int64)
    total = np.bincount(back, counts, len(u)).astype(np.int64)
    held = np.zeros(len(u), bool)
    held[back[(asked & np.uint32(1)) > 0]] = True
    seen = np.flatnonzero(counts)[::-1]
    first = np.full(len(u), -1)
    first[back[seen]] = seen  # the last one written is the first that is seen
    owners = np.zeros(len(counts), bool)
    owners[first[first >= 0]] = True
    full = (total.astype(np.uint64) | np.where(held, HELD, np.uint64(0)))[back] | np.where(owners, OWNED, np.uint64(0))
    m, part, rows, at = int(d["m"].iloc[0]), int(d["part"].iloc[0]), [], 0
    for block, k in zip(d["block"], keys):
        rows.append(("answer", m, part, block, None, packed(full[at : at + len(k)]), None, None))
        at += len(k)
    kept = total > 0
    n = np.bincount(np.minimum(total, TOP + 2), minlength=TOP + 3)[: TOP + 2]
    if keep:
        rows.append(("model", m, part, None, packed_keys(u[kept]), packed(total[kept]), None, None))
    rows.append(("stat", m, part, None, None, np.append(n, [total.sum(), kept.sum()]).astype("<i8").tobytes(), None, None))
    return pd.DataFrame(rows, columns=COLUMNS)


def reply_histories(d: pd.DataFrame, keep: bool) -> pd.DataFrame:
    """Adds up the followers of the histories of one range: their counts, what is taken off them, what is kept of their shorter n-grams.

    Counts come twice as large, one more where the block wants the sums.
    """
    d = d.sort_values("block", kind="stable")
    keys = [unpacked_keys(k) for k in d["keys"]]
    u, back = np.unique(np.concatenate(keys), return_inverse=True)
    given = [np.concatenate([decoded(v, kind) for v in d[c]]) for c, kind in (("v0", np.uint64), ("v1", np.float64), ("v2", np.float64))]
    asks = (given[0] & np.uint64(1)) > 0
    given[0] >>= np.uint64(1)
    count, taken, low = [np.bincount(back, x, len(u)) for x in given]
    count = count.astype(np.uint64)
    m, part, rows, at = int(d["m"].iloc[0]), int(d["part"].iloc[0]), [], 0
    for block, k in zip(d["block"], keys):
        x = back[at : at + len(k)][asks[at : at + len(k)]]
        if len(x):
            rows.append(("answer", m, part, block, None, coded(count[x]), coded(taken[x]), coded(low[x])))
        at += len(k)
    if keep:
        seen = count > 0
        rows.append(("model", m, part, None, packed_keys(u[seen]), coded(count[seen]), coded((count - taken)[seen]), coded(low[seen])))
    return pd.DataFrame(rows, columns=COLUMNS)


class Scorer:
    """A block with the answers it has got so far."""

    def __init__(self, block: Block, answers: pd.DataFrame, order: int, stats: list[Discounts], whole: bool, last: bool):
        self.grams, self.stats, self.order = Grams(block, order), stats, order
        g = self.grams
        got = {k: x for k, x in answers.sort_values(["step", "m", "part"]).groupby(["step", "m"])}
        self.count, self.taken, self.low, self.sent = {}, {}, {}, {}
        for m in range(1, order + 1):
            full = np.empty(len(g.key[m]), np.uint64)
            full[g.sorted[m]] = self.joined(got.get((0, m)), "v0", np.uint64, len(full))
            self.count[m] = c = (full & ~(OWNED | HELD)).astype(np.int64)
            held, before = (full & HELD) > 0, held if m > 1 else None
            own = full >= OWNED
            del full
            if m == 1:
                continue
            h, n, total = g.history[m], len(g.key[m - 1]), self.count[m - 1]
            taken = c - stats[m - 1].kept(c)
            self.taken[m] = np.bincount(h, taken, n)  # by followers in this block: something, or not known
            asks = np.zeros(n, bool)
            asks[h] = self.taken[m][h] <= NOTHING
            asks[h[c == 0]] = True
            asks &= total > 0
            if last:
                at = g.sorted[m - 1][asks[g.sorted[m - 1]]]
                self.taken[m][at] = self.joined(got.get((1, m)), "v1", np.float64, len(at))
                self.low[m] = np.zeros(n)
                self.low[m][at] = self.joined(got.get((1, m)), "v2", np.float64, len(at))
                continue
            h = h[own]
            below = stats[m - 2].kept(total)[g.lower[m][own]]
            count, taken, low = [np.bincount(h, x, n).astype(float) for x in (c[own], taken[own], below)]  # of nothing it counts in integers
            gives = (count > 0) & (whole | before | (total > TOP) & (taken > 0))
            at = g.sorted[m - 1][(asks | gives)[g.sorted[m - 1]]]
            self.sent[m] = at, [count[at].astype(np.uint64) * np.uint64(2) + asks[at], taken[at], low[at]]

    @staticmethod
    def joined(rows, column: str, kind, n: int) -> np.ndarray:
        out = np.concatenate([decoded(b, kind) for b in rows[column]]) if rows is not None else np.zeros(0, kind)
        if len(out) != n:
            raise RuntimeError(f"a block has {n} keys and {len(out)} answers")
        return out

    def asks(self, number: int, bits: int) -> Iterator[pd.DataFrame]:
        """For each history that is sent what the n-grams owned here add to its sums."""
        for m, (at, sums) in self.sent.items():
            yield dealt(m, number, self.grams.key[m - 1][at], sums, bits)

    def unigram(self) -> tuple[np.ndarray, float]:
        """Probability of each distinct word of the block; the total it is taken of."""
        s = self.stats[0]
        kept = s.total - float(sum(r * s.n[r] * (1 - s.d[r]) for r in range(1, TOP + 1)))
        total = s.total if s.total - kept > NOTHING else s.total + 1
        return np.where(self.count[1] > 0, s.kept(self.count[1]) / total, 1 - kept / total), total

    def scores(self) -> pd.DataFrame:
        g, b, s = self.grams, self.grams.block, self.stats[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            prob, whole = self.unigram()
            one = np.log10(prob)
            below, lower = np.full(1, whole), np.zeros(len(g.key[1]), np.int64)  # totals of the histories of the order below, and which is whose
            log = one[g.number[1]]
            for m in range(2, self.order + 1):  # from the shortest history up: each order replaces or backs off
                count, taken = self.count[m - 1], self.taken[m]
                total = count + (taken <= NOTHING)
                alpha = np.where(count > 0, (total - count + taken) / total / np.maximum(1 - self.low[m] / below[lower], 1e-15), 1.0)
                c, h = self.count[m], g.history[m]
                p = np.where(c > 0, self.stats[m - 1].kept(c) / total[h], 0.0)
                one = np.where(p > 0, np.log10(p), np.log10(alpha)[h] + one[g.lower[m]])
                log[g.place[m]] = one[g.number[m]]
                below, lower = total, g.lower[m]
            base = np.log10((self.count[1] + 0.1) / (s.total + 0.1 * (s.kinds + 1)))[g.number[1]]
        known = (self.count[1] > 0).astype(np.int64)[g.number[1]]
        at = np.cumsum(b.size) - b.size
        add = lambda x: np.add.reduceat(x, at)  # noqa: E731  every document has its end token
        return pd.DataFrame({
            "doc_id": pd.array(b.ids, "Int64"), "held_out": b.held, "n_tokens": b.size, "n_known": add(known),
            "train_tokens": s.total, "base_score": add(base), "score": add(log),
        })


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def katz_scores(docs: DataFrame, order: int = ORDER, divisor: int = 10, folder: str | None = None) -> DataFrame:
    """Scores of all documents under the model of those whose fold is not 0; with ``folder`` the model's tables stay there.

    One pass over the documents for the blocks, which are stored; over these one for the counts of the shorter n-grams, one for
    the longest, which are most, one for the histories, one for the scores. ``bits`` ranges of the key space follow the number of
    shuffle partitions.
    """
    spark = docs.sparkSession
    keep = folder is not None
    folder = folder or f"{run_root(spark)}/llm/katz-{uuid.uuid4().hex}"
    bits = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length())
    blocks = freeze(blocks_of(docs, divisor))

    def ask_counts(orders: list[int]) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for d in batches:
                for number, state in zip(d["block"], d["state"]):
                    g = Grams(Block.unpack(state), orders[-1])
                    for m in orders:
                        keys, asked = g.asks(m)
                        yield dealt(m, number, keys, [asked], bits).assign(v1=None, v2=None)
                    del g
                    trim()

        return blocks.mapInPandas(run, ASKS)

    for orders in filter(None, (list(range(1, order)), [order])):  # what is shuffled for the first is gone when the second begins
        mode = "append" if orders[0] > 1 else "error"  # never to an older model
        table = answered(f"{folder}/counts", ask_counts(orders), lambda d: reply_counts(d, keep), spark, mode)
    sums = {m: np.zeros(TOP + 4, np.int64) for m in range(1, order + 1)}
    for r in table.where("kind = 'stat'").select("m", "v0").toLocalIterator():
        sums[r["m"]] += np.frombuffer(r["v0"], "<i8")
    stats = [Discounts(sums[m][: TOP + 2], int(sums[m][-2]), int(sums[m][-1])) for m in range(1, order + 1)]
    answers = table.where("kind = 'answer'").select("block", F.lit(0).alias("step"), "m", "part", "v0", "v1", "v2")

    def together(fn, schema: str, last: bool) -> DataFrame:
        def run(d: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
            out = fn(int(d["block"].iloc[0]), Scorer(Block.unpack(d["state"].iloc[0]), a, order, stats, keep, last))
            trim()
            return out

        return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, schema)

    if order > 1:
        asks = together(lambda number, s: pd.concat(list(s.asks(number, bits))), ASKS, False)
        table = answered(f"{folder}/histories", asks, lambda d: reply_histories(d, keep), spark)
        answers = answers.unionByName(table.where("kind = 'answer'").select("block", F.lit(1).alias("step"), "m", "part", "v0", "v1", "v2"))
    return together(lambda _, s: s.scores(), SCORES, True)


def op1_katz(spark: SparkSession, root: str) -> DataFrame:
    return katz_scores(read(spark, root, "documents"))
