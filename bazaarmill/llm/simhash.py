"""SimHash near-duplicates by a self-join of binary tries.

``fingerprints`` gives each document a 64-bit fingerprint, ``near_pairs`` joins the distinct fingerprints with themselves,
``clusters`` gives each document the smallest ``doc_id`` of its group.

The join walks a trie over sorted fingerprints with itself. A pair of nodes holds the bits in which their prefixes differ;
both split at the next bit, a crossed pair costs one bit, and a pair over the budget is dropped with all below it. To spread
the trie over tasks, the fingerprint is cut in ``budget + 1`` blocks: two fingerprints within the budget agree in one block at
least, so tries that share a block's value are walked alone. A value shared by more than ``hot`` fingerprints is cut once more
by the same rule over its remaining bits. A pair counts only under the first block that both share, so it is found once.

Only a forest of the links found in a task leaves it, so a dense group gives as many rows as members, not as its pairs.

Cases: a null, empty or blank text has fingerprint zero and links like any other; equal rows and equal texts share a
fingerprint and so a group; rows with a null ``doc_id`` get a fingerprint, and a group only if another document has it too; an
empty table gives no rows; other input columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import components, read, stored, words

SEED = 42
SHINGLE = 3
BUDGET = 3
#: Fingerprints with one block's value beyond which that value is cut again.
HOT = 50_000
#: Node pairs walked at once, and the product of sizes below which a node pair is compared outright.
FRONT, LEAF = 400_000, 32


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    from xxhash import xxh64_intdigest

    w = words(text)
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= shingle:
        return xxh64_intdigest(joined, seed)
    size = np.fromiter(map(len, w), np.int64, len(w)) + 1
    end = np.cumsum(size) - 1
    start = end - size + 1
    n = len(w) - shingle + 1
    s, e = start[:n].tolist(), end[shingle - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        h = np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(s[i : i + (1 << 16)], e[i : i + (1 << 16)])), np.uint64)
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Rows (doc_id, fp): the fingerprint's 64 bits as a long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle, seed) for t in b["text"]), np.uint64, len(b))
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fp.view(np.int64)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, fp long")


def blocks(bits: int, parts: int) -> list[tuple[int, int]]:
    """(shift, width) of ``parts`` neighbouring blocks of ``bits`` bits, the highest first."""
    width = [bits // parts + (i < bits % parts) for i in range(parts)]
    return [(bits - sum(width[: i + 1]), w) for i, w in enumerate(width)]


def block_of(x: np.ndarray, shift: int, width: int) -> np.ndarray:
    return (x >> np.uint64(shift)) & np.uint64((1 << width) - 1)


def without(x: np.ndarray, shift: int, width: int) -> np.ndarray:
    """The bits outside a block, moved together."""
    high = (x >> np.uint64(shift + width)) << np.uint64(shift) if shift + width < 64 else np.zeros_like(x)
    return high | (x & np.uint64((1 << shift) - 1))


def first_equal(a: np.ndarray, b: np.ndarray, cut: list[tuple[int, int]]) -> np.ndarray:
    """The first block in which each pair agrees."""
    out = np.full(len(a), len(cut), np.int64)
    for i in range(len(cut) - 1, -1, -1):
        out[block_of(a ^ b, *cut[i]) == 0] = i
    return out


def trie_walk(keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ``keys`` within ``budget`` bits, each once, group by group.

    A group is a range of ascending keys. Node pairs of one level are walked together; a long front is walked in parts, so
    memory is bounded by ``FRONT`` times the depth.
    """
    stack = [(63, starts, ends, starts, ends, np.zeros(len(starts), np.int8))]
    ones = {}
    while stack:
        bit, a0, a1, b0, b1, cost = stack.pop()
        if len(a0) > FRONT:
            h = len(a0) // 2
            stack += [(bit, *(x[h:] for x in (a0, a1, b0, b1, cost))), (bit, *(x[:h] for x in (a0, a1, b0, b1, cost)))]
            continue
        leaf = ((a1 - a0) * (b1 - b0) <= LEAF) | (bit < 0)
        if leaf.any():
            n, m = (a1 - a0)[leaf], (b1 - b0)[leaf]
            total = n * m
            for lo, hi in spans(total, 1 << 22):
                t = total[lo:hi]
                k = np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t)
                width = np.repeat(m[lo:hi], t)
                i, j = np.repeat(a0[leaf][lo:hi], t) + k // width, np.repeat(b0[leaf][lo:hi], t) + k % width
                good = (i < j) & (np.bitwise_count(keys[i] ^ keys[j]) <= budget)
                if good.any():
                    yield i[good], j[good]
            a0, a1, b0, b1, cost = (x[~leaf] for x in (a0, a1, b0, b1, cost))
        if not len(a0):
            continue
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((keys >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        c = ones[bit]
        am, bm = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0])
        twice = a0 == b0  # the pair of a node with itself: its crossed children are one pair
        nexts = [
            (a0, am, b0, bm, cost), (am, a1, bm, b1, cost), (a0, am, bm, b1, cost + 1),
            tuple(x[~twice] for x in (am, a1, b0, bm, cost + 1)),
        ]
        joined = [np.concatenate(x) for x in zip(*nexts)]
        keep = (joined[1] > joined[0]) & (joined[3] > joined[2]) & (joined[4] <= budget)
        keep &= ~((joined[0] == joined[2]) & (joined[1] - joined[0] < 2))
        stack.append((bit - 1, *(x[keep] for x in joined)))


def spans(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose sizes sum to about ``most``."""
    end, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(end, (end[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the groups of each pair; ``label`` always points to a smaller or equal index."""
    while len(i):
        a, b = label[i], label[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def near_pairs(classes: DataFrame, budget: int = BUDGET, hot: int = HOT) -> DataFrame:
    """Links (a, b) that connect the representatives ``rep`` of fingerprints ``fp`` within ``budget`` bits.

    Enough links for the groups: all links of a task are merged there, and each member is linked to one other.
    """
    cut = blocks(64, budget + 1)
    keyed = classes.select("fp", "rep", F.posexplode(F.array(*[
        F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in cut
    ])).alias("block", "value"))
    counted = keyed.groupBy("block", "value").agg(F.count("*").alias("size")).where(F.col("size") > hot).select("block", "value", F.lit(True).alias("many"))
    tagged = keyed.join(counted, ["block", "value"], "left").withColumn("many", F.coalesce("many", F.lit(False)))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            many = b["many"].to_numpy(bool)
            b = b[["block", "value", "fp", "rep"]]
            yield b[~many].assign(sub=-1, sub_value=0)
            for k, (shift, width) in enumerate(cut):
                x = b[many & (b["block"] == k).to_numpy()]
                if len(x):
                    rest = without(x["fp"].to_numpy().view(np.uint64), shift, width)
                    for i, (s, w) in enumerate(blocks(64 - width, budget + 1)):
                        yield x.assign(sub=i, sub_value=block_of(rest, s, w).astype(np.int64))

    dealt = tagged.mapInPandas(split, "block int, value long, fp long, rep long, sub int, sub_value long")
    group = ["block", "value", "sub", "sub_value"]

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in whole_groups(batches, group):
            d = d.assign(u=d["fp"].to_numpy().view(np.uint64)).sort_values([*group, "u"], kind="stable").reset_index(drop=True)
            new = (d[group] != d[group].shift()).any(axis=1).to_numpy()
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(d))
            big = ends - starts > 1
            keys, block, sub = d["u"].to_numpy(), d["block"].to_numpy(), d["sub"].to_numpy()
            label = np.arange(len(d))
            for i, j in trie_walk(keys, starts[big], ends[big], budget):
                good = first_equal(keys[i], keys[j], cut) == block[i]
                for k, (shift, width) in enumerate(cut):
                    at = good & (sub[i] >= 0) & (block[i] == k)
                    if at.any():
                        rest = blocks(64 - width, budget + 1)
                        good[at] = first_equal(without(keys[i[at]], shift, width), without(keys[j[at]], shift, width), rest) == sub[i[at]]
                merge(label, i[good], j[good])
            linked = np.flatnonzero(label != np.arange(len(d)))
            rep = d["rep"].to_numpy()
            yield pd.DataFrame({"a": rep[linked], "b": rep[label[linked]]})

    return dealt.repartition(*[F.col(c) for c in group]).sortWithinPartitions(*group).mapInPandas(join, "a long, b long")


def whole_groups(batches: Iterator[pd.DataFrame], group: list[str], rows: int = 200_000) -> Iterator[pd.DataFrame]:
    """Sorted batches as frames of about ``rows`` rows that never cut a group."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if len(b):
            held.append(b)
        if sum(map(len, held)) < rows:
            continue
        d = pd.concat(held, ignore_index=True)
        last = (d[group] == d[group].iloc[-1]).all(axis=1).to_numpy()
        cut = len(d) - int(np.argmin(last[::-1])) if not last.all() else 0
        if cut:
            yield d.iloc[:cut]
        held = [d.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def clusters(rows: DataFrame, budget: int = BUDGET, hot: int = HOT) -> DataFrame:
    """Rows (doc_id, fp, component_id) for stored rows (doc_id, fp)."""
    classes = stored(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")))
    found = components(near_pairs(classes, budget, hot))
    of = classes.join(found, classes["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return rows.join(of, "fp", "left").select("doc_id", "fp", "component_id")


def op9_simhash(spark: SparkSession, root: str) -> DataFrame:
    rows = stored(fingerprints(read(spark, root, "documents")))
    return clusters(rows).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def simhash_stage(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    """Keeps one document of each group, the one with the smallest ``doc_id``; rows without an id stay."""
    rows = stored(fingerprints(docs))
    kept = clusters(rows).where("doc_id = component_id").select(F.col("doc_id").alias("_kept"))
    once = docs.join(kept.distinct(), F.col("doc_id").cast("long") == F.col("_kept"), "left_semi")
    total, ids = rows.where("doc_id is not null").agg(F.count("*"), F.count_distinct("doc_id")).first()
    if total > ids:  # an id that occurs several times is one document
        once = once.dropDuplicates(["doc_id"])
    return once.unionByName(docs.where("doc_id is null"))
