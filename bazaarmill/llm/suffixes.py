"""Exact removal of repeated byte strings with suffix arrays by linear grouping.

A byte goes if it lies in a ``LENGTH``-byte string that also starts earlier: in a document with a smaller id, or earlier in the
same document. Strings are judged on the input.

``suffix_array`` sorts suffixes in two phases. The first keeps groups of suffixes with a common Lyndon prefix and
processes them from the highest down: each suffix of the group points to the nearest one before it in a lower group, and the
suffixes pointed to leave their group for a new one right above, the higher the more pointers meet there. The second emits
the order: from the smallest suffix on, the suffix before a placed one, and those along its pointers, take the first free places
of their groups. No ranks are renamed and nothing is sorted twice.

To sort only what can repeat, each string is represented by the smallest hash among its ``ANCHOR``-byte substrings: equal
strings have equal anchors. Neighbouring strings with one anchor make a run. Documents come in blocks; a block asks, by range of
the hash, which of its anchors occur elsewhere too (as packed keys, not as rows). The bytes of runs with a repeated anchor, equal ones of
a block as one, meet at their anchor and are cut to the part that can repeat. There the suffixes of all different runs are sorted together; equal neighbours in
that order are one string, and all places but the first are reported to their block. A run whose anchor occurs more than
``HOT`` times, or in a run of more than ``LONG`` strings anywhere, is cut into its single strings, each with its own hash, so that a phrase that stands in a third of all documents does
not gather their surroundings in one task.

Documents that equal an earlier one are found first, by two hashes over the whole text, and are removed whole.

Cases: a null or empty text has no bytes; a text shorter than ``LENGTH`` loses nothing; rows with one ``doc_id`` count as places in one
document, so equal rows are judged alike, by smaller ids and by earlier starts; a null id is smaller than all others; an empty
table gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import read, stored, utf8
from .katz import packed, packed_keys, unpacked, unpacked_keys
from .simhash import whole_groups

LENGTH = 100
ANCHOR = 48
HOT = 20_000
#: In the place of a count, for an anchor with a long run.
MANY = 2**32 - 1
#: Strings in one run beyond which its anchor is treated as one that occurs too often: periodic text.
LONG = 2_000
BLOCK_BYTES = 12_000_000
#: Bytes of runs whose suffixes are sorted together.
BATCH = 100_000
NULL = -(1 << 63)


def suffix_array(s: list[int]) -> list[int]:
    """The starts of all suffixes of ``s`` in ascending order; a suffix is greater than its own prefixes."""
    n = len(s)
    symbols = sorted(set(s))
    number = {c: k for k, c in enumerate(symbols)}
    group = [number[c] for c in s]
    members: list = [set() for _ in symbols]
    for i, g in enumerate(group):
        members[g].add(i)
    higher = [k + 1 for k in range(len(symbols))]
    lower = [k - 1 for k in range(len(symbols))]
    if symbols:
        higher[-1] = -1
    before = [-1] * n
    done = bytearray(n)
    g = len(symbols) - 1
    while g >= 0:
        met: dict[int, int] = {}
        for i in sorted(members[g]):
            j = i - 1
            while j >= 0 and done[j]:
                j = before[j]
            before[i] = j
            done[i] = 1
            if j >= 0:
                met[j] = met.get(j, 0) + 1
        for i in [j for j in met if done[j]]:
            del met[i]
        if len(met) == 1:
            ((j, _),) = met.items()
            moves = {(group[j], 1): [j]}
        else:
            moves = {}
            for j, k in met.items():
                moves.setdefault((group[j], k), []).append(j)
        for h, k in sorted(moves, key=lambda x: -x[1]) if len(moves) > 1 else moves:
            left, moved = members[h], moves[h, k]
            if len(moved) == len(left):
                # all that was left of the group moves: it keeps its place below those that moved before
                continue
            new = len(members)
            left.difference_update(moved)
            members.append(set(moved))
            for j in moved:
                group[j] = new
            above = higher[h]
            higher.append(above)
            lower.append(h)
            higher[h] = new
            if above >= 0:
                lower[above] = new
        g = lower[g]
    first = [0] * len(members)
    at, g = 0, 0
    while g >= 0 and symbols:
        first[g] = at
        at += len(members[g])
        g = higher[g]
    out = [-1] * n
    placed = bytearray(n)
    j = n - 1
    for k in range(-1, n):
        if k >= 0:
            j = out[k] - 1
        while j >= 0 and not placed[j]:
            placed[j] = 1
            h = group[j]
            free = first[h]
            out[free] = j
            first[h] = free + 1
            j = before[j]
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def substring_hashes(b: bytes, size: int) -> np.ndarray:
    """A hash of each substring of ``size`` bytes, by doubling."""
    h = np.frombuffer(b, np.uint8).astype(np.uint64) + np.uint64(1)
    done = 1
    while done < size:
        step = min(done, size - done)
        h = h[: len(h) - step] * np.uint64(0x9E3779B97F4A7C15) + h[step:] * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        done += step
    return mixed(h)


def slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = pick(x[: len(x) - step], x[step:])
        done += step
    return x


def runs_of(b: bytes, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings of ``length`` bytes with one anchor: the anchors, first and last starts, and if the anchor may stand in a
    run more than once. The fifth result has the hash of every place that is an anchor."""
    if len(b) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.uint64)
    h, width = substring_hashes(b, anchor), length - anchor + 1
    least = slide(h, width, np.minimum)
    start = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    rim = np.zeros(width - 1, np.uint64)
    places = h[slide(np.concatenate([rim, least, rim]), width, np.maximum) == h]
    again = np.unique(places[1:][places[1:] == places[:-1]])
    key = least[start]
    return key, start, np.append(start[1:], len(least)) - 1, np.isin(key, again) if len(again) else np.zeros(len(key), bool), places


class Texts:
    """The documents of a block."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, data: bytes):
        self.ids, self.sizes, self.data = ids, sizes, data
        self.edge = np.concatenate([[0], np.cumsum(sizes)]).tolist()

    @classmethod
    def of(cls, rows: list[tuple[int, bytes]]) -> Texts:
        return cls(np.array([i for i, _ in rows], np.int64), np.array([len(b) for _, b in rows], np.int64), b"".join(b for _, b in rows))

    def pack(self) -> bytes:
        return pickle.dumps((self.ids, self.sizes, len(self.data), packed(np.frombuffer(self.data, np.uint8))))

    @classmethod
    def unpack(cls, raw: bytes) -> Texts:
        ids, sizes, _, data = pickle.loads(raw)
        return cls(ids, sizes, unpacked(data, np.uint8).tobytes())

    def text(self, k: int) -> bytes:
        return self.data[self.edge[k] : self.edge[k + 1]]

    def runs(self, length: int, anchor: int) -> tuple[np.ndarray, ...]:
        """(document, anchor, first start, last start, more than once) of all runs, and the hashes of all anchor places."""
        found = [runs_of(self.text(k), length, anchor) for k in range(len(self.ids))]
        which = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        return which, *(np.concatenate([f[c] for f in found]) for c in range(5))


def text_blocks(docs: DataFrame, emit, schema: str) -> DataFrame:
    """``emit(number, texts)`` of each block. A block is part of one input partition, and cut alike each time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number, rows, held = TaskContext.get().partitionId() << 32, [], 0
        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"]):
                rows.append((NULL if pd.isna(doc_id) else int(doc_id), utf8(text)))
                held += len(rows[-1][1]) + 16
                if held >= BLOCK_BYTES:
                    yield from emit(number, Texts.of(rows))
                    number, rows, held = number + 1, [], 0
        if rows:
            yield from emit(number, Texts.of(rows))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, schema)


def same_strings(contexts: list[bytes], spans: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, offset, string) of all strings of ``length`` bytes of the contexts; equal strings share a number.

    Context k has ``spans[k]`` strings, starting at its first bytes. Equal strings are neighbours in the suffix order.
    """
    text = b"".join(c + b"\0" for c in contexts)
    symbols = np.frombuffer(text, np.uint8).astype(np.int64) + 1
    edge = np.cumsum([len(c) + 1 for c in contexts])
    symbols[edge - 1] = 0  # ends are smaller than all bytes
    order = np.array(suffix_array(symbols.tolist()), np.int64)
    owner = np.searchsorted(edge, order, side="right")
    offset = order - np.concatenate([[0], edge])[owner]
    real = offset < np.array(spans)[owner]
    order, owner, offset = order[real], owner[real], offset[real]
    windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), length)
    new = np.ones(len(order), bool)
    for lo in range(1, len(order), 1 << 16):
        hi = min(len(order), lo + (1 << 16))
        new[lo:hi] = (windows[order[lo:hi]] != windows[order[lo - 1 : hi - 1]]).any(axis=1)
    return owner, offset, np.cumsum(new) - 1


def trimmed(groups: pd.DataFrame, length: int) -> Iterator[tuple[bool, list[list]]]:
    """Per anchor its different runs, each with its (block, document, id, start) places, cut to what can repeat.

    A string whose hash no other place here has is unique, for equal strings share their anchor. A run is cut to the part
    from its first to its last string that is not; runs without one are left out.
    """
    own_twice = set(groups.loc[groups["twice"], "anchor"])
    runs: dict[tuple[int, bytes], int] = {}
    run = np.array([runs.setdefault(key, len(runs)) for key in zip(groups["anchor"], groups["bytes"])], np.int64)
    counts = np.fromiter(map(len, groups["places"]), np.int64, len(groups)) // 24
    where = np.frombuffer(b"".join(groups["places"]), "<i8").reshape(-1, 3)
    where = np.column_stack([np.repeat(groups["block"].to_numpy(), counts), where])
    run_of = np.repeat(run, counts)
    where = where[np.argsort(run_of, kind="stable")]
    copies = np.bincount(run_of, minlength=len(runs))
    upto = np.cumsum(copies)
    names = list(runs)
    sizes = np.array([len(data) for _, data in names], np.int64)
    spans = sizes - length + 1
    edge = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), spans)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(spans) - spans, spans)
    h = substring_hashes(b"".join(data for _, data in names), length)[edge[owner] + offset]
    _, back = np.unique(h, return_inverse=True)
    again = np.flatnonzero(np.bincount(back, copies[owner])[back] > 1)
    first = np.full(len(sizes), -1)
    last = np.full(len(sizes), -1)
    first[owner[again][::-1]] = offset[again][::-1]
    last[owner[again]] = offset[again]
    out: dict[int, dict[bytes, list[np.ndarray]]] = {}
    for k in np.flatnonzero(first >= 0).tolist():
        anchor, data = names[k]
        moved = where[upto[k] - copies[k] : upto[k]].copy()
        moved[:, 3] += first[k]
        out.setdefault(anchor, {}).setdefault(data[first[k] : last[k] + length], []).append(moved)
    for anchor, own in out.items():
        yield anchor in own_twice, [[data, np.concatenate(p)] for data, p in own.items()]


def repeated_places(groups: pd.DataFrame, length: int) -> Iterator[pd.DataFrame]:
    """Starts of strings that occur earlier too, for whole groups of runs with one anchor; rows (block, places)."""
    found: dict[int, list[np.ndarray]] = {}
    batch: list[list] = []  # per different run: its bytes, and (block, document, id, start) of its places
    held = 0

    def report(place: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        for block in np.unique(place[:, 0]):
            k = place[:, 0] == block
            found.setdefault(int(block), []).append(np.stack([place[k, 1], first[k], last[k]], axis=1))

    def flush() -> None:
        nonlocal batch, held
        if batch:
            owner, offset, string = same_strings([b[0] for b in batch], [len(b[0]) - length + 1 for b in batch], length)
            copies = np.array([len(b[1]) for b in batch])
            place = np.concatenate([b[1] for b in batch])
            at = np.cumsum(copies) - copies
            rep = copies[owner]
            row = np.repeat(at[owner], rep) + np.arange(rep.sum()) - np.repeat(np.cumsum(rep) - rep, rep)
            start, string = place[row, 3] + np.repeat(offset, rep), np.repeat(string, rep)
            rank = np.lexsort((start, place[row, 2], string))
            again = np.concatenate([[False], string[rank][1:] == string[rank][:-1]])
            # places equal in id and start are one place
            head = rank[np.maximum.accumulate(np.where(again, 0, np.arange(len(rank))))]
            again &= (place[row, 2][rank] != place[row, 2][head]) | (start[rank] != start[head])
            gone = rank[again]
            order = gone[np.lexsort((start[gone], row[gone]))]
            if len(order):
                cut = np.concatenate([[True], (row[order][1:] != row[order][:-1]) | (start[order][1:] != start[order][:-1] + 1)])
                a = np.flatnonzero(cut)
                z = np.append(a[1:], len(order)) - 1
                report(place[row[order][a]], start[order][a], start[order][z])
        batch, held = [], 0

    for twice, own in trimmed(groups, length):
        if len(own) == 1 and not twice:  # one run of different strings: their order is known
            data, place = own[0]
            rank = np.lexsort((place[:, 3], place[:, 2]))
            place = place[rank]
            late = place[(place[:, 2] != place[0, 2]) | (place[:, 3] != place[0, 3])]
            if len(late):
                report(late, late[:, 3], late[:, 3] + len(data) - length)
            continue
        batch += own
        held += sum(len(b[0]) for b in own)
        if held >= BATCH:
            flush()
    flush()
    for block, parts in found.items():
        yield pd.DataFrame({"block": [block], "places": [np.concatenate(parts).astype("<i8").tobytes()]})


def asked(n: np.ndarray, is_long: np.ndarray) -> np.ndarray:
    """How often a block has each anchor; ``MANY`` for those with a long run."""
    return np.where(is_long, MANY, np.minimum(n, MANY - 1)).astype(np.uint32)


def anchor_kinds(counts: np.ndarray, back: np.ndarray, size: int, hot: int) -> np.ndarray:
    """For each block's anchor 0 if it occurs once in all, 2 if more than ``hot`` times or in a long run, else 1."""
    total = np.bincount(back, counts, size)
    total[back[counts == MANY]] = hot + 1
    return ((total > 1).astype(np.uint8) + (total > hot))[back]


def repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256): spans are the removed byte ranges [start, end)."""
    spark = docs.sparkSession
    bits = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length())

    def state(number: int, t: Texts) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"block": [number], "state": [t.pack()]})

    def names(number: int, t: Texts) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_128_digest

        d = [xxh3_128_digest(t.text(k)) for k in range(len(t.ids))]
        yield pd.DataFrame({"block": number, "nth": np.arange(len(d)), "id": t.ids, "one": [int.from_bytes(x[:8], "little", signed=True) for x in d], "two": [int.from_bytes(x[8:], "little", signed=True) for x in d], "size": t.sizes})

    named = text_blocks(docs, names, "block long, nth int, id long, one long, two long, size long").where(F.col("size") >= length)
    named = stored(named)
    key = ["one", "two", "size"]
    firsts = named.groupBy(*key).agg(F.min("id").alias("first"))
    copies = named.join(firsts, key).where("id > first").groupBy("block").agg(F.collect_list("nth").alias("copies"))  # at most a block's documents

    def ask(number: int, t: Texts) -> Iterator[pd.DataFrame]:
        _, h, first, last, _, places = t.runs(length, anchor)
        u, n = np.unique(places, return_counts=True)
        n = asked(n, np.isin(u, h[last - first >= LONG]))
        edge = np.searchsorted(u >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).tolist()
        rows = [(r, number, packed_keys(u[a:b]), packed(n[a:b])) for r, (a, b) in enumerate(zip(edge, edge[1:])) if b > a]
        yield pd.DataFrame(rows, columns=["part", "block", "keys", "counts"])

    def answer(d: pd.DataFrame) -> pd.DataFrame:
        keys = [unpacked_keys(k) for k in d["keys"]]
        u, back = np.unique(np.concatenate(keys), return_inverse=True)
        kind = anchor_kinds(np.concatenate([unpacked(c, np.uint32) for c in d["counts"]]), back, len(u), hot)
        rows, at = [], 0
        for block, k in zip(d["block"], keys):
            rows.append((int(d["part"].iloc[0]), block, packed(kind[at : at + len(k)])))
            at += len(k)
        return pd.DataFrame(rows, columns=["part", "block", "kinds"])

    asks = text_blocks(docs, ask, "part int, block long, keys binary, counts binary")
    answers = stored(asks.groupBy("part").applyInPandas(answer, "part int, block long, kinds binary"))
    known = answers.select("block", "part", "kinds", F.lit(None).cast("array<int>").alias("copies")).unionByName(
        stored(copies).select("block", F.lit(-1).alias("part"), F.lit(None).cast("binary").alias("kinds"), "copies")
    )
    blocks = text_blocks(docs, state, "block long, state binary")

    def contexts(d: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        columns = ["anchor", "block", "bytes", "places", "twice"]
        if not len(d):
            raise RuntimeError("answers for a block that is no more: its documents changed between steps")
        t, number = Texts.unpack(d["state"].iloc[0]), int(d["block"].iloc[0])
        which, h, first, last, twice, _ = t.runs(length, anchor)
        u, back = np.unique(h, return_inverse=True)
        got = a[a["part"] >= 0].sort_values("part")
        kind = np.concatenate([unpacked(k, np.uint8) for k in got["kinds"]]) if len(got) else np.zeros(0, np.uint8)
        if len(kind) != len(u):
            raise RuntimeError(f"a block has {len(u)} anchors and {len(kind)} answers: its documents changed between steps")
        copy = np.zeros(len(t.ids), bool)
        for c in a[a["part"] < 0]["copies"]:
            copy[np.asarray(c, np.int64)] = True
        rows: dict[tuple, list] = {}
        use = np.flatnonzero((kind[back] > 0) & ~copy[which])
        for k, w, f, z, own in zip(use.tolist(), which[use].tolist(), first[use].tolist(), last[use].tolist(), twice[use].tolist()):
            base = t.edge[w]
            if kind[back[k]] == 1:
                rows.setdefault((int(h[k].view(np.int64)), t.data[base + f : base + z + length], own), []).append((w, int(t.ids[w]), f))
            else:
                for p in range(f, z + 1):
                    string = t.data[base + p : base + p + length]
                    name = int.from_bytes(hashlib.blake2b(string, digest_size=8).digest(), "little", signed=True)
                    rows.setdefault((name, string, False), []).append((w, int(t.ids[w]), p))
        return pd.DataFrame([(k, number, b, struct.pack(f"<{3 * len(p)}q", *itertools.chain.from_iterable(p)), own) for (k, b, own), p in rows.items()], columns=columns)

    runs = blocks.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(contexts, "anchor long, block long, bytes binary, places binary, twice boolean")

    def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in whole_groups(batches, ["anchor"], 20_000):
            yield from repeated_places(d, length)

    places = stored(runs.repartition(F.col("anchor")).sortWithinPartitions("anchor").mapInPandas(resolve, "block long, places binary"))
    marks = places.select("block", "places", F.lit(None).cast("array<int>").alias("copies")).unionByName(
        known.where("part < 0").select("block", F.lit(None).cast("binary").alias("places"), "copies")
    )

    def cut(d: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        t = Texts.unpack(d["state"].iloc[0])
        parts = [np.frombuffer(p, "<i8").reshape(-1, 3) for p in m["places"] if p is not None]
        all_of = np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)
        all_of = all_of[np.lexsort((all_of[:, 1], all_of[:, 0]))]
        edge = np.searchsorted(all_of[:, 0], np.arange(len(t.ids) + 1))
        copy = {int(x) for c in m["copies"] if c is not None for x in c}
        rows = []
        for k in range(len(t.ids)):
            b = t.text(k)
            if k in copy:
                spans = [(0, len(b))]
            else:
                spans = []
                for _, a, z in all_of[edge[k] : edge[k + 1]].tolist():
                    if spans and a <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], max(spans[-1][1], z + length))
                    else:
                        spans.append((a, z + length))
            sha, at = hashlib.sha256(), 0
            for a, z in spans:
                sha.update(b[at:a])
                at = z
            sha.update(b[at:])
            rows.append((None if t.ids[k] == NULL else int(t.ids[k]), len(b), sum(z - a for a, z in spans), len(spans), [x for s in spans for x in s], sha.hexdigest()))
        out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])
        return out.astype({"doc_id": "Int64"})

    return blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInPandas(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<long>, kept_sha256 string"
    )


def op10_suffix_dedup(spark: SparkSession, root: str) -> DataFrame:
    return repeats(read(spark, root, "documents")).drop("spans")
