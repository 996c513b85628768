"""Token ids in a canonical, length-limited Huffman file format.

``tokenize`` turns texts into ids, ``write_ids`` stores them in ascending ``doc_id`` order (or that of another number), ``read_ids``
reads a folder back. The format is a folder of two tables:

* ``code``: one row per used id with its code length. Codes are canonical (sorted by length, then id), so lengths suffice.
  Lengths come from the global counts by package-merge and never exceed ``max_bits``.
* ``blocks``: independent blocks of whole documents (a longer document gets a block of its own) with their document ids and
  lengths, the coded bits, and the bit offset of every ``every``-th id. Decoding starts at all these checkpoints at once and
  looks ``max_bits`` bits up in one table, so it needs no loop over single ids and no neighbouring block.

Blocks carry their part of the range partitioning and their first position in it; the position over all files follows from
the parts' sums, one row per part.

Cases: a null text is empty; an empty text has only the end id; rows with the same ``doc_id`` are ordered by their coded ids;
equal rows are stored as often as they occur; a null ``doc_id`` sorts first; an empty table gives an empty folder
that reads back as no rows; other input columns are ignored, whatever their names.
"""

from __future__ import annotations

import contextlib
import functools
import itertools
import json
import operator
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import run_root
from .common import kept_in_worker, read, stored

BLOCK_IDS = 1 << 20
EVERY = 256
MAX_BITS = 18
#: Distinct pieces whose ids a worker keeps, and their characters; beyond either only half as many stay, of those that came more than once.
CACHE = 300_000
CACHE_CHARS = 8 << 20
#: Bytes of text that are encoded together, unless one text has more.
SLICE = 4 << 20


class Numbers(dict):
    """Numbers keys in the order in which they are first looked up, and lists the new ones."""

    def __init__(self) -> None:
        self.new: list = []

    def __missing__(self, key) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n


class Pieces:
    """Encodes texts with the tokenizers library, each distinct piece once.

    A text is cut before every space that stands between two characters other than white space, and a piece around every such
    line feed. The vocabulary's own splitting never joins across these places, so the ids of the pieces, one after another, are
    the ids of the text. Pieces of Latin letters, digits, ASCII punctuation and single line feeds go to the library's merge model,
    several at once: if no entry of the vocabulary spans two kinds of these characters, merging does not join what the splitting
    parts, and a piece begins at each id that begins with a space. Of the others, letters and a tail of punctuation are two words
    to the splitting, so these go to the merge model one by one; any other piece goes through the whole library. A text with other white space beside a space is encoded
    whole, and so is one that holds an added token of the vocabulary, such as ``<|endoftext|>``: the library takes that
    out before all else.
    """

    TAIL = ".,;:!?*$%&#()\"-/"
    #: Pieces that are merged together: more than the 256 bytes up to which the merge model keeps what it has merged.
    TOGETHER = 64
    MARKS = r"!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"  # no apostrophe: what follows it may be a word
    PLAIN = re.compile(f"[A-Za-zÀ-ÖØ-öø-ÿ0-9{MARKS}]+(?:\n[A-Za-zÀ-ÖØ-öø-ÿ0-9{MARKS}]+)*")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        # The short cut holds for byte-level vocabularies with the usual splitting into letters, digits and the rest.
        split = self.tok.pre_tokenizer
        self.direct = isinstance(split, pre_tokenizers.ByteLevel) and split.use_regex and not split.add_prefix_space and self.tok.normalizer is None
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        self.byte = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(other)}
        self.starts = kept_in_worker(f"starts of {path}", self.spaced) if self.direct else None
        self.known, self.chars, self.tails = Numbers(), 0, {}
        self.begin = self.size = self.uses = np.zeros(0, np.int64)
        self.odd, self.flat = np.zeros(0, bool), np.zeros(0, np.uint32)

    def spaced(self) -> np.ndarray | None:
        """Which ids begin with a space; None if an entry of the vocabulary spans kinds of characters that ``PLAIN`` mixes."""
        vocabulary = self.tok.get_vocab()
        space, feed, high = self.byte[32], self.byte[10], "".join(re.escape(self.byte[b]) for b in [*range(0x80, 0xC0), 0xC3])
        letter, digit, mark = f"A-Za-z{high}", "0-9", self.MARKS
        plain = re.compile(f"[{letter}{digit}{mark}{space}{feed}]+")
        spans = re.compile(f"[{letter}][{digit}{mark}]|[{digit}][{letter}{mark}]|[{mark}][{letter}{digit}]|[{letter}{digit}{mark}{feed}]{space}|[{letter}{digit}{mark}{space}]{feed}|{feed}[{letter}{digit}{mark}]")
        if any(plain.fullmatch(t) and t not in self.added for t in filter(spans.search, vocabulary)):
            return None
        out = np.zeros(max(vocabulary.values()) + 1, bool)
        out[[i for t, i in vocabulary.items() if t.startswith(space)]] = True
        return out

    def merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``PLAIN`` pieces after a space each, one after another, and their numbers."""
        ids: list[int] = []
        merge, get = self.tok.model.tokenize, operator.attrgetter("id")
        for i in range(0, len(pieces), self.TOGETHER):
            text = " " + " ".join(pieces[i : i + self.TOGETHER])
            text = text.replace(" ", self.byte[32]).replace("\n", self.byte[10]) if text.isascii() else text.encode().decode("latin-1").translate(self.byte)
            ids += map(get, merge(text))
        flat = np.array(ids, np.uint32)
        begin = np.flatnonzero(self.starts[flat])
        if len(begin) != len(pieces):
            raise RuntimeError(f"{len(pieces)} pieces have {len(begin)} beginnings")
        return flat, np.diff(begin, append=len(flat))

    def forget(self) -> None:
        """Keeps half of ``CACHE`` and ``CACHE_CHARS`` at most, of the pieces that came more than once."""
        often, pieces = np.flatnonzero((self.uses > 1) & ~self.odd), list(self.known)  # in the order of their numbers
        kept, chars, old = Numbers(), 0, []
        for k in often.tolist():
            p = pieces[k]
            n = len(p) if type(p) is str else len(p[0])
            if len(kept) < CACHE // 2 and chars + n <= CACHE_CHARS // 2:
                dict.__setitem__(kept, p, len(kept))
                chars += n
                old.append(k)
        old = np.array(old, np.int64)
        self.flat = self.gather(old)
        self.size = self.size[old]
        self.begin = np.cumsum(self.size) - self.size
        self.uses, self.odd = np.zeros(len(old), np.int64), np.zeros(len(old), bool)
        self.known, self.chars = kept, chars

    def gather(self, k: np.ndarray) -> np.ndarray:
        """The ids of pieces ``k``, one after another."""
        n = self.size[k]
        end = np.cumsum(n)
        return self.flat[np.arange(int(end[-1]) if len(end) else 0) + np.repeat(self.begin[k] - (end - n), n)]

    def learn(self, new: list) -> None:
        """Ids of new pieces, in their order: a string stands for a space and itself, a tuple for a text's first piece."""
        rows: list = [None] * len(new)
        odd, rest, joint, first = np.zeros(len(new), bool), [], [], len(self.size)
        plain = self.PLAIN.fullmatch if self.starts is not None else lambda _: None
        known, merge, byte, tails, tail_of = self.known.get, self.tok.model.tokenize, self.byte, self.tails, self.TAIL

        def part(text: str, lead: str) -> list[int] | None:
            """The ids of letters and a tail, after a space (``lead``) or not; None if the piece is of another kind."""
            base = text.rstrip(tail_of)
            if not base.isalpha():
                return None
            ids = None
            if lead and len(base) < len(text) and (k := known(base)) is not None:  # the same letters without the tail
                ids = self.flat[self.begin[k] : self.begin[k] + self.size[k]].tolist() if k < first else rows[k - first]
            if not ids:
                ids = [t.id for t in merge(lead + (base if base.isascii() else base.encode().decode("latin-1").translate(byte)))]
            if len(base) < len(text):
                tail = text[len(base) :]
                if tail not in tails:
                    tails[tail] = [t.id for t in merge(tail)]
                ids = ids + tails[tail]
            return ids

        def lines(text: str, lead: str) -> list[int] | None:
            if "\n" not in text:
                return part(text, lead)
            ids: list[int] = []
            for i, line in enumerate(text.split("\n")):
                found = part(line, lead if i == 0 else "")
                if found is None:
                    return None
                if i:
                    ids += self.feed
                ids += found
            return ids

        for n, p in enumerate(new):
            if type(p) is str and plain(p):
                joint.append(n)
                self.chars += len(p)
                continue
            text, lead = (p, "\u0120") if type(p) is str else (p[0], "")
            self.chars += len(text)
            if lead and (not text or text[0].isspace()) or text[-1:].isspace():
                odd[n], rows[n] = True, []
            elif not self.direct or (ids := lines(text, lead)) is None:
                rest.append(n)
            else:
                rows[n] = ids
        for i in range(0, len(rest), 4096):
            where = rest[i : i + 4096]
            texts = [new[n][0] if type(new[n]) is tuple else " " + new[n] for n in where]
            for n, e in zip(where, self.tok.encode_batch_fast(texts, add_special_tokens=False)):
                rows[n] = e.ids
        flat, many = self.merged([new[n] for n in joint]) if joint else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        rows = [r for r in rows if r is not None]
        order = np.concatenate([joint, np.delete(np.arange(len(new)), joint)]).astype(np.int64)  # as they stand in ``flat``
        size, begin = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        size[order] = np.concatenate([many, np.fromiter(map(len, rows), np.int64, len(rows))])
        begin[order] = len(self.flat) + np.cumsum(size[order]) - size[order]
        others = np.fromiter(itertools.chain.from_iterable(rows), np.uint32, int(size.sum()) - len(flat))
        self.flat, self.begin, self.size = np.concatenate([self.flat, flat, others]), np.concatenate([self.begin, begin]), np.concatenate([self.size, size])
        self.odd, self.uses = np.concatenate([self.odd, odd]), np.concatenate([self.uses, np.zeros(len(new), np.int64)])

    @functools.cached_property
    def feed(self) -> list[int]:
        return self.tok.encode("\n", add_special_tokens=False).ids

    def ids(self, texts) -> list[np.ndarray]:
        """The ids of each text of a list or an Arrow array without nulls."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if not len(texts):
            return []
        if len(self.known) > CACHE or self.chars > CACHE_CHARS:
            self.forget()
        cut = pc.split_pattern(texts, " ")
        first = cut.offsets.to_numpy().astype(np.int64)
        words = cut.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
        first -= first[0]
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        look = self.known.__getitem__
        k = np.fromiter(map(look, distinct), np.int64, len(distinct))[words.indices.to_numpy()]
        opening = words.indices.to_numpy()[first[:-1]].tolist()
        k[first[:-1]] = [look((distinct[i],)) for i in opening]
        if self.known.new:
            self.learn(self.known.new)
            self.known.new = []
        self.uses += np.bincount(k, minlength=len(self.uses))
        flat = self.gather(k)
        edge = np.concatenate([[0], np.cumsum(self.size[k])])[first]
        out = [flat[a:b] for a, b in zip(edge.tolist(), edge[1:].tolist())]
        # white space beside a space, or an added token: those texts go whole
        odd = np.logical_or.reduceat(self.odd[k], first[:-1])
        for x in self.added:
            odd |= pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(odd).tolist()
        found = self.tok.encode_batch_fast([texts[i].as_py() for i in whole], add_special_tokens=False) if whole else []
        for i, e in zip(whole, found):
            out[i] = np.array(e.ids, np.uint32)
        return out


def slices(batch, column: str, most: int = SLICE) -> Iterator:
    """The rows of an Arrow batch in parts of at most ``most`` bytes of a column; a larger value is a part of its own."""
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
    at = 0
    while at < batch.num_rows:
        before = int(size[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def trim() -> None:
    """Gives memory that is free in this worker back to the system, so that it doesn't hold it while it waits for other work."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = 2, bounds: list[int] = (), order: str = "doc_id") -> DataFrame:
    """Rows (doc_id, rank, part, ids): each text's ids and the end id as little-endian unsigned 32-bit integers.

    ``rank`` is the value of ``order``, a whole number, and ``part`` its range among ``bounds``; nulls are in the first.
    """
    cuts = np.array(bounds, np.int64)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = Pieces(tokenizer)
        end = np.array([end_id], "<u4")
        for b in batches:
            for c in slices(b, "text"):
                ids = enc.ids(c.column("text").fill_null(""))
                where = c.column("rank").fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
                part = np.searchsorted(cuts, where, side="left").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [c.column("doc_id"), c.column("rank"), pa.array(part), pa.array([np.concatenate([x, end]).astype("<u4").tobytes() for x in ids], pa.binary())],
                    names=["doc_id", "rank", "part", "ids"],
                )
        del enc
        trim()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(order).cast("long").alias("rank"), "text")
    return rows.mapInArrow(run, "doc_id long, rank long, part int, ids binary")


def code_lengths(counts: dict[int, int], max_bits: int) -> dict[int, int]:
    """Optimal code lengths of at most ``max_bits`` bits, by package-merge over the vocabulary's counts."""
    ids = sorted(counts, key=lambda i: (counts[i], i))
    if len(ids) < 2:
        return {i: 1 for i in ids}
    if len(ids) > 1 << max_bits:
        raise ValueError(f"{len(ids)} ids do not fit codes of {max_bits} bits")
    w = np.array([counts[i] for i in ids], np.int64)
    # Level by level only how many leaves lie among the chosen items is needed: keep which items of a level are leaves.
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(max_bits):
        merged = np.concatenate([w, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order < len(w))
        merged = merged[order]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    lengths = np.zeros(len(ids), np.int64)
    take = 2 * (len(ids) - 1)
    for leaf in reversed(levels):
        n = int(leaf[:take].sum())
        lengths[:n] += 1
        take = 2 * (take - n)
    return {i: int(x) for i, x in zip(ids, lengths)}


def canonical(lengths: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, lengths and codes in canonical order."""
    order = sorted(lengths, key=lambda i: (lengths[i], i))
    size = np.array([lengths[i] for i in order], np.int64)
    code, codes, last = 0, [], int(size[0]) if len(size) else 0
    for n in size.tolist():
        code <<= n - last
        last = n
        codes.append(code)
        code += 1
    return np.array(order, np.int64), size, np.array(codes, np.uint64)


def pack_all(ids: np.ndarray, sizes: np.ndarray, table: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Coded bits of several documents, most significant first, each from a whole byte on; ``sizes`` has their numbers of ids.

    ``table`` has code * 64 + length of each id. Returns the bytes, each document's first byte and number of bits, and the bit offset
    of every id in its document.
    """
    found = table[ids]
    n = (found & np.uint64(63)).astype(np.int64)
    end = np.cumsum(n)
    upto = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(sizes)])]
    total = np.diff(upto)
    begin = np.cumsum((total + 7) // 8) - (total + 7) // 8
    local = end - n - np.repeat(upto[:-1], sizes)
    start = local + np.repeat(8 * begin, sizes)
    out = np.zeros((int(start[-1] + n[-1]) if len(ids) else 0) // 64 + 2, np.uint64)
    word, bit = start >> 6, start & 63
    room = 64 - bit - n  # bits left in the word after the code; negative if it goes on in the next
    code = found >> np.uint64(6)
    over = np.flatnonzero(room < 0)  # at most one code crosses into each word
    here = code << (room & 63).astype(np.uint64)
    here[over] = code[over] >> (-room[over]).astype(np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    if len(first):
        out[word[first]] |= np.bitwise_or.reduceat(here, first)
    out[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
    return out.astype(">u8").tobytes(), begin, total, local


def pack(ids: np.ndarray, table: np.ndarray) -> tuple[bytes, np.ndarray, int]:
    """Coded bits of one document, the bit offset of every id, and the number of bits."""
    bits, _, total, local = pack_all(ids, np.array([len(ids)]), table)
    return bits[: (int(total[0]) + 7) // 8], local, int(total[0])


def unpack_lanes(bits: bytes, marks: np.ndarray, lanes: np.ndarray, max_bits: int, table: np.ndarray) -> np.ndarray:
    """The ids behind checkpoints ``marks``, ``lanes[i]`` from the i-th on, one after another. ``table`` has id * 64 + length.

    All checkpoints advance together, one id each a step; the longest stand first, so those that are done drop off the end.
    """
    raw = np.frombuffer(bits + b"\0" * (16 - len(bits) % 8), ">u8").astype(np.uint64)
    order = np.argsort(-lanes, kind="stable")
    left, at = lanes[order], marks.astype(np.int64)[order]
    place = (np.cumsum(lanes) - lanes)[order]
    out = np.empty(int(lanes.sum()), np.uint32)
    mask, last = np.uint64((1 << max_bits) - 1), len(raw) - 2
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k, side="left"))  # those with more than k ids
        w, b = np.minimum(at[:n] >> 6, last), (at[:n] & 63).astype(np.uint64)
        window = (raw[w] << b) | ((raw[w + 1] >> np.uint64(1)) >> (np.uint64(63) - b))
        found = table[(window >> np.uint64(64 - max_bits)) & mask]
        out[place[:n] + k] = found >> 6
        at[:n] += found & 63
    return out


def unpack(bits: bytes, count: int, marks: np.ndarray, every: int, max_bits: int, table: np.ndarray) -> np.ndarray:
    """The ``count`` ids of one document with a checkpoint at every ``every``-th."""
    lanes = np.clip(count - every * np.arange(len(marks)), 0, every)
    return unpack_lanes(bits, marks, lanes, max_bits, table)


def write_ids(tokens: DataFrame, folder: str, max_bits: int = MAX_BITS, block_ids: int = BLOCK_IDS, every: int = EVERY) -> None:
    """Writes rows (doc_id, rank, part, ids) into ``folder`` in ascending order of rank. Parts must be ascending ranges of it.

    Runs three jobs: the counts of ids (bounded by the vocabulary), the code table, the blocks. Each document is coded
    before the shuffle, so that only coded bits move.
    """
    spark = tokens.sparkSession

    def tally(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(1, np.int64)
        for b in batches:
            for part in slices(b, "ids"):
                c = np.bincount(np.frombuffer(b"".join(part.column("ids").to_pylist()), "<u4"))
                if len(c) > len(total):
                    total = np.pad(total, (0, len(c) - len(total)))
                total[: len(c)] += c
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    counts = {r["id"]: r["n"] for r in tokens.select("ids").mapInArrow(tally, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator()}
    lengths = code_lengths(counts, max_bits)
    spark.createDataFrame([(i, n) for i, n in sorted(lengths.items())], "id long, bits int").write.parquet(f"{folder}/code")
    order, size, code = canonical(lengths)
    table = np.zeros(int(order.max(initial=0)) + 1, np.uint64)
    table[order] = (code << np.uint64(6)) | size.astype(np.uint64)
    shared = spark.sparkContext.broadcast(table)  # bounded by the vocabulary

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = shared.value
        for b in batches:
            for part in slices(b, "ids", 1 << 20):
                raw = part.column("ids").to_pylist()
                sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
                bits, begin, total, local = pack_all(np.frombuffer(b"".join(raw), "<u4"), sizes, table)
                lanes = -(-sizes // every)
                nth = np.arange(len(local)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                marks, edge = local[nth % every == 0].astype("<i8").tobytes(), 8 * np.concatenate([[0], np.cumsum(lanes)])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("rank"), part.column("part"), pa.array(sizes), pa.array(total),
                        pa.array([bits[a : a + (t + 7) // 8] for a, t in zip(begin.tolist(), total.tolist())], pa.binary()),
                        pa.array([marks[a:z] for a, z in zip(edge.tolist(), edge[1:].tolist())], pa.binary()),
                        pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                    ],
                    names=["doc_id", "rank", "part", "n", "n_bits", "bits", "marks", "crc"],
                )

    coded = tokens.mapInArrow(encode, "doc_id long, rank long, part int, n long, n_bits long, bits binary, marks binary, crc long")
    ordered = coded.repartition(F.col("part")).sortWithinPartitions("part", "rank", "crc", "bits")

    def assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, first, docs, held = None, 0, [], 0

        def block():
            marks, at = [], 0
            for d in docs:
                marks.append(np.frombuffer(d[4], "<i8") + at)
                at += 8 * len(d[3])
            return pd.DataFrame([{
                "part": part, "first": first,
                "docs": np.array([-1 if d[0] is None else d[0] for d in docs], "<i8").tobytes(),
                "nulls": np.packbits([d[0] is None for d in docs]).tobytes(),
                "sizes": np.array([d[1] for d in docs], "<i8").tobytes(),
                "marks": np.concatenate(marks).astype("<i8").tobytes(), "bits": b"".join(d[3] for d in docs), "n": held,
            }])

        for b in batches:
            for doc_id, p, n, n_bits, bits, marks in zip(b["doc_id"], b["part"], b["n"], b["n_bits"], b["bits"], b["marks"]):
                if docs and (p != part or held + n > block_ids):
                    yield block()
                    first, docs, held = (first + held if p == part else 0), [], 0
                if p != part:
                    part, first = p, 0
                docs.append((None if pd.isna(doc_id) else int(doc_id), int(n), int(n_bits), bits, marks))
                held += int(n)
        if docs:
            yield block()

    blocks = ordered.mapInPandas(assemble, "part int, first long, docs binary, nulls binary, sizes binary, marks binary, bits binary, n long")
    blocks.write.option("compression", "none").parquet(f"{folder}/blocks")
    spark.createDataFrame([(json.dumps({"max_bits": max_bits, "every": every}),)], "about string").write.parquet(f"{folder}/about")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of a folder; ``start`` counts the ids of all documents before."""
    about = json.loads(spark.read.parquet(f"{folder}/about").first()["about"])
    lengths = {r["id"]: r["bits"] for r in spark.read.parquet(f"{folder}/code").toLocalIterator()}
    max_bits, every = about["max_bits"], about["every"]
    shared = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.parquet(f"{folder}/blocks")
    sums = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n").alias("n")).toLocalIterator()}
    starts, at = {}, 0
    for p in sorted(sums):
        starts[p], at = at, at + sums[p]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order, size, code = canonical(shared.value)
        table = np.ones(1 << max_bits, np.int64)
        for i, n, c in zip(order.tolist(), size.tolist(), code.tolist()):
            a = c << (max_bits - n)
            table[a : a + (1 << (max_bits - n))] = i * 64 + n
        for b in batches:
            for part, first, docs, nulls, sizes, marks, bits in zip(*(b[c] for c in ("part", "first", "docs", "nulls", "sizes", "marks", "bits"))):
                docs, sizes, marks = np.frombuffer(docs, "<i8"), np.frombuffer(sizes, "<i8"), np.frombuffer(marks, "<i8")
                many = -(-sizes // every)  # checkpoints of each document; the last one is short
                nth = np.arange(len(marks)) - np.repeat(np.cumsum(many) - many, many)
                flat = unpack_lanes(bits, marks, np.minimum(np.repeat(sizes, many) - every * nth, every), max_bits, table)
                begin = np.cumsum(sizes) - sizes
                at = starts[part] + first + np.cumsum(sizes) - sizes
                yield pd.DataFrame({
                    "doc_id": pd.arrays.IntegerArray(docs.copy(), np.unpackbits(np.frombuffer(nulls, np.uint8), count=len(docs)).astype(bool)),
                    "start": at, "n_tokens": sizes,
                    "ids": [flat[s : s + n].astype("<u4").tobytes() for s, n in zip(begin.tolist(), sizes.tolist())],
                })

    return blocks.drop("n").mapInPandas(decode, "doc_id long, start long, n_tokens long, ids binary")


def range_bounds(docs: DataFrame, parts: int, order: str = "doc_id") -> list[int]:
    """Upper bounds that deal ``order`` into ascending ranges of about equal numbers of rows; reads that column alone."""
    if parts < 2:
        return []
    cuts = docs.select(F.col(order).cast("double").alias("d")).approxQuantile("d", [i / parts for i in range(1, parts)], 0.2 / parts)
    return sorted({int(c) for c in cuts})


def token_file(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 2, order: str = "doc_id") -> DataFrame:
    """Tokenizes, writes the file format in ascending ``order``, reads it back: rows (doc_id, start, n_tokens, ids)."""
    spark = docs.sparkSession
    folder = folder or f"{run_root(spark)}/token_ids/{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tokens = stored(tokenize(docs, tokenizer, end_id, range_bounds(docs, parts, order), order))
    write_ids(tokens, folder)
    return read_ids(spark, folder)


def with_place(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with the place of each row in its table's files, and that column's name; ``doc_id`` if it is no table of files.

    A range-sorted table is written in the order of its files, so the place has that order: the file's number and the row in it.
    """
    name = "_place"
    while name in docs.columns:
        name = "_" + name
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
    place = F.when(number != "", number.cast("long") * F.lit(1 << 40) + F.col("_metadata.row_index"))
    try:
        return docs.withColumn(name, place), name
    except AnalysisException:
        return docs, "doc_id"


def digest(rows: DataFrame) -> DataFrame:
    """Per document the unsigned CRC-32 of its ids as little-endian 32-bit integers."""
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_token_ids(spark: SparkSession, root: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    return digest(token_file(read(spark, root, "documents"), tokenizer or public_tokenizers.path("byte_bpe_50k.json")))


def token_stage(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    """Last stage of the pipeline: every row of ``docs`` as token ids, read back from the file format.

    The stage before writes its mix sorted by training position; the ids are written in that order.
    """
    import public_tokenizers

    rows, order = with_place(docs)
    return token_file(rows, public_tokenizers.path("byte_bpe_50k.json"), order=order).select("doc_id", "start", "n_tokens", "ids")
