"""Benchmark decontamination with one Aho-Corasick automaton over the test items.

Items and documents are normalised alike: A-Z lower-cased, then the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, so
digits, letters and all characters beyond ASCII. The patterns are all windows of ``window`` consecutive item words; a shorter
item is one pattern. The automaton works on words as numbers, with all words that no item has as one: it reads each
document's words once and reports every occurrence of every pattern. Hits are marked on words, and words know their place in
the original text.

Benchmarks are small by nature, but that is checked: items with more than ``most_words`` words in all are split into blocks
by their id's hash, each with an automaton of its own. Blocks come to the driver and to the workers one at a time: the documents
are written once with a number for each, scanned once for each block, and the hits of a scan, which few documents have, are
stored as word ranges. A document's ranges of all blocks are united. A worker builds the automaton of a block once and
keeps it for its next tasks; at ``MOST_WORDS`` it holds about 190 MB.

Cases: a null or empty text has no words, is not contaminated and matches nothing; equal items or windows count once for each
item id; windows of items with a null id hit, but name no item; rows are judged alone, so repeated documents give equal rows;
with an empty benchmark nothing is hit; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import kept_in_worker, read, stored, utf8

WINDOW = 10
MOST_WORDS = 200_000

#: Bytes that stand outside words become spaces, A-Z become a-z; bytes of characters beyond ASCII stay.
TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256)
)
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def item_words(text: str | None) -> list[bytes]:
    return utf8(text).translate(TABLE).split()


class Automaton:
    """Patterns of the item words of one block."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        import ahocorasick

        self.ids: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item_id, text in items:
            w = [self.ids.setdefault(x, len(self.ids) + 1) for x in item_words(text)]
            for i in range(max(1, len(w) - window + 1) if w else 0):
                found = owners.setdefault(tuple(w[i : i + window]), set())
                if item_id is not None:
                    found.add(item_id)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, who in owners.items():
            self.machine.add_word(key, (len(key), tuple(sorted(who))))
        self.machine.make_automaton()
        self.empty = not owners

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit word ranges, united and ascending, and the ids of the items that occur."""
        if self.empty or not words:
            return [], set()
        get = self.ids.get
        ranges: list[list[int]] = []
        who: set = set()
        for end, (size, items) in self.machine.iter(tuple([get(w, 0) for w in words])):
            who.update(items)
            start = end - size + 1
            while ranges and ranges[-1][1] >= start:  # ends ascend, so only the last ranges can touch
                start = min(start, ranges.pop()[0])
            ranges.append([start, end + 1])
        return [(a, b) for a, b in ranges], who


def unite(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of word ranges."""
    place = [m.span() for m in WORD.finditer(text)]
    return [(place[a][0], place[b - 1][1]) for a, b in ranges]


Items = list[tuple[int | None, str | None]]


def item_blocks(benchmark: DataFrame, most_words: int) -> tuple[int, Iterator[Items]]:
    """The number of blocks of about ``most_words`` words, and their items, one block on the driver at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    total = items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    n = max(1, -(-int(total) // most_words))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return n, ([(r["item_id"], r["text"]) for r in items.where(block == k).distinct().collect()] for k in range(n))


def scanner(spark: SparkSession, items: Items, window: int) -> Column:
    """A column over the text: struct(n_words, ranges, items) under one block's automaton."""
    shared, key = spark.sparkContext.broadcast(items), uuid.uuid4().hex  # bounded by most_words

    @F.pandas_udf("n_words long, ranges array<long>, items array<long>")
    def scanned(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = kept_in_worker(key, lambda: Automaton(shared.value, window))
        for b in texts:
            rows = []
            for text in b:
                w = item_words(text)
                hit, who = machine.scan(w)
                rows.append((len(w), [x for r in hit for x in r], sorted(who)))
            yield pd.DataFrame(rows, columns=["n_words", "ranges", "items"])

    return scanned("text")


def placed(text: str, ranges: str) -> Column:
    """A column: struct(n_hit, spans) of the united word ranges in a text."""

    @F.pandas_udf("n_hit long, spans array<long>")
    def found(texts: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        rows = []
        for t, flat in zip(texts, ranges):
            hit = unite([tuple(r) for r in np.reshape(flat, (-1, 2)).astype(int).tolist()])
            rows.append((sum(b - a for a, b in hit), [x for s in original_spans(t, hit) for x in s] if hit else []))
        return pd.DataFrame(rows, columns=["n_hit", "spans"])

    return found(text, ranges)


def with_hits(docs: DataFrame, benchmark: DataFrame, name: str, window: int = WINDOW, most_words: int = MOST_WORDS) -> DataFrame:
    """``docs`` and a column ``name``: struct(n_words, n_hit, items, spans); spans are character ranges of the original text.

    With one block of items the scan is a column over the text, and rows stay where they are.
    """
    spark = docs.sparkSession
    n, blocks = item_blocks(benchmark, most_words)
    if n == 1:
        found = docs.withColumn(name, scanner(spark, next(blocks), window))
    else:
        row = f"{name}_row"
        numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()))  # written, so a row keeps its number
        parts = []
        for items in blocks:
            scan = numbered.select(row, "text").withColumn(name, scanner(spark, items, window))
            parts.append(stored(scan.where(F.size(f"{name}.ranges") > 0).select(row, f"{name}.ranges", f"{name}.items")))
        hits = reduce(DataFrame.unionByName, parts).groupBy(row).agg(  # one row for each block that hits
            F.flatten(F.collect_list("ranges")).alias(f"{name}_r"), F.array_distinct(F.flatten(F.collect_list("items"))).alias(f"{name}_i")
        )
        none = F.array().cast("array<long>")
        words = scanner(spark, [], window)["n_words"]
        found = numbered.join(hits, row, "left").withColumn(
            name, F.struct(words.alias("n_words"), F.coalesce(f"{name}_r", none).alias("ranges"), F.coalesce(f"{name}_i", none).alias("items"))
        ).drop(row, f"{name}_r", f"{name}_i")
    at = f"{name}_at"
    return found.withColumn(at, placed("text", f"{name}.ranges")).withColumn(name, F.struct(
        F.col(f"{name}.n_words"), F.col(f"{at}.n_hit"), F.col(f"{name}.items"), F.col(f"{at}.spans"),
    )).drop(at)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most_words: int = MOST_WORDS) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, items, spans), one for each document."""
    found = with_hits(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, "hits", window, most_words)
    return found.select("doc_id", "hits.*")


def decontaminate_stage(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    """Drops the documents in which a benchmark window occurs; all others stay as they are."""
    name = "_hits"
    while any(c.startswith(name) for c in docs.columns):
        name = "_" + name
    return with_hits(docs, read(spark, root, "benchmark"), name).where(F.col(name)["n_hit"] == 0).select(*[f"`{c}`" for c in docs.columns])


def op4_decontaminate(spark: SparkSession, root: str) -> DataFrame:
    found = scan(read(spark, root, "documents"), read(spark, root, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
pattern AS MATERIALIZED (SELECT DISTINCT item_id, w[i : i + least({WINDOW}, len(w)) - 1] AS p
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS i FROM b WHERE len(w) > 0)),
found AS MATERIALIZED (SELECT row, item_id, i, n FROM (
    SELECT row, n, i, w[i : i + n - 1] AS q FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT len(p) AS n FROM pattern)))
  JOIN pattern ON p = q),
hit AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS place FROM found) GROUP BY row),
items AS (SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT row, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row) LEFT JOIN items USING (row)
"""
