"""Conversation prefix trie by truncation peeling.

A node is a distinct sequence of first turns. The operator descends from the deepest turn: conversations that end at a depth
meet the nodes that survive from the depth below, equal sequences are merged, the last turn is stripped and the rest is
grouped again. All of a node's figures are complete when it is found, so nodes are discovered and aggregated in one pass, and
the rows that go up are nodes, no longer conversations.

* ``keyed`` names each prefix by four running sums of hashes of (depth, turn): a prefix's name without its last turn is the
  difference, so stripping is arithmetic. Running sums and turn numbers are taken over range-partitioned segments; a
  conversation with a third of all turns is cut like the rest. Names have 128 bits.
* ``peel`` strips one turn a round up to depth ``SINGLE``. Below that a round takes a block of depths, each twice as deep as
  the next, so a conversation of n turns takes about log n rounds. In a block, each node belongs to its smallest member, whose
  nodes form the lower end of its path; a subtree is the sum over that path below it and over all paths that hang off it.
* ``digests`` hashes the sorted ids that end at a node. Ids are range-sorted and packed into rows of ``PACK`` ids, then each
  node's few packed rows pass one stream through SHA-256; no list of ids is ever held whole.

Turns are ordered by turn (null first), then role, then the SHA-256 of the text. Cases: a null role or text is empty; rows
without a ``conv_id`` belong to no conversation; repeated rows are turns of their own; a conversation without turns ends at the
root; an empty table has no nodes; other columns are never read. ``conv_id % 5`` has the sign of ``conv_id``, as in SQL.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.ordered import row_numbers, running
from ..session import partitions, run_root
from .common import read, stored

SINGLE = 8
PACK = 50_000
KEY = ["k0", "k1", "k2", "k3"]
UP = ["p0", "p1", "p2", "p3"]
FIGURES = ["n_convs", "n_children", "n_leaves", "saved"]
EMPTY = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, place, n_bytes, digest): the turns numbered from 1 in each conversation. Texts do not go further."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("any"),  # lets equal rows part into several segments
    )
    order = ["turn", "role", "digest", "any"]
    return row_numbers(rows, ["conv_id"], order, "place").select("conv_id", "place", "n_bytes", "digest")


def rebuilt(turns: DataFrame, group: int = 5, modulus: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, n_bytes, digest, last) of the rebuilt conversations, and (conv_id, n_turns) of all of them.

    The first h turns come from the conversation ``conv_id - conv_id % group``, the others from the conversation itself.
    """
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    start = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus).alias("h")
    convs = lengths.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), start)
    given = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("given"))
    taken = F.least("h", F.coalesce("given", F.lit(0)))
    convs = stored(
        convs.join(given, "base", "left").select(
            "conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns")
        )
    )
    heads = turns.where(F.col("place") < modulus).withColumnRenamed("conv_id", "base")  # a few turns of at most `group` readers
    heads = heads.join(convs.select("conv_id", "base", "h", "n_turns"), "base").where("place <= h")
    own = turns.join(convs.select("conv_id", "h", "taken", "n_turns"), "conv_id").where("place > h")

    def rows(df: DataFrame, depth: Column) -> DataFrame:
        return df.select("conv_id", depth.alias("depth"), "n_bytes", "digest", (depth == F.col("n_turns")).alias("last"))

    return rows(heads, F.col("place")).unionByName(rows(own, F.col("taken") + F.col("place") - F.col("h"))), convs.select("conv_id", "n_turns")


def keyed(turns: DataFrame) -> DataFrame:
    """Adds the prefix's name (KEY) and that of the prefix without its last turn (UP); drops the digest."""
    low = 0xFFFFFFFF
    one, two = F.xxhash64("depth", "digest"), F.xxhash64("digest", "depth", F.lit(1))
    lanes = [one.bitwiseAND(low), F.shiftrightunsigned(one, 32), two.bitwiseAND(low), F.shiftrightunsigned(two, 32)]
    rows = turns.select("conv_id", "depth", "n_bytes", "last", *[c.alias(f"t{i}") for i, c in enumerate(lanes)])
    summed = running(rows, ["conv_id"], ["depth"], {k: F.col(f"t{i}") for i, k in enumerate(KEY)})
    back = [(F.col(k) - F.col(f"t{i}")).alias(UP[i]) for i, k in enumerate(KEY)]
    return summed.select("conv_id", "depth", "n_bytes", "last", *KEY, *back)


def block_of(depth: Column) -> Column:
    """Depths to ``SINGLE`` alone, then 9 to 16, 17 to 32, 33 to 64 and so on (``SINGLE`` is 8)."""
    return F.when(depth <= SINGLE, depth).otherwise(F.length(F.bin(depth - 1)) + (SINGLE - 3)).cast("int")


def bounds(block: int) -> tuple[int, int]:
    """The depths above and at the lower end of a block."""
    return (block - 1, block) if block <= SINGLE else (SINGLE << (block - SINGLE - 1), SINGLE << (block - SINGLE))


def total(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def peel_one(carriers: DataFrame, turns: DataFrame) -> DataFrame:
    """Merges the carriers of one depth into its nodes."""
    rows = carriers.join(turns.select("conv_id", "depth", "n_bytes", *KEY, *UP), "conv_id")
    found = rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), *total(*FIGURES), *[F.min(c).alias(c) for c in ("depth", "n_bytes", *UP)]
    )
    return closed(found)


def closed(found: DataFrame) -> DataFrame:
    """A node's own part: it is a leaf if it has no child, and saves its last text for all members but one."""
    return found.withColumns({
        "n_leaves": F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves")),
        "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("n_bytes"),
    })


def peel_block(carriers: DataFrame, turns: DataFrame) -> DataFrame:
    """Merges the carriers of a block of depths into its nodes, with the figures of whole subtrees.

    ``carriers`` has one row for each conversation that still stands for others or ends here: the depth ``top`` where it enters
    and the figures it brings.
    """
    rows = stored(carriers.join(turns.select("conv_id", "depth", "n_bytes", *KEY, *UP), "conv_id").where("depth <= top"))
    enters = F.col("depth") == F.col("top")
    brought = [F.sum(F.when(enters, F.col(c)).otherwise(0)).alias(c) for c in FIGURES[1:]]
    found = rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), *total("n_convs"), *brought, *[F.min(c).alias(c) for c in ("depth", "n_bytes", *UP)]
    )
    found = stored(found)
    below = found.groupBy(*[F.col(p).alias(k) for p, k in zip(UP, KEY)]).agg(F.count("*").alias("_kids"))
    nodes = closed(
        found.join(below, KEY, "left").withColumn("n_children", F.col("n_children") + F.coalesce("_kids", F.lit(0))).drop("_kids")
    )
    sums = {"n_leaves": "_leaves", "saved": "_saved"}
    path = running(nodes.withColumn("_up", -F.col("depth")), ["conv_id"], ["_up"], {s: F.col(c) for c, s in sums.items()})
    path = stored(path)
    tails = stored(path.groupBy("conv_id").agg(F.sum("n_leaves").alias("_tl"), F.sum("saved").alias("_ts")))
    hung = rows.select("conv_id", *KEY).join(tails, "conv_id").groupBy(*KEY).agg(F.sum("_tl").alias("_hl"), F.sum("_ts").alias("_hs"))
    return (
        path.join(tails, "conv_id").join(hung, KEY)
        .withColumns({"n_leaves": F.col("_leaves") + F.col("_hl") - F.col("_tl"), "saved": F.col("_saved") + F.col("_hs") - F.col("_ts")})
        .select(*KEY, "conv_id", *FIGURES, "depth", "n_bytes", *UP)
    )


def peel(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes with KEY, UP and figures; and (conv_id, depth, KEY) of each conversation's end.

    ``turns`` are keyed turns; ``convs`` has (conv_id, n_turns) and decides which conversations end at the root.
    """
    spark = turns.sparkSession
    path = f"{run_root(spark)}/llm/trie-{uuid.uuid4().hex}"
    tagged = turns.withColumn("block", block_of(F.col("depth")))
    tagged.hint("rebalance", "block").write.partitionBy("block").parquet(path)
    filed = spark.read.schema(tagged.schema).parquet(path)
    deepest = filed.agg(F.max("block")).first()[0] or 0
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    first = [one.alias("n_convs"), *[zero.alias(c) for c in FIGURES[1:]]]
    levels: list[DataFrame] = []
    standing: DataFrame | None = None
    for block in range(deepest, 0, -1):
        low, high = bounds(block)
        here = filed.where(F.col("block") == block)
        carriers = here.where("last").select("conv_id", F.col("depth").alias("top"), *first)
        if standing is not None:
            carriers = carriers.unionByName(standing.withColumn("top", F.lit(high).cast("long")))
        nodes = stored(peel_one(carriers.drop("top"), here) if block <= SINGLE else peel_block(carriers, here))
        levels.append(nodes)
        standing = nodes.where(F.col("depth") == low + 1).select("conv_id", *[one.alias(c) if c == "n_children" else c for c in FIGURES])
    ended = convs.where("n_turns = 0").select("conv_id", *first)
    at_root = ended if standing is None else ended.unionByName(standing)
    root = at_root.agg(F.min("conv_id").alias("conv_id"), *total(*FIGURES)).where("n_convs is not null")
    root = root.select(*[zero.alias(k) for k in KEY], "*", zero.alias("depth"), zero.alias("n_bytes"), *[F.lit(None).cast("long").alias(p) for p in UP])
    nodes = reduce(DataFrame.unionByName, [*levels, closed(root)])
    ends = filed.where("last").select("conv_id", *KEY).unionByName(
        convs.where("n_turns = 0").select("conv_id", *[zero.alias(k) for k in KEY])
    )
    return nodes, ends


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins runs of ids of one node, in the order they come, into rows of at most ``PACK`` ids."""
    key, first, ids = None, None, []

    def row():
        return pa.RecordBatch.from_pydict(
            {**{k: [v] for k, v in zip(KEY, key)}, "first": [first], "ids": [",".join(map(str, ids))]},
            schema=pa.schema([(k, pa.int64()) for k in KEY] + [("first", pa.int64()), ("ids", pa.string())]),
        )

    for b in batches:
        for *k, conv in zip(*(b.column(i).to_pylist() for i in range(len(KEY) + 1))):
            if k != key or len(ids) >= PACK:
                if ids:
                    yield row()
                key, first, ids = k, conv, []
            ids.append(conv)
    if ids:
        yield row()


def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for each node over its packed rows, which come in order."""
    key, sha, done = None, None, []

    def out():
        return pa.RecordBatch.from_pydict(
            {**{k: [d[0][i] for d in done] for i, k in enumerate(KEY)}, "ends_sha256": [d[1] for d in done]},
            schema=pa.schema([(k, pa.int64()) for k in KEY] + [("ends_sha256", pa.string())]),
        )

    for b in batches:
        for *k, ids in zip(*(b.column(c).to_pylist() for c in (*KEY, "ids"))):
            if k != key:
                if sha is not None:
                    done.append((key, sha.hexdigest()))
                key, sha = k, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if len(done) > 10_000:
            yield out()
            done = []
    if sha is not None:
        done.append((key, sha.hexdigest()))
    if done:
        yield out()


def digests(ends: DataFrame) -> DataFrame:
    """(KEY, ends_sha256) of the nodes where conversations end."""
    n, long = partitions(ends.sparkSession), ", ".join(f"{k} long" for k in KEY)
    sorted_ids = ends.select(*KEY, "conv_id").repartitionByRange(n, *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    packed = sorted_ids.mapInArrow(pack, f"{long}, first long, ids string")
    return packed.repartition(n, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(stream, f"{long}, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each node of the trie over turns (conv_id, depth, n_bytes, digest, last) and conversations (conv_id, n_turns)."""
    nodes, ends = peel(keyed(turns), convs)
    nodes = stored(nodes)
    parents = nodes.select(*[F.col(k).alias(p) for k, p in zip(KEY, UP)], F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(parents, UP, "left").join(digests(ends), KEY, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )


def op11_prefix_trie(spark: SparkSession, root: str) -> DataFrame:
    return trie(*rebuilt(turns_of(read(spark, root, "conversations"))))


#: CRC-32 of a decimal number's digits, bit by bit, as SQL has no function for it.
_CRC = """xor(4294967295, list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
    lambda crc, d: list_reduce([xor(crc, d)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, count(*) AS own FROM t GROUP BY conv_id),
c AS (SELECT l.conv_id, l.conv_id - l.conv_id % 5 AS base, h, least(h, coalesce(b.own, 0)) AS taken
  FROM (SELECT conv_id, {_CRC} % 9 AS h FROM l) l LEFT JOIN l b ON b.conv_id = l.conv_id - l.conv_id % 5),
r AS (SELECT c.conv_id, place AS depth, role, text FROM c JOIN t ON t.conv_id = c.base AND place <= h
  UNION ALL SELECT c.conv_id, taken + place - h, role, text FROM c JOIN t USING (conv_id) WHERE place > h),
p AS (SELECT c.conv_id, coalesce(turns, []) AS turns FROM c LEFT JOIN (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY depth) AS turns FROM r GROUP BY conv_id) q ON q.conv_id = c.conv_id),
e AS (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM p),
n AS (SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN len(turns) = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256,
    coalesce(max(strlen(turns[depth].text)), 0) AS n_bytes
  FROM e GROUP BY depth, turns[1:depth]),
k AS (SELECT n.*, (SELECT count(*) FROM n b WHERE b.depth = n.depth + 1 AND b.path[1:n.depth] = n.path) AS n_children,
    (SELECT min(a.conv_id) FROM n a WHERE a.depth = n.depth - 1 AND n.path[1:n.depth - 1] = a.path) AS parent_conv_id FROM n)
SELECT a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, count(*) FILTER (b.n_children = 0) AS n_leaves,
  sum((b.n_convs - 1) * b.n_bytes)::BIGINT AS saved_tokens, a.ends_sha256
FROM k a JOIN k b ON b.depth >= a.depth AND b.path[1:a.depth] = a.path
GROUP BY a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, a.ends_sha256, a.path
"""
