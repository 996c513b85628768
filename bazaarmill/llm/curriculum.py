"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight and a schedule, that is an intensity over the training time 0 to 1, given by knots with straight lines
between. ``targets`` shares the words of the mix by weight; no target exceeds ``most`` times its source's words, and what is
over is shared again by weight. ``assign`` takes whole documents until their source's target is met, then integrates the
source's schedule into a cumulative demand of words and inverts it: a copy gets the time at which the demand reaches the
middle of its words among the source's taken words. ``training_order`` repeats the documents and range-sorts them by that time.

A source's documents come in the order of a hash of their id, so reruns agree and the taken part is not one of position;
documents over a hundredth of their source's words are taken first, so that the one at the edge is small and each source's taken
words are within half of it from the target. Running sums are made over ranges of (source, order), so a hot source is
cut into many tasks. Sources are numbered by the same helper; nothing is gathered per source but sums.

Cases: a null or blank text has size 0 and takes no words; sources are compared by code point, and null is a source, the last;
equal rows are documents of their own, each with its own copies; a null id has a place like any other; an empty table
gives no rows; other columns are carried by ``training_order`` and ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.ordered import row_numbers, running
from .common import read, stored

WEIGHTS = (3.0, 1.0, 2.0)
#: Intensities over time, repeating like the weights: heavy sources fade out, the others come in.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (0.5, 0.5), (1.0, 2.0)), ((0.0, 0.5), (1.0, 1.5)))
SHARE = 1.5
MOST = 2.0
WORDS = "[^\\x20\\x09-\\x0D]+"


def size_of(text: str = "text"):
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """Rows (source, source_size, nth, target) for rows (source, source_size).

    Resharing ends when no further source reaches its limit: then every other has the same words per weight. Each round is
    one aggregate over the sources; the limits reached only grow.
    """
    ranked = row_numbers(sources.withColumn("_last", F.col("source").isNull()), [], ["_last", "source"], "nth")
    slot = F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1
    weighed = stored(ranked.select("source", "source_size", "nth", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), slot.cast("int")).alias("weight")))
    total, all_weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    rate, before = (share * (total or 0) / all_weight if all_weight else 0.0), -1
    while True:
        full = F.col("source_size") * most <= F.col("weight") * rate
        n, used, left = weighed.agg(
            F.count_if(full), F.sum(F.when(full, F.col("source_size") * most)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if n == before or not left:
            break
        before, rate = n, (share * total - (used or 0.0)) / left
    return weighed.select("source", "source_size", "nth", F.least(F.col("source_size") * most, F.col("weight") * rate).cast("double").alias("target"))


def time_of(share, schedule: tuple):
    """The time at which a schedule's cumulative demand reaches a share (0 to 1) of its whole."""
    parts, area = [], 0.0
    for (t0, r0), (t1, r1) in zip(schedule, schedule[1:]):
        parts.append((area, t0, r0, (r1 - r0) / (t1 - t0)))
        area += (r0 + r1) / 2 * (t1 - t0)
    out = None
    for begin, t0, r0, slope in parts:
        c = F.greatest(share * area - begin, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(r0 * r0) + 2 * slope * c, F.lit(0.0)))
        at = F.lit(t0) + F.when(c > 0, 2 * c / (F.lit(r0) + root)).otherwise(0.0)
        out = at if out is None else F.when(share * area >= begin, at).otherwise(out)
    return out


def assign(sized: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, schedules: tuple = SCHEDULES, most: float = MOST) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, copies, times) for rows (doc_id, source, size).

    ``times`` has a training time for each copy.
    """
    rows = stored(sized.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.col("size").cast("long").alias("size")))
    sums = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), share, weights, most)
    known = rows.join(sums.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    keyed = known.withColumns({"_small": F.col("size") * 100 <= F.col("source_size"), "_key": F.xxhash64("doc_id")})
    summed = running(keyed, ["source"], ["_small", "_key", "doc_id", "size"], {"_end": F.col("size")})
    middle = F.col("_end") - F.col("size") / 2
    copies = F.lit(0)
    for k in range(int(-(-most // 1))):
        copies = copies + F.when(middle + k * F.col("source_size") < F.col("target"), 1).otherwise(0)
    taken = stored(summed.select("doc_id", "source", "size", "source_size", "nth", "target", "_key", copies.alias("copies")))
    rounds = range(1, int(-(-most // 1)) + 1)
    cumulated = running(taken, ["source"], ["_key", "doc_id", "size", "copies"], {f"_end{k}": F.when(F.col("copies") >= k, F.col("size")).otherwise(F.lit(0).cast("long")) for k in rounds})
    whole = taken.groupBy(F.col("source").alias("_source")).agg(*[F.sum(F.when(F.col("copies") >= k, F.col("size")).otherwise(0)).alias(f"_all{k}") for k in rounds])
    both = cumulated.join(whole, F.col("source").eqNullSafe(F.col("_source")))
    every = sum((F.col(f"_all{k}") for k in rounds), F.lit(0))
    before, times = F.lit(0), []
    for k in rounds:
        part = F.when(every > 0, (before + F.col(f"_end{k}") - F.col("size") / 2) / every).otherwise(0.0)
        part = F.least(F.greatest(part, F.lit(0.0)), F.lit(1.0))
        slot = F.pmod(F.col("nth") - 1, F.lit(len(schedules)))
        at = None
        for i, s in enumerate(schedules):
            at = F.when(slot == i, time_of(part, s)) if at is None else at.when(slot == i, time_of(part, s))
        times.append(F.when(F.col("copies") >= k, at))
        before = before + F.col(f"_all{k}")
    return both.select("doc_id", "source", "size", "source_size", "target", "copies", F.array_compact(F.array(*times)).alias("times"))


def training_order(docs: DataFrame, **mix) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, range-sorted by training time."""
    row, at = "_row", "_time"
    while {row, at} & set(docs.columns):
        row, at = "_" + row, "_" + at
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()))  # written, so a row keeps its number
    placed = assign(numbered.select(F.col(row).alias("doc_id"), F.col("source").cast("string").alias("source"), size_of().alias("size")), **mix)
    times = stored(placed.select(F.col("doc_id").alias(row), F.explode("times").alias(at)))
    return numbered.join(times, row).repartitionByRange(at, row).sortWithinPartitions(at, row).select(*[f"`{c}`" for c in docs.columns])


def op2_curriculum(spark: SparkSession, root: str) -> DataFrame:
    docs = read(spark, root, "documents").select("doc_id", "source", size_of().alias("size"))
    placed = assign(docs)
    return placed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
        F.get("times", F.lit(0)).alias("first_time"), F.get("times", F.lit(1)).alias("second_time"),
    ).orderBy("first_time", "doc_id")


def curriculum_stage(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    """The documents as the mix takes them: some not at all, some twice, in training order."""
    return training_order(docs)
