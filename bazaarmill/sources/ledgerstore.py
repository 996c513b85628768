"""A ledger that is continued: postings arrive in batches, and only what they touch is folded again.

Three tables, one folder per batch (generation): ``nets`` has the net change per entity and day, ``folds`` the closing balances and
corrections of each day that was folded, ``heads`` the first day that the batch touched of each entity. A batch folds its entities from
that day on, starting at the balances of the day before; entities that it does not touch are not folded. Rows of an older generation
hold up to the first day that a later one touched. Nothing is changed in place: heads are renamed into place last, so a
batch that broke off is not seen, and is filled again by the next try. A batch id that is known is passed over.

One writer at a time. Daily nets add up, so a late posting is one more row of its day.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..functions.money import TOTAL
from ..operators import ledger
from . import storage


class LedgerStore:
    def __init__(self, spark: SparkSession, path: str, entity: dict[str, str], accounts: Sequence[str] = ledger.ACCOUNTS, chain=ledger.CHAIN):
        """``entity``: its columns and their types."""
        self.spark, self.path, self.accounts, self.chain = spark, path, list(accounts), list(chain)
        self.entity = list(entity)
        keys = ", ".join(f"{c} {t}" for c, t in entity.items())
        sums = ", ".join(f"{a} {TOTAL}" for a in accounts)
        fixes = ", ".join(f"f{i} {TOTAL}" for i in range(len(self.chain)))
        self.schemas = {
            "nets": f"{keys}, day date, {sums}, gen int",
            "folds": f"{keys}, day date, {sums}, {fixes}, gen int",
            "heads": f"{keys}, from_day date, batch string, gen int",
        }

    def generations(self) -> list[int]:
        return sorted(int(m[1]) for n in storage.folders(self.spark, f"{self.path}/heads") if (m := re.fullmatch(r"gen=(\d+)", n)))

    def _table(self, name: str) -> DataFrame:
        """Rows of the batches that are done."""
        done = self.generations()
        if not done:
            return self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{name}").filter(F.col("gen").isin(done))

    def _by_entity(self, a: DataFrame, b: DataFrame):
        on = F.lit(True)
        for c in self.entity:
            on = on & a[c].eqNullSafe(b[c])
        return on

    def folds(self) -> DataFrame:
        """(entity, day, balances, f0, f1 ...): the state that holds, over all generations."""
        later = W.partitionBy(*self.entity).orderBy("gen").rowsBetween(1, W.unboundedFollowing)  # a row per batch that touched the entity
        heads = self._table("heads").select(*self.entity, "gen", F.min("from_day").over(later).alias("_until"))
        rows = self._table("folds")
        met = rows.join(heads, self._by_entity(rows, heads) & (rows["gen"] == heads["gen"]))
        return met.filter(F.col("_until").isNull() | (F.col("day") < F.col("_until"))).select(*[rows[c] for c in rows.columns if c != "gen"])

    def post(self, postings: DataFrame, batch: str) -> int | None:
        """Adds a batch of postings; returns its generation, or None if the batch is known or empty."""
        if not self._table("heads").filter(F.col("batch") == batch).isEmpty():
            return None
        gen = (self.generations() or [0])[-1] + 1
        ledger.daily_net(postings, self.entity, self.accounts).write.mode("overwrite").parquet(f"{self.path}/nets/gen={gen}")
        new = self.spark.read.schema(self.schemas["nets"]).parquet(f"{self.path}/nets").filter(F.col("gen") == gen)
        touched = new.groupBy(*self.entity).agg(F.min("day").alias("from_day"))

        before = self.folds()
        earlier = before.join(touched, self._by_entity(before, touched)).filter(F.col("day") < F.col("from_day"))
        state = earlier.groupBy(*[before[c] for c in self.entity]).agg(*[F.max_by(before[a], before["day"]).alias(f"_s_{a}") for a in self.accounts])
        nets = self._table("nets").unionByName(new)
        due = nets.join(touched, self._by_entity(nets, touched)).filter(F.col("day") >= F.col("from_day"))
        days = due.groupBy(*[nets[c] for c in self.entity], "day").agg(*[F.sum(a).cast(TOTAL).alias(a) for a in self.accounts])
        vectors = ledger.day_vectors(days, self.entity, self.accounts)
        held = vectors.join(state, self._by_entity(vectors, state), "left").select(
            *[vectors[c] for c in vectors.columns], *[F.coalesce(f"_s_{a}", F.lit(0).cast(TOTAL)).alias(f"_s_{a}") for a in self.accounts]
        )
        folded = ledger.fold_days(held, self.entity, self.accounts, self.chain, start={a: F.col(f"_s_{a}") for a in self.accounts}, every_day=True)
        folded.write.mode("overwrite").parquet(f"{self.path}/folds/gen={gen}")

        aside = f"{self.path}/_aside-{uuid.uuid4().hex}"
        touched.withColumn("batch", F.lit(batch)).write.parquet(aside)
        if self.spark.read.parquet(aside).isEmpty():
            storage.remove(self.spark, aside)
            return None
        storage.move(self.spark, aside, f"{self.path}/heads/gen={gen}")
        return gen

    def corrections(self) -> DataFrame:
        """The postings of all corrections that hold."""
        return ledger.correction_postings(self.folds(), self.entity, self.chain)

    def balances(self) -> DataFrame:
        """(entity, day, accounts): closing balances of days with postings, corrections included."""
        return self.folds().select(*self.entity, "day", *self.accounts)
