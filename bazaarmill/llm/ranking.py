"""Text quality by Bradley-Terry pairwise ranking.

A document's quality is a linear score of its features. The model learns from preference pairs (a text marked 1 is preferred to a text
marked 0): the chance that one is preferred is the logistic function of the difference of scores, so the loss of a pair is the logistic
loss of its difference of features. Scores have no zero of their own; a threshold turns them into decisions: the quantile of the
labelled scores below which the labelled share of 0 lies, each label weighed by its count among all labelled rows.

Features look at form, not at words, so they hold in any language: frequencies of pairs of neighbouring byte classes (letters by case,
digits, white space, each ASCII punctuation mark, other bytes), shares of repeated words and lines, distinct words per 100 words,
word lengths. They are taken over whole texts, in pieces of bounded size.

``fit`` learns from every labelled document, and each marked 1 is compared with each marked 0. Features are stored once, sparse, some
thousand documents a row. A step of the descent reads them twice: first the scores are counted in cells of width ``CELL``, which
gives the loss of all pairs and the pull of all opponents on a score; then each document adds its pull to the gradient. Within
a cell scores stand at their mean and the pull is interpolated, which is off by less than ``CELL ** 2 / 8``. The loss
is strictly convex, so its minimum is one model. The threshold is the exact quantile of all labelled scores, found by narrowing
intervals. The driver holds the model (about 1,500 numbers), cells and interval counts, whose numbers don't follow the rows.

Cases: a null text is empty, and an empty text has features and a score like any other; a label other than 0 or 1, or null, is not
learned from; a document marked both ways counts for both; repeated rows of a document are learned once, the smallest text; with
only one label every score is the smoothed share of 1; without labels 0.5; equal texts get equal scores; an empty table gives no rows;
other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.guards import may_contain
from .common import fold, read, stored, utf8

PAIRS = 8
PENALTY = 1e-3
#: The descent ends when the gradient is this short, or after so many steps.
SHORT, STEPS = 1e-4, 200
CELL = 1 / 64
#: Scores beyond are counted at the edge. With the penalty no minimum comes near: texts have features of length 4 at most.
EDGE = 256.0
#: Documents whose features are stored as one row.
CHUNK = 4_096
#: Intervals of the scores that are counted at once, and rows that are few enough to be looked at one by one.
INTERVALS, FEW = 4_096, 4_096
#: The score at the threshold: a document is predicted 1 from here on.
CUT = 0.3
PIECE = 1 << 20


def byte_classes() -> np.ndarray:
    """0 lower case, 1 upper case, 2 digit, 3 line feed, 4 other white space and controls, 5 bytes beyond ASCII, then each other ASCII byte."""
    out = np.full(256, 4, np.int64)
    out[128:] = 5
    other = 6
    for b in range(33, 127):
        c = chr(b)
        if c.islower():
            out[b] = 0
        elif c.isupper():
            out[b] = 1
        elif c.isdigit():
            out[b] = 2
        else:
            out[b], other = other, other + 1
    out[10] = 3
    return out


CLASSES = byte_classes()
SIDE = int(CLASSES.max()) + 1
STATS = 9
WIDTH = SIDE * SIDE + STATS


def features(text: str | None) -> np.ndarray:
    """The square roots of the frequencies of class pairs, then ``STATS`` shares between 0 and about 1."""
    b = utf8(text)
    pairs = np.zeros(SIDE * SIDE)
    last = 4
    for start in range(0, len(b), PIECE):
        c = CLASSES[np.frombuffer(b, np.uint8, min(PIECE, len(b) - start), start)]
        pairs += np.bincount(np.concatenate([[last], c[:-1]]) * SIDE + c, minlength=SIDE * SIDE)
        last = c[-1]
    words = b.split()
    lines = [x for x in b.split(b"\n") if x.strip()]
    n = max(1, len(words))
    blocks = [len(set(words[i : i + 100])) / len(words[i : i + 100]) for i in range(0, len(words), 100)]
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    stats = [
        sum(a == c for a, c in zip(words, words[1:])) / n,
        sum(a == c for a, c in zip(words, words[2:])) / n,
        float(np.mean(blocks)) if blocks else 0.0,
        len(set(words)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        min(1.0, lengths.mean() / 20),
        min(1.0, lengths.std() / 20),
        min(1.0, np.log1p(len(words)) / 12),
        float(not words),
    ]
    return np.concatenate([np.sqrt(pairs / max(1, len(b))), stats]).astype(np.float32)


def preference_pairs(better: int, worse: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of preferred and other documents: every document of the larger side is in ``PAIRS`` pairs, with spread opponents.

    For comparisons in small groups; ``fit`` takes all pairs.
    """
    n = PAIRS * max(better, worse)
    r = np.arange(n)
    if better >= worse:
        return r % better, (r % better + r // better * max(1, worse // PAIRS) + r // better) % worse
    return (r % worse + r // worse * max(1, better // PAIRS) + r // worse) % better, r % worse


def packed(marks: list[int], rows: list[np.ndarray], number: int = 0) -> dict:
    """Documents' features as one row: marks, numbers of features that are not 0, their places and values."""
    at = [np.flatnonzero(f) for f in rows]
    return {
        "chunk": number, "n0": marks.count(0), "n1": marks.count(1), "marks": np.array(marks, np.int8).tobytes(), "sizes": np.array([len(x) for x in at], "<i4").tobytes(),
        "at": np.concatenate(at).astype("<u2").tobytes(), "value": np.concatenate([f[x] for f, x in zip(rows, at)]).astype("<f4").tobytes(),
    }


PACKED = "chunk long, n0 long, n1 long, marks binary, sizes binary, at binary, value binary"


class Chunk:
    """Features of some documents, opened."""

    def __init__(self, row):
        self.marks, sizes = np.frombuffer(row["marks"], np.int8), np.frombuffer(row["sizes"], "<i4")
        self.of = np.repeat(np.arange(len(sizes)), sizes)
        self.at = np.frombuffer(row["at"], "<u2").astype(np.int64)
        self.value = np.frombuffer(row["value"], "<f4").astype(np.float64)

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, self.value * w[self.at], len(self.marks))

    def cells(self, w: np.ndarray) -> np.ndarray:
        """Per mark and occupied cell: mark, cell, documents, sum of scores."""
        s = np.clip(self.scores(w), -EDGE, EDGE)
        key = np.floor(s / CELL).astype(np.int64) * 2 + self.marks
        u, back = np.unique(key, return_inverse=True)
        return np.stack([u & 1, u >> 1, np.bincount(back, minlength=len(u)), np.bincount(back, s, len(u))], 1).astype(np.float64)

    def gradient(self, w: np.ndarray, pulls: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        s = np.clip(self.scores(w), -EDGE, EDGE)
        pull = np.where(self.marks == 1, np.interp(s, *pulls[1]), np.interp(s, *pulls[0]))
        return np.bincount(self.at, self.value * pull[self.of], len(w))


def merged(cells: np.ndarray) -> np.ndarray:
    """Cells added up, in ascending order of mark and cell."""
    u, back = np.unique(cells[:, 0] * 2**32 + cells[:, 1], return_inverse=True)
    first = np.unique(back, return_index=True)[1]
    return np.stack([cells[first, 0], cells[first, 1], np.bincount(back, cells[:, 2], len(u)), np.bincount(back, cells[:, 3], len(u))], 1)


def contest(cells: np.ndarray) -> tuple[float, list[tuple[np.ndarray, np.ndarray]]]:
    """The mean loss over all pairs, and per mark points of the scores with the loss's slope for one document there."""
    cell, n, mean = ([x[cells[:, 0] == m] for m in (0, 1)] for x in (cells[:, 1], cells[:, 2], cells[:, 3] / cells[:, 2]))
    n0, n1 = n[0].sum(), n[1].sum()
    loss = sum(float(k * (np.logaddexp(0, mean[0] - s) @ n[0])) for s, k in zip(mean[1].tolist(), n[1].tolist())) / (n0 * n1)

    def lost(points: np.ndarray, other: int, sign: int) -> np.ndarray:
        """The mean chance that a score loses against those of the other mark."""
        return np.array([(1 / (1 + np.exp(np.clip(sign * (x - mean[other]), -40, 40)))) @ n[other] for x in points.tolist()]) / n[other].sum()

    points = [np.union1d(c, c + 1) * CELL for c in cell]
    return loss, [(points[0], lost(points[0], 1, -1) / n0), (points[1], -lost(points[1], 0, 1) / n1)]


def descend(loss_and_slope, width: int) -> np.ndarray:
    """The minimum of a convex function from 0 on, by L-BFGS with halved steps."""
    w = np.zeros(width)
    loss, g = loss_and_slope(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        if np.linalg.norm(g) <= SHORT:
            break
        d, used = -g, []
        for s, y in reversed(past):
            a = (s @ d) / (s @ y)
            d = d - a * y
            used.append(a)
        if past:
            s, y = past[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y), a in zip(past, reversed(used)):
            d = d + (a - (y @ d) / (s @ y)) * s
        step = 1.0
        while step > 1e-4:
            new_loss, new_g = loss_and_slope(w + step * d)
            if new_loss <= loss + 1e-4 * step * (g @ d) + CELL**2 / 256:  # cells blur the loss
                break
            step /= 2
        else:
            break
        if step * d @ (new_g - g) > 0:
            past = [*past[-9:], (step * d, new_g - g)]
        w, loss, g = w + step * d, new_loss, new_g
    return w


def rank_weights(better: np.ndarray, worse: np.ndarray) -> np.ndarray:
    """Weights that minimise the mean logistic loss of all pairs' score differences, with a small penalty, of documents in memory."""
    c = Chunk(packed([1] * len(better) + [0] * len(worse), [*better, *worse]))
    return descend(lambda w: penalised(w, merged(c.cells(w)), lambda pulls: c.gradient(w, pulls)), better.shape[1])


def penalised(w: np.ndarray, cells: np.ndarray, gradient) -> tuple[float, np.ndarray]:
    loss, pulls = contest(cells)
    return loss + PENALTY / 2 * float(w @ w), gradient(pulls) + PENALTY * w


def quantile_cut(scores: np.ndarray, weights: np.ndarray, share: float) -> float:
    """The score below which ``share`` of the weight lies, halfway to the next score."""
    order = np.argsort(scores, kind="stable")
    below = np.cumsum(weights[order]) / weights.sum()
    k = min(int(np.searchsorted(below, share - 1e-9)), len(scores) - 2)
    return float(scores[order][k] + scores[order][k + 1]) / 2


def stored_features(texts: DataFrame) -> DataFrame:
    """The features of rows (doc_id, mark, text), sparse, ``CHUNK`` documents a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number, marks, rows = TaskContext.get().partitionId() << 32, [], []
        for b in batches:
            for mark, text in zip(b["mark"].tolist(), b["text"]):
                marks.append(mark)
                rows.append(features(text))
                if len(rows) == CHUNK:
                    yield pd.DataFrame([packed(marks, rows, number)])
                    number, marks, rows = number + 1, [], []
        if rows:
            yield pd.DataFrame([packed(marks, rows, number)])

    return stored(texts.sortWithinPartitions("doc_id", "mark").mapInPandas(run, PACKED))


def added(chunks: DataFrame, each, add) -> list:
    """What ``each`` gives of the chunks, put together by ``add`` in every task; the tasks' arrays in the order of their first chunks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, out = None, None
        for b in batches:
            for row in b.to_dict("records"):
                x = each(Chunk(row))
                first, out = (row["chunk"], x) if out is None else (first, add(out, x))
        if out is not None:
            yield pd.DataFrame([{"first": first, "sum": out.tobytes()}])

    rows = chunks.mapInPandas(run, "first long, sum binary").collect()  # a row a task, as long as the model or the occupied cells
    return [np.frombuffer(r["sum"]) for r in sorted(rows, key=lambda r: r["first"])]


def threshold(scored: DataFrame, weight: tuple[float, float], share: float) -> float:
    """``quantile_cut`` of rows (mark, s), each mark with its weight, without gathering them: intervals with the place are cut again."""
    total = scored.groupBy("mark").agg(F.count("*").alias("n")).collect()
    total = sum(weight[r["mark"]] * r["n"] for r in total)
    lo, hi, n = scored.agg(F.min("s"), F.max("s"), F.count("*")).first()
    below, above, before, after = 0.0, 0.0, [], []  # the weight on both sides of the interval, and the score next to it
    while n > FEW and lo < hi:
        inside = scored.where(F.col("s").between(lo, hi))
        spot = F.least(F.floor((F.col("s") - lo) / (hi - lo) * INTERVALS), F.lit(INTERVALS - 1)).cast("int")
        parts = inside.groupBy(spot.alias("spot")).agg(F.count("*").alias("n"), F.sum("mark").alias("ones"), F.min("s").alias("lo"), F.max("s").alias("hi")).orderBy("spot").collect()
        w = np.array([weight[0] * (r["n"] - r["ones"]) + weight[1] * r["ones"] for r in parts])
        k = min(int(np.searchsorted((below + np.cumsum(w)) / total, share - 1e-9)), len(parts) - 1)
        before, after = [parts[k - 1]["hi"]] if k else before, [parts[k + 1]["lo"]] if k + 1 < len(parts) else after
        below, above = below + float(w[:k].sum()), above + float(w[k + 1 :].sum())
        lo, hi, n = parts[k]["lo"], parts[k]["hi"], parts[k]["n"]
    rows = scored.where(F.col("s").between(lo, hi)).groupBy("s", "mark").agg(F.count("*").alias("n")).collect()  # FEW, or one score
    values, weights = [*before], [below] * len(before)
    for r in sorted(rows, key=lambda r: (r["s"], r["mark"])):  # equal rows count as one and the last of them
        values += [r["s"]] * min(r["n"], 2)
        weights += [weight[r["mark"]] * (r["n"] - 1)] * (r["n"] > 1) + [weight[r["mark"]]]
    return quantile_cut(np.array(values + after), np.array(weights + [above] * len(after)), share)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[str, np.ndarray, float]:
    """(kind, weights, threshold) from all labelled rows: kind ``ranked``, or ``constant`` with the score in place of the threshold."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("mark")).where("mark in (0, 1) and doc_id is not null").distinct()
    counts = {r["mark"]: r["n"] for r in marked.groupBy("mark").agg(F.count("*").alias("n")).collect()}
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2) if counts else 0.5
    if len(counts) < 2:
        return "constant", np.zeros(WIDTH), share
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # only texts whose id may be labelled are shuffled, by a bitmap of bounded size; the join decides
    texts = may_contain(texts, ["doc_id"], marked.select(F.col("doc_id").alias("k0")).distinct())
    chunks = stored_features(texts.join(marked.hint("merge"), "doc_id").groupBy("doc_id", "mark").agg(F.min("text").alias("text")))
    found = chunks.agg(F.sum("n0"), F.sum("n1")).first()
    if not found[0] or not found[1]:
        return "constant", np.zeros(WIDTH), share

    def loss_and_slope(w: np.ndarray) -> tuple[float, np.ndarray]:
        cells = added(chunks, lambda c: c.cells(w), lambda a, b: merged(np.concatenate([a, b])))
        return penalised(w, merged(np.concatenate([x.reshape(-1, 4) for x in cells])), lambda pulls: sum(added(chunks, lambda c: c.gradient(w, pulls), np.add)))

    w = descend(loss_and_slope, WIDTH)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.to_dict("records"):
                c = Chunk(row)
                yield pd.DataFrame({"mark": c.marks.astype(np.int32), "s": c.scores(w)})

    each = stored(chunks.mapInPandas(scored, "mark int, s double"))
    return "ranked", w, threshold(each, (counts[0] / found[0], counts[1] / found[1]), counts[0] / (counts[0] + counts[1]))


def scorer(spark: SparkSession, model: tuple[str, np.ndarray, float]):
    """A column over the text: the score between 0 and 1, ``CUT`` at the threshold."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kind, w, cut = shared.value
        at_cut = float(np.log(CUT / (1 - CUT)))
        for b in texts:
            if kind == "constant":
                yield pd.Series(np.full(len(b), cut))
            else:
                s = Chunk(packed([0] * len(b), [features(t) for t in b])).scores(w) if len(b) else np.zeros(0)
                yield pd.Series(1 / (1 + np.exp(-np.clip(s - cut + at_cut, -40, 40))))

    return scored("text")


def training(labels: DataFrame) -> DataFrame:
    return labels.where(fold("doc_id", 5) != 0)


def op12_quality(spark: SparkSession, root: str) -> DataFrame:
    docs = read(spark, root, "documents")
    model = fit(docs, training(read(spark, root, "labels")))
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scorer(spark, model).alias("score"))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
