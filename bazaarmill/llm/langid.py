"""Language identification with error-correcting output codes.

Each language gets a codeword of bits. For each bit a binary classifier over letter n-grams tells the languages with that bit
from those without. A text is decoded to the codeword with the least loss, each bit's loss weighted by the classifier's
margin; if a second codeword's loss is close, the text is flagged as ambiguous.

``learn`` fits the classifiers on a bounded sample: about ``per_language`` labelled texts of each language, chosen by a hash of
``doc_id``, so reruns agree. A bit's weight of an n-gram is the log-odds of its mean frequency in the two sets of languages; each
language counts alike, however many texts it has. The model is ``grams`` times bits numbers, small enough to send to all tasks.
Language values are codes, so few; the model grows with their number and with nothing else.

Cases: a text that is null or has no letter is ``und`` with score 0; if no language can be learned, all are; one learned
language is always chosen; ties of loss go to the smaller value; equal rows get equal predictions; an empty table gives no rows;
very long texts are read whole, in pieces; other columns are never read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import fold, read, utf8

GRAMS = 1 << 15
PER_LANGUAGE = 4_000
#: Margins are per n-gram; this many n-grams' worth of evidence saturates a bit.
SHARPNESS = 12.0
#: Share of the score that a second codeword must stay under.
CLOSE = 0.4
LETTERS = re.compile(r"[^\W\d_]+")
#: Signs such as ½, ② and Ⅷ are no letters, though ``\w`` has them.
NUMERALS = {c: " " for c in range(0x110000) if unicodedata.category(chr(c)) in ("No", "Nl")}
SIGNS = frozenset(map(chr, NUMERALS))


def grams(text: str | None) -> np.ndarray:
    """Numbers below ``GRAMS`` of the byte trigrams of the lower-cased letter runs; empty without letters."""
    if text and not text.isascii() and not SIGNS.isdisjoint(text):
        text = text.translate(NUMERALS)
    runs = LETTERS.findall(text.lower()) if text else []
    if not runs:
        return np.zeros(0, np.int64)
    b = np.frombuffer(utf8(" " + " ".join(runs) + " "), np.uint8).astype(np.uint32)
    h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
    return ((h * np.uint32(0x27D4EB2F)) >> np.uint32(17)).astype(np.int64)


def codewords(n: int) -> np.ndarray:
    """n rows of +1 and -1. Up to six languages all distinct splits; beyond, the best of seeded random codes."""
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 6:
        bits = np.arange(1, 1 << (n - 1))
        rows = [np.ones(len(bits), np.int64)] + [1 - 2 * (bits >> k & 1) for k in range(n - 1)]
        return np.array(rows, np.int8)
    width, rng, best, far = max(15, int(np.ceil(10 * np.log2(n)))), np.random.default_rng(7), None, -1
    for _ in range(50):
        code = np.where(rng.random((n, width)) < 0.5, 1, -1).astype(np.int8)
        if (np.abs(code.sum(0)) == n).any():
            continue
        agree = code.astype(np.int32) @ code.T
        least = int((width - agree[~np.eye(n, dtype=bool)].max()) // 2)
        if least > far:
            best, far = code, least
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weight: np.ndarray  # grams x bits

    def losses(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Loss of each text for each language, and which texts have letters."""
        margin = np.zeros((len(texts), self.code.shape[1]))
        seen = np.zeros(len(texts), bool)
        for i, t in enumerate(texts):
            g = grams(t)
            seen[i] = len(g) > 0
            for k in range(0, len(g), 1 << 17):
                margin[i] += self.weight[g[k : k + (1 << 17)]].sum(0, dtype=np.float64)
            margin[i] /= max(1, len(g))
        z = SHARPNESS * margin[:, None, :] * self.code[None]
        return np.logaddexp(0, -z).sum(2), seen

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        n = len(self.languages)
        if not n:
            return pd.DataFrame({"lang_pred": ["und"] * len(texts), "score": 0.0, "ambiguous": False})
        loss, seen = self.losses(texts)
        p = np.exp(loss.min(1, keepdims=True) - loss)
        p /= p.sum(1, keepdims=True)
        best = loss.argmin(1)
        score = p[np.arange(len(p)), best]
        second = np.sort(p, axis=1)[:, -2] if n > 1 else np.zeros(len(p))
        return pd.DataFrame({
            "lang_pred": [self.languages[b] if s else "und" for b, s in zip(best, seen)],
            "score": np.where(seen, score, 0.0), "ambiguous": seen & (second >= CLOSE),
        })


def learn(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fits the model on rows (doc_id, text, lang) with a language."""
    spark = labelled.sparkSession
    labelled = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, 1), np.int8), np.zeros((GRAMS, 1), np.float32))
    share = spark.createDataFrame([(k, min(1.0, per_language / sizes[k])) for k in languages], "lang string, share double")
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) / 1_000_003.0
    sample = labelled.join(F.broadcast(share), "lang").where(draw < F.col("share"))  # one row for each language

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                g = grams(text)
                if len(g):
                    total.setdefault(lang, np.zeros(GRAMS))
                    u, n = np.unique(g, return_counts=True)
                    total[lang][u] += n / max(1.0, len(g) / 1000)  # a very long text counts like one of 1000 n-grams
        for lang, t in total.items():
            u = np.flatnonzero(t)
            yield pd.DataFrame({"lang": lang, "gram": u, "n": t[u]})

    counted = sample.select("lang", "text").mapInPandas(count, "lang string, gram int, n double")
    rows = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    freq = np.zeros((len(languages), GRAMS))
    freq[[languages.index(x) for x in rows["lang"]], rows["gram"]] = rows["n"]
    freq = (freq + 0.5) / (freq + 0.5).sum(1, keepdims=True)
    code = codewords(len(languages))
    weight = np.zeros((GRAMS, code.shape[1]), np.float32)
    for k in range(code.shape[1]):
        plus, minus = freq[code[:, k] > 0], freq[code[:, k] < 0]
        if len(plus) and len(minus):
            weight[:, k] = np.log(plus.mean(0)) - np.log(minus.mean(0))
    return Model(languages, code, weight)


def predictor(spark: SparkSession, model: Model):
    """A column over the text: struct(lang_pred, score, ambiguous)."""
    shared = spark.sparkContext.broadcast((model.languages, model.code, model.weight))  # plain data: workers have no package to load a class from

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predicted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        here = Model(*shared.value)
        for b in texts:
            yield here.predict(list(b))

    return predicted("text")


def training(docs: DataFrame) -> DataFrame:
    return docs.where(fold("doc_id", 4) != 2)


def op3_language_id(spark: SparkSession, root: str) -> DataFrame:
    docs = read(spark, root, "documents")
    column = predictor(spark, learn(training(docs)))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), column.alias("p"))
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "p.lang_pred", "p.score", "p.ambiguous")


def language_stage(spark: SparkSession, docs: DataFrame, root: str) -> DataFrame:
    """Drops the documents without a language: no letters, or two languages that fit about alike."""
    name = "_language"
    while name in docs.columns:
        name = "_" + name
    found = docs.withColumn(name, predictor(spark, learn(training(docs))))
    return found.where((F.col(name)["lang_pred"] != "und") & ~F.col(name)["ambiguous"]).select(*[f"`{c}`" for c in docs.columns])
