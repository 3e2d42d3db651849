"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of character n-grams (one to three characters of a
lower-cased word with its boundaries), hashed to ``BUCKETS`` slots. The weights are trained
with follow-the-regularised-leader (proximal, per coordinate) under an elastic net, so
that most of them are exactly zero, and the softmax is calibrated by one temperature
that is fitted on part of the sample the weights have not seen.

The model is fitted on a bounded sample: at most ``PER_LANG`` documents of each
language and ``SAMPLE`` in all, those of least md5 of their id, never one with crc32(id) mod 3
= 1. Only their hashed counts reach the driver. The model (one weight for each language
and slot) is broadcast; prediction covers every row and every whole text.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is
every text if there is nothing to learn from; repeated rows are predicted each; of rows
with one id the least text is learned from; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysight.llm.common import bound_batches, columns_of, id_fold, table, text_or_empty, unused

PER_LANG, SAMPLE, EPOCHS = 800, 8000, 2
BITS = 14
BUCKETS = 1 << BITS
#: Learning rate and its offset, L1 and L2 of the elastic net.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
#: Every how many rows of the sample one is kept for calibration.
CALIBRATE = 5
UNKNOWN = "und"
#: Least calibrated probability with which the pipeline keeps a document.
KEEP_SCORE = 0.5


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def letters_of(text: str) -> np.ndarray:
    """Lower-cased code points with each run of other characters as one 0, 0 at both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    high = codes >= 0x10000
    is_letter = _letters()[np.where(high, 0, codes)]
    if high.any():
        found = np.unique(codes[high])
        is_letter |= np.isin(codes, [c for c in found.tolist() if chr(c).isalpha()])
    codes = np.concatenate([[0], np.where(is_letter, codes, 0), [0]]).astype(np.uint32)
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    keep[0] = True
    return codes[keep]


def n_grams(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Slots and counts of the hashed n-grams; None if there is no letter."""
    c = letters_of(text)
    if not c.any():
        return None
    a, b, d = c[:-2], c[1:-1], c[2:]
    one = c[c != 0] * np.uint32(2654435761)
    two = (c[:-1] * np.uint32(2246822519)) ^ (c[1:] * np.uint32(3266489917) + np.uint32(1))
    inside = b != 0
    three = ((a * np.uint32(668265263)) ^ (b * np.uint32(374761393)) + (d * np.uint32(2869860233)))[inside] * np.uint32(2654435769)
    slots = np.concatenate([one, two * np.uint32(2654435769), three]) >> np.uint32(32 - BITS)
    counts = np.bincount(slots, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at.astype(np.uint16 if BITS <= 16 else np.uint32), counts[at].astype(np.float32)


class Model:
    """Weights (languages x slots), bias, idf and temperature."""

    def __init__(self, rows: list[tuple[str, np.ndarray, np.ndarray]]):
        self.langs = sorted({r[0] for r in rows})
        if not rows:
            return
        seen = np.zeros(BUCKETS)
        for _, at, _ in rows:
            seen[at] += 1
        self.idf = (np.log((1 + len(rows)) / (1 + seen)) + 1).astype(np.float32)
        learn = [r for i, r in enumerate(rows) if i % CALIBRATE] or rows
        held = rows[::CALIBRATE]
        self._train(learn)
        self._calibrate(held)

    def features(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[at]
        return x / np.linalg.norm(x)

    def _train(self, rows: list) -> None:
        k = len(self.langs)
        z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))  # the last slot is the bias
        number = {lang: i for i, lang in enumerate(self.langs)}
        examples = [(number[lang], np.append(at.astype(np.int64), BUCKETS), np.append(self.features(at, counts), 1.0)[:, None])
                    for lang, at, counts in rows]

        def weights(zi, ni):
            return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
        for _ in range(EPOCHS):
            for y, at, x in examples:
                zi, ni = z[at], n[at]
                w = weights(zi, ni)
                logit = (x * w).sum(axis=0)
                p = np.exp(logit - logit.max())
                p /= p.sum()
                p[y] -= 1
                g = x * p
                z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
                n[at] = ni + g * g
        w = weights(z, n)
        self.weights, self.bias, self.temperature = w[:-1].astype(np.float32), w[-1], 1.0

    def logits(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.features(at, counts) @ self.weights[at] + self.bias

    def _calibrate(self, rows: list) -> None:
        """The temperature of least log loss on rows that were not learned from."""
        logit = np.array([self.logits(at, counts) for _, at, counts in rows])
        y = np.array([self.langs.index(lang) for lang, _, _ in rows])

        def loss(t: float) -> float:
            s = logit / t
            s = s - s.max(axis=1, keepdims=True)
            return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())
        self.temperature = min(np.geomspace(0.05, 20, 121), key=loss)

    def predict(self, text: str) -> tuple[str, float]:
        if not self.langs or (grams := n_grams(text)) is None:
            return UNKNOWN, 0.0
        s = self.logits(*grams) / self.temperature
        p = np.exp(s - s.max())
        best = int(np.argmax(p))
        return self.langs[best], float(p[best] / p.sum())


def fit(docs: DataFrame, per_lang: int = PER_LANG, sample: int = SAMPLE) -> Model:
    """The model of the bounded sample of (doc_id, text, lang)."""
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    in_lang = Window.partitionBy("lang").orderBy("_h", "doc_id")
    chosen = (docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (id_fold() != 1))
              .select("doc_id", "lang", order.alias("_h"))
              .withColumn("_n", F.row_number().over(in_lang)).where(F.col("_n") <= per_lang)
              .orderBy("_n", "_h", "lang").limit(sample).select("doc_id", F.col("lang").alias("_lang")).distinct())
    # at most ``sample`` rows: safe to broadcast
    found = (docs.select("doc_id", "lang", text_or_empty().alias("text")).join(
        F.broadcast(chosen.withColumnRenamed("doc_id", "_id")), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")))
        .groupBy("doc_id", "lang").agg(F.min("text").alias("text")))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            grams = [n_grams(t) for t in pdf["text"]]
            yield pd.DataFrame({"h": pdf["h"], "lang": pdf["lang"],
                                "at": [None if g is None else g[0].tobytes() for g in grams],
                                "n": [None if g is None else g[1].tobytes() for g in grams]})
    rows = (found.select(F.md5(F.concat(F.lit("order:"), F.col("doc_id").cast("string")).cast("binary")).alias("h"), "lang", "text")
            .mapInPandas(count, "h string, lang string, at binary, n binary").where("at is not null")
            .orderBy("h", "lang").toArrow().to_pylist())
    kind = np.uint16 if BITS <= 16 else np.uint32
    return Model([(r["lang"], np.frombuffer(r["at"], kind), np.frombuffer(r["n"], np.float32)) for r in rows])


def predict(text: Column, model: Model, spark: SparkSession) -> Column:
    """struct(lang, score) of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang: string, score: double>")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = shared.value
        for s in batches:
            yield pd.DataFrame([fitted.predict(t) for t in s], columns=["lang", "score"]).astype({"score": "float64"})
    return language(F.coalesce(text.cast("string"), F.lit("")))


def languages(docs: DataFrame, train: DataFrame) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``held_out`` to the documents."""
    spark = docs.sparkSession
    bound_batches(spark)
    model = fit(train)
    found = docs.withColumn("_found", predict(text_or_empty(), model, spark))
    return (found.withColumns({"lang_pred": F.col("_found.lang"), "score": F.col("_found.score"), "held_out": id_fold() == 1})
            .drop("_found"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return languages(docs.select("doc_id", "text"), docs).select("doc_id", "held_out", "lang_pred", "score")


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents whose language is told with a score of KEEP_SCORE at least."""
    spark = docs.sparkSession
    bound_batches(spark)
    model = fit(docs)
    name = unused(docs, "_found")
    found = docs.withColumn(name, predict(text_or_empty(), model, spark))
    known = (F.col(f"{name}.lang") != UNKNOWN) & (F.col(f"{name}.score") >= KEEP_SCORE)
    return found.where(known).select(*columns_of(docs))
