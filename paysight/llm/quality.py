"""Quality classifier by nearest-neighbour voting in a latent semantic space.

A text is a bag of terms that say how it is written rather than what: trigrams of byte
classes (lower case, upper case, digits, space, line ends, kinds of punctuation, bytes of
other letters), words equal to the word before, words seen before in the text, new words.
Terms are weighted by TF-IDF, and a truncated SVD of labelled texts gives the latent
space. The labelled vectors are broadcast; every document is compared with all of them by
exact cosines, one matrix product for each block of documents, and the labels of its
``NEIGHBOURS`` nearest vote with their similarity as weight.

The labelled texts are a bounded sample: at most ``PER_LABEL`` rows of each label, those of
least md5 of their id. So the broadcast has a fixed bound (2 * PER_LABEL vectors of ``RANK``
numbers, and the projection of ``TERMS`` rows), whatever the corpus. Labels of rows with
crc32(id) mod 3 = 1 are never read. Scoring covers every row and every whole text.

Defined results: a null text counts as the empty one; a text without terms, or one that
is like no labelled text, gets the share of good labels in the sample as score (so does
every text if there are labels of one value only; 0.5 if there are none); a document
labelled several times counts once, as good if at least half of its labels are; labels
other than 0 and 1 or null, and labels of unknown documents, are not used; repeated rows
are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysight.llm.common import bound_batches, columns_of, id_fold, table, text_or_empty

#: Labelled rows of each label, latent dimensions, voting neighbours, documents in a block.
PER_LABEL, RANK, NEIGHBOURS, BLOCK = 1000, 24, 15, 256

_KINDS = (b"\n\r", b" \t\x0b\x0c", b"0123456789", b".", b",;:", b"!?", b"'\"-", b"|", b"#$%&*@^~<>=+/\\_{}[]()`")
N_KINDS = 12  # those, lower case, upper case, bytes of other letters; the rest counts as the last of _KINDS


def _class_table() -> np.ndarray:
    out = np.full(256, len(_KINDS) - 1, np.uint16)
    for k, chars in enumerate(_KINDS):
        out[list(chars)] = k
    out[ord("a"):ord("z") + 1], out[ord("A"):ord("Z") + 1], out[128:] = 9, 10, 11
    return out


_CLASS = _class_table()
_GRAMS = N_KINDS ** 3
#: Terms: the trigrams, and the three kinds of words.
TERMS = _GRAMS + 3


def terms(text: str) -> np.ndarray:
    """Term counts of a text, damped by log(1 + n)."""
    data = text.encode("utf-8", "replace")
    c = _CLASS[np.frombuffer(data, np.uint8)]
    out = np.zeros(TERMS, np.float32)
    if len(c) > 2:
        out[:_GRAMS] = np.bincount((c[:-2] * N_KINDS + c[1:-1]) * N_KINDS + c[2:], minlength=_GRAMS)
    words = data.split()
    if words:
        same = sum(a == b for a, b in zip(words, words[1:]))
        new = len(set(words))
        out[_GRAMS:] = same, len(words) - same - new if len(words) > same + new else 0, new
    out[_GRAMS:] *= 4  # words are fewer than trigrams
    return np.log1p(out)


class Space:
    """The fitted latent space: term weights, projection, labelled vectors and labels."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, rank: int = RANK, neighbours: int = NEIGHBOURS):
        self.neighbours = neighbours
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.trained = 0 < labels.sum() < len(labels)
        if not self.trained:
            return
        self.idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
        x = self._weighted(counts)
        values, vectors = np.linalg.eigh((x @ x.T).astype(np.float64))  # documents by documents: bounded by the sample
        top = np.argsort(values)[::-1][:rank]
        top = top[values[top] > 1e-9 * max(values.max(), 1e-30)]
        self.projection = (x.T @ (vectors[:, top] / np.sqrt(values[top]))).astype(np.float32)
        self.vectors, self.labels = self._latent(x), labels.astype(np.float32)

    def _weighted(self, counts: np.ndarray) -> np.ndarray:
        x = counts * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def _latent(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.projection
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of good labels among the nearest of each row."""
        if not self.trained:
            return np.full(len(counts), self.prior)
        cosines = self._latent(self._weighted(counts)) @ self.vectors.T
        k = min(self.neighbours, cosines.shape[1])
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64)
        total = weight.sum(axis=1)
        votes = (weight * self.labels[near]).sum(axis=1)
        return np.where((total > 0) & counts.any(axis=1), votes / np.where(total > 0, total, 1), self.prior)


def labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """label and text of the bounded sample: the rows of least md5 of each label."""
    one = (labels.where("doc_id is not null and quality in (0, 1)").where(id_fold() != 1)
           .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("_label")))
    known = one.join(docs.select(F.col("doc_id")).distinct(), "doc_id", "left_semi")
    order = Window.partitionBy("_label").orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id")
    chosen = known.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_label).select("doc_id", "_label")
    # at most 2 * per_label rows: safe to broadcast
    found = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.first("_label").alias("label"), F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Space:
    """The latent space of the labelled sample; only term counts reach the driver."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"],
                                "terms": [terms(t).tobytes() for t in pdf["text"]]})
    rows = (labelled_sample(docs, labels, per_label).mapInPandas(count, "doc_id long, label int, terms binary")
            .orderBy("doc_id").toArrow().to_pylist())
    counts = np.array([np.frombuffer(r["terms"], np.float32) for r in rows], np.float32).reshape(-1, TERMS)
    return Space(counts, np.array([r["label"] for r in rows], np.float64))


def score(text: Column, space: Space, spark: SparkSession) -> Column:
    """Score in [0, 1] of a text column; higher: label 1 is likelier."""
    shared = spark.sparkContext.broadcast(space)

    @F.pandas_udf("double")
    def voted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = shared.value
        for s in batches:
            out = [np.empty(0)]
            for i in range(0, len(s), BLOCK):
                out.append(fitted.scores(np.stack([terms(t) for t in s.iloc[i:i + BLOCK]])))
            yield pd.Series(np.concatenate(out))
    return voted(F.coalesce(text.cast("string"), F.lit("")))


def quality_scores(docs: DataFrame, train: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``score``, ``predicted`` and ``held_out`` to the documents; ``train`` has the labelled texts."""
    spark = docs.sparkSession
    bound_batches(spark)
    space = fit(train, labels)
    return (docs.withColumn("score", score(text_or_empty(), space, spark))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
            .withColumn("held_out", id_fold() == 1))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality_scores(docs, docs, labels).select("doc_id", "held_out", "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted as good, with their columns."""
    spark = docs.sparkSession
    bound_batches(spark)
    space = fit(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
    return docs.where(score(text_or_empty(), space, spark) >= 0.5).select(*columns_of(docs))
