"""Ranked lexical search by LEMP-style norm buckets.

Documents and items are vectors over the terms of the items: a document's coordinate is the
term's impact (weight times saturated frequency), an item's the number of its occurrences,
and the score is their inner product. Terms that no item has can't add to a score, so they
are left out of the vectors (but count in N, L and n).

1. Every document becomes a compact vector (term numbers and frequencies); the table is
   written once, and N, L and all document frequencies are read from it.
2. Impacts give each vector its length (Euclidean norm); vectors are written in falling
   order of length within each partition, with a bucket number (``STEPS`` buckets for each
   doubling of the length).
3. The longest buckets (at least ``HEAD`` vectors) are searched first. Their k-th best scores are
   thresholds for all items, and by Cauchy-Schwarz (score <= item length x vector length)
   vectors shorter than any item needs are not even read.
4. The other buckets are searched block by block. An item leaves out a block whose longest
   vector is too short for it (Cauchy-Schwarz). Inside a block the item's coordinates are
   ordered by the largest product each can give here; those from which on the rest can't reach
   the threshold any more (by the sum of coordinate bounds, or by Cauchy-Schwarz) are set
   aside. Only vectors on the postings of the others are candidates, and those whose partial
   score plus the bound of the rest stays below the threshold are dropped.
5. Survivors are scored exactly in 64-bit integers; each task keeps its best k for each item,
   raising its thresholds, and the lists of the tasks are merged.

All bounds are rounded up, and a vector that can tie is kept, so the result is exact.
Items are worked on in blocks of at most about ``BLOCK_ENTRIES`` (item, term) pairs; only a block is
broadcast, and a table of items of any size takes more blocks, not more memory. Documents are
never shuffled.

Defined results: null texts have no terms; rows of ``docs`` are documents of their own (repeated
rows rank side by side, ids may repeat); ties go to the smaller doc_id, rows without id last;
rows of ``items`` are searched one by one (repeated ones repeat their ranks); items without
terms or without a hit, and empty tables, give no rows; other columns, whatever their names,
are ignored; texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysight.llm.common import bound_batches, table, text_or_empty
from paysight.session import materialize

K = 20
#: Buckets for each doubling of a vector's length, and vectors that the first search takes at least.
STEPS, HEAD = 4, 16_384
#: (item, term) pairs of one block of items.
BLOCK_ENTRIES = 250_000
#: Vectors that are searched at once.
ROWS = 4096
#: Bounds are raised by this share against rounding.
SLACK = 1e-9

#: Term characters: all but the ASCII ones that are no letter or digit; A-Z become a-z.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_TERMS = bytes((c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32) for c in range(256))


def terms_of(text: Column) -> Column:
    """All terms of a text, in order."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), 0)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, terms: np.ndarray, tfs: np.ndarray, m) -> np.ndarray:
    """Coordinates of vectors, in 64-bit integers (``m``: one number, or one for each entry)."""
    tf = tfs.astype(np.int64)
    return weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


# ----------------------------------------------------------------------------- vectors
def term_vectors(docs: DataFrame, vocabulary, text: Column) -> Column:
    """struct<n, terms, tfs> of a text: all its terms counted, those of the vocabulary listed."""
    @F.pandas_udf("struct<n: bigint, terms: array<int>, tfs: array<int>>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        number = vocabulary.value
        for s in batches:
            ns, terms, tfs = [], [], []
            for body in s:
                found = bytes(body).translate(_TO_TERMS).split()
                counts = Counter(found)
                known = [(number[t], c) for t, c in counts.items() if t in number]
                ns.append(len(found))
                terms.append(np.array([k for k, _ in known], np.int32))
                tfs.append(np.array([c for _, c in known], np.int32))
            yield pd.DataFrame({"n": pd.Series(ns, dtype="int64"), "terms": pd.Series(terms, dtype=object), "tfs": pd.Series(tfs, dtype=object)})
    return vectors(text.cast("binary"))


# ----------------------------------------------------------------------------- search
class Items:
    """The items of one block: term numbers, counts and length of each."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray]):
        self.terms, self.counts = terms, counts
        self.norms = np.array([math.sqrt(float((c * c).sum())) for c in counts])


class Block:
    """Up to ``ROWS`` vectors, by row and by term."""

    def __init__(self, weights: np.ndarray, rows: pd.DataFrame):
        sizes = np.array([len(t) for t in rows["terms"]])
        self.ids, self.none = rows["id"].to_numpy(), rows["none"].to_numpy()
        self.norms = rows["norm"].to_numpy()
        self.n, self.longest = len(rows), float(self.norms.max())
        self.terms = np.concatenate(rows["terms"].to_list()).astype(np.int64)
        self.impacts = impacts(weights, self.terms, np.concatenate(rows["tfs"].to_list()), np.repeat(rows["m"].to_numpy(), sizes))
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        order = np.argsort(self.terms, kind="stable")
        self.post_rows, self.post_impacts = np.repeat(np.arange(self.n), sizes)[order], self.impacts[order]
        ordered = self.terms[order]
        self.present, self.first = np.unique(ordered, return_index=True)
        self.stop = np.append(self.first[1:], len(ordered))
        self.most = np.maximum.reduceat(self.post_impacts, self.first)

    def best(self, terms: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that can reach the score ``least``, and their exact scores."""
        at = np.searchsorted(self.present, terms)
        here = (at < len(self.present)) & (self.present[np.minimum(at, len(self.present) - 1)] == terms)
        at, terms, counts = at[here], terms[here], counts[here]
        bound = counts * self.most[at].astype(np.float64)
        order = np.argsort(-bound, kind="stable")
        at, terms, counts, bound = at[order], terms[order], counts[order], bound[order]
        # bounds of the coordinates from each one on: sum of their largest products, and Cauchy-Schwarz
        by_sum = np.append(np.cumsum(bound[::-1])[::-1], 0.0) * (1 + SLACK)
        by_norm = np.sqrt(np.append(np.cumsum((counts * counts)[::-1])[::-1], 0)) * (1 + SLACK)
        short = np.minimum(by_sum, by_norm * self.longest) < least
        focus = int(np.argmax(short)) if short.any() else len(at)
        if focus == 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lo, sizes = self.first[at[:focus]], (self.stop - self.first)[at[:focus]]
        entries = _ranges(lo, sizes)
        rows, values = self.post_rows[entries], self.post_impacts[entries].astype(np.float64)
        partial = np.bincount(rows, np.repeat(counts[:focus], sizes) * values, self.n)
        seen = np.bincount(rows, values * values, self.n)
        rest = np.minimum(by_sum[focus], np.sqrt(np.maximum(self.norms ** 2 * (1 + SLACK) - seen * (1 - SLACK), 0)) * by_norm[focus])
        left = np.flatnonzero((partial > 0) & ((partial + rest) * (1 + SLACK) >= least))
        if not len(left):
            return left, left
        lengths = self.ends[left] - self.starts[left]
        entries = _ranges(self.starts[left], lengths)
        by_term = np.zeros(int(max(self.present[-1], terms.max())) + 1, np.int64)
        by_term[terms] = counts
        scores = np.add.reduceat(by_term[self.terms[entries]] * self.impacts[entries], np.cumsum(lengths) - lengths)
        good = scores >= least
        return left[good], scores[good]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + size), one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def search(batches: Iterator[pd.DataFrame], items: Items, weights: np.ndarray, least: np.ndarray, k: int) -> Iterator[pd.DataFrame]:
    """The best k vectors of all batches for each item. ``least``: a score known to be needed."""
    least = least.copy()
    held: list[list[tuple[np.ndarray, ...]]] = [[] for _ in items.terms]
    for pdf in batches:
        for i in range(0, len(pdf), ROWS):
            block = Block(weights, pdf.iloc[i:i + ROWS])
            for q in np.flatnonzero(items.norms * block.longest * (1 + SLACK) >= least):
                rows, scores = block.best(items.terms[q], items.counts[q], int(least[q]))
                if not len(rows):
                    continue
                held[q].append((scores, block.none[rows], block.ids[rows]))
                if sum(len(x[0]) for x in held[q]) >= k:
                    held[q] = [_top(held[q], k)]
                    least[q] = max(least[q], held[q][0][0][-1])
    for q, found in enumerate(held):
        if found:
            scores, none, ids = _top(found, k)
            yield pd.DataFrame({"item": np.full(len(ids), q, np.int32), "id": ids, "none": none, "score": scores})


def _top(found: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    scores, none, ids = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((ids, none, -scores))[:k]
    return scores[order], none[order], ids[order]


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "none", "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, entries: list, k: int, text: str) -> DataFrame | None:
    """item, rank, id, none, score for the items of one block: ``entries`` are (key, term, count)."""
    spark = docs.sparkSession
    keys = sorted({e.key for e in entries})
    names = sorted({e.term for e in entries})
    number = {t.encode(): i for i, t in enumerate(names)}
    vocabulary = spark.sparkContext.broadcast(number)
    vectors = materialize(docs.withColumn("v", term_vectors(docs, vocabulary, text_or_empty(text)))
                          .select("id", "none", "v.n", "v.terms", "v.tfs"), "term-vectors")
    n_docs, length = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n_docs:
        return None
    weights = np.zeros(len(names), np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():  # at most one row a name
        weights[r.t] = weight(n_docs, r.df)
    by_item: dict[int, list] = {key: [] for key in keys}
    for e in entries:
        by_item[e.key].append((number[e.term.encode()], e.n))
    pairs = [np.array(sorted(by_item[key]), np.int64) for key in keys]
    shared = spark.sparkContext.broadcast((Items([p[:, 0] for p in pairs], [p[:, 1] for p in pairs]), weights))
    items = shared.value[0]

    @F.pandas_udf("double")
    def norm(terms: pd.Series, tfs: pd.Series, m: pd.Series) -> pd.Series:
        w = shared.value[1]
        return pd.Series([math.sqrt(float((impacts(w, t, f, x).astype(np.float64) ** 2).sum())) for t, f, x in zip(terms, tfs, m, strict=True)], dtype="float64")
    m = F.lit(75) + F.expr(f"(25 * cast(n as decimal(38,0)) * {n_docs}) div {length}")
    measured = (vectors.where(F.size("terms") > 0).withColumn("m", m.cast("long")).withColumn("norm", norm("terms", "tfs", "m"))
                .where("norm > 0").withColumn("bucket", F.floor(F.log2("norm") * STEPS)))
    ordered = materialize(measured.sortWithinPartitions(F.desc("norm")), "impact-vectors")

    head, seen = None, 0
    for r in ordered.groupBy("bucket").agg(F.count("*").alias("n")).orderBy(F.desc("bucket")).collect():  # one row a bucket
        head, seen = r.bucket, seen + r.n
        if seen >= HEAD:
            break
    if head is None:
        return None

    def found(part: DataFrame, least: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            return search(batches, shared.value[0], shared.value[1], least, k)
        rows = part.select("id", "none", "m", "terms", "tfs", "norm")
        return _best(rows.mapInPandas(run, "item int, id long, none boolean, score long"), k)
    least = np.ones(len(keys), np.int64)
    first = materialize(found(ordered.where(F.col("bucket") >= head), least), "head-ranks")
    for r in first.where(F.col("rank") == k).collect():  # at most one row an item
        least[r.item] = r.score
    needed = float((least / np.maximum(items.norms, 1e-300)).min()) * (1 - SLACK)
    rest = found(ordered.where((F.col("bucket") < head) & (F.col("norm") >= needed)), least)
    best = _best(first.drop("rank").unionByName(rest.drop("rank")), k)
    ids = spark.createDataFrame([(i, key) for i, key in enumerate(keys)], "item int, key long")
    return best.join(F.broadcast(ids), "item").select("key", "rank", "id", "none", "score")  # a block's items at most


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", item_col: str = "item_id", text: str = "text",
                  block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k best documents of each item."""
    spark = docs.sparkSession
    bound_batches(spark)
    stated = materialize(items.select(F.col(f"`{item_col}`").alias("item_id"), terms_of(text_or_empty(text)).alias("terms"))
                         .withColumn("key", F.monotonically_increasing_id()), "search-items")
    total = stated.agg(F.sum(F.size(F.array_distinct("terms")))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_entries))
    counted = stated.select("key", F.explode("terms").alias("term")).groupBy("key", "term").agg(F.count("*").alias("n"))
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`"), F.lit(0)).cast("long").alias("id"), F.col(f"`{id_col}`").isNull().alias("none"),
                       F.col(f"`{text}`").alias("text"))
    out = spark.createDataFrame([], "key long, rank int, id long, none boolean, score long")
    for b in range(blocks):
        entries = counted.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).collect()
        if entries and (best := _search_block(rows, entries, k, "text")) is not None:
            out = out.unionByName(materialize(best, "item-ranks") if blocks > 1 else best)
    return out.join(stated.select("key", "item_id"), "key").select(
        "item_id", "rank", F.when(~F.col("none"), F.col("id")).alias("doc_id"), "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
