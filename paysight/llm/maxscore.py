"""Exact top-k inner-product search by MaxScore over blocks.

Each dimension is a query term. Candidates are packed into shards of ``shard_rows``
vectors; a shard holds one posting list of impacts for each term (its column) and the
least and largest impact of each term. For a query, an impact is counted from the end of
its range that is worst for the query's weight, so that all contributions are >= 0 and a
term's score bound is ``|weight| * (largest - least)``. With the k-th best score so far as
threshold, terms are split by bound: the *non-essential* ones can't lift a candidate over
the threshold together. The postings of the essential terms are traversed; the others are
probed only for candidates whose partial score plus remaining bound is still competitive.
Shards of one group share the threshold; the lists of the groups are merged.

Queries and candidates meet in blocks (``query_block`` queries, ``shards_per_group``
shards) with an equality join on a cell number: no vector pair is a row, and memory for a
cell has a fixed bound. Scores are integer inner products and exact (as long as they fit
64 bits); ties go to the smaller id.

Defined results: vectors that are null, or hold null or non-finite components, take no
part; an empty vector, or one shorter than others, counts as filled up with zeros; a row
without id takes no part; a query id that occurs several times is asked once (with its
least vector), and candidates with the query's own id are left out; repeated rows are
candidates each, so their id may stand several times in a list; fewer than k candidates
give a shorter list; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysight.llm.common import table

QUERY_BLOCK, SHARD_ROWS, SHARDS_PER_GROUP = 1024, 2048, 4
#: Scores below this are exact in float32 and float64 arithmetic.
EXACT32, EXACT64 = 2 ** 23, 2 ** 52


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component, null for a vector that takes no part."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(vector.isNotNull() & ok,
                  F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _packed(df: DataFrame, rows: int) -> DataFrame:
    """(id long, v array<long>) rows packed into blocks of at most ``rows`` rows."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        part, n = TaskContext.get().partitionId(), 0
        for pdf in batches:
            for i in range(0, len(pdf), rows):
                cut = pdf.iloc[i:i + rows]
                m = _matrix(list(cut["v"]))
                yield pd.DataFrame({"block": [(part << 32) + n], "ids": [cut["id"].to_numpy("<i8").tobytes()],
                                    "dims": [m.shape[1]], "vectors": [m.astype("<i8").tobytes() if m.dtype.itemsize == 8
                                                                      else m.astype("<i2").tobytes()],
                                    "wide": [m.dtype.itemsize == 8]})
                n += 1
    return df.mapInPandas(pack, "block long, ids binary, dims int, vectors binary, wide boolean")


def _matrix(vectors: list) -> np.ndarray:
    dims = max((len(v) for v in vectors), default=0)
    m = np.zeros((len(vectors), dims), dtype=np.int64)
    for i, v in enumerate(vectors):
        m[i, :len(v)] = v
    small = not m.size or np.abs(m).max() < 2 ** 15
    return m.astype(np.int16) if small else m


def _unpacked(rows: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for r in rows.itertuples(index=False):
        m = np.frombuffer(r.vectors, dtype="<i8" if r.wide else "<i2")
        ids = np.frombuffer(r.ids, dtype="<i8")
        out.append((ids, m.reshape(len(ids), r.dims)))
    return out


class Best:
    """The k best (score, id) of one query so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def floor(self):
        return self.scores[-1] if len(self.scores) == self.k else None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((i, -s))[:self.k]
        self.scores, self.ids = s[order], i[order]


def _exact_type(queries: np.ndarray, shard: np.ndarray):
    """The fastest type in which all sums of this block are exact."""
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(shard).max(initial=0)) * 4 * max(1, shard.shape[1])
    return np.float32 if most < EXACT32 else np.float64 if most < EXACT64 else np.int64


def search_shard(qids: np.ndarray, queries: np.ndarray, ids: np.ndarray, shard: np.ndarray, best: list[Best]) -> None:
    """MaxScore of each query against one shard; ``best`` is updated."""
    if not len(ids):
        return
    dims = max(queries.shape[1], shard.shape[1])
    queries = np.pad(queries, ((0, 0), (0, dims - queries.shape[1])))
    shard = np.pad(shard, ((0, 0), (0, dims - shard.shape[1])))
    kind = _exact_type(queries, shard)
    postings = np.ascontiguousarray(shard.T.astype(kind))  # one list of impacts for each term
    weights = queries.astype(kind)
    least, most = postings.min(axis=1, initial=0), postings.max(axis=1, initial=0)
    for k, (qid, w) in enumerate(zip(qids, weights, strict=True)):
        worst = np.where(w >= 0, least, most)
        bound = np.abs(w) * (most - least)
        order = np.argsort(-bound, kind="stable")
        base = (w * worst).sum()
        floor = best[k].floor()
        if floor is None:
            scores, rows = w @ postings, np.arange(len(ids))
        else:
            rest = base + np.append(np.cumsum(bound[order][::-1])[::-1], 0)  # best score without the first terms
            if rest[0] < floor:
                continue
            n = int(np.searchsorted(-rest, -floor, side="right"))  # terms from here on are non-essential
            essential, other = order[:n], order[n:]
            part = w[essential] @ postings[essential]
            reach = floor - (bound[other].sum() + (w[other] * worst[other]).sum())
            rows = np.flatnonzero(part >= reach)
            if not len(rows):
                continue
            scores = part[rows]
            if len(other):
                scores = scores + w[other] @ postings[np.ix_(other, rows)]
            keep = scores >= floor
            scores, rows = scores[keep], rows[keep]
        own = ids[rows] != qid
        scores, rows = scores[own], rows[own]
        if len(rows) > best[k].k:  # only those that can enter, ties included
            nth = np.partition(scores, len(scores) - best[k].k)[len(scores) - best[k].k]
            rows, scores = rows[scores >= nth], scores[scores >= nth]
        if len(rows):
            best[k].add(scores.astype(np.int64), ids[rows])


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, query_block: int = QUERY_BLOCK,
          shard_rows: int = SHARD_ROWS, shards_per_group: int = SHARDS_PER_GROUP) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query.

    Both frames have columns ``id`` (long) and ``v`` (array of long)."""
    queries = queries.select("id", "v").where("id is not null and v is not null").groupBy("id").agg(F.min("v").alias("v"))
    candidates = candidates.select("id", "v").where("id is not null and v is not null")
    n_queries, n_rows = queries.count(), candidates.count()
    blocks = max(1, math.ceil(n_queries / query_block))
    groups = max(1, math.ceil(n_rows / (shard_rows * shards_per_group)))

    shards = _packed(candidates, shard_rows).withColumn("g", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    left = (_packed(queries.repartition(blocks, "id"), query_block)
            .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    # the blocks of queries are numbered by what they hold: a cell is (block of queries, group of shards)
    left = left.withColumn("b", F.pmod(F.xxhash64("block"), F.lit(blocks)).cast("int"))
    right = shards.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def score(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = []
        stored = _unpacked(c)
        for qids, vectors in _unpacked(q):
            best = [Best(k) for _ in qids]
            for ids, shard in stored:
                search_shard(qids, vectors, ids, shard, best)
            out += [pd.DataFrame({"query_id": qid, "vec_id": b.ids, "score": b.scores}) for qid, b in zip(qids, best, strict=True)]
        if not out:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        return pd.concat(out, ignore_index=True)

    found = (left.groupBy("b", "g").cogroup(right.groupBy("b", "g"))
             .applyInPandas(score, "query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = (table(spark, sf_dir, "embeddings")
               .select(F.col("vec_id").cast("long").alias("id"), quantised(F.col("embedding")).alias("v")))
    return top_k(vectors.where("id % 20 = 0"), vectors)
