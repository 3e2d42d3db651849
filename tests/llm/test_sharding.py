import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from paysight.llm import sharding
from tests.llm.conftest import SF


def best_capacity(sizes, shards):
    """Smallest feasible capacity by dynamic programming over all contiguous partitions."""
    inf, n = float("inf"), len(sizes)
    pre = [0]
    for s in sizes:
        pre.append(pre[-1] + s)
    best = [0] + [inf] * n
    for _ in range(shards):
        best = [0] + [min(max(best[j], pre[i] - pre[j]) for j in range(i + 1)) for i in range(1, n + 1)]
    return best[n] if n else 0


def check(rows, texts, shards=8):
    """rows of shard_documents; texts: list of the input's texts."""
    assert len(rows) == len(texts)
    groups, slots, load, of = defaultdict(int), defaultdict(list), defaultdict(int), {}
    for t in texts:
        groups[hashlib.md5((t or "").encode()).hexdigest()] += len((t or "").encode()) + 1
    for r in rows:
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
        assert of.setdefault((r.text_crc32, r.size), r.shard) == r.shard
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if len(groups) <= 400:
        assert max(load.values(), default=0) == best_capacity([groups[k] for k in sorted(groups)], shards)


def test_edge_rows(spark, edge_docs):
    texts = [r.text for r in edge_docs.collect()]
    check(sharding.shard_documents(edge_docs).collect(), texts)


def test_query(spark):
    rows = sharding.op7_sharding(spark, SF).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode()) and
               r["size"] == len((text[r.doc_id] or "").encode()) + 1 for r in rows)
    check(rows, list(text.values()))


@pytest.mark.parametrize("hot", [0, 1])
@pytest.mark.parametrize("seed", range(3))
def test_minimax_is_exact(spark, seed, hot, monkeypatch):
    """Few digits in the first cells, so that cells must be resolved."""
    monkeypatch.setattr(sharding, "DIGITS", 1)
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    rng = random.Random(seed)
    sizes = {hashlib.md5(str(rng.random()).encode()).hexdigest(): rng.choice([1, 5, 30, 200]) for _ in range(200)}
    if hot:
        sizes[rng.choice(list(sizes))] = 6000
    groups = spark.createDataFrame([(k, v) for k, v in sizes.items()], "key string, size long")
    cuts, capacity = sharding.minimax_cuts(groups)
    order = sorted(sizes)
    assert capacity == best_capacity([sizes[k] for k in order], 8)
    load = groups.withColumn("shard", sharding.shard_of(F.col("key"), cuts)).groupBy("shard").agg(F.sum("size").alias("s"))
    assert max(r.s for r in load.collect()) == capacity


def test_empty(spark, no_docs):
    assert sharding.shard_documents(no_docs).count() == 0


def test_rows_of_one_id_are_numbered_in_several_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 20)
    for i in (None, 7):
        df = spark.createDataFrame([(i, f"{k:03d}", 0) for k in range(200)], "doc_id long, key string, shard int")
        rows = sorted(sharding.with_slots(df, "doc_id", ["key"]).collect(), key=lambda r: r.slot)
        assert [r.slot for r in rows] == list(range(200))
        # one bucket would give all of them in the order of their keys
        assert sum(a.key > b.key for a, b in zip(rows, rows[1:])) > 3
