import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paysight.llm import maxscore
from tests.llm.conftest import SF


def brute(rows, k=20):
    """rows: (id, vector of floats or None)."""
    q = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q.append((i, [math.floor(64 * float(x)) for x in v]))
    out = {}
    for qi in sorted({i for i, _ in q if i % 20 == 0}):
        qv = min(v for i, v in q if i == qi)
        s = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in q if i != qi)[:k]
        out.update({(qi, r): (i, -n) for r, (n, i) in enumerate(s, 1)})
    return out


def result(df):
    return {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in df.collect()}


def frame(spark, rows, kind="double"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return df.select(F.col("vec_id").alias("id"), maxscore.quantised(F.col("embedding")).alias("v"))


def run(v, **kw):
    return result(maxscore.top_k(v.where("id % 20 = 0"), v, **kw))


def test_query_against_brute_force(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
        assert result(maxscore.op3_top_k(spark, sf)) == brute(rows)


@pytest.mark.parametrize("blocks", [{}, {"query_block": 3, "shard_rows": 7, "shards_per_group": 2}])
def test_ties_nulls_sparse_and_repeated(spark, blocks):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.choice([0, 0, 0, 0.5, -0.25, 1.0], 6)]) for i in range(300)]
    rows += [(i, [0.5, 0.5, 0.0, 0.0, 0.0, 0.0]) for i in range(300, 420)]  # one vector, many ids
    rows += [(500, None), (520, [None, 1.0]), (540, [float("nan")] * 6), (560, [float("inf")] * 6), (580, []), (600, [1.0]),
             (None, [1.0] * 6), (40, [1.0] * 6), (3, rows[3][1])]
    assert run(frame(spark, rows), **blocks) == brute(rows)


def test_large_components_are_exact(spark):
    rows = [(i, [float((i * 7919 + d * 104729) % 2000003 - 10 ** 6) * s for d in range(5)]) for s, i in
            [(1, j) for j in range(60)] + [(20, j) for j in range(60, 90)]]
    assert run(frame(spark, rows)) == brute(rows)


def test_few_and_no_rows(spark):
    assert run(frame(spark, [(0, [1.0]), (1, [2.0])])) == {(0, 1): (1, 64 * 128)}
    assert run(frame(spark, [])) == {}
    assert run(frame(spark, [(20, [1.0])])) == {}
