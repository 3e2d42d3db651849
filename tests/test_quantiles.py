"""Exact percentiles against the built-in aggregate."""

import pytest
from pyspark.sql import functions as F

from paysight.operators import quantiles
from paysight.operators.quantiles import exact_percentiles, with_percentiles

PS = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]


@pytest.fixture(scope="module")
def values(spark):
    # one group with most rows, many ties, a heavy tail, a null group, null values
    g = F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), F.col("id") % 11))
    v = F.when(F.col("id") % 13 == 0, F.lit(None)).when(F.col("id") % 5 == 0, 7.0).otherwise(F.pow(F.col("id") * 37 % 1009, F.lit(3.0)) / 10)
    return spark.range(5000).select(g.alias("g"), v.cast("double").alias("v")).cache()


@pytest.mark.parametrize("cell", [65_536, 20, 1])
def test_groups_and_whole_equal_the_aggregate(values, monkeypatch, cell):
    """Without a pass over prefixes, with some, and with all four."""
    monkeypatch.setattr(quantiles, "CELL", cell)
    want = {r.g: r.q for r in values.groupBy("g").agg(F.percentile("v", PS).alias("q")).collect()}
    got = {r.g: r.q for r in exact_percentiles(values, "v", PS, ["g"]).collect()}
    assert got.keys() == want.keys() and None in got
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12)
    assert exact_percentiles(values, "v", PS).first().q == pytest.approx(
        values.agg(F.percentile("v", PS)).first()[0], rel=1e-12)


def test_empty_and_valueless(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "g string, v double")
    assert exact_percentiles(df.limit(0), "v", [0.5], ["g"]).collect() == []
    assert exact_percentiles(df.limit(0), "v", [0.5]).first().q == [None]
    both = with_percentiles(df, "v", [0.5], ["g"])
    assert sorted((r.g, r.n, r.q) for r in both.collect()) == [("a", 1, None), ("b", 1, [2.0])]


def test_order_of_bit_patterns(spark, monkeypatch):
    """Signs, zeros, tiny, huge and infinite values in four passes."""
    monkeypatch.setattr(quantiles, "CELL", 1)
    vals = [-float("inf"), -1e300, -2.5, -2.4999999999999996, -1e-310, 0.0, 5e-324, 1.0, 1.0000000000000002, 3e9, 1e300, float("inf")]
    df = spark.createDataFrame([(v,) for v in vals for _ in range(2)], "v double")
    ps = [i / (2 * len(vals) - 1) for i in range(0, 2 * len(vals), 2)]
    got = exact_percentiles(df, "v", ps).first().q
    assert got[1:-1] == pytest.approx(vals[1:-1], rel=1e-9)


def test_the_source_is_read_once(spark, values, tmp_path):
    values.write.parquet(str(tmp_path / "v"))
    df = spark.read.parquet(str(tmp_path / "v"))
    assert str(tmp_path) not in with_percentiles(df, "v", PS, ["g"])._jdf.queryExecution().executedPlan().toString()
