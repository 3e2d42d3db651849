"""Post-processing (F16, F17), metrics (V1) and rounding."""

from pyspark.sql import functions as F

from paysight.operators.evaluate import regression_metrics
from paysight.operators.scoring import post_process


def test_f16_clip_point_and_bounds(spark):
    df = spark.createDataFrame([(10_000.0, 20_000.0, 500_000.0)], "p double, lo double, hi double")
    r = df.select(post_process(F.col("p"), F.col("lo"), F.col("hi")).alias("r")).first()["r"]
    assert (r["lower"], r["point"], r["upper"]) == (20_000.0, 20_000.0, 400_000.0)


def test_f16_reorders_crossing_bounds(spark):
    df = spark.createDataFrame([(80_000.0, 90_000.0, 70_000.0)], "p double, lo double, hi double")
    r = df.select(post_process(F.col("p"), F.col("lo"), F.col("hi")).alias("r")).first()["r"]
    assert (r["lower"], r["upper"]) == (70_000.0, 90_000.0)


def test_f17_band(spark):
    df = spark.createDataFrame([(100_000.0,)], "p double")
    r = df.select(post_process(F.col("p"), None, None).alias("r")).first()["r"]
    assert (r["lower"], r["point"], r["upper"]) == (85_000.0, 100_000.0, 115_000.0)


def test_round_two_digits_uses_exact_binary_value(spark):
    # 109192.97 * 1.15 is just below ...975 in binary: rounds down, as Python does
    v = 109192.97 * 1.15
    df = spark.createDataFrame([(v,)], "p double")
    got = df.select(F.round("p", 2)).first()[0]
    assert got == round(v, 2)


def test_v1_metrics(spark):
    df = spark.createDataFrame([(100.0, 110.0), (200.0, 180.0)], "y double, p double")
    m = regression_metrics(df, "y", "p").first()
    assert abs(m["MAE"] - 15) < 1e-9
    assert abs(m["RMSE"] - 15.811388) < 1e-6
    assert abs(m["R2"] - 0.9) < 1e-9
    assert abs(m["MAPE"] - 10) < 1e-9
