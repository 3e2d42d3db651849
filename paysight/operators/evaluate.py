"""Evaluation (V1-V12): metrics, CV summaries, importances and report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str, pred: str, by: list[str] | None = None
                       ) -> DataFrame:
    """V1: MAE, RMSE, R2 and MAPE (%) in one aggregate (optionally per group).

    R2 = 1 - SSE / (n * var_pop(y)); MAPE divides by y without a guard (a zero
    label gives NULL via try_divide instead of failing under ANSI mode).
    """
    e = F.col(label) - F.col(pred)
    aggs = [F.count("*").alias("n"),
            F.avg(F.abs(e)).alias("MAE"),
            F.sqrt(F.avg(e * e)).alias("RMSE"),
            (1 - F.sum(e * e) / (F.count("*") * F.var_pop(label))).alias("R2"),
            (F.avg(F.abs(F.try_divide(e, F.col(label)))) * 100).alias("MAPE")]
    return df.groupBy(*(by or [])).agg(*aggs)


def identity_limits(df: DataFrame, label: str, pred: str) -> DataFrame:
    """V2: limits of the predicted-vs-actual identity line."""
    return df.agg(F.least(F.min(label), F.min(pred)).alias("lo"),
                  F.greatest(F.max(label), F.max(pred)).alias("hi"))


def cv_summary(fold_metrics: DataFrame, model_col: str = "model") -> DataFrame:
    """V4: per model mean R2, population std of R2, mean MAE and RMSE; R2 desc."""
    return (fold_metrics.groupBy(model_col)
            .agg(F.avg("R2").alias("R2_mean"), F.stddev_pop("R2").alias("R2_std"),
                 F.avg("MAE").alias("MAE_mean"), F.avg("RMSE").alias("RMSE_mean"))
            .orderBy(F.desc("R2_mean"), model_col))


def interval_metrics(df: DataFrame, label: str, lo: str, hi: str, nominal: float) -> DataFrame:
    """V5: repair crossing bounds (min/max), coverage %, mean width, nominal %."""
    a, b = F.least(lo, hi), F.greatest(lo, hi)
    inside = (F.col(label) >= a) & (F.col(label) <= b)
    return df.agg(F.count("*").alias("n"),
                  (F.avg(inside.cast("double")) * 100).alias("coverage_pct"),
                  F.avg(b - a).alias("mean_width"),
                  F.lit(float(nominal)).alias("nominal_pct"))


def band_table(df: DataFrame, id_col: str, label: str, lo: str, hi: str) -> DataFrame:
    """V6: rows sorted by actual value with their position and an inside flag.

    The position is a distributed zipWithIndex over a range partitioning (no
    single-partition window)."""
    from paysight.operators.split import global_position
    a, b = F.least(lo, hi), F.greatest(lo, hi)
    base = df.select(id_col, label, a.alias("lower"), b.alias("upper"))
    p = global_position(base, [label, id_col], "position")
    return p.withColumn("inside", (F.col(label) >= F.col("lower")) & (F.col(label) <= F.col("upper")))


def rank_table(metrics: DataFrame, by: str = "RMSE", model_col: str = "model",
               top: int | None = None) -> DataFrame:
    """Order a metrics table (ascending ``by``, name tie-break)."""
    out = metrics.orderBy(by, model_col)
    return out.limit(top) if top else out


def best_model(metrics: DataFrame, by: str = "RMSE", model_col: str = "model") -> DataFrame:
    """The model with the lowest ``by`` (ties by name)."""
    return metrics.agg(F.min_by(model_col, F.struct(by, model_col)).alias("best_model"),
                       F.min(by).alias(f"best_{by}"))


def promote(champion: DataFrame, challenger: DataFrame, by: str = "RMSE") -> DataFrame:
    """champion/challenger: the challenger replaces the champion only when its
    ``by`` is strictly lower; a missing champion counts as +infinity."""
    c = champion.agg(F.min(by).alias("champion_metric"))
    return challenger.select("model", F.col(by).alias("challenger_metric"),
                             c.scalar().alias("champion_metric")).withColumn(
        "promoted", F.col("challenger_metric") <
        F.coalesce(F.col("champion_metric"), F.lit(float("inf"))))
