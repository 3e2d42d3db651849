"""Closed-form predictors used as deterministic references by the evaluation
operators (their outputs can be recomputed exactly in SQL): the global mean,
the per-group mean, and per-group quantile intervals (a one-level quantile
"tree", the cheap form of the quantile forest)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysight.operators.quantiles import percentiles, value_counts


def fit_group_mean(train: DataFrame, key: str | None, y: str) -> tuple[DataFrame | None, Column]:
    """Per-key mean of ``y`` (one row per key) and the global mean for unseen keys."""
    gm = train.agg(F.avg(y)).scalar()
    if key is None:
        return None, gm
    return train.groupBy(key).agg(F.avg(y).alias("_gm_pred")), gm


def predict_group_mean(df: DataFrame, table: DataFrame | None, gm: Column, key: str | None,
                       out: str = "prediction") -> DataFrame:
    if table is None:
        return df.withColumn(out, gm)
    return (df.join(table, key, "left").withColumn(out, F.coalesce("_gm_pred", gm))
            .drop("_gm_pred"))


def fit_group_quantiles(train: DataFrame, key: str, y: str, lo_q: float, hi_q: float
                        ) -> tuple[DataFrame, Column]:
    """Per-key (lo, hi) quantiles of ``y`` and the global pair for unseen keys."""
    pair = F.struct(F.col("q")[0].alias("lo"), F.col("q")[1].alias("hi"))
    counts = value_counts(train, y, [key])
    g = percentiles(counts, [lo_q, hi_q]).select(pair).scalar()
    t = percentiles(counts, [lo_q, hi_q], [key]).select(
        key, F.col("q")[0].alias("_q_lo"), F.col("q")[1].alias("_q_hi"))
    return t, g


def predict_group_quantiles(df: DataFrame, table: DataFrame, g: Column, key: str) -> DataFrame:
    return (df.join(table, key, "left")
            .withColumn("lower_raw", F.coalesce("_q_lo", g["lo"]))
            .withColumn("upper_raw", F.coalesce("_q_hi", g["hi"]))
            .drop("_q_lo", "_q_hi"))


def crossfit_group_mean(df: DataFrame, key: str | None, y: str, fold: str,
                        out: str = "prediction") -> DataFrame:
    """Out-of-fold group means for every row in one pass (k-fold CV of the group-mean
    predictor): per (key, fold) sums, minus the own fold; unseen -> out-of-fold mean."""
    ft = df.groupBy(fold).agg(F.count("*").alias("_fn"), F.sum(y).alias("_fs"))
    tot = df.agg(F.struct(F.count("*").alias("n"), F.sum(y).alias("s"))).scalar()
    gm = ft.select(fold, ((tot["s"] - F.col("_fs")) / (tot["n"] - F.col("_fn"))).alias("_og"))
    res = df.join(F.broadcast(gm), fold)
    if key is None:
        return res.withColumn(out, F.col("_og")).drop("_og")
    kf = df.groupBy(key, fold).agg(F.count("*").alias("_kn"), F.sum(y).alias("_ks"))
    kt = kf.groupBy(key).agg(F.sum("_kn").alias("_tn"), F.sum("_ks").alias("_ts"))
    oof = kf.join(kt, key).select(key, fold, F.try_divide(F.col("_ts") - F.col("_ks"),
                                                          F.col("_tn") - F.col("_kn")).alias("_om"))
    return (res.join(oof, [key, fold], "left")
            .withColumn(out, F.coalesce("_om", "_og")).drop("_om", "_og"))
