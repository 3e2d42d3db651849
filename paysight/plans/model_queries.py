"""Model-side queries (rows / invariant checks, and one closed-form SQL check).

Encoders and vocabularies have the library's sizes and every learner sees all training rows.
Numbers of trees and rounds of the zoo, the early stop and the learner that scores are ``CONFIG``'s, chosen
for these tables (README); the library's defaults are the original ones. Searches run all candidates with the
rounds drawn for them, and the stack has the original forest. Prepared feature frames are written once per (session, data
folder) and reused by every query here, and so is the run registry: training, searches, stack
and deployment are steps of one record, and a query that needs a step finds it there.
"""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysight.config import COLS, FEATURE_COLUMNS, LOWER_QUANTILE, UPPER_QUANTILE, ModelConfig
from paysight.operators import explain as XP
from paysight.operators import intervals as IV
from paysight.operators import models as M
from paysight.operators import tuning as TU
from paysight.operators.registry import METRICS, Registry, params_of
from paysight.operators.scorer import Scorer
from paysight.operators.evaluate import interval_metrics, regression_metrics
from paysight.operators.split import hash_sample
from paysight.plans.shared import split_frame
from paysight.session import materialize, scratch_path
from paysight.sources.requests import requests

#: The library's sizes, but for the zoo's trees and rounds: so many that the validation loss of the driver's tables
#: has passed its least value (boosting), or hardly falls any more (forests). Searches and stack have all of theirs.
CONFIG = ModelConfig(forest_trees=40, small_gbt_rounds=60, xgb_rounds=60, lgbm_rounds=60, forest_depth=10, patience=20)
#: The date that stands for "now" in the registered queries, so that reruns agree.
POSTED_AT = "2024-01-15 00:00:00"
#: Trees of the cross-validated forest.
CV_TREES = 40
#: Candidates of a search that are fitted at once.
PARALLEL = 8
_CACHE: dict = {}


def _split_raw(spark, sf) -> DataFrame:
    return split_frame(spark, sf)


def _data(spark, sf) -> M.PreparedData:
    key = ("prep", spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        _CACHE[key] = M.prepare(_split_raw(spark, sf), CONFIG)
    return _CACHE[key]


def _metrics(df: DataFrame, name: str, split: str) -> DataFrame:
    m = regression_metrics(df, COLS.target, "prediction_usd")
    return m.select(F.lit(name).alias("model"), F.lit(split).alias("split"), "n", "MAE", "RMSE",
                    "R2", "MAPE")


def _val_test(model, data: M.PreparedData, name: str) -> DataFrame:
    return _metrics(M.score_usd(model, data.val), name, "val").unionByName(
        _metrics(M.score_usd(model, data.test), name, "test"))


# ---------------------------------------------------------------- M1 closed form
def q_m1_one_feature_ols(spark, sf):
    """M1 on a single feature: slope and intercept equal SQL regr_slope / intercept."""
    df = _split_raw(spark, sf).filter(F.col("split") == "train")
    from pyspark.ml.feature import VectorAssembler
    v = VectorAssembler(inputCols=["n_skills"], outputCol="x").transform(
        df.withColumn("n_skills", F.col("n_skills").cast("double")))
    m = LinearRegression(featuresCol="x", labelCol=COLS.target, regParam=0.0,
                         solver="normal", standardization=False).fit(v)
    return spark.createDataFrame([(round(float(m.coefficients[0]), 4),
                                   round(float(m.intercept), 4))], "slope double, intercept double")


# ---------------------------------------------------------------- zoo / ranking
def q_m1_m4_linear_zoo(spark, sf):
    res, _ = M.train_all(_data(spark, sf), CONFIG, only=["LinearRegression", "Ridge", "Lasso",
                                                        "ElasticNet"], parallelism=4)
    return res.drop("seconds")


def q_m5_m9_tree_zoo(spark, sf):
    res, _ = M.train_all(_data(spark, sf), CONFIG, parallelism=PARALLEL, only=["RandomForest", "ExtraTrees", "GradientBoosting", "XGBoost", "LightGBM"])
    return res.drop("seconds")


def q_m10_early_stopping(spark, sf):
    data = _data(spark, sf)
    run = M.fit_with_early_stopping(data, CONFIG)
    return _val_test(run.model, data, "EarlyStoppingGBT").withColumns({"rounds": F.lit(run.rounds), "best_round": F.lit(run.best)})


# ---------------------------------------------------------------- the run registry: M11-M16
def _registry(spark, sf) -> Registry:
    key = ("registry", spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        _CACHE[key] = Registry(spark, scratch_path(spark, "registry"))
    return _CACHE[key]


def _scores(score, data) -> dict:
    """Metrics of a scoring function on both held-out splits."""
    return {split: regression_metrics(score(df), COLS.target, "prediction_usd").first() for split, df in (("val", data.val), ("test", data.test))}


def _lightgbm():
    return M.boosted(CONFIG, CONFIG.lgbm_rounds, rate=0.05, depth=6, row_share=0.8, feature_share=0.8)


def _train_step(spark, sf):
    """The learner that scores, trained, tested and saved (the original serves LightGBM)."""
    def run(folder):
        data = _data(spark, sf)
        model = M.boost(data.train, _lightgbm(), path=f"{folder}/run").model
        model.write().overwrite().save(f"{folder}/model")
        return "LightGBM", _scores(lambda df: M.score_usd(model, df), data), {}
    return _registry(spark, sf).step("train", {"rounds": CONFIG.lgbm_rounds, "rate": 0.05, "depth": 6}, run)


SEARCHES = {"lightgbm": (TU.LGBM_SPACE, "lgbm_trials", 42), "xgboost": (TU.XGB_SPACE, "xgb_trials", 43)}


def _tune_step(spark, sf, which: str):
    """A search; its record holds the winner's parameters, its folder all scores."""
    space, trials, seed = SEARCHES[which]

    def run(folder):
        data = _data(spark, sf)
        best, model, table = TU.race(data, space, getattr(CONFIG, trials), PARALLEL, seed, CONFIG, f"{folder}/race")
        table.write.mode("overwrite").parquet(f"{folder}/trials")
        model.write().overwrite().save(f"{folder}/model")
        return which, _scores(lambda df: M.score_usd(model, df), data), {"best": best}
    return _registry(spark, sf).step(f"tune-{which}", {"trials": getattr(CONFIG, trials), "seed": seed, "share": CONFIG.round_share}, run)


def _tuned(spark, sf, which: str):
    """The learner that a search has found."""
    best = params_of(_tune_step(spark, sf, which))["best"]
    return TU.learner(best, CONFIG, _data(spark, sf).train.count())


def _trials(spark, sf, which: str) -> DataFrame:
    table = spark.read.parquet(f"{_tune_step(spark, sf, which).path}/trials")
    return table.withColumn("params", F.to_json("params")).orderBy(F.desc("rung"), "RMSE", "trial")


def q_m12_tune_lightgbm(spark, sf):
    return _trials(spark, sf, "lightgbm")


def q_m13_tune_xgboost(spark, sf):
    return _trials(spark, sf, "xgboost")


def _bases(spark, sf) -> dict:
    """The stack's learners: a forest, and both boosted ones with their tuned parameters."""
    return {"extratrees": M.forest(CONFIG, CONFIG.stack_trees, bootstrap=False), **{w: _tuned(spark, sf, w) for w in SEARCHES}}


def _stack_step(spark, sf):
    parent = _tune_step(spark, sf, "lightgbm").key, _tune_step(spark, sf, "xgboost").key

    def run(folder):
        data = _data(spark, sf)
        meta, refit = M.stack(_split_raw(spark, sf), data, _bases(spark, sf), CONFIG, n_folds=5, parallelism=PARALLEL)
        meta.write().overwrite().save(f"{folder}/meta")
        for name, m in refit.items():
            m.write().overwrite().save(f"{folder}/{name}")
        return "Stack", _scores(lambda df: M.stack_predict(meta, refit, df), data), {"weights": [float(x) for x in meta.coefficients]}
    return _registry(spark, sf).step("stack", {"tuned": parent, "trees": CONFIG.stack_trees}, run, parent[0])


def _metric_rows(spark, row, extra: dict | None = None) -> DataFrame:
    rows = [(row.model, split, *[m[c] for c in METRICS]) for split, m in sorted(row.metrics.items())]
    out = spark.createDataFrame(rows, "model string, split string, MAE double, RMSE double, R2 double, MAPE double")
    return out.withColumns({k: F.lit(v) for k, v in (extra or {}).items()})


def q_m14_stacking(spark, sf):
    return _metric_rows(spark, _stack_step(spark, sf))


def _deploy_step(spark, sf):
    """The compact learner with tuned parameters, beside the metrics of the champion it stands for."""
    stack = _stack_step(spark, sf)

    def run(folder):
        data = _data(spark, sf)
        model, _ = M.deploy_compact(data, _tuned(spark, sf, "lightgbm"))
        model.write().overwrite().save(f"{folder}/model")
        return "LightGBM", _scores(lambda df: M.score_usd(model, df), data), {}
    return _registry(spark, sf).step("deploy", {"stack": stack.key}, run, stack.key)


def q_m16_deploy(spark, sf):
    row = _deploy_step(spark, sf)
    parent = _registry(spark, sf).find(row.parent)
    return _metric_rows(spark, row, {"role": "deployed"}).unionByName(_metric_rows(spark, parent, {"role": "reference"}))


def q_m15_run_record(spark, sf):
    """The record itself: each step's metrics, and whether it is the champion."""
    _train_step(spark, sf), _stack_step(spark, sf)
    reg = _registry(spark, sf)
    best = reg.champion()
    return reg.metrics().withColumn("champion", (F.col("step") == best.step) & (F.col("model") == best.model))


def _qrf(spark, sf):
    key = ("qrf", spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        _CACHE[key] = IV.fit_quantile_forest(_data(spark, sf).train, M.LABEL)
    return _CACHE[key]


def q_m17_quantile_forest(spark, sf):
    data = _data(spark, sf)
    q = IV.predict_quantiles(_qrf(spark, sf), data.test, COLS.id,
                             [LOWER_QUANTILE, UPPER_QUANTILE])
    s = data.test.select(COLS.id, COLS.target).join(q, COLS.id).select(
        COLS.id, COLS.target, F.expm1(F.col(IV.qcol(LOWER_QUANTILE))).alias("lower"),
        F.expm1(F.col(IV.qcol(UPPER_QUANTILE))).alias("upper"))
    return interval_metrics(s, COLS.target, "lower", "upper",
                            round((UPPER_QUANTILE - LOWER_QUANTILE) * 100, 6))


# ---------------------------------------------------------------- explanations
def _ridge(spark, sf):
    key = ("ridge", spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        data = _data(spark, sf)
        _CACHE[key] = M.ridge(2.0, data.train.count()).fit(data.train)
    return _CACHE[key]


def q_v7_permutation_importance(spark, sf):
    key = ("v7", spark.sparkContext.applicationId, sf)
    if key in _CACHE:
        return _CACHE[key]
    # a linear learner: each column's contributions change places, no features are made again
    imp = XP.linear_permutation_importance(_ridge(spark, sf), _data(spark, sf).test, COLS.id, COLS.target,
                                           FEATURE_COLUMNS, M.TE_COLS, repeats=5)
    _CACHE[key] = M.materialize(imp, "permutation-importance")
    return _CACHE[key]


def q_v8_tree_importance(spark, sf):
    data, m = _serving(spark, sf)
    return XP.tree_importance(m, data.train, M.TE_COLS)


def q_v9_linear_shap(spark, sf):
    data = _data(spark, sf)
    sample = hash_sample(data.test, COLS.id, 1000)
    return XP.linear_shap(_ridge(spark, sf), sample, data.train, M.TE_COLS)


def q_v9_tree_shap(spark, sf):
    """V9 of the boosted model that scores: P4 sample of the test rows, 100 background rows of the training rows."""
    data, model = _serving(spark, sf)
    raw = _split_raw(spark, sf).select(COLS.id, "split", *FEATURE_COLUMNS)

    def score(frame):
        return M.score_usd(model, data.prep_model.transform(M.encode(frame, data.encoders)))
    sample, background = (hash_sample(raw.where(F.col("split") == x).drop("split"), COLS.id, n) for x, n in (("test", 1000), ("train", 100)))
    return XP.sampled_shapley(score, sample, background, COLS.id, FEATURE_COLUMNS, orders=4)


def q_v10_top_importances(spark, sf):
    return XP.top_k(q_v7_permutation_importance(spark, sf), 10)


# ---------------------------------------------------------------- T6-T8, S7, scoring
def q_t6_assembled_features(spark, sf):
    from pyspark.ml.functions import vector_to_array
    d = _data(spark, sf).train
    nz = F.size(F.filter(vector_to_array("features"), lambda x: x != 0))
    return d.select(COLS.id, nz.alias("n_nonzero"), F.size(vector_to_array("features"))
                    .alias("width"))


def q_t7_log_wrapper(spark, sf):
    data = _data(spark, sf)
    return M.score_usd(_ridge(spark, sf), data.val).select(COLS.id, COLS.target,
                                                           "prediction_usd")


def q_t8_native_frame(spark, sf):
    from paysight.config import NUMERIC_FEATURES, OHE_FEATURES, TARGET_ENC_FEATURES
    cats = OHE_FEATURES + TARGET_ENC_FEATURES
    tr, rest = M.native_frame(_split_raw(spark, sf), CONFIG, cats)
    pm = M.native_frame_model(cats, NUMERIC_FEATURES, CONFIG).fit(tr)
    gbt = M.boosted(CONFIG, CONFIG.lgbm_rounds, depth=6, rate=0.05, bins=64).fit(materialize(pm.transform(tr).select(M.LABEL, "features"), "native-features"))
    val = M.score_usd(gbt, pm.transform(rest.filter(F.col("split") == "val")))
    return _metrics(val, "NativeFrameGBT", "val")


def q_s7_model_roundtrip(spark, sf):
    data = _data(spark, sf)
    path = scratch_path(spark, "scorer")
    Scorer(data.encoders, data.prep_model, _ridge(spark, sf), name="Ridge").save(path)
    back = Scorer.load(spark, path)
    raw_val = _split_raw(spark, sf).filter(F.col("split") == "val")
    return M.score_usd(back.point_model, back.features(raw_val)).select(COLS.id, "prediction_usd")


def _serving(spark, sf):
    """The prepared data and the recorded learner that scores."""
    from pyspark.ml.regression import GBTRegressionModel
    return _data(spark, sf), GBTRegressionModel.load(f"{_train_step(spark, sf).path}/model")


def q_r1_r2_score_range(spark, sf):
    from paysight.operators.scoring import request_features, score_range
    data, gbt = _serving(spark, sf)
    feats = data.prep_model.transform(M.encode(request_features(requests(spark, sf), POSTED_AT),
                                               data.encoders))
    return score_range(feats, gbt, _qrf(spark, sf), "request_id")


def q_r3_stream_scoring(spark, sf):
    from paysight.streaming.scoring import start_stream
    data, gbt = _serving(spark, sf)
    in_dir = scratch_path(spark, "requests-in")
    requests(spark, sf).write.mode("overwrite").json(in_dir)
    out_dir, ckpt = scratch_path(spark, "scores-out"), scratch_path(spark, "scores-ckpt")
    path = scratch_path(spark, "scorer")
    Scorer(data.encoders, data.prep_model, gbt, _qrf(spark, sf), "GBT").save(path)
    q = start_stream(spark, in_dir, out_dir, ckpt, Scorer.load(spark, path), posted_at=POSTED_AT)
    q.awaitTermination()  # ends when the folder is drained, and raises what ended the query early
    return spark.read.parquet(out_dir).drop("batch")


def q_v4_cv_models(spark, sf):
    from paysight.operators.evaluate import cv_summary
    n = _data(spark, sf).train.count()
    est = {"LightGBM": _lightgbm(), "XGBoost": M.boosted(CONFIG, CONFIG.xgb_rounds, rate=0.05, depth=6, row_share=0.8, feature_share=0.8),
           "ExtraTrees": M.forest(CONFIG, CV_TREES, bootstrap=False), "Ridge": M.ridge(2.0, n)}
    return cv_summary(M.cross_validate(_split_raw(spark, sf), est, CONFIG, n_folds=5, parallelism=PARALLEL))


MODEL_QUERIES = {
    "m1_one_feature_ols": q_m1_one_feature_ols,
    "m1_m4_linear_zoo": q_m1_m4_linear_zoo,
    "m5_m9_tree_zoo": q_m5_m9_tree_zoo,
    "m10_early_stopping": q_m10_early_stopping,
    "m12_tune_lightgbm": q_m12_tune_lightgbm,
    "m13_tune_xgboost": q_m13_tune_xgboost,
    "m14_stacking": q_m14_stacking,
    "v4_cv_models": q_v4_cv_models,
    "m15_run_record": q_m15_run_record,
    "m16_deploy": q_m16_deploy,
    "m17_quantile_forest": q_m17_quantile_forest,
    "v7_permutation_importance": q_v7_permutation_importance,
    "v8_tree_importance": q_v8_tree_importance,
    "v9_linear_shap": q_v9_linear_shap,
    "v9_tree_shap": q_v9_tree_shap,
    "v10_top_importances": q_v10_top_importances,
    "t6_assembled_features": q_t6_assembled_features,
    "t7_log_wrapper": q_t7_log_wrapper,
    "t8_native_frame": q_t8_native_frame,
    "s7_model_roundtrip": q_s7_model_roundtrip,
    "r1_r2_score_range": q_r1_r2_score_range,
    "r3_stream_scoring": q_r3_stream_scoring,
}
