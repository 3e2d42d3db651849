"""Invariants of the model side on the smallest tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_quantile_forest_ordered_and_scoring_invariants(spark):
    from paysight.plans import model_queries as MQ
    r = MQ.q_r1_r2_score_range(spark, SF_SMALL)
    bad = r.filter(~((F.col("lower") <= F.col("predicted_salary")) &
                     (F.col("predicted_salary") <= F.col("upper")))).count()
    assert bad == 0
    assert r.filter(F.col("lower") < 15000).count() == 0
    assert r.filter(F.col("upper") > 400000).count() == 0


def test_stream_equals_batch(spark):
    from paysight.plans import model_queries as MQ
    from paysight.sources.requests import requests
    from paysight.operators.scorer import Scorer
    data, gbt = MQ._serving(spark, SF_SMALL)
    scorer = Scorer(data.encoders, data.prep_model, gbt, MQ._qrf(spark, SF_SMALL))
    batch = scorer.score_requests(requests(spark, SF_SMALL), MQ.POSTED_AT)
    stream = MQ.q_r3_stream_scoring(spark, SF_SMALL)
    cols = ["request_id", "predicted_salary", "lower", "upper"]
    assert sorted(batch.select(*cols).collect()) == sorted(stream.select(*cols).collect())


def test_learners_recover_the_planted_signal(spark):
    """Noise is uniform over 80,000, so the best R2 is about 0.8; the mean predictor has 0."""
    from paysight.plans import model_queries as MQ
    for q, n in ((MQ.q_m1_m4_linear_zoo, 4), (MQ.q_m10_early_stopping, 2), (MQ.q_t8_native_frame, 1)):
        res = q(spark, SF_SMALL).collect()
        assert len(res) == n and all(r["R2"] > 0.5 for r in res), res


def test_trees_recover_the_planted_signal(spark):
    from paysight.operators import models as M
    from paysight.plans import model_queries as MQ
    mc = MQ.CONFIG
    res, fitted = M.train_all(MQ._data(spark, SF_SMALL), mc, parallelism=3, only=[
        "RandomForest", "ExtraTrees", "GradientBoosting", "XGBoost", "LightGBM"])
    rows = res.collect()
    assert len(rows) == 5 and all(r["R2"] > 0.4 for r in rows), rows
    assert fitted["XGBoost"].getNumTrees == mc.xgb_rounds + 1  # all rounds, and the mean
    assert [r["RMSE"] for r in rows] == sorted(r["RMSE"] for r in rows)


def test_importance_finds_seniority_first(spark):
    from paysight.plans import model_queries as MQ
    rows = MQ.q_v8_tree_importance(spark, SF_SMALL).collect()
    by = {r["feature"]: r["importance"] for r in rows}
    assert by["seniority_score"] + by["job_title"] > 0.4
    assert by["job_country"] > by["health_flag"]


def test_split_frame_train_has_oof_encodings(spark):
    from paysight.plans import model_queries as MQ
    d = MQ._data(spark, SF_SMALL)
    n = d.train.count() + d.val.count() + d.test.count()
    assert n == MQ._split_raw(spark, SF_SMALL).count()


def test_v9_linear_shap_matches_numpy(spark):
    import numpy as np
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from paysight.operators.explain import linear_shap
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = x @ np.array([1.5, -2.0, 0.5]) + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(x, y)],
                               "a double, b double, c double, y double")
    v = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    m = LinearRegression(labelCol="y").fit(v)
    got = {r["feature"]: r["mean_abs_shap"] for r in linear_shap(m, v, v, []).collect()}
    coef = m.coefficients.toArray()
    exp = np.abs((x - x.mean(axis=0)) * coef).mean(axis=0)
    for name, e in zip(["a", "b", "c"], exp):
        assert abs(got[name] - e) < 1e-9


def test_scorer_from_its_folder_equals_the_one_in_memory(spark, tmp_path):
    from paysight.operators.scorer import Scorer
    from paysight.plans import model_queries as MQ
    from paysight.sources.requests import requests
    data, gbt = MQ._serving(spark, SF_SMALL)
    own = Scorer(data.encoders, data.prep_model, gbt, MQ._qrf(spark, SF_SMALL), "GBT", {"rows": 1})
    own.save(str(tmp_path / "scorer"))
    back = Scorer.load(spark, str(tmp_path / "scorer"))
    req = requests(spark, SF_SMALL)
    a, b = (sorted(s.score_requests(req, MQ.POSTED_AT).collect()) for s in (own, back))
    assert a == b and a[0].model == "GBT" and back.metadata == {"rows": 1}
    # no aggregate over training rows is left in the encoding of requests
    from paysight.operators.scoring import request_features
    plan = back.features(request_features(req))._jdf.queryExecution().optimizedPlan().toString()
    assert "avg(" not in plan and "label_log" not in plan


def test_stacking_does_not_see_held_out_labels(spark):
    """Out-of-fold predictions of a fold stay the same when its labels change."""
    from pyspark.ml.regression import LinearRegression

    from paysight.config import COLS, ModelConfig
    from paysight.operators import models as M
    from paysight.operators.split import ordered_folds
    from paysight.plans.shared import split_frame
    train = split_frame(spark, SF_SMALL).filter(F.col("split") == "train")
    fold = ordered_folds(train.select(COLS.id), COLS.id, 2, "_f")
    changed = train.join(fold, COLS.id).withColumn(COLS.target, F.when(F.col("_f") == 0, F.col(COLS.target) * 3 + 7)
                                                    .otherwise(F.col(COLS.target))).drop("_f")
    base = {"ridge": LinearRegression(featuresCol="features", labelCol=M.LABEL, regParam=0.1)}
    mc = ModelConfig(skills_vocab=50, title_vocab=20)
    a, b = ({r[COLS.id]: round(r["p_ridge"], 3) for r in M.out_of_fold(x, base, mc, 2)[0].collect()} for x in (train, changed))
    assert a == b and len(a) > 0


def test_permutation_positions_do_not_overflow(spark):
    df = spark.range(1).selectExpr("4000000000L p", "3999999999L a")
    src = ((F.col("p").cast("decimal(19,0)") * F.col("a").cast("decimal(19,0)") + 5) % F.lit(4000000001).cast("decimal(19,0)"))
    assert df.select(src.cast("long").alias("x")).first().x == (4000000000 * 3999999999 + 5) % 4000000001


def test_shared_folder_must_be_set_on_a_cluster():
    from types import SimpleNamespace as N

    import pytest

    from paysight.session import shared_dir
    sc = N(_jsc=N(sc=lambda: N(getCheckpointDir=lambda: N(isDefined=lambda: False))),
           getConf=lambda: {}, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(N(sparkContext=sc))


def test_native_frame_keeps_every_category_and_term(spark):
    from paysight.config import COLS, NUMERIC_FEATURES, ModelConfig
    from paysight.operators import models as M
    from paysight.plans.shared import split_frame
    k = F.pmod(F.xxhash64(COLS.id), F.lit(100))
    frame = split_frame(spark, SF_SMALL).withColumns({
        COLS.company: F.when(k > 0, F.concat(F.lit("c"), k)), "skills_text": F.concat(F.lit("s"), F.pmod(F.xxhash64(COLS.id, F.lit(1)), F.lit(400))),
        COLS.target: (20000 + 1000 * k).cast("double")})
    tr, rest = M.native_frame(frame, ModelConfig(), [COLS.company, COLS.country])
    means = tr.groupBy(COLS.company).agg(F.avg(M.LABEL).alias("m"), F.count("*").alias("n"))
    got = rest.join(means, COLS.company)
    assert tr.select(COLS.company).distinct().count() > 90  # without a value: one category more
    assert got.count() > 0 and got.where("abs(te_company_name - m) > 1e-9").count() == 0
    # each term of the training rows has a column
    out = M.native_frame_model([COLS.company, COLS.country], NUMERIC_FEATURES, ModelConfig()).fit(tr).transform(tr)
    terms = tr.select("skills_text").distinct().count()
    assert terms > 256 and len(out.first()._n_sk_c) == terms
    assert len(out.first().features) > len(NUMERIC_FEATURES) + 2 + terms


def test_stack_and_deployment_use_the_recorded_searches(spark, monkeypatch):
    """One record: the searches run once, their parameters feed the stack and the deployed model."""
    from dataclasses import replace

    from paysight.operators import tuning as T
    from paysight.plans import model_queries as MQ
    mc = replace(MQ.CONFIG, lgbm_trials=3, xgb_trials=3, round_share=0.01, lgbm_rounds=10, stack_trees=5, forest_depth=5)
    monkeypatch.setattr(MQ, "CONFIG", mc)
    monkeypatch.setitem(MQ._CACHE, ("registry", spark.sparkContext.applicationId, SF_SMALL), MQ.Registry(spark, MQ.scratch_path(spark, "registry-test")))
    raced, race = [], T.race
    monkeypatch.setattr(MQ.TU, "race", lambda *a, **k: raced.append(a[2]) or race(*a, **k))
    stack = MQ.q_m14_stacking(spark, SF_SMALL).collect()
    deployed = MQ.q_m16_deploy(spark, SF_SMALL).collect()
    trials = MQ.q_m12_tune_lightgbm(spark, SF_SMALL).collect()
    record = MQ.q_m15_run_record(spark, SF_SMALL).collect()
    assert raced == [3, 3] and sorted(r.split for r in stack) == ["test", "val"]
    assert [(r.trial in (0, 1, 2), r.rung) for r in trials] == [(True, 1)] + [(True, 0)] * 3
    assert {r.step for r in record} == {"train", "tune-lightgbm", "tune-xgboost", "stack", "deploy"} and len(record) == 10
    val = {r.step: r.RMSE for r in record if r.split == "val"}
    assert {r.step for r in record if r.champion} == {min(val, key=val.get)}
    assert sorted((r.role, r.split) for r in deployed) == [(x, y) for x in ("deployed", "reference") for y in ("test", "val")]
    assert {r.RMSE for r in deployed if r.role == "reference"} == {r.RMSE for r in stack}
    best = MQ.params_of(MQ._tune_step(spark, SF_SMALL, "lightgbm"))["best"]
    assert MQ._tuned(spark, SF_SMALL, "lightgbm").rate == best["rate"] and trials[0].RMSE == min(r.RMSE for r in trials if r.rung == 1)


def test_library_defaults_are_the_original_sizes():
    from paysight.config import ModelConfig
    mc = ModelConfig()
    assert (mc.xgb_rounds, mc.lgbm_rounds, mc.cat_rounds, mc.small_gbt_rounds, mc.forest_trees, mc.stack_trees) == (600, 800, 600, 150, 200, 400)
    assert (mc.lgbm_trials, mc.xgb_trials, mc.patience, mc.round_share) == (40, 25, 60, 1.0)
