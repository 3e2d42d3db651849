"""Model training, comparison, stacking and deployment.

Layout of a training run:
1. ``fit_encoders`` fits the data-dependent joins on the training rows (rare-bucket
   slots, target encodings) and ``encode`` attaches them to any split.
2. ``feature_model`` (Spark ML ``Pipeline``: scaler, one-hot, two TF-IDF blocks,
   assembler) is fitted once on the training rows; train / val / test are
   transformed once and written to the shared folder (lineage cut, executor loss
   recovers from the file, not from a recomputation).
3. Each learner of the zoo fits on the cached features with label ``log1p(y)``;
   predictions are mapped back with ``expm1`` and scored in USD.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysight.config import (COLS, NUMERIC_FEATURES, OHE_FEATURES, SEED, SKILLS_TEXT,
                             TARGET_ENC_FEATURES, TITLE_TEXT, ModelConfig)
from paysight.functions.stopwords import ENGLISH_STOP_WORDS
from paysight.operators import encoders as T
from paysight.operators.boosting import Boosting, BoostRun, boost
from paysight.operators.evaluate import regression_metrics
from paysight.operators.split import hash_folds, ordered_folds
from paysight.session import materialize

LABEL = "label_log"
TE_COLS = [f"te_{c}" for c in TARGET_ENC_FEATURES]


# ----------------------------------------------------------------------------- encoders
@dataclass
class FittedEncoders:
    slots: dict = field(default_factory=dict)      # column -> (category, slot) frame
    target: dict = field(default_factory=dict)     # column -> (encoding frame, default)
    mean: float | None = None                      # the default of unseen categories


def fit_encoders(train: DataFrame, min_frequency: int, y: str = LABEL, ohe: list[str] = OHE_FEATURES,
                 target: list[str] = TARGET_ENC_FEATURES) -> FittedEncoders:
    """T2 + T3 (inference side) fitted on the training rows.

    The tables (one row per category) are written once: scoring reads them and never
    aggregates the training rows again."""
    fe = FittedEncoders(mean=train.agg(F.avg(y)).first()[0])
    for c in ohe:
        fe.slots[c] = materialize(T.frequent_categories(train, c, min_frequency), f"slots-{c}")
    for c in target:
        enc, _ = T.fit_target_encoding(train, c, y)
        fe.target[c] = (materialize(enc, f"target-{c}"), F.lit(fe.mean))
    return fe


def encode(df: DataFrame, fe: FittedEncoders) -> DataFrame:
    """Attach slots and full-train target encodings (val / test / new rows)."""
    out = df
    for c, fitted in fe.slots.items():
        out = T.one_hot_slot(out, fitted, c, f"{c}__slot")
    for c, (enc, default) in fe.target.items():
        out = T.apply_target_encoding(out, enc, default, c, f"te_{c}")
    return out


def encode_train(train: DataFrame, fe: FittedEncoders, id_col: str, n_folds: int,
                 seed: int = SEED, y: str = LABEL) -> DataFrame:
    """Training rows: slots as for any row; target encodings out-of-fold."""
    out = train
    for c, fitted in fe.slots.items():
        out = T.one_hot_slot(out, fitted, c, f"{c}__slot")
    # own seed: these folds are independent of the split and of the outer CV folds
    folded = hash_folds(train, id_col, n_folds, seed + 1, "_te_fold")
    out = hash_folds(out, id_col, n_folds, seed + 1, "_te_fold")
    gstats = T.fold_statistics(folded, y, "_te_fold")
    for c in fe.target:
        # written, as the plans of several columns in one are more than a driver should hold
        table = materialize(T.target_encode_crossfit(folded, c, y, "_te_fold", gstats), f"crossfit-{c}")
        out = T.apply_crossfit_encoding(out, table, c, "_te_fold", f"te_{c}")
    return out.drop("_te_fold")


def preprocessing(mc: ModelConfig) -> Pipeline:
    """The vectorising stages (fitted on train only)."""
    return Pipeline(stages=T.feature_stages(
        NUMERIC_FEATURES, OHE_FEATURES, TE_COLS, SKILLS_TEXT, TITLE_TEXT, ENGLISH_STOP_WORDS,
        mc.skills_vocab, mc.title_vocab, mc.title_min_df))


def native_frame(split_frame: DataFrame, mc: ModelConfig, cat_cols: list[str], id_col: str = COLS.id,
                 target: str = COLS.target) -> tuple[DataFrame, DataFrame]:
    """T8 re-aimed: training rows and the others with the label and, for each categorical
    column however many values it has, its ordered target statistic ``te_<column>``: out of
    fold on the training rows, a missing value being a category of its own."""
    df = split_frame.withColumn(LABEL, F.log1p(target)).withColumns(
        {**{c: F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in cat_cols},
         **{c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (SKILLS_TEXT, TITLE_TEXT)}})
    df = materialize(df, "native-rows")
    train = df.filter(F.col("split") == "train")
    fe = fit_encoders(train, mc.ohe_min_frequency, ohe=[], target=cat_cols)
    return (materialize(encode_train(train, fe, id_col, mc.n_folds, mc.seed), "native-train"),
            encode(df.filter(F.col("split") != "train"), fe))


def native_frame_model(cat_cols: list[str], numeric: list[str], mc: ModelConfig) -> Pipeline:
    """The columns of ``native_frame`` as one vector for a tree learner: numerics as they
    are, target statistics, and a count for each term of the T4 and T5 vocabularies."""
    from pyspark.ml.feature import CountVectorizer, RegexTokenizer
    return Pipeline(stages=[
        RegexTokenizer(inputCol=SKILLS_TEXT, outputCol="_n_sk", pattern=r"\s+"),
        CountVectorizer(inputCol="_n_sk", outputCol="_n_sk_c", vocabSize=mc.skills_vocab),
        RegexTokenizer(inputCol=TITLE_TEXT, outputCol="_n_ti", pattern=T.WORD_PATTERN, gaps=False),
        CountVectorizer(inputCol="_n_ti", outputCol="_n_ti_c", vocabSize=mc.title_vocab),
        VectorAssembler(inputCols=numeric + [f"te_{c}" for c in cat_cols] + ["_n_sk_c", "_n_ti_c"],
                        outputCol="features", handleInvalid="keep")])


@dataclass
class PreparedData:
    train: DataFrame
    val: DataFrame
    test: DataFrame
    encoders: FittedEncoders
    prep_model: PipelineModel


def prepare(split_frame: DataFrame, mc: ModelConfig, id_col: str = COLS.id,
            target: str = COLS.target) -> PreparedData:
    """Fit encoders and the preprocessing pipeline on train; transform all splits once."""
    df = split_frame.withColumn(LABEL, F.log1p(target))
    train = df.filter(F.col("split") == "train")
    fe = fit_encoders(train, mc.ohe_min_frequency)
    # written once: the pipeline fit makes one pass per estimator stage over it
    tr = materialize(encode_train(train, fe, id_col, mc.n_folds, mc.seed), "train-encoded")
    rest = encode(df.filter(F.col("split") != "train"), fe)
    prep = preprocessing(mc).fit(tr)
    keep = [id_col, target, LABEL, "split", "features"]
    tr_f = materialize(prep.transform(tr).select(*keep), "train-features")
    rest_f = materialize(prep.transform(rest).select(*keep), "rest-features")
    return PreparedData(tr_f, rest_f.filter(F.col("split") == "val"),
                        rest_f.filter(F.col("split") == "test"), fe, prep)


# ----------------------------------------------------------------------------- model zoo
def _label_std(train: DataFrame) -> float:
    return float(train.agg(F.stddev_samp(LABEL)).first()[0])


def elastic_net_params(alpha: float, l1_ratio: float, label_std: float) -> dict:
    """Penalty of the (alpha, l1_ratio) convention in Spark's (regParam, elasticNetParam)."""
    reg = alpha * l1_ratio + alpha * (1 - l1_ratio) * label_std
    return {"regParam": reg, "elasticNetParam": (alpha * l1_ratio / reg) if reg else 0.0}


def boosted(mc: ModelConfig, rounds: int, **params) -> Boosting:
    """Boosted trees of ``rounds`` rounds on all rows."""
    return Boosting(rounds=rounds, seed=mc.seed, label=LABEL, **params)


def forest(mc: ModelConfig, trees: int, **params) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol="features", labelCol=LABEL, numTrees=trees,
                                 maxDepth=mc.forest_depth, featureSubsetStrategy="sqrt",
                                 seed=mc.seed, cacheNodeIds=True, **params)


def ridge(alpha: float, n: int) -> LinearRegression:
    """Penalty alpha on the sum of squared errors over n rows."""
    return LinearRegression(featuresCol="features", labelCol=LABEL, standardization=False,
                            regParam=alpha / n, elasticNetParam=0.0)


def model_zoo(train: DataFrame, mc: ModelConfig) -> dict:
    """M1-M9 as Spark ML learners.

    Up to 4096 features the linear ones solve the normal equations, which takes one pass
    over the rows whatever the number of iterations; beyond, Spark iterates over them."""
    n = train.count()
    sd = _label_std(train)
    common = {"featuresCol": "features", "labelCol": LABEL}
    lin = {**common, "standardization": False, "maxIter": 5000}
    # Penalties, rates, depths and fractions of the original learners.
    return {
        "LinearRegression": LinearRegression(**common, regParam=0.0),
        "Ridge": ridge(2.0, n),
        "Lasso": LinearRegression(**lin, **elastic_net_params(0.001, 1.0, sd)),
        "ElasticNet": LinearRegression(**lin, **elastic_net_params(0.001, 0.5, sd)),
        "RandomForest": forest(mc, mc.forest_trees, minInstancesPerNode=2),
        "ExtraTrees": forest(mc, mc.forest_trees, bootstrap=False),
        "GradientBoosting": boosted(mc, mc.small_gbt_rounds, rate=0.1, depth=3, row_share=0.7, feature_share=0.1),
        "XGBoost": boosted(mc, mc.xgb_rounds, rate=0.05, depth=6, row_share=0.8, feature_share=0.8),
        "LightGBM": boosted(mc, mc.lgbm_rounds, rate=0.05, depth=6, row_share=0.8, feature_share=0.8),
    }


def score_usd(model, df: DataFrame, out: str = "prediction_usd") -> DataFrame:
    """Predict log1p(salary) and map back to USD."""
    return model.transform(df).withColumn(out, F.expm1("prediction")).drop("prediction")


class TrainingFailed(RuntimeError):
    """Learners that failed (name -> error), with the ranking and the models of the others."""

    def __init__(self, errors: dict, ranking: DataFrame, fitted: dict):
        super().__init__("; ".join(f"{name}: {type(e).__name__}: {e}" for name, e in errors.items()))
        self.errors, self.ranking, self.fitted = errors, ranking, fitted


def train_all(data: PreparedData, mc: ModelConfig,
              only: list[str] | None = None, parallelism: int = 1) -> tuple[DataFrame, dict]:
    """Fit every learner, score val, time it, rank by RMSE.

    Returns (metrics DataFrame, fitted models). ``parallelism`` fits several
    learners at once from driver threads (each fit is itself a distributed job).
    Metrics rows are tiny; the fits run against the written feature frames.
    A failing learner does not stop the others, but a ranking without it is no result:
    ``TrainingFailed`` names it and holds what the others gave.
    """
    from concurrent.futures import ThreadPoolExecutor
    spark = data.train.sparkSession
    zoo = {k: v for k, v in model_zoo(data.train, mc).items()
           if not only or k in only}
    errors: dict = {}

    def run(item):
        name, est = item
        t0 = time.time()
        try:
            m = est.fit(data.train)
            met = regression_metrics(score_usd(m, data.val), COLS.target,
                                     "prediction_usd").first()
        except Exception as e:  # noqa: BLE001 - raised once the others have ended
            errors[name] = e
            return None
        return name, m, (name, float(met["MAE"]), float(met["RMSE"]), float(met["R2"]),
                         float(met["MAPE"]), round(time.time() - t0, 1))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        results = [r for r in ex.map(run, zoo.items()) if r is not None]
    fitted = {name: m for name, m, _ in results}
    res = spark.createDataFrame([row for _, _, row in results],
                                "model string, MAE double, RMSE double, R2 double, "
                                "MAPE double, seconds double").orderBy("RMSE", "model")
    if errors:
        raise TrainingFailed(errors, res, fitted) from next(iter(errors.values()))
    return res, fitted


def fit_with_early_stopping(data: PreparedData, mc: ModelConfig, rounds: int | None = None, path: str | None = None) -> BoostRun:
    """M10 re-aimed: training ends ``mc.patience`` rounds after the least validation loss, and
    the model keeps the rounds up to it. A run with the same ``path`` goes on where it stopped."""
    return boost(data.train, boosted(mc, rounds or mc.cat_rounds, rate=0.06, depth=6), data.val, mc.patience, path)


# ----------------------------------------------------------------------------- stacking
def out_of_fold(train: DataFrame, bases: dict, mc: ModelConfig, n_folds: int = 5,
                parallelism: int = 1) -> list[DataFrame]:
    """For each unshuffled fold of raw training rows: id, target and one prediction column
    per base learner, everything fitted on the other folds (encoders and preprocessing of all
    folds from one aggregate, ``FoldStatistics``)."""
    from concurrent.futures import ThreadPoolExecutor
    from paysight.operators.fold_statistics import FoldStatistics
    sums = FoldStatistics.of(ordered_folds(train, COLS.id, n_folds, "_fold"), "_fold", mc)

    def one(k: int) -> DataFrame:
        d = sums.prepare(k)
        preds = d.val
        for name, est in bases.items():
            preds = score_usd(est.fit(d.train), preds, f"p_{name}")
        return materialize(preds.select(COLS.id, COLS.target, *[f"p_{n}" for n in bases]), "stack-oof")

    # the folds are independent: run them from driver threads
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        return list(ex.map(one, range(n_folds)))


def stack(split_frame: DataFrame, data: PreparedData, bases: dict, mc: ModelConfig, n_folds: int = 5,
          meta_alpha: float = 1.0, parallelism: int = 1) -> tuple:
    """Out-of-fold base predictions in USD (unshuffled folds of the training rows of
    ``split_frame``), Ridge meta learner on them, bases refitted on all training rows.

    For each fold encoders and preprocessing come from the other folds, so that no
    label of a held-out row reaches its own prediction. Returns (meta model, refitted
    bases); score with ``stack_predict``."""
    from concurrent.futures import ThreadPoolExecutor
    folds = out_of_fold(split_frame.filter(F.col("split") == "train"), bases, mc, n_folds, parallelism)
    oof = folds[0]
    for f in folds[1:]:
        oof = oof.unionByName(f)
    cols = [f"p_{n}" for n in bases]
    meta_in = VectorAssembler(inputCols=cols, outputCol="meta_features").transform(oof)
    n = meta_in.count()
    meta = LinearRegression(featuresCol="meta_features", labelCol=COLS.target,
                            regParam=meta_alpha / n, elasticNetParam=0.0,
                            standardization=False).fit(meta_in)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        refit = dict(zip(bases, ex.map(lambda e: e.fit(data.train), bases.values())))
    return meta, refit


def stack_predict(meta, refit: dict, df: DataFrame) -> DataFrame:
    out = df
    for name, m in refit.items():
        out = score_usd(m, out, f"p_{name}")
    cols = [f"p_{n}" for n in refit]
    out = VectorAssembler(inputCols=cols, outputCol="meta_features").transform(out)
    return meta.transform(out).withColumnRenamed("prediction", "prediction_usd")


# ----------------------------------------------------------------------------- deploy
def deploy_compact(data: PreparedData, learner: Boosting, reference: DataFrame | None = None) -> tuple:
    """Refit one boosted model with tuned params; metrics rows tagged by role,
    keeping the ensemble's metrics (``reference``) alongside."""
    m = learner.fit(data.train)
    frames = []
    for split, df in [("val", data.val), ("test", data.test)]:
        met = regression_metrics(score_usd(m, df), COLS.target, "prediction_usd")
        frames.append(met.select(F.lit("deployed").alias("role"), F.lit(split).alias("split"),
                                 "MAE", "RMSE", "R2", "MAPE"))
    out = frames[0].unionByName(frames[1])
    if reference is not None:
        out = out.unionByName(reference.select(F.lit("reference").alias("role"), "split", "MAE",
                                               "RMSE", "R2", "MAPE"))
    return m, out


# ----------------------------------------------------------------------------- CV
def cross_validate(frame: DataFrame, estimators: dict, mc: ModelConfig, n_folds: int = 5,
                   id_col: str = COLS.id, parallelism: int = 1) -> DataFrame:
    """V4 for learners: shuffled k folds over all prepared rows; per fold the encoders
    and the preprocessing come from the other folds (no leakage; one aggregate for all folds,
    ``FoldStatistics``), each learner is fitted and scored on the held-out fold (V1 by fold).

    Returns per-fold metrics (model, fold, n, MAE, RMSE, R2, MAPE); summarise with
    ``evaluate.cv_summary``."""
    from concurrent.futures import ThreadPoolExecutor
    from functools import reduce

    from paysight.operators.fold_statistics import FoldStatistics
    sums = FoldStatistics.of(hash_folds(frame.drop("split"), id_col, n_folds, mc.seed + 2, "_cv_fold"), "_cv_fold", mc, id_col)

    def one(k: int) -> list[DataFrame]:
        data, out = sums.prepare(k, id_col), []
        for name, est in estimators.items():
            met = regression_metrics(score_usd(est.fit(data.train), data.val), COLS.target, "prediction_usd")
            out.append(materialize(met.select(F.lit(name).alias("model"), F.lit(k).alias("fold"), "*"), "cv-fold"))
        return out
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        return reduce(DataFrame.unionByName, [m for part in ex.map(one, range(n_folds)) for m in part])
