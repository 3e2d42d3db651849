"""A learner that fails is no shorter ranking."""

from types import SimpleNamespace as N

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from paysight.config import COLS, ModelConfig
from paysight.operators import models as M


class Failing:
    def fit(self, rows):
        raise ValueError("no memory left")


def test_a_failing_learner_is_named_after_the_others_have_ended(spark, monkeypatch):
    rows = spark.createDataFrame([(float(i % 7) / 7 + 10, Vectors.dense(float(i % 7), float(i % 5))) for i in range(60)], [M.LABEL, "features"])
    rows = rows.withColumn(COLS.target, F.expm1(M.LABEL))
    good = LinearRegression(featuresCol="features", labelCol=M.LABEL)
    monkeypatch.setattr(M, "model_zoo", lambda train, mc: {"Bad": Failing(), "Good": good})
    data = N(train=rows, val=rows)
    with pytest.raises(M.TrainingFailed, match="Bad: ValueError: no memory left") as failed:
        M.train_all(data, ModelConfig(), parallelism=2)
    assert set(failed.value.errors) == {"Bad"} and set(failed.value.fitted) == {"Good"}
    assert [r.model for r in failed.value.ranking.collect()] == ["Good"]
    ranking, fitted = M.train_all(data, ModelConfig(), only=["Good"])
    assert [r.model for r in ranking.collect()] == ["Good"] == list(fitted)
