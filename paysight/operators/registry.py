"""The run registry: one append-only record from training to deployment.

Every step (training a learner, a search, the stack, a deployment) adds one row: its key, its
parameters, its metrics on each split, where its model lies, and the step it came from. The
key is a digest of the step's name and parameters, so a repeated step finds its row and changes nothing.
The champion is an aggregate over the record, not a file that is overwritten: the step of least
validation RMSE, the earlier one among equals (a challenger must be strictly better).

Rows are Parquet files of their own under the registry's folder; nothing is ever rewritten.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

SCHEMA = ("key string, step string, model string, parent string, params string, path string, recorded timestamp, "
          "metrics map<string, struct<MAE: double, RMSE: double, R2: double, MAPE: double>>")
METRICS = ("MAE", "RMSE", "R2", "MAPE")


def step_key(step: str, params: dict) -> str:
    return hashlib.sha256(f"{step}:{json.dumps(params, sort_keys=True, default=str)}".encode()).hexdigest()[:24]


@dataclass
class Registry:
    spark: SparkSession
    path: str

    def table(self) -> DataFrame:
        """All recorded steps (none: an empty table)."""
        try:
            return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/steps")
        except AnalysisException:
            return self.spark.createDataFrame([], SCHEMA)

    def find(self, key: str) -> Row | None:
        return self.table().where(F.col("key") == key).orderBy("recorded").first()

    def step(self, step: str, params: dict, run: Callable[[str], tuple[str, dict, dict]], parent: str | None = None) -> Row:
        """The row of a step; ``run(folder)`` does it and returns (model name, metrics by split,
        results that later steps need) unless it is recorded already. ``folder`` depends on the key alone,
        so that a step that was broken off finds what it has left there."""
        key = step_key(step, params)
        if (row := self.find(key)) is not None:
            return row
        folder = f"{self.path}/models/{key}"
        model, metrics, results = run(folder)
        kept = {split: tuple(float(m[c]) for c in METRICS) for split, m in metrics.items()}
        now = self.spark.sql("SELECT current_timestamp()").first()[0]
        row = (key, step, model, parent, json.dumps({**params, **results}, sort_keys=True, default=str), folder, now, kept)
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/steps")
        return self.find(key)

    def champion(self, steps: list[str] | None = None) -> Row | None:
        """The step of least validation RMSE (M15), the earlier one among equals."""
        rows = self.table().where(F.col("metrics")["val"].isNotNull())
        rows = rows.where(F.col("step").isin(steps)) if steps else rows
        best = rows.agg(F.min_by(F.struct(*rows.columns), F.struct(F.col("metrics")["val"]["RMSE"], "recorded", "key")).alias("b")).first().b
        return best

    def metrics(self) -> DataFrame:
        """(step, model, split, MAE, RMSE, R2, MAPE) of all steps."""
        rows = self.table().select("step", "model", F.explode("metrics").alias("split", "m"))
        return rows.select("step", "model", "split", *[F.col("m")[c].alias(c) for c in METRICS])


def params_of(row: Row) -> dict:
    return json.loads(row.params)
