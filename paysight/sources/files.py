"""File sources and sinks (S1, S2, S4-S7) with declared schemas, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysight.config import CSV_NULL_TOKENS


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             null_tokens: list[str] = CSV_NULL_TOKENS) -> DataFrame:
    """Full CSV scan with a declared schema.

    Every column is read as text (quoted, multi-line fields allowed), the usual
    missing-value spellings become NULL in one expression per column, and only
    then are values cast to the declared types (``try_cast``: a bad number is NULL,
    not an error). Selecting columns afterwards prunes the scan (S2).
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    raw = (spark.read.schema(as_text).option("header", True).option("multiLine", True)
           .option("escape", '"').option("mode", "PERMISSIVE").csv(path))
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        c = F.when(c.isin(*null_tokens), F.lit(None)).otherwise(c)
        if not isinstance(f.dataType, T.StringType):
            c = c.try_cast(f.dataType)
        out.append(c.alias(f.name))
    return raw.select(*out)


def write_csv(df: DataFrame, path: str) -> None:
    """Ranked table as CSV with a header (overwrite)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Re-read a written table with its schema."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Metrics as JSON lines (overwrite)."""
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON source with a declared schema; a missing path is an empty frame."""
    try:
        return spark.read.schema(schema).json(path)
    except Exception as e:  # noqa: BLE001 - a missing report is tolerated
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def report_lines(sections: list[tuple[str, DataFrame]]) -> DataFrame:
    """(section, metric, value) rows from one-row metric frames (unpivoted)."""
    frames = []
    for name, df in sections:
        cols = df.columns
        long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
            [], cols, "metric", "value")
        frames.append(long.select(F.lit(name).alias("section"), "metric", "value"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def write_report(df: DataFrame, path: str) -> None:
    """The report as parquet plus a text rendering (one line per metric)."""
    df.write.mode("overwrite").parquet(f"{path}/table")
    df.select(F.concat_ws(" | ", "section", "metric", F.col("value").cast("string"))
              .alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/text")


def save_model(model, path: str) -> None:
    """Persist a fitted PipelineModel (or any MLWritable)."""
    model.write().overwrite().save(path)


def load_model(path: str, optional: bool = False):
    """Load a PipelineModel; ``optional`` returns None when it is absent."""
    from pyspark.ml import PipelineModel
    try:
        return PipelineModel.load(path)
    except Exception:  # noqa: BLE001
        if optional:
            return None
        raise


def load_reports(spark: SparkSession, paths: dict[str, str], schema: T.StructType) -> DataFrame:
    """Read every metrics table (JSON) that exists, tag it with its name and
    union them; a missing report contributes nothing instead of failing."""
    frames = [read_json(spark, p, schema).withColumn("report", F.lit(name))
              for name, p in paths.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
