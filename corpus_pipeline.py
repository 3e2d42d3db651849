"""The corpus pipeline: five operators over the documents, one after another.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all its
predecessor kept. ``run`` writes each result as Parquet into the shared folder and reads it
again as the next stage's input, so an executor lost later costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paysight.llm import bpe, language, mixing, quality, simhash
from paysight.llm.common import table
from paysight.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents predicted as bad go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language that can be told go."""
    return language.keep_known(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the document of least id of each group stays."""
    return simhash.keep_one_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as its source's target takes it."""
    return mixing.mix(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: token counts and digests of ids and round trip of each emitted document."""
    return bpe.token_digests(docs)


STAGES = [("quality", quality_stage), ("language", language_stage), ("near_dedup", near_dedup_stage),
          ("mixing", mixing_stage), ("encoding", encoding_stage)]

#: Nearest-neighbour votes, a trained classifier, xxh64 bit majorities and BPE have no SQL form;
#: the pipeline is tested against brute-force versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
