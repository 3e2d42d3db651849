"""Intermediate tables shared by the registered queries within one session.

The split frame (prepared postings with their train / val / test label) is
computed once per (session, data folder), written to the shared folder, and
re-read by every query that needs it: the same reuse a warehouse would get from
a materialised table, and a lost executor re-reads files instead of recomputing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paysight.config import COLS
from paysight.operators.features import feature_projection, prepared
from paysight.operators.split import train_val_test
from paysight.sources.postings import postings

CACHE: dict = {}


def split_frame(spark: SparkSession, sf: str) -> DataFrame:
    key = ("split", spark.sparkContext.applicationId, sf)
    if key not in CACHE:
        # the columns that queries read (C6), written by the split itself
        CACHE[key] = train_val_test(feature_projection(prepared(postings(spark, sf))), COLS.id)
    return CACHE[key]
