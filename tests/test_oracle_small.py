"""Spark queries against their DuckDB oracle on the smallest tables (a fast subset;
tools/oracle_check.py runs every query)."""

import math

import duckdb
import pytest

from conftest import SF_SMALL

NAMES = ["postings_view", "f1_parse_skills", "f10_skill_categories", "c6_feature_frame",
         "a1_describe", "a6_histograms", "a9_box_stats", "a12_highest_paying_items",
         "w5_mean_skills", "w9_inclusion", "p1_split", "t3_target_encoding",
         "t5_title_tfidf", "r1_request_features", "v4_cv_baseline", "v6_band_table"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x.item() if hasattr(x, "item") else x) for x in r)
           for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    from paysight.sources.tables import DRIVER_TABLES, table_path
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    exp = duck.execute(E.oracle_sql()[name]).df()
    assert _rows(got) == _rows(exp)


def test_entry_has_rows(spark):
    import __spark_entry__ as E
    assert E.entry(spark).count() > 0
