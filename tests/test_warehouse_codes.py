"""Warehouse count options and category codes."""

from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_w3_approx_distinct_close_to_exact(spark):
    from paysight.operators.warehouse import count_diagnostics
    from paysight.sources.warehouse import register_star_schema
    register_star_schema(spark, SF_SMALL)
    exact = dict(count_diagnostics(spark).collect())
    approx = dict(count_diagnostics(spark, approx=True).collect())
    k = "facts_with_any_skill"
    assert abs(approx[k] - exact[k]) <= 0.15 * exact[k]
    assert {m: v for m, v in approx.items() if m != k} == {m: v for m, v in exact.items() if m != k}


def test_c8_codes_are_sorted_distinct_positions(spark):
    from paysight.operators.features import code_column
    vals = [(i, None if i % 11 == 0 else f"v{(i * 7) % 50:03d}") for i in range(400)]
    df = spark.createDataFrame(vals, "id int, c string")
    got = {r["id"]: r["c_code"] for r in code_column(df, "c").collect()}
    order = sorted({v for _, v in vals if v is not None})
    exp = {i: (-1 if v is None else order.index(v)) for i, v in vals}
    assert got == exp
    assert df.count() == code_column(df, "c").filter(F.col("c_code") >= -1).count()
