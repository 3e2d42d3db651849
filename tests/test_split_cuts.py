"""The split by cut points."""

from collections import Counter

import pytest

from paysight.operators import split as SP


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("copies", [1, 4])
def test_split_sizes_hold_with_repeated_ids_and_no_wide_sort(spark, copies):
    df = spark.range(101 * copies).selectExpr(f"case when id = 0 then null else id div {copies} end pid", "id x")
    n = 101 * copies - 1  # a row without id has no place in the order
    s = SP.train_val_test(df, "pid")
    n_test, n_val = SP.split_sizes(n)
    got = s.collect()
    assert Counter(r.split for r in got) == {"test": n_test, "val": n_val, "train": n - n_test - n_val}
    assert sorted(r.x for r in got) == list(range(1, 101 * copies))
    place = {"test": 0, "val": 1, "train": 2}
    h = {r.pid: r.h for r in df.select("pid", SP.portable_hash("pid").alias("h")).collect()}
    order = [place[r.split] for r in sorted(got, key=lambda r: (h[r.pid], r.pid, place[r.split]))]
    assert order == sorted(order)
    assert "Window" not in plan_of(s) and "Sort" not in plan_of(s)
