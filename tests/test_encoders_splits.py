"""Fitted transforms and splits: unseen handling, out-of-fold property, exact sizes."""

import math

import pandas as pd
from pyspark.sql import functions as F

from paysight.operators import encoders as T
from paysight.operators import split as SP


def test_t2_rare_bucket_and_unseen(spark):
    train = spark.createDataFrame([("a",)] * 12 + [("b",)] * 3, "c string")
    fitted = T.frequent_categories(train, "c", 10)
    df = spark.createDataFrame([("a",), ("b",), ("zz",)], "c string")
    got = dict(T.one_hot_slot(df, fitted, "c", "slot").select("c", "slot").collect())
    assert got == {"a": "a", "b": "__infrequent__", "zz": None}


def test_t3_unseen_gets_global_mean(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0)], "c string, y double")
    enc, gm = T.fit_target_encoding(train, "c", "y")
    df = spark.createDataFrame([("zz",)], "c string")
    got = T.apply_target_encoding(df, enc, gm, "c", "te").first()["te"]
    assert abs(got - 14.0 / 3) < 1e-12


def test_t3_crossfit_equals_brute_force(spark):
    rows = [(i, f"k{i % 7}", float((i * 37) % 101) / 10.0, i % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, c string, y double, fold int")
    table = T.target_encode_crossfit(df, "c", "y", "fold")
    got = {r["id"]: r["te"] for r in
           T.apply_crossfit_encoding(df, table, "c", "fold", "te").collect()}
    pdf = pd.DataFrame(rows, columns=["id", "c", "y", "fold"])
    for _, r in pdf.iterrows():
        other = pdf[pdf.fold != r.fold]
        gmean, gvar = other.y.mean(), other.y.var(ddof=0)
        cat = other[other.c == r.c].y
        n = len(cat)
        lam = n * gvar / (n * gvar + cat.var(ddof=0))
        exp = lam * cat.mean() + (1 - lam) * gmean
        assert abs(got[r.id] - exp) < 1e-9


def test_tfidf_smooth_idf_and_l2(spark):
    docs = spark.createDataFrame([(1, "a b b"), (2, "a c")], "id int, t string")
    terms = T.skill_terms(docs, "id", "t")
    w = T.tfidf_long(terms, "id", docs.select("id"), 10)
    got = {(r["id"], r["term"]): r["weight"] for r in w.collect()}
    idf_a, idf_b = math.log(3 / 3) + 1, math.log(3 / 2) + 1
    norm1 = math.sqrt(idf_a ** 2 + (2 * idf_b) ** 2)
    assert abs(got[(1, "b")] - 2 * idf_b / norm1) < 1e-12
    assert abs(got[(1, "a")] - idf_a / norm1) < 1e-12


def test_p1_split_exact_sizes_disjoint_complete(spark):
    df = spark.range(1000).withColumnRenamed("id", "pid")
    s = SP.train_val_test(df, "pid")
    counts = dict(s.groupBy("split").count().collect())
    n_test = math.ceil(0.15 * 1000)
    n_val = math.ceil(0.15 / 0.85 * (1000 - n_test))
    assert counts == {"test": n_test, "val": n_val, "train": 1000 - n_test - n_val}
    assert s.select("pid").distinct().count() == 1000


def test_global_position_matches_sort(spark):
    df = spark.range(500).withColumn("k", (F.col("id") * 7919) % 503)
    p = SP.global_position(df, ["k", "id"], "pos")
    got = [r["id"] for r in p.orderBy("pos").collect()]
    exp = [r["id"] for r in df.orderBy("k", "id").collect()]
    assert got == exp
    assert [r["pos"] for r in p.orderBy("pos").collect()] == list(range(500))


def test_p3_ordered_folds_sizes(spark):
    df = spark.range(23).withColumnRenamed("id", "pid")
    f = SP.ordered_folds(df, "pid", 5)
    sizes = sorted(f.groupBy("fold").count().collect())
    assert [r["count"] for r in sizes] == [5, 5, 5, 4, 4]
    firsts = [r["pid"] for r in f.filter(F.col("fold") == 0).orderBy("pid").collect()]
    assert firsts == [0, 1, 2, 3, 4]


def test_hash_position_matches_sort(spark):
    df = spark.range(3000).withColumnRenamed("id", "pid").withColumn(
        "h", SP.portable_hash("pid"))
    p = SP.hash_position(df, "h", "pid", "pos", buckets=16)
    got = [r["pid"] for r in p.orderBy("pos").collect()]
    exp = [r["pid"] for r in df.orderBy("h", "pid").collect()]
    assert got == exp
    assert sorted(r["pos"] for r in p.collect()) == list(range(3000))


def test_hot_key_third_of_rows_results_whole(spark):
    """One category holds a third of all rows: encodings and item statistics stay
    exact (partial aggregation, no row dropped or capped)."""
    from paysight.operators import eda
    n = 3000
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 17}", float((i * 31) % 97), i % 5)
            for i in range(n)]
    df = spark.createDataFrame(rows, "id int, c string, y double, fold int")
    table = T.target_encode_crossfit(df, "c", "y", "fold")
    got = T.apply_crossfit_encoding(df, table, "c", "fold", "te")
    assert got.count() == n
    pdf = pd.DataFrame(rows, columns=["id", "c", "y", "fold"])
    hot_rows = {r["id"]: r["te"] for r in got.filter(F.col("c") == "hot").collect()}
    for fold in range(5):
        other = pdf[pdf.fold != fold]
        cat = other[other.c == "hot"].y
        gv = other.y.var(ddof=0)
        lam = len(cat) * gv / (len(cat) * gv + cat.var(ddof=0))
        exp = lam * cat.mean() + (1 - lam) * other.y.mean()
        some = pdf[(pdf.c == "hot") & (pdf.fold == fold)].id.iloc[0]
        assert abs(hot_rows[some] - exp) < 1e-9
    items = spark.createDataFrame([(i, ["hot"] if i % 3 == 0 else [f"s{i % 7}"], float(i))
                                   for i in range(n)], "id int, items array<string>, y double")
    top = {r["item"]: r["n_postings"] for r in eda.item_frequency(items, "items", 10).collect()}
    assert top["hot"] == n // 3
