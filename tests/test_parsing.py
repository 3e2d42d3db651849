"""Edge rows for the scalar functions (expected answers by reading the original code)."""

from pyspark.sql import functions as F

from paysight.functions import parsing as P
from paysight.functions import request as R
from paysight.functions import text as X


def _one(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_f1_parse_skill_list(spark):
    vals = ["['Python ', 'SQL']", "[\"women's\", 'c++']", "('a', 'b')", None, "", "nan",
            "{'a': 1}", "[", "[]", "('a',)"]
    got = _one(spark, vals, P.parse_skill_list)
    assert got[0] == ["python", "sql"]
    assert got[1] == ["women's", "c++"]
    assert got[2] == ["a", "b"]
    for i in (3, 4, 5, 6, 7, 8):
        assert got[i] == [], (vals[i], got[i])
    assert got[9] == ["a"]


def test_f2_f3_text_and_count(spark):
    got = _one(spark, ["['power bi', 'sql', 'sql']", None],
               lambda c: F.struct(P.skills_text(P.parse_skill_list(c)).alias("t"),
                                  P.n_items(P.parse_skill_list(c)).alias("n")))
    assert (got[0]["t"], got[0]["n"]) == ("power bi sql sql", 3)
    assert (got[1]["t"], got[1]["n"]) == ("", 0)


def test_f5_f6_title_length_and_words(spark):
    got = _one(spark, ["", "a b  c", None, "x y"],
               lambda c: F.struct(X.text_length(c).alias("l"), X.word_count(c).alias("w")))
    assert [(g["l"], g["w"]) for g in got] == [(0, 0), (6, 3), (0, 0), (3, 2)]


def test_f7_int_flag(spark):
    vals = ["True", "TRUE", "yes", "t", "1", "1.0", None, "no"]
    assert _one(spark, vals, X.int_flag) == [1, 1, 1, 1, 1, 0, 0, 0]


def test_f8_seniority(spark):
    vals = ["Sr. Data Eng", "Senior intern", "Mid-level", "Internal auditor", None,
            "Head of Data", "Data Scientist"]
    assert _one(spark, vals, X.seniority_score) == [2, -1, 0, 0, 0, 2, 0]


def test_f9_posted_month(spark):
    assert _one(spark, ["2023-06-16 13:44:15", "bad", None], X.posted_month) == [6, 0, 0]


def test_f10_skill_categories(spark):
    vals = ["{'async': ['x'], 'other': ['a','b'], 'cloud': []}",
            "{'other': ['a','b'], 'async': ['x']}",
            "{'cloud': 'abc', 'databases': ['x']}",
            "{'cloud': ['x'], 'cloud': ['y','z']}",
            None, "", "['a']",
            "{'programming': ['python', 'sql'], 'libraries': ['pandas']}"]
    got = _one(spark, vals, P.skill_category_counts)
    assert (got[0]["cat_other"], got[0]["cat_cloud"], got[0]["n_skill_categories"]) == (2, 0, 2)
    assert (got[1]["cat_other"], got[1]["n_skill_categories"]) == (3, 2)
    assert (got[2]["cat_cloud"], got[2]["cat_databases"], got[2]["n_skill_categories"]) == (0, 1, 1)
    assert (got[3]["cat_cloud"], got[3]["n_skill_categories"]) == (2, 1)
    for i in (4, 5, 6):
        assert all(v == 0 for v in got[i].asDict().values()), vals[i]
    assert (got[7]["cat_programming"], got[7]["cat_libraries"], got[7]["n_skill_categories"]) \
        == (2, 1, 2)


def test_c8_bool_code(spark):
    assert _one(spark, ["True", "False", None], X.bool_code) == [1, 0, -1]


def test_f12_comma_list(spark):
    got = _one(spark, [" , SQL,,", "python, Pytorch", None], P.split_comma_list)
    assert got == [["sql"], ["python", "pytorch"], []]


def test_f13_contract_map(spark):
    vals = ["CDI", "CDD", "contractor", "Part-Time", "temporary", "", None]
    assert _one(spark, vals, R.contract_to_schedule) == [
        "Full-time", "Contractor", "Full-time", "Part-time", "Temp work", "Full-time",
        "Full-time"]


def test_f14_level_injection(spark):
    df = spark.createDataFrame([("Data Analyst", "Junior"), ("Senior Data Scientist", "senior"),
                                ("Engineer", ""), ("Engineer", None)], "t string, l string")
    got = [r[0] for r in df.select(R.inject_level("t", "l")).collect()]
    assert got == ["Junior Data Analyst", "Senior Data Scientist", "Engineer", "Engineer"]


def test_f15_falsy_default(spark):
    got = _one(spark, ["", None, "Acme"], lambda c: R.falsy_default(c, "unknown"))
    assert got == ["unknown", "unknown", "Acme"]
