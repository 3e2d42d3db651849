"""The ``postings`` view: job-posting shaped rows derived from the driver tables.

One posting per order. Items (skills) are the distinct part names on the order's
lines; the structured skills map groups them by a category taken from the part
type. All list/map text is produced in the same Python-literal layout as the
original CSV so the parsing functions see realistic input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysight.sources.tables import load_table

# Part type -> skill category of the derived map. STANDARD maps to a
# deliberately unknown category so the "unknown adds to other" rule is exercised.
PART_TYPE_CATEGORY = {
    "ECONOMY": "programming",
    "LARGE": "databases",
    "MEDIUM": "cloud",
    "PROMO": "libraries",
    "SMALL": "other",
    "STANDARD": "async",
}

# Order priority -> seniority word prefixed to the title.
PRIORITY_LEVEL = {
    "1-URGENT": "Senior ",
    "2-HIGH": "Lead ",
    "3-MEDIUM": "Mid ",
    "5-LOW": "Junior ",
}
# What the derived salary pays for each seniority level (default below), for
# each step of the nation key, for remote work, and what outliers get on top. The rest
# of it is noise: the order total modulo NOISE.
LEVEL_PAY = {"1-URGENT": 128_000.0, "2-HIGH": 96_000.0, "3-MEDIUM": 64_000.0, "5-LOW": 0.0}
OTHER_PAY, NATION_PAY, REMOTE_PAY, OUTLIER_PAY, NOISE = 32_000.0, 2_500.0, 20_000.0, 400_000.0, 80_000.0


POSTINGS_SCHEMA = T.StructType([
    T.StructField("posting_id", T.LongType(), False),
    T.StructField("job_title", T.StringType()),
    T.StructField("job_title_short", T.StringType()),
    T.StructField("job_schedule_type", T.StringType()),
    T.StructField("salary_rate", T.StringType()),
    T.StructField("salary_year_avg", T.DoubleType()),
    T.StructField("salary_hour_avg", T.DoubleType()),
    T.StructField("job_country", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("job_location", T.StringType()),
    T.StructField("job_work_from_home", T.StringType()),
    T.StructField("job_no_degree_mention", T.StringType()),
    T.StructField("job_health_insurance", T.StringType()),
    T.StructField("job_posted_date", T.StringType()),
    T.StructField("job_skills", T.StringType()),
    T.StructField("job_type_skills", T.StringType()),
])


def _lookup(col: Column, mapping: dict[str, str], default: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[col], default)


def salary() -> Column:
    """Yearly pay with a planted signal: seniority, nation, remote flag, noise, a few outliers."""
    k = F.col("o_orderkey")
    level = F.lit(OTHER_PAY)
    for priority, pay in LEVEL_PAY.items():
        level = F.when(F.col("o_orderpriority") == priority, F.lit(pay)).otherwise(level)
    fixed = (level + F.coalesce(F.col("c_nationkey"), F.lit(0)) * NATION_PAY
             + F.when(k % 3 == 0, F.lit(REMOTE_PAY)).otherwise(0.0)
             + F.when(k % 50 == 7, F.lit(OUTLIER_PAY)).otherwise(0.0))
    return fixed + F.col("o_totalprice") % NOISE


def _quoted_list(arr: Column) -> Column:
    """array<string> -> "['a', 'b']"."""
    return F.concat(F.lit("["),
                    F.array_join(F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))),
                                 ", "),
                    F.lit("]"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: sorted distinct item names and the category map text.

    One shuffle on the order key: ``collect_set`` de-duplicates map-side, so an
    order holding a huge share of lines still ships at most its distinct
    (category, item) pairs to the reducer. Everything else is per-row array work.
    """
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = load_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    cat = _lookup(F.col("p_type"), PART_TYPE_CATEGORY, F.lower(F.col("p_type")))
    pairs = (li.join(part, li.l_partkey == part.p_partkey)
             .select(F.col("l_orderkey").alias("k"),
                     F.struct(cat.alias("cat"), F.col("p_name").alias("name")).alias("ci")))
    per_order = pairs.groupBy("k").agg(F.collect_set("ci").alias("ci"))
    names = F.array_sort(F.array_distinct(F.transform("ci", lambda x: x["name"])))
    cats = F.array_sort(F.array_distinct(F.transform("ci", lambda x: x["cat"])))

    def entry(c: Column) -> Column:
        in_cat = F.array_sort(F.array_distinct(
            F.transform(F.filter("ci", lambda x: x["cat"] == c), lambda x: x["name"])))
        return F.concat(F.lit("'"), c, F.lit("': "), _quoted_list(in_cat))

    type_text = F.concat(F.lit("{"), F.array_join(F.transform(cats, entry), ", "), F.lit("}"))
    return per_order.select("k", _quoted_list(names).alias("job_skills"),
                            type_text.alias("job_type_skills"))


def postings(spark: SparkSession, sf_dir: str, with_items: bool = True) -> DataFrame:
    """Build the postings frame (column layout of the raw job-postings CSV).

    ``with_items=False``: for readers of no skill column, which are null then; the same rows
    without a look at the order lines."""
    o = load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    c = load_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # nation is a fixed 25-row dimension: broadcasting it is size-bounded.
    n = F.broadcast(load_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    k = F.col("o_orderkey")
    pay = salary()
    level = _lookup(F.col("o_orderpriority"), PRIORITY_LEVEL, F.lit(""))
    df = (o.join(c, o.o_custkey == c.c_custkey, "left")
          .join(n, F.col("c_nationkey") == n.n_nationkey, "left"))
    if with_items:
        items = order_items(spark, sf_dir)  # one row an order
        df = df.join(items, k == items.k, "left")
    else:
        df = df.withColumns({c: F.lit(None).cast("string") for c in ("job_skills", "job_type_skills")})
    return df.select(
        k.alias("posting_id"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(level, F.col("c_mktsegment"), F.lit(" Engineer")))
         .alias("job_title"),
        F.col("c_mktsegment").alias("job_title_short"),
        F.when(k % 53 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus"))
         .alias("job_schedule_type"),
        F.when(k % 10 == 0, F.lit("hour")).otherwise(F.lit("year")).alias("salary_rate"),
        F.when(k % 10 == 0, F.lit(None).cast("double"))
         .when(k % 10 == 1, F.lit(0.0))
         .otherwise(pay).alias("salary_year_avg"),
        F.when(k % 10 == 0, pay / 2080.0).alias("salary_hour_avg"),
        F.col("n_name").alias("job_country"),
        F.col("c_name").alias("company_name"),
        F.concat(F.col("n_name"), F.lit("-"), F.col("c_mktsegment")).alias("job_location"),
        F.when(k % 3 == 0, F.lit("True")).otherwise(F.lit("False")).alias("job_work_from_home"),
        F.when(k % 5 == 0, F.lit("true")).alias("job_no_degree_mention"),
        F.when(k % 2 == 0, F.lit("1")).otherwise(F.lit("0")).alias("job_health_insurance"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("job_posted_date"),
        F.col("job_skills"),
        F.col("job_type_skills"),
    )
