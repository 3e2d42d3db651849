"""Star-schema views over the driver tables (the warehouse the diagnostics query).

``fact_jobs`` is one row per order with the posting's salary rules; the bridge is
``lineitem``; dimensions are ``customer`` (job), ``part`` (skills), ``supplier``
(company), ``nation`` (location) and the distinct order dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysight.sources.tables import load_table

STAR_VIEWS = ["fact_jobs", "bridge_job_skills", "dim_job", "dim_job_skills", "dim_company",
              "dim_location", "dim_date"]


def fact_jobs(spark: SparkSession, sf: str) -> DataFrame:
    o = load_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("job_fact_id"), F.col("o_custkey").alias("job_id"),
        F.date_format(F.col("o_orderdate"), "yyyyMMdd").cast("int").alias("date_id"),
        F.when(k % 10 == 0, F.lit(None).cast("double")).when(k % 10 == 1, F.lit(0.0))
         .otherwise(F.col("o_totalprice")).alias("salary_average_year"),
        F.when(k % 10 == 0, F.col("o_totalprice") / 2080.0).alias("salary_average_hour"))


def star_schema(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    li = load_table(spark, sf, "lineitem")
    return {
        "fact_jobs": fact_jobs(spark, sf),
        "bridge_job_skills": li.select(F.col("l_orderkey").alias("job_fact_id"),
                                       F.col("l_partkey").alias("skill_id")),
        "dim_job": load_table(spark, sf, "customer").select(
            F.col("c_custkey").alias("job_id"), F.col("c_mktsegment").alias("job_title_short")),
        "dim_job_skills": load_table(spark, sf, "part").select(
            F.col("p_partkey").alias("skill_id"), F.col("p_name").alias("skills"),
            F.col("p_type").alias("type")),
        "dim_company": load_table(spark, sf, "supplier").select(
            F.col("s_suppkey").alias("company_id"), F.col("s_name").alias("company_name")),
        "dim_location": load_table(spark, sf, "nation").select(
            F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("job_country"),
            F.col("n_regionkey").alias("region_id")),
        "dim_date": load_table(spark, sf, "orders").select(
            F.date_format(F.col("o_orderdate"), "yyyyMMdd").cast("int").alias("date_id"))
        .distinct(),
    }


def register_star_schema(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    views = star_schema(spark, sf)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
