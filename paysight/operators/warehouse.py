"""Star-schema diagnostics.

Bridge-side work is aggregated before it is joined: a fact holding a third of
all bridge rows collapses to one partial row per map task, so no join task
receives the hot key's raw rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text SQL over the registered views (W1-W3): the warehouse query path.
COUNT_SQL = {
    "salaried_year_count":
        "SELECT COUNT(*) AS n FROM fact_jobs WHERE salary_average_year IS NOT NULL",
    "salaried_year_positive_count":
        "SELECT COUNT(*) AS n FROM fact_jobs WHERE salary_average_year > 0",
    "salaried_hour_count":
        "SELECT COUNT(*) AS n FROM fact_jobs WHERE salary_average_hour IS NOT NULL",
    "fact_total": "SELECT COUNT(*) AS n FROM fact_jobs",
    "facts_with_any_skill":
        "SELECT COUNT(DISTINCT job_fact_id) AS n FROM bridge_job_skills",
}


def count_diagnostics(spark: SparkSession, approx: bool = False) -> DataFrame:
    """One row per named count, each a text SQL query over the views.

    ``approx`` swaps the exact distinct count for a HyperLogLog estimate (one
    small sketch per task instead of a shuffle of the distinct keys)."""
    def text(q: str) -> str:
        return q.replace("COUNT(DISTINCT job_fact_id)", "approx_count_distinct(job_fact_id)") \
            if approx else q
    frames = [spark.sql(text(q)).select(F.lit(name).alias("metric"),
                                        F.col("n").cast("long").alias("n"))
              for name, q in COUNT_SQL.items()]
    return reduce(DataFrame.unionByName, frames)


def _salaried_facts(fact: DataFrame, positive: bool) -> DataFrame:
    cond = (F.col("salary_average_year") > 0) if positive else \
        F.col("salary_average_year").isNotNull()
    return fact.filter(cond)


def facts_with_skill(fact: DataFrame, bridge: DataFrame, positive: bool = False) -> DataFrame:
    """Salaried facts having at least one bridge row (semi join on distinct keys)."""
    keys = bridge.select("job_fact_id").distinct()
    return (_salaried_facts(fact, positive).join(keys, "job_fact_id", "left_semi")
            .agg(F.count("*").alias("n")))


def mean_skills_per_fact(fact: DataFrame, bridge: DataFrame, positive: bool = False) -> DataFrame:
    """Mean bridge rows per salaried fact, over facts that have any."""
    per = bridge.filter(F.col("skill_id").isNotNull()).groupBy("job_fact_id").agg(
        F.count("*").alias("cnt"))
    j = _salaried_facts(fact, positive).select("job_fact_id").join(per, "job_fact_id")
    return j.agg(F.avg(F.col("cnt").cast("double")).alias("avg_skills"))


def titles_by_count(fact: DataFrame, dim_job: DataFrame, top: int = 15,
                    positive: bool = False) -> DataFrame:
    """Salaried facts per job title with mean salary, most frequent first.

    Facts are pre-aggregated per job key (sum, count) before the dimension join,
    so the join sees one row per key instead of one per fact.
    """
    per_job = (_salaried_facts(fact, positive).groupBy("job_id")
               .agg(F.count("*").alias("n"), F.sum("salary_average_year").alias("s")))
    j = per_job.join(dim_job, "job_id")
    g = j.groupBy("job_title_short").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    return (g.select("job_title_short", F.col("n").cast("long").alias("n"),
                     (F.col("s") / F.col("n")).alias("avg_salary"))
            .orderBy(F.desc("n"), "job_title_short").limit(top))


def table_row_counts(views: dict[str, DataFrame]) -> DataFrame:
    """Every view with its row count, largest first."""
    frames = [df.agg(F.count("*").alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in views.items()]
    return reduce(DataFrame.unionByName, frames).orderBy(F.desc("row_count"), "table_name")


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def column_catalogue(views: dict[str, DataFrame], exact: bool = True) -> DataFrame:
    """One row per column: type, nullable, position and a one-pass profile
    (null %, distinct values, numeric min / max). ``exact=False`` uses HLL."""
    frames = []
    for name, df in views.items():
        fields = df.schema.fields
        aggs = []
        for f in fields:
            c = F.col(f.name)
            nd = F.count_distinct(c) if exact else F.approx_count_distinct(c)
            num = isinstance(f.dataType, _NUMERIC)
            aggs.append(F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("nullable"),
                F.lit(fields.index(f) + 1).alias("ordinal"),
                (F.avg(c.isNull().cast("double")) * 100).alias("null_pct"),
                nd.cast("long").alias("n_distinct"),
                (F.min(c).cast("double") if num else F.lit(None).cast("double")).alias("min_value"),
                (F.max(c).cast("double") if num else F.lit(None).cast("double")).alias("max_value"),
            ))
        one = df.agg(F.array(*aggs).alias("cols"))
        frames.append(one.select(F.lit(name).alias("table_name"),
                                 F.inline("cols")))
    return reduce(DataFrame.unionByName, frames)


def inclusion_profile(pairs: list[tuple[str, DataFrame, str, str, DataFrame, str]]) -> DataFrame:
    """For each candidate (child.col -> parent.col): distinct child values,
    orphans and coverage %, from one left join with a flag of the parent's keys."""
    frames = []
    for child_name, child, ccol, parent_name, parent, pcol in pairs:
        cv = child.select(F.col(ccol).alias("v")).where(F.col("v").isNotNull()).distinct()
        pv = parent.select(F.col(pcol).alias("v")).distinct().withColumn("found", F.lit(1))
        s = cv.join(pv, "v", "left").agg(
            F.count("*").alias("n_child_values"), F.count_if(F.col("found").isNull()).alias("n_orphans")).select(
            F.lit(f"{child_name}.{ccol}").alias("child"),
            F.lit(f"{parent_name}.{pcol}").alias("parent"), "n_child_values", "n_orphans")
        frames.append(s)
    out = reduce(DataFrame.unionByName, frames)
    return out.withColumn(
        "coverage_pct",
        F.when(F.col("n_child_values") > 0,
               100.0 * (F.col("n_child_values") - F.col("n_orphans")) / F.col("n_child_values")))


def warehouse_audit(fact: DataFrame, bridge: DataFrame, dim_job: DataFrame) -> DataFrame:
    """Zeros standing for missing salaries, bridge coverage of facts, and the
    share of the job dimension referenced by facts."""
    keys = bridge.select("job_fact_id").distinct()
    with_b = fact.join(keys, "job_fact_id", "left_semi").agg(F.count("*")).scalar()
    used = fact.agg(F.count_distinct("job_id")).scalar()
    dim_n = dim_job.agg(F.count("*")).scalar()
    return fact.agg(
        F.count("*").alias("n_facts"),
        F.sum((F.col("salary_average_year") == 0).cast("long")).alias("n_zero_salary"),
        F.sum(F.col("salary_average_year").isNull().cast("long")).alias("n_null_salary"),
    ).select("n_facts", "n_zero_salary", "n_null_salary",
             with_b.alias("n_facts_with_bridge"),
             (100.0 * with_b / F.col("n_facts")).alias("pct_facts_with_bridge"),
             used.alias("n_job_keys_used"), dim_n.alias("n_job_keys"),
             (100.0 * used / dim_n).alias("pct_job_keys_used"))
