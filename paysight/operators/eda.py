"""Exploratory statistics (A1-A13) as Spark aggregates.

Exact percentiles (linear interpolation) come from ``quantiles``: the source is counted by
value once, and all that a function needs is read from that table; each function takes ``accuracy`` to switch to
``percentile_approx`` (one pass, mergeable sketch). Every other statistic is a
single aggregate job with map-side partial aggregation; nothing is collected
except one-row statistics (bin edges, thresholds).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysight.config import HIST_BINS, TOP_CATEGORIES
from paysight.operators.quantiles import group_sizes, join_groups, percentiles, value_counts, with_percentiles

# KDE grid of the plotting library's histogram (points, cut in bandwidths).
KDE_GRID_POINTS = 200
KDE_CUT = 0.0


def grouped_percentiles(df: DataFrame, by: str, value: str, ps: list[float],
                        accuracy: int | None = None) -> DataFrame:
    """One row for each group: ``by``, ``n`` (rows) and ``q`` (the percentiles)."""
    if accuracy:
        return df.groupBy(by).agg(F.count("*").alias("n"), F.percentile_approx(value, ps, accuracy).alias("q"))
    return with_percentiles(df, value, ps, [by])


def describe(df: DataFrame, target: str, accuracy: int | None = None,
             decimals: int = 0) -> DataFrame:
    """A1: count, mean, sample std, min, 5/25/50/75/95 %, max (rounded)."""
    ps = [0.05, 0.25, 0.5, 0.75, 0.95]
    if accuracy:
        g = df.agg(F.count(target).alias("count"), F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"), F.min(target).alias("min"),
                   F.max(target).alias("max"), F.percentile_approx(target, ps, accuracy).alias("_p"))
    else:
        counts = value_counts(df, target)
        held = counts.where(F.col("_v").isNotNull())
        c, v = F.col("_c"), F.col("_v")
        mean = held.agg(F.sum(v * c) / F.sum(c)).scalar()
        one = held.agg(F.coalesce(F.sum(c), F.lit(0)).alias("count"), (F.sum(v * c) / F.sum(c)).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
                       F.sum(c * F.pow(v - mean, F.lit(2.0))).alias("_ss"))
        one = one.withColumn("std", F.when(F.col("count") > 1, F.sqrt(F.try_divide(F.col("_ss"), F.col("count") - 1))))
        g = one.withColumn("_k", F.lit(0)).join(percentiles(counts, ps).select(F.lit(0).alias("_k"), F.col("q").alias("_p")), "_k")  # one row and one row
    names = ["p5", "p25", "p50", "p75", "p95"]
    return g.select(
        F.col("count").cast("long").alias("count"),
        *[F.round(F.col(c).cast("double"), decimals).alias(c) for c in ["mean", "std", "min"]],
        *[F.round(F.col("_p")[i].cast("double"), decimals).alias(n) for i, n in enumerate(names)],
        F.round(F.col("max").cast("double"), decimals).alias("max"))


def stats(df: DataFrame, **exprs: Column) -> Column:
    """One-row aggregate as a struct-valued scalar subquery (lazy, reused by name)."""
    return df.agg(F.struct(*[e.alias(k) for k, e in exprs.items()])).scalar()


def row_counts(raw: DataFrame, usable: DataFrame) -> DataFrame:
    """A2: raw and usable row counts in one row."""
    return raw.agg(F.count("*").alias("n_raw")).select(
        "n_raw", usable.agg(F.count("*")).scalar().alias("n_usable"))


def missing_pct(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A3: % missing per column, only > 0, descending (one pass, then unpivot)."""
    columns = columns or df.columns
    one = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in columns])
    long = one.unpivot([], columns, "column", "missing_pct")
    return long.filter(F.col("missing_pct") > 0).orderBy(F.desc("missing_pct"), "column")


def target_coverage(raw: DataFrame, salaried: DataFrame, target: str,
                    n_items: str = "n_skills") -> DataFrame:
    """A4: % rows with the target; mean item count; % rows with any item."""
    b = stats(salaried, mean_items=F.avg(n_items),
              pct_with_items=F.avg((F.col(n_items) > 0).cast("double")) * 100)
    return raw.agg((F.avg(F.col(target).isNotNull().cast("double")) * 100)
                   .alias("pct_with_target")).select(
        "pct_with_target", b["mean_items"].alias("mean_items"),
        b["pct_with_items"].alias("pct_with_items"))


def adjusted_skew(col: str | Column) -> Column:
    """A5: bias-adjusted sample skewness G1 = g1 * sqrt(n(n-1)) / (n-2)."""
    c = F.col(col) if isinstance(col, str) else col
    n = F.count(c).cast("double")
    return F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)


def skew_report(df: DataFrame, target: str) -> DataFrame:
    """A5: skew of the target and of log1p(target)."""
    return df.agg(adjusted_skew(target).alias("skew_raw"),
                  adjusted_skew(F.log1p(target)).alias("skew_log"))


def bin_index(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin of ``value`` in [lo, hi]; the last bin is closed."""
    raw = F.floor((value - lo) / (hi - lo) * bins).cast("long")
    return F.when(hi == lo, F.lit(0).cast("long")).otherwise(F.least(raw, F.lit(bins - 1)))


def histogram(df: DataFrame, value: str | Column, bins: int = HIST_BINS,
              series: str = "value") -> DataFrame:
    """Equal-width bin table (empty bins included) over [min, max].

    The bounds are one aggregate joined back as a one-row frame; bin counts are a
    grouped count with partial aggregation; empty bins come from a ``sequence``
    frame of exactly ``bins`` rows.
    """
    v = F.col(value) if isinstance(value, str) else value
    vals = df.select(v.cast("double").alias("v")).filter(F.col("v").isNotNull())
    st = stats(vals, lo=F.min("v"), hi=F.max("v"))
    counted = (vals.select(bin_index(F.col("v"), st["lo"], st["hi"], bins).alias("bin"))
               .groupBy("bin").agg(F.count("*").alias("n")))
    grid = vals.sparkSession.range(bins).select(
        F.col("id").alias("bin"), st["lo"].alias("lo"), st["hi"].alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    return (grid.join(counted, "bin", "left")
            .select(F.lit(series).alias("series"), F.col("bin").cast("long").alias("bin"),
                    (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def kde_curve(df: DataFrame, value: str | Column, fine_bins: int = 1024,
              grid_points: int = KDE_GRID_POINTS, cut: float = KDE_CUT,
              series: str = "value") -> DataFrame:
    """Gaussian KDE (Scott bandwidth sigma * n^-1/5) on a grid of points.

    Binned KDE: the data are first reduced to ``fine_bins`` weighted bin centres
    (one grouped count); each centre then expands to its contribution at every
    grid point and the contributions are summed per grid point. Work is
    fine_bins x grid_points whatever the data size.
    """
    v = F.col(value) if isinstance(value, str) else value
    vals = df.select(v.cast("double").alias("v")).filter(F.col("v").isNotNull())
    st = stats(vals, lo=F.min("v"), hi=F.max("v"), n=F.count("v"),
               h=F.stddev_samp("v") * F.pow(F.count("v").cast("double"), F.lit(-0.2)))
    centres = (vals.select(bin_index(F.col("v"), st["lo"], st["hi"], fine_bins).alias("b"))
               .groupBy("b").agg(F.count("*").alias("w"))
               .select("b", "w", st["lo"].alias("lo"), st["hi"].alias("hi"),
                       st["n"].alias("n"), st["h"].alias("h")))
    bw = (F.col("hi") - F.col("lo")) / fine_bins
    centres = centres.withColumn("c", F.col("lo") + (F.col("b") + 0.5) * bw)
    g0 = F.col("lo") - cut * F.col("h")
    step = (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / (grid_points - 1)
    contrib = centres.select(
        "n", "h", F.posexplode(F.transform(
            F.sequence(F.lit(0), F.lit(grid_points - 1)),
            lambda i: F.col("w") * F.exp(-0.5 * F.pow(((g0 + i * step) - F.col("c")) / F.col("h"),
                                                      2)))).alias("g", "k"),
        g0.alias("g0"), step.alias("step"))
    dens = contrib.groupBy("g", "g0", "step", "n", "h").agg(F.sum("k").alias("ks"))
    return dens.select(
        F.lit(series).alias("series"), F.col("g").cast("long").alias("point"),
        (F.col("g0") + F.col("g") * F.col("step")).alias("x"),
        (F.col("ks") / (F.col("n") * F.col("h") * F.lit((2 * 3.141592653589793) ** 0.5)))
        .alias("density"))


def top_categories(df: DataFrame, category: str, target: str, top: int = TOP_CATEGORIES,
                   accuracy: int | None = None) -> DataFrame:
    """Categories with the highest median target (NULL group dropped), top-k."""
    rows = df.filter(F.col(category).isNotNull()).select(F.col(category).alias("category"), F.col(target).alias("y"))
    g = (grouped_percentiles(rows, "category", "y", [0.5], accuracy)
         .select("category", F.col("q")[0].alias("median_target"), "n"))
    return g.orderBy(F.desc("median_target"), "category").limit(top)


def box_stats(df: DataFrame, category: str, target: str, top: int = TOP_CATEGORIES,
              accuracy: int | None = None) -> DataFrame:
    """Box-plot numbers for the top categories; whiskers at the furthest values
    within 1.5 IQR of the quartiles (outliers hidden).

    The quartile table has at most ``top`` rows, so broadcasting it is bounded.
    """
    by = ["category"]
    rows = df.filter(F.col(category).isNotNull()).select(F.col(category).alias("category"), F.col(target).alias("y"))
    counts = value_counts(rows, "y", by)
    ps = [0.25, 0.5, 0.75]
    q = rows.groupBy("category").agg(F.percentile_approx("y", ps, accuracy).alias("q")) if accuracy else percentiles(counts, ps, by)
    q = q.select("category", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    q = q.orderBy(F.desc("median"), "category").limit(top)  # C7
    lim = q.select("*", (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lo_fence"),
                   (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("hi_fence"))
    j = counts.join(F.broadcast(lim), "category")
    inside = F.col("_v").between(F.col("lo_fence"), F.col("hi_fence"))
    return j.groupBy("category", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_hi"),
        F.sum("_c").alias("n"))


def group_median_gap(df: DataFrame, flag: str, target: str, yes="True", no="False",
                     accuracy: int | None = None) -> DataFrame:
    """A10: median(target | flag=yes) - median(target | flag=no), only when the flag
    has exactly two groups; otherwise NULL."""
    rows = df.select(F.col(flag).cast("string").alias("flag"), F.col(target).alias("y"))
    if accuracy:
        g = rows.groupBy("flag").agg(F.percentile_approx("y", [0.5], accuracy).alias("q"))
    else:
        counts = value_counts(rows, "y", ["flag"])
        g = join_groups(group_sizes(counts, ["flag"]), percentiles(counts, [0.5], ["flag"]), ["flag"])
    g = g.agg(F.count("flag").alias("n_groups"), *[F.max(F.when(F.col("flag") == x, F.col("q")[0])).alias(name)
                                                   for x, name in ((yes, "median_yes"), (no, "median_no"))])
    return g.select("n_groups", "median_yes", "median_no",
                    F.when(F.col("n_groups") == 2, F.col("median_yes") - F.col("median_no"))
                    .alias("median_gap"))


def item_frequency(df: DataFrame, items: str, top: int = 25) -> DataFrame:
    """Postings per item (each item once per posting, F18), top-k by count."""
    ex = df.select(F.explode(F.array_distinct(items)).alias("item"))
    return (ex.groupBy("item").agg(F.count("*").alias("n_postings"))
            .orderBy(F.desc("n_postings"), "item").limit(top))


def highest_paying_items(df: DataFrame, items: str, target: str, min_support: int = 100,
                         top: int = 20, accuracy: int | None = None) -> DataFrame:
    """Median target per item over postings holding it, support >= n, top-k.

    Explode after ``array_distinct`` (F18) so a posting counts once per item. The
    counts are partially aggregated map-side.
    """
    ex = df.select(F.explode(F.array_distinct(items)).alias("item"), F.col(target).alias("y"))
    g = (grouped_percentiles(ex, "item", "y", [0.5], accuracy)
         .select("item", F.col("n").alias("n_postings"), F.col("q")[0].alias("median_target")))
    return (g.filter(F.col("n_postings") >= min_support)
            .orderBy(F.desc("median_target"), "item").limit(top))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair, long form, in one aggregate."""
    pairs = [(a, b) for a in columns for b in columns]
    one = df.agg(*[(F.lit(1.0) if a == b else F.corr(a, b)).alias(f"{a}|{b}")
                   for a, b in pairs])
    long = one.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "r")
    parts = F.split("pair", r"\|")
    return long.select(parts[0].alias("col_a"), parts[1].alias("col_b"), "r")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
