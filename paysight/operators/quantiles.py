"""Exact percentiles (linear interpolation) by radix selection over a value-count table.

The source is read once: its rows are counted by (group, value), with partial aggregation, and
that table is written. A wanted rank is then found by cells: at first a cell is a whole group. As
long as a cell that holds a wanted rank has more than ``CELL`` different values, it is cut by the
next 16 bits of the order-preserving bit pattern of the double, and counts by those bits tell
which cells hold the ranks. After four passes a cell is one value, so there are never more; most
tables need none. The values of the cells left, at most ``CELL`` in each, are put in order.

No group is held in one task, there is no sketch, and nothing is compared with a list of cuts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysight.session import materialize

#: Different values that a task may put in order.
CELL = 65_536
#: Bits of one pass, and of a double.
STEP, WIDTH = 16, 64


def _same(a: str, b: str, by: list[str]) -> Column:
    """Equal groups, null like any other value."""
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in by], F.lit(True))


def _prefix(passes: int) -> Column:
    """The first ``16 * passes`` bits of a value's order: its bit pattern, below zero reversed."""
    if not passes:
        return F.lit(0).cast("long")
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.col("_v")).cast("long")
    return F.shiftright(F.when(bits < 0, bits.bitwiseXOR(F.lit(2 ** 63 - 1))).otherwise(bits), WIDTH - STEP * passes)


def value_counts(df: DataFrame, value: str | Column, by: list[str] | None = None) -> DataFrame:
    """The written table of (group, ``_v``, ``_c``): rows of each value, null included, by group."""
    v = F.col(value) if isinstance(value, str) else value
    return materialize(df.select(*(by or []), v.cast("double").alias("_v")).groupBy(*(by or []), "_v").agg(F.count("*").alias("_c")), "value-counts")


def group_sizes(counts: DataFrame, by: list[str]) -> DataFrame:
    """Rows ``n`` of each group, with and without a value."""
    return counts.groupBy(*by).agg(F.sum("_c").alias("n"))


def _ranks(ps: list[float]) -> tuple[list[Column], Column]:
    at = [F.lit(float(p)) * (F.col("_total") - 1) for p in ps]
    return at, F.array(*[f(x).cast("long") for x in at for f in (F.floor, F.ceil)])


def percentiles(counts: DataFrame, ps: list[float], by: list[str] | None = None) -> DataFrame:
    """``q`` (array, one value for each of ``ps``) for each group of ``by`` (or of all rows), from
    a table of ``value_counts`` by these columns, or by more.

    Null values take no part; a group without other values has no row, and all rows of a
    table without values have one of nulls."""
    by = list(by or [])
    rows = counts.where(F.col("_v").isNotNull())
    if set(counts.columns) - {*by, "_v", "_c"}:
        rows = rows.groupBy(*by, "_v").agg(F.sum("_c").alias("_c"))
    at, wanted = _ranks(ps)
    cells = rows.groupBy(*by).agg(F.sum("_c").alias("_total"), F.count("*").alias("_values")).withColumns(
        {"_cell": F.lit(0).cast("long"), "_before": F.lit(0).cast("long")})
    keys, passes = [*by, "_cell"], 0
    while passes < WIDTH // STEP and (cells.agg(F.max("_values")).first()[0] or 0) > CELL:
        passes += 1
        finer = _inside(rows, cells, by, passes - 1).withColumn("_next", _prefix(passes)).groupBy(*keys, "_before", "_total", "_next").agg(
            F.sum("_c").alias("_n"), F.count("*").alias("_values"))
        ahead = Window.partitionBy(*keys).orderBy("_next").rowsBetween(Window.unboundedPreceding, -1)  # at most 2^16 rows a cell
        finer = finer.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_n").over(ahead), F.lit(0))).withColumn("_cell", F.col("_next"))
        holds = F.exists(wanted, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_n")))
        cells = materialize(finer.where(holds).select(*keys, "_before", "_total", "_values"), "percentile-cells")
    earlier = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = _inside(rows, cells, by, passes).withColumn("_first", F.col("_before") + F.coalesce(F.sum("_c").over(earlier), F.lit(0)))

    def at_rank(r: Column) -> Column:
        return F.max(F.when((r >= F.col("_first")) & (r < F.col("_first") + F.col("_c")), F.col("_v")))
    ends = placed.groupBy(*by).agg(F.max("_total").alias("_total"), *[
        at_rank(f(x).cast("long")).alias(f"_{k}{i}") for i, x in enumerate(at) for k, f in (("lo", F.floor), ("hi", F.ceil))])
    q = [F.col(f"_lo{i}") + (x - F.floor(x)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}")) for i, x in enumerate(at)]
    return ends.select(*by, F.array(*q).alias("q"))


def _inside(rows: DataFrame, cells: DataFrame, by: list[str], passes: int) -> DataFrame:
    """The values of the cells, each with its cell's columns."""
    a, b = rows.withColumn("_cell", _prefix(passes)).alias("a"), cells.alias("b")
    return a.join(b, _same("a", "b", by) & (F.col("a._cell") == F.col("b._cell"))).select(
        *[F.col(f"a.{c}") for c in by], "a._cell", "_v", "_c", "_before", "_total")


def exact_percentiles(df: DataFrame, value: str | Column, ps: list[float], by: list[str] | None = None) -> DataFrame:
    """``q`` for each group of the rows of ``df``."""
    return percentiles(value_counts(df, value, by), ps, by)


def with_percentiles(df: DataFrame, value: str | Column, ps: list[float], by: list[str]) -> DataFrame:
    """One row for each group: ``by``, its rows ``n`` and ``q`` (null without values)."""
    counts = value_counts(df, value, by)
    return join_groups(group_sizes(counts, by), percentiles(counts, ps, by), by)


def join_groups(groups: DataFrame, quantiles: DataFrame, by: list[str]) -> DataFrame:
    a, b = groups.alias("a"), quantiles.alias("b")
    return a.join(b, _same("a", "b", by), "left").select("a.*", "b.q")
