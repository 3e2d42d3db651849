"""Mixing sources to target weights.

Sizes are added up for each source; weights and the sizes give each source a target,
and targets over ``CEILING`` times the source are cut there and the excess is shared
among the others by weight until none is above. The rate of a source is target / size.
Each document is emitted floor(rate) times plus once more if a number drawn by a hash of
seed and id, uniform in [0, 1), is under the fraction of the rate. So a rerun makes the
same mix, on any partitioning.

Only sums travel: documents are added up before the exchange, one row for each source
is ordered and shared out, and it comes back to the documents by a join that is broadcast
only while the number of sources is at most ``BROADCAST_SOURCES``; beyond it, both sides are
salted, so that a source with a third of all rows is split.

Defined results: a null or wordless text has size 0 and is emitted like any other of
its source; a source without words has target 0 and rate 0; a null source is one source,
ordered last; rows with one id (or none) draw the same number, so repeated rows are all
taken or all left; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysight.llm.common import WORD, columns_of, table, text_or_empty, unused
from paysight.session import materialize

WEIGHTS, SHARE, CEILING, SEED = (3, 1, 2), 1.5, 2, 42
BROADCAST_SOURCES, SALTS = 100_000, 32


def words(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def draw(id_col: str = "doc_id", seed: int = SEED) -> Column:
    """Uniform in [0, 1): the first 52 bits of md5("seed:id")."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   ceiling: int = CEILING) -> DataFrame:
    """source, source_size, target, rate: one row for each source of (source, size)."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sums.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(ceiling))
    # water level: sources in order of cap / weight; the level at each, were all before it full
    s = s.withColumn("full_at", F.col("cap") / F.col("weight"))
    before = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "total": F.sum("source_size").over(everything) * share, "weights": F.sum("weight").over(everything),
        "used": F.coalesce(F.sum("cap").over(before), F.lit(0.0)), "gone": F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    s = s.withColumn("level_here", (F.col("total") - F.col("used")) / (F.col("weights") - F.col("gone")))
    level = F.coalesce(F.max(F.when(F.col("level_here") <= F.col("full_at"), F.col("level_here"))).over(everything),
                       F.max("full_at").over(everything))
    target = F.least(F.col("cap"), level * F.col("weight"))
    return (s.withColumn("target", target)
            .select("source", "source_size", "target",
                    F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate")))


def copies(rate: Column, draw_col: Column) -> Column:
    """floor(rate) and one more with the probability of the fraction."""
    return (F.floor(rate) + F.when(draw_col < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def with_copies(docs: DataFrame, source: str = "source", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``_size``, ``_source_size``, ``_target`` and ``_copies`` to each row; columns of
    these names are replaced."""
    docs = docs.drop("_size", "_source_size", "_target", "_copies").withColumn("_size", words(text))
    own, rate, salt, part = (unused(docs, n) for n in ("_source", "_rate", "_salt", "_part"))
    targets = materialize(source_targets(docs.select(F.col(source).alias("source"), F.col("_size").alias("size"))), "source-targets")
    targets = targets.select(F.col("source").alias(own), F.col("source_size").alias("_source_size"),
                             F.col("target").alias("_target"), F.col("rate").alias(rate))
    same = F.col(source).eqNullSafe(F.col(own))
    if targets.count() <= BROADCAST_SOURCES:
        joined = docs.join(F.broadcast(targets), same)
    else:
        salted = docs.withColumn(salt, F.pmod(F.xxhash64(F.col(id_col), F.col("_size")), F.lit(SALTS)).cast("int"))
        spread = targets.withColumn(part, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(spread, same & (F.col(salt) == F.col(part)))
    return joined.withColumn("_copies", copies(F.col(rate), draw(id_col))).drop(own, rate, salt, part)


def mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their own columns only."""
    n = with_copies(docs.select("doc_id", "source", "text", F.struct(*columns_of(docs)).alias("row")))
    return n.select("row", F.explode(F.array_repeat(F.lit(1), F.col("_copies")))).select("row.*")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return with_copies(docs).select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).cast("long").alias("taken"))
