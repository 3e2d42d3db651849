"""Splits, folds and samples (P1-P4) keyed on a stable row id.

The order of rows is a portable hash of (id, seed): the same in every engine and
independent of partitioning, so a split is reproducible after executor loss or a
re-read. No global single-partition window over the rows is used: positions come
from hash buckets plus per-bucket counts, or from a range partitioning plus
per-partition counts (a distributed zipWithIndex) for any other order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paysight.config import N_FOLDS, SEED, TEST_SIZE, VAL_SIZE


def portable_hash(col: str | Column, seed: int = SEED) -> Column:
    """First 60 bits of md5("<id>-<seed>") as a non-negative long."""
    c = F.col(col) if isinstance(col, str) else col
    digest = F.md5(F.concat(c.cast("string"), F.lit(f"-{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def global_position(df: DataFrame, order_cols: list[str], name: str = "pos",
                    partitions: int | None = None) -> DataFrame:
    """0-based position of each row in the total order of ``order_cols``.

    Range-partition on the order, sort inside partitions, tag rows with their
    partition and local index, and write that to the shared folder (so the tags are
    fixed and the lineage is cut). Offsets come from per-partition counts - one small row per
    partition, broadcast back (size bounded by the partition count).
    """
    spark = df.sparkSession
    from paysight.session import materialize
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_local", F.monotonically_increasing_id()
                     - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    r = materialize(r, "positions")
    counts = r.groupBy("_pid").agg(F.count("*").alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n"))
                            .alias("_off"))
    return (r.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.col("_local"))
            .drop("_pid", "_local", "_off"))


def hash_position(df: DataFrame, h_col: str, id_col: str, name: str = "pos",
                  buckets: int | None = None) -> DataFrame:
    """0-based position in (hash, id) order for a uniform 60-bit hash column.

    The top bits of the hash give equal-sized value-range buckets without any
    sampling; a bucket's offset is the count of all lower buckets (one small
    aggregate, one row per bucket) and the rank inside a bucket is a window
    partitioned by bucket. Deterministic, no checkpoint, no single-partition
    pass over the rows. ``buckets`` defaults to 8 per shuffle partition, so the
    rows per bucket stay bounded as the cluster is sized to the data.
    """
    spark = df.sparkSession
    if buckets is None:
        buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(60, math.ceil(math.log2(max(buckets, 1))))
    b = F.shiftright(F.col(h_col), 60 - bits) if bits else F.lit(0).cast("long")
    tagged = df.withColumn("_bucket", b)
    counts = tagged.groupBy("_bucket").agg(F.count("*").alias("_n"))
    offsets = counts.select("_bucket", (F.sum("_n").over(Window.orderBy("_bucket"))
                                        - F.col("_n")).alias("_off"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(h_col, id_col)) - 1
    return (tagged.join(offsets, "_bucket").withColumn(name, F.col("_off") + rank)
            .drop("_bucket", "_off"))


def split_sizes(n: int, test_size: float = TEST_SIZE, val_size: float = VAL_SIZE) -> tuple:
    """Exact sizes of test and validation (ceil of the fraction, then of the rest)."""
    n_test = math.ceil(test_size * n)
    ratio = val_size / (1 - test_size)
    n_val = math.ceil(ratio * (n - n_test))
    return n_test, n_val


def train_val_test(df: DataFrame, id_col: str, seed: int = SEED,
                   test_size: float = TEST_SIZE, val_size: float = VAL_SIZE,
                   exact: bool = True) -> DataFrame:
    """Add ``split`` in {train, val, test}.

    exact: sizes equal the ceil rule, by hash-order position. Otherwise a
    threshold on the hash (no ordering at all; sizes are then approximate).
    """
    h = portable_hash(id_col, seed)
    if not exact:
        u = h.cast("double") / float(2 ** 60)
        vfrac = val_size / (1 - test_size) * (1 - test_size)
        return df.withColumn("split", F.when(u < test_size, "test")
                             .when(u < test_size + vfrac, "val").otherwise("train"))
    from paysight.session import materialize
    # every later step reads the split many times: the rows are written once to the shared
    # checkpoint folder (lineage cut; a lost executor re-reads them instead of recomputing the
    # features) and never sorted: two cut points tell the splits apart
    p = materialize(df.withColumn("_h", h).where(F.col("_h").isNotNull()), "split-rows")
    n_test, n_val = split_sizes(p.count(), test_size, val_size)
    cuts = hash_cuts(p, "_h", id_col, [n_test, n_test + n_val])
    if any(more for *_, more in cuts):  # rows of one id on both sides: which of them is fixed by writing it
        tied = F.col(id_col).isin([c[1] for c in cuts if c[3]])
        order = F.row_number().over(Window.partitionBy(id_col).orderBy("_h"))
        p = materialize(p.where(~tied).withColumn("_k", F.lit(0)).unionByName(p.where(tied).withColumn("_k", order)), "split-ties")
    else:
        p = p.withColumn("_k", F.lit(0))

    def first(cut: tuple) -> Column:
        ch, cid, taken, _ = cut
        if ch is None:
            return F.lit(False)
        same = (F.col("_h") == ch) & (F.col(id_col) == F.lit(cid))
        return (F.col("_h") < ch) | ((F.col("_h") == ch) & (F.col(id_col) < F.lit(cid))) | (same & (F.col("_k") <= taken))
    return p.withColumn("split", F.when(first(cuts[0]), "test").when(first(cuts[1]), "val")
                        .otherwise("train")).drop("_h", "_k")


def hash_cuts(df: DataFrame, h_col: str, id_col: str, sizes: list[int], bits: int = 12) -> list[tuple]:
    """For each size n: (hash, id) of the n-th row in (hash, id) order, how many of the rows of that
    id are among the first n, and whether there are more of them (hash and id None for n = 0).

    One aggregate counts the rows by the top ``bits`` of the 60-bit hash; only the few buckets
    that hold a wanted row are ordered, and of those only (hash, id)."""
    bucket = F.shiftright(F.col(h_col), 60 - bits)
    counts = dict(df.groupBy(bucket.alias("b")).count().collect())  # at most 2 ** bits rows
    wanted, before = {}, 0
    for b in sorted(counts):
        wanted.update({n: (b, before) for n in sizes if before < n <= before + counts[b]})
        before += counts[b]
    if not wanted:
        return [(None, None, 0, False) for _ in sizes]
    keys = (df.select(bucket.alias("b"), h_col, id_col).where(F.col("b").isin(sorted({b for b, _ in wanted.values()})))
            .groupBy("b", h_col, id_col).agg(F.count("*").alias("m")))
    upto = F.sum("m").over(Window.partitionBy("b").orderBy(h_col, id_col))
    keys = keys.withColumn("_upto", upto)
    hit = F.lit(False)
    for n, (b, start) in wanted.items():
        hit = hit | ((F.col("b") == b) & (F.col("_upto") >= n - start) & (F.col("_upto") - F.col("m") < n - start))
    rows = keys.where(hit).collect()  # one row a size at most
    out = []
    for n in sizes:
        b, start = wanted.get(n, (None, 0))
        row = next((r for r in rows if r["b"] == b and r["_upto"] - r["m"] < n - start <= r["_upto"]), None)
        taken = 0 if row is None else n - start - (row["_upto"] - row["m"])
        out.append((None, None, 0, False) if row is None else (row[h_col], row[id_col], taken, taken < row["m"]))
    return out


def hash_folds(df: DataFrame, id_col: str, k: int = N_FOLDS, seed: int = SEED,
               name: str = "fold") -> DataFrame:
    """Shuffled k folds by the portable hash."""
    return df.withColumn(name, (portable_hash(id_col, seed) % k).cast("int"))


def ordered_folds(df: DataFrame, id_col: str, k: int = N_FOLDS, name: str = "fold") -> DataFrame:
    """Unshuffled k folds: contiguous id ranges, the first n % k folds one larger."""
    n = df.count()
    big, small = n // k + 1, n // k
    n_big = n % k
    p = global_position(df, [id_col], "_pos")
    cut = big * n_big
    fold = F.when(F.col("_pos") < cut, F.floor(F.col("_pos") / big)) \
        .otherwise(F.lit(n_big) + F.floor((F.col("_pos") - cut) / max(small, 1)))
    return p.withColumn(name, fold.cast("int")).drop("_pos")


def hash_sample(df: DataFrame, id_col: str, n: int = 1000, seed: int = SEED) -> DataFrame:
    """min(n, rows) rows with the smallest hash (per-partition top-n, then merge)."""
    return (df.withColumn("_h", portable_hash(id_col, seed))
            .orderBy("_h", id_col).limit(n).drop("_h"))
