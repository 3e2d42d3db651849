"""SimHash near-duplicates by deletion-variant signatures.

Each text gets a 64-bit fingerprint: the bitwise majority of the hashes of its word
shingles. Fingerprints link at ``MAX_BITS`` = 4 or fewer differing bits. They are cut into
three segments: four differences can't give each of three segments two of them, so two
linked fingerprints have a segment that differs by at most one bit. Every segment is
indexed under one variant for each of its bits with that bit left out (64 variants for
a fingerprint); two segments that differ by one bit at most share a variant. Rows with an
equal variant meet by an equality join, and each pair is verified on all 64 bits.

Only different fingerprints are indexed, however many copies they have. A variant that
many fingerprints share (a large group of near copies) is not expanded into pairs:

1. every fingerprint is verified against the first and last one in the ordered list of
   its variant and against a few before it (``NEIGHBOURS``), and the links found are
   contracted to components;
2. the join then pairs only fingerprints of different components, in variants that hold
   more than one component, and gives one row for each pair of components.

A *hot* variant, one of over ``VARIANT_ROWS`` fingerprints, is cut into parts of about as
many by a hash. In step 1 the parts are put in order one by one, beside the least and largest
fingerprint of the whole variant. In step 2 the left side of the join is in one part and
the right side is sent to every part, so that each pair still meets once and no task
has to hold a whole variant.

No link between different components is lost: step 2 looks at all pairs that step 1
has not already joined. Components come from alternating large-star and small-star
rounds, each written to the shared folder; links or members never go to the driver.

Defined results: a null text counts as the empty one; a text without words has the
fingerprint zero and links like any other; fewer words than a shingle make one shingle
of all words; repeated rows are all returned, with one component; rows without doc_id get
the component of their group (null if no row of it has an id); an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysight.llm.common import bound_batches, columns_of, table, text_or_empty
from paysight.session import materialize

SHINGLE, SEED, MAX_BITS = 4, 42, 4
#: First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Besides the ends of its variant's list, a fingerprint is first compared with these many before it.
NEIGHBOURS = (1, 2, 4, 8, 16, 32)
#: Fingerprints in one part of a variant, and hot variants up to which their table is broadcast.
VARIANT_ROWS, BROADCAST_VARIANTS = 2048, 100_000
#: Shingle hashes that are unpacked to bits at once.
BLOCK = 65_536


def fingerprint_of(text: str, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text."""
    words = text.encode("utf-8", "replace").lower().split()  # on bytes: A-Z only; space and \\t..\\r
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined, digest = b" ".join(words), xxhash.xxh64_intdigest
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[:-1]])
        n = len(words) - shingle + 1
        hashes = [digest(joined[a:b], SEED)
                  for a, b in zip(starts[:n].tolist(), (ends[shingle - 1:] - 1).tolist(), strict=True)]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        block = np.array(hashes[i:i + BLOCK], dtype="<u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([fingerprint_of(t, shingle) for t in s], dtype="int64")
    return simhash(F.coalesce(text.cast("string"), F.lit("")))


def variants(df: DataFrame) -> DataFrame:
    """Each row of ``df`` (with a fingerprint ``fp``) under its 64 one-wildcard segment variants."""
    j = F.col("_bit")
    start = F.when(j < SEGMENTS[1][0], SEGMENTS[0][0]).when(j < SEGMENTS[2][0], SEGMENTS[1][0]).otherwise(SEGMENTS[2][0])
    mask = F.when(j < SEGMENTS[1][0], 2 ** SEGMENTS[0][1] - 1).otherwise(2 ** SEGMENTS[1][1] - 1).cast("long")
    spread = df.withColumn("_bit", F.explode(F.sequence(F.lit(0), F.lit(63))))
    segment = F.call_function("shiftrightunsigned", F.col("fp"), start).bitwiseAND(mask)
    wild = F.call_function("shiftleft", F.lit(1).cast("long"), j - start)
    key = segment.bitwiseAND(F.bitwise_not(wild)).bitwiseOR(F.call_function("shiftleft", j.cast("long"), F.lit(32)))
    return spread.withColumn("key", key).drop("_bit")


def _near(a: Column, b: Column, max_bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the least node reachable.

    Alternating large-star and small-star rounds. Each round is written to the shared
    folder, so that a lost executor repeats one round at most."""
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .where("u <> v").distinct(), "links")
    mark = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(lower.select("u", F.col("m").alias("v"))).distinct())
        edges = materialize(small, "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def _spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly before each of them is expanded to 64 variants."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")


def _in_parts(df: DataFrame, hot: DataFrame) -> DataFrame:
    """The variants of ``df`` with the columns of ``hot`` (null for others), ``parts`` and ``part``."""
    if hot.count() <= BROADCAST_VARIANTS:
        hot = F.broadcast(hot)
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    return (variants(_spread(df)).join(hot, "key", "left")
            .withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", part))


def link_components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, comp) for different fingerprints ``fp``: comp is the least fingerprint reachable."""
    if max_bits >= 2 * len(SEGMENTS):
        raise ValueError(f"{len(SEGMENTS)} segments find at most {2 * len(SEGMENTS) - 1} differing bits")
    fps = fps.select("fp")
    hot = materialize(variants(_spread(fps)).groupBy("key")
                      .agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).where(F.col("n") > VARIANT_ROWS)
                      .select("key", F.ceil(F.col("n") / VARIANT_ROWS).cast("int").alias("parts"), "lo", "hi"), "hot-variants")
    in_order = Window.partitionBy("key", "part").orderBy("fp")
    same = Window.partitionBy("key", "part")
    others = F.array("lo", "hi", F.min("fp").over(same), F.max("fp").over(same), *[F.lag("fp", n).over(in_order) for n in NEIGHBOURS])
    stars = (_in_parts(fps, hot).withColumn("others", others)
             .withColumn("others", F.filter("others", lambda x: (x != F.col("fp")) & _near(x, F.col("fp"), max_bits)))
             .where(F.size("others") > 0).select(F.col("fp").alias("a"), F.explode(F.array_distinct("others")).alias("b")))
    first = components(stars)
    joined = materialize(fps.join(first, F.col("fp") == F.col("node"), "left")
                         .select("fp", F.coalesce("root", "fp").alias("c")), "first-components")
    hot = materialize(_in_parts(joined, hot).where("parts > 1").groupBy("key", "parts")
                      .agg(F.min("c").alias("lo"), F.max("c").alias("hi")), "hot-components")
    mixed = (_in_parts(joined, hot).withColumns({"lo": F.coalesce("lo", F.min("c").over(same)),
                                                 "hi": F.coalesce("hi", F.max("c").over(same))})
             .where("lo < hi").select("key", "parts", "part", "fp", "c"))
    met = materialize(mixed, "variants")
    x = met.alias("x")
    y = met.where("parts = 1").unionByName(
        met.where("parts > 1").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))).alias("y")
    cross = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.c") < F.col("y.c"))
                    & _near(F.col("x.fp"), F.col("y.fp"), max_bits))
             .select(F.col("x.c").alias("a"), F.col("y.c").alias("b")))
    second = components(cross).withColumnsRenamed({"node": "c"})
    return joined.join(second, "c", "left").select("fp", F.coalesce("root", "c").alias("comp"))


def _members(docs: DataFrame, shingle: int, max_bits: int, text: str, *more: Column) -> DataFrame:
    """doc_id, fp, comp, component_id and the columns ``more`` of every row."""
    bound_batches(docs.sparkSession)
    fps = materialize(docs.select("doc_id", fingerprint(text_or_empty(text), shingle).alias("fp"), *more), "fingerprints")
    groups = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least_doc")), "different-fingerprints")
    member = materialize(link_components(groups, max_bits), "components")
    ids = (groups.join(member, "fp").groupBy("comp").agg(F.min("least_doc").alias("component_id")))
    return fps.join(member.join(ids, "comp"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, text: str = "text") -> DataFrame:
    """doc_id, fp (signed) and component_id of every row."""
    return _members(docs, shingle, max_bits, text).select("doc_id", "fp", "component_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_each(docs: DataFrame) -> DataFrame:
    """One row of each near-duplicate group: the one of least doc_id (none is last), then of
    the least digest of its text. Groups stay apart where ids are missing or repeat."""
    digest = F.md5(text_or_empty().cast("binary"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    first = (_members(docs, SHINGLE, MAX_BITS, "text", digest.alias("digest")).groupBy("comp").agg(F.min(order).alias("m"))
             .select(F.col("m.doc_id").alias("first_id"), F.col("m.digest").alias("first_digest")))
    rows = docs.select(F.struct(*columns_of(docs)).alias("row"), F.col("doc_id").alias("id"), digest.alias("digest"))
    same = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("digest") == F.col("first_digest"))
    return rows.join(first, same, "left_semi").dropDuplicates(["id", "digest"]).select("row.*")
