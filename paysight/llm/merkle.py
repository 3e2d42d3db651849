"""Document fingerprints: a Merkle tree over paragraphs and sections.

* A leaf is a paragraph: a line with its line end; lines of over ``LEAF_CHARS``
  characters are cut into parts. The leaves of a text put together are the text.
* A section is ``SECTION_LEAVES`` leaves in a row, its node the hash of theirs.
* The root is the hash of the section nodes.

The fingerprint writes the tree down as ``root:section,leaf,leaf...;section,...``, the root
with 64 hex digits and the other nodes with ``NODE_HEX``. Equal texts have equal roots, and
different texts different ones but for collisions of sha256. Where two roots differ,
sections (and in them leaves) that differ locate the edits, see :func:`edits`. Likeness is
the share of common leaves, 2 * common / (leaves of both), counted over different
leaves; it is 1 only for equal roots.

Only built-in expressions are used. The next document of each one in id order is
found with one exchange of the texts: ids are cut at exact ids of the table into ranges,
the first row of each range is also sent to the range before it, and a window runs in
each range. No range is a whole table, and their number follows the partitions.

Defined results: a null text counts as the empty one, which has no leaves; two texts
without leaves are alike 1, one such text and another 0; rows with one id are ordered by
the hash of their texts; rows without id come last; for a table of one row the next
document is the row itself; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysight.llm.common import table, text_or_empty

LEAF_CHARS, SECTION_LEAVES, NODE_HEX = 128, 16, 12
#: Id ranges for each shuffle partition.
RANGES_PER_PARTITION = 4


def leaves(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"[^\n]{1,%d}\n?|\n" % LEAF_CHARS), F.lit(0))


def _node(children: Column) -> Column:
    return F.sha2(children, 256)


def sections(text: Column) -> Column:
    """The tree below the root: array of struct(node, leaves), all hashes whole."""
    hashed = F.transform(leaves(text), _node)

    def cut(h: Column) -> Column:
        starts = F.when(F.size(h) > 0, F.sequence(F.lit(1), F.size(h), F.lit(SECTION_LEAVES))) \
            .otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.slice(h, i, F.lit(SECTION_LEAVES)))
    return F.transform(cut(hashed), lambda s: F.struct(_node(F.concat_ws("", s)).alias("node"), s.alias("leaves")))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the fingerprint of a text column."""
    def short(x: Column) -> Column:
        return F.substring(x, 1, NODE_HEX)

    df = df.withColumn("_tree", sections(F.col(text)))
    root = _node(F.concat_ws("", F.transform("_tree", lambda x: x["node"])))
    body = F.concat_ws(";", F.transform("_tree", lambda x: F.concat_ws(
        ",", short(x["node"]), F.transform(x["leaves"], short))))
    return df.withColumn(name, F.concat(root, F.lit(":"), body)).drop("_tree")


def leaves_of(fingerprint: Column) -> Column:
    """The leaf hashes written in a fingerprint."""
    return F.flatten(F.transform(F.split(F.substring_index(fingerprint, ":", -1), ";"),
                                 lambda s: F.slice(F.split(s, ","), F.lit(2), F.greatest(F.size(F.split(s, ",")) - 1, F.lit(0)))))


def likeness(a: Column, b: Column, leaves_a: Column, leaves_b: Column) -> Column:
    """Share of common leaves of two fingerprints; the sets of their leaves are given."""
    total = F.size(leaves_a) + F.size(leaves_b)
    shared = 2.0 * F.size(F.array_intersect(leaves_a, leaves_b)) / F.greatest(total, F.lit(1))
    return F.when(F.substring(a, 1, 64) == F.substring(b, 1, 64), F.lit(1.0)) \
        .otherwise(F.least(shared, F.lit(1.0) - 1.0 / (total + 1)))


def edits(a: Column, b: Column) -> Column:
    """Sections (from 0) in which two fingerprints differ, by descending from the root."""
    def sections(x: Column) -> Column:
        return F.split(F.substring_index(x, ":", -1), ";")

    def of(a_sections: Column, b_sections: Column) -> Column:
        most = F.greatest(F.size(a_sections), F.size(b_sections))
        return F.filter(F.sequence(F.lit(0), most - 1), lambda i: ~F.get(a_sections, i).eqNullSafe(F.get(b_sections, i)))
    return F.when(F.substring(a, 1, 64) == F.substring(b, 1, 64), F.array().cast("array<int>")) \
        .otherwise(of(sections(a), sections(b)))


def _range_bounds(docs: DataFrame, n: int) -> list[int]:
    """At most n + 1 ids of the table that cut it into ranges of about as many rows; the
    first and last are its least and largest id."""
    if n <= 1:
        probs = [0.0, 1.0]
    else:
        probs = [i / n for i in range(n + 1)]
    found = docs.where("_id is not null").select(F.col("_id").cast("double").alias("x"), "_id")
    ends = found.agg(F.min("_id").alias("a"), F.max("_id").alias("b")).first()
    if ends is None or ends.a is None:
        return []
    if max(abs(ends.a), abs(ends.b)) >= 2 ** 53:  # ids that doubles can't tell apart: keep the ends only
        return sorted({ends.a, ends.b})
    inner = found.approxQuantile("x", probs, 1.0 / (4 * max(n, 1)))
    return sorted({ends.a, ends.b, *(int(x) for x in inner)})


def _longs(xs: list[int]) -> Column:
    """A constant array, one literal in the plan however long."""
    return F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>") if xs else F.array().cast("array<bigint>")


def _below(bounds: list[int], id_col: Column) -> Column:
    """How many of the sorted bounds are < id, by a two-level search in constant arrays."""
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.size(F.filter(_longs(bounds[::step]), lambda x: x < id_col))
    part = F.slice(_longs(bounds), (F.greatest(coarse, F.lit(1)) - 1) * step + 1, F.lit(step))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * step + F.size(F.filter(part, lambda x: x < id_col)))


def with_next(docs: DataFrame, cols: list[str]) -> DataFrame:
    """Add ``next_<col>`` of the next row in descending ``doc_id`` order (after the last:
    the first) for each of ``cols``; ``_tie`` orders rows of one id."""
    docs = docs.withColumn("_id", F.col("doc_id").cast("long"))
    n = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _range_bounds(docs, n)
    ends = bounds[1:]  # range k holds the ids over ends[k - 1] and up to ends[k], its first row in this order
    own = F.when(F.col("_id").isNull(), F.lit(0)).otherwise(_below(ends, F.col("_id"))) if ends else F.lit(0)
    docs = docs.withColumn("_range", own)
    # the first row of a range also ends the range above it; the very first ends the lowest range
    if ends:
        also = F.when(F.col("_id") == ends[-1], F.lit(0)) \
            .when(F.get(_longs(ends), F.col("_range")) == F.col("_id"), F.col("_range") + 1)
    else:
        also = F.lit(0)  # one id, or none: one range, closed by its own rows
    here = F.struct(F.col("_range").alias("r"), F.lit(0).alias("copy"))
    there = F.struct(also.alias("r"), F.lit(1).alias("copy"))
    to = F.when(also.isNotNull(), F.array(here, there)).otherwise(F.array(here))
    sent = docs.withColumn("_to", F.explode(to)).withColumn("_r", F.col("_to.r")).withColumn("_copy", F.col("_to.copy"))
    w = Window.partitionBy("_r").orderBy("_copy", F.col("_id").desc_nulls_last(), "_tie")
    following = sent.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in cols])
    return following.where("_copy = 0").drop("_id", "_range", "_to", "_r", "_copy")


def edited_and_next(docs: DataFrame) -> DataFrame:
    """The documents with ``fingerprint``, the edited text and likenesses."""
    body = docs.select("doc_id", text_or_empty().alias("text"))
    base = with_fingerprint(body, "text", "fingerprint").withColumn("_tie", F.substring("fingerprint", 1, 64))
    pairs = with_next(base, ["text", "fingerprint"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    out = with_fingerprint(pairs.withColumn("edited", edited), "edited", "edited_fingerprint")
    own, other, changed = (F.array_distinct(leaves_of(F.col(c))) for c in ("fingerprint", "next_fingerprint", "edited_fingerprint"))
    out = out.withColumns({"_own": own, "_next": other, "_edited": changed})
    return out.withColumns({
        "n_chars": F.length("text").cast("long"),
        "near_edited": likeness(F.col("fingerprint"), F.col("edited_fingerprint"), F.col("_own"), F.col("_edited")),
        "near_next": likeness(F.col("fingerprint"), F.col("next_fingerprint"), F.col("_own"), F.col("_next"))})


def op4_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (edited_and_next(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    "fingerprint", "edited_fingerprint", "near_edited", "near_next"))
