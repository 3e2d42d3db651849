"""N-gram Jaccard join by grouped prefixes.

A document's set is its distinct word shingles; two documents link when their sets' Jaccard
similarity reaches a threshold. Two sets that similar share a token among the first
``n - ceil(t * n) + 1`` of each in any one order of all tokens (the prefix filter).

1. Tokens are ordered by hash, but those that many documents have go last. They are counted
   over all documents for one eighth of the hash range, which is where prefixes come from; the
   ``HOT_TOKENS`` most frequent at most are broadcast. The order only decides how many
   candidates there are, never which links are found.
2. Documents with equal sets collapse to one set; sets with identical prefix and size collapse
   to one group. Only a group's prefix is indexed, one posting for each token.
3. Groups that share a prefix token are candidates. Pairs of groups are filtered by size, by
   their number of common prefix tokens (with what can follow the last of them) and, where each
   stands for one member (groups of few members are searched member by member), by parity bitmaps: bit i of a set's bitmap is the parity of its tokens that
   fall on i, so two bitmaps differ in no more bits than the sets in tokens. The pairs left
   are expanded to their members, these are filtered by their bitmaps, and each pair of members
   that is left is verified on its whole texts, shingle by shingle.

Near copies share their prefixes with thousands of others, so links are contracted first:
every member is verified against its group's first one, and each group against the ends, the
most copied group and a few neighbours of its first posting lists. Where long lists have several
components left, each of their members is then verified against two others that have a 64-bit
word of the bitmaps in common with it (near copies often do). The components found go into
step 3, which then has to look at pairs of members of different components only; it looks at
all of them, so no link between different components is lost.

A posting list of over ``LIST_ROWS`` groups is cut into parts by a hash: for the contraction each
part is ordered for itself, in step 3 one side of the join is in one part and the other is
sent to all of them. No task has to hold a list or a group.

Tokens are 64-bit hashes while searching. Equal sets are told by size and a 128-bit digest;
links are verified on the shingles themselves.

Defined results: null texts and texts without words have the empty set, link with nothing
and are their own component; fewer words than a shingle make one shingle of all; repeated
rows are returned each, in one component; rows without doc_id get the component of their
group (null if no row of it has an id); other columns, whatever their names, are ignored; an
empty table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysight.llm.common import bound_batches, table, text_or_empty
from paysight.llm.simhash import components
from paysight.session import drop_folder, materialize, scratch_path

#: Words of a shingle and least similarity in percent.
SHINGLE, PERCENT = 3, 90
#: Tokens are counted below this hash (of 2^63), are hot in over ``HOT_DF`` documents, and so many are broadcast at most.
COUNTED_BELOW, HOT_DF, HOT_TOKENS = 2 ** 60, 32, 262_144
#: Groups in one part of a posting list, and cut lists up to which their table is broadcast.
LIST_ROWS, BROADCAST_LISTS = 2048, 100_000
#: Positions of the prefix whose lists serve the contraction, and the neighbours looked at there.
STAR_POSITIONS, NEIGHBOURS = 4, (1, 2, 4, 8, 16)
#: Least length of the lists that a further round of the contraction looks at, and least bits of a telling word of a bitmap.
CROWD, TELLING = 16, 6
#: Members of a group and component up to which each is searched for itself, by its bitmaps.
UNIT_MEMBERS = 1024
#: Shingles that a task remembers while verifying.
REMEMBERED = 200_000
#: Bits of a set's parity bitmaps, and their number (each by other bits of the tokens), as 64-bit columns.
BITS, MAPS = 512, 2
WORDS = [f"b{i}" for i in range(MAPS * BITS // 64)]
#: Buckets of text keys by which texts that are not asked for are left out before they are shuffled.
KEY_BUCKETS = 2 ** 20


# ----------------------------------------------------------------------------- sets
def shingles(body: bytes, k: int = SHINGLE) -> set[bytes]:
    """Distinct shingles of a text's UTF-8 bytes, A-Z lower-cased (words end at space and \\t..\\r)."""
    words = body.lower().split()
    if len(words) < k:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)))


def tokens(found: set[bytes]) -> np.ndarray:
    """Sorted 63-bit hashes."""
    digest = xxhash.xxh3_64_intdigest
    return np.sort(np.fromiter((digest(s) >> 1 for s in found), np.int64, len(found)))


def prefix_size(n: int, percent: int) -> int:
    return n + percent * n // -100 + 1 if n else 0


def prefix_of(toks: np.ndarray, hot: np.ndarray, place: np.ndarray, percent: int, n: int | None = None) -> np.ndarray:
    """The first tokens: by hash, hot ones (sorted in ``hot``) last and in the order of ``place``.
    Of a set of ``n`` tokens ``toks`` may be the part that ``leading`` keeps."""
    p = prefix_size(len(toks) if n is None else n, percent)
    if not len(hot):
        return toks[:p]
    at = np.minimum(np.searchsorted(hot, toks), len(hot) - 1)
    is_hot = hot[at] == toks
    cold = toks[~is_hot][:p]
    if len(cold) == p:
        return cold
    late = toks[is_hot]
    return np.concatenate([cold, late[np.argsort(place[at[is_hot]], kind="stable")][:p - len(cold)]])


def leading(toks: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """What a prefix can be made of, whichever tokens turn out to be hot: all tokens below
    ``COUNTED_BELOW``, and as many of the others, which are never hot, as a prefix has."""
    c = np.searchsorted(toks, COUNTED_BELOW)
    return toks[:c], toks[c:c + prefix_size(len(toks), percent)]


def parity(toks: np.ndarray) -> np.ndarray:
    """The parity bitmaps of a set, one after another, as 64-bit integers."""
    width = BITS.bit_length() - 1
    odd = [(np.bincount((toks >> (width * i)) & (BITS - 1), minlength=BITS) & 1).astype(np.uint8) for i in range(MAPS)]
    return np.packbits(np.concatenate(odd), bitorder="little").view("<i8")


def hot_tokens(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens in ``low`` (sorted), and each one's place by frequency."""
    counts = sets.select(F.explode("low").alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    often = materialize(counts.where(F.col("df") > HOT_DF), "frequent-tokens")
    least, kept = 0, 0
    for r in often.groupBy(F.floor(F.log2("df")).alias("b")).agg(F.count("*").alias("n")).orderBy(F.desc("b")).collect():  # one row a power of two
        if kept + r.n > HOT_TOKENS:
            least = 2 ** (r.b + 1)
            break
        kept += r.n
    found = often.where(F.col("df") >= least).toPandas()  # at most HOT_TOKENS rows
    order = np.argsort(found["token"].to_numpy(np.int64), kind="stable")
    place = np.empty(len(found), np.int64)
    place[np.lexsort((found["token"].to_numpy(np.int64), found["df"].to_numpy(np.int64)))] = np.arange(len(found))
    return found["token"].to_numpy(np.int64)[order], place[order]


def described_sets(docs: DataFrame, text: Column, k: int, percent: int) -> DataFrame:
    """doc_id, key (of the text), n, sig (of the set), leading tokens (low, more) and the bitmap of every row.
    The only step that cuts all texts into shingles."""
    @F.pandas_udf("struct<n: bigint, sig: binary, low: array<bigint>, more: array<bigint>, bits: array<bigint>>")
    def described(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = [tokens(shingles(bytes(b), k)) for b in s]
            low, more = zip(*(leading(t, percent) for t in rows)) if rows else ((), ())
            yield pd.DataFrame({"n": pd.Series(map(len, rows), dtype="int64"), "sig": pd.Series([xxhash.xxh3_128_digest(t.tobytes()) for t in rows], dtype=object),
                                "low": pd.Series(low, dtype=object), "more": pd.Series(more, dtype=object),
                                "bits": pd.Series([parity(t) for t in rows], dtype=object)})
    rows = docs.select("doc_id", _key(text).alias("key"), described(text.cast("binary")).alias("s"))
    return rows.select("doc_id", "key", "s.n", "s.sig", "s.low", "s.more", *[F.col("s.bits")[i].alias(w) for i, w in enumerate(WORDS)])


def document_sets(docs: DataFrame, text: Column, k: int, percent: int) -> DataFrame:
    """doc_id, key (of the text), n, sig (of the set), prefix, its digest and the bitmap of every row."""
    spark = docs.sparkSession
    path = scratch_path(spark, "described-sets")
    described_sets(docs, text, k, percent).write.parquet(path)
    sets = spark.read.parquet(path)
    hot = spark.sparkContext.broadcast(hot_tokens(sets))

    @F.pandas_udf("struct<prefix: array<bigint>, head: binary>")
    def headed(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        often, place = hot.value
        for sizes, low, more in batches:
            first = [prefix_of(np.concatenate([a, b]).astype(np.int64, copy=False), often, place, percent, n) for n, a, b in zip(sizes, low, more)]
            yield pd.DataFrame({"prefix": pd.Series(first, dtype=object), "head": pd.Series([xxhash.xxh3_128_digest(t.tobytes()) for t in first], dtype=object)})
    rows = sets.select("doc_id", "key", "n", "sig", headed("n", "low", "more").alias("h"), *WORDS)
    out = materialize(rows.select("doc_id", "key", "n", "sig", "h.prefix", "h.head", *WORDS), "document-sets")
    drop_folder(spark, path)
    return out


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


# ----------------------------------------------------------------------------- verification
def similar(a: set, b: set, percent: int) -> bool:
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _needed(nx: Column, ny: Column, percent: int) -> Column:
    """Least number of common tokens of similar sets of these sizes."""
    return F.ceil((nx + ny) * percent / (100 + percent) - 1e-6)


def _bitmaps_allow(x: str, y: str, percent: int) -> Column:
    """Whether each of two rows' bitmaps differs in no more bits than similar sets may in tokens."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    most = nx + ny - 2 * _needed(nx, ny, percent)
    words = [F.bit_count(F.col(f"{x}.{w}").bitwiseXOR(F.col(f"{y}.{w}"))) for w in WORDS]
    per = BITS // 64
    return reduce(lambda a, b: a & b, [reduce(lambda a, b: a + b, words[i:i + per]) <= most for i in range(0, len(words), per)])


def bitmap_filter(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids that their sizes and bitmaps allow."""
    rows = sets.select("sid", "n", *WORDS)
    met = pairs.alias("p").join(rows.alias("x"), F.col("p.a") == F.col("x.sid")).join(rows.alias("y"), F.col("p.b") == F.col("y.sid"))
    return met.where(_compatible(F.col("x.n"), F.col("y.n"), percent) & _bitmaps_allow("x", "y", percent)).select("p.a", "p.b")


def texts_of(pairs: DataFrame, sets: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """(sid, body) of the sets in the pairs. Only texts in the same bucket as one of them are shuffled;
    the buckets, at most ``KEY_BUCKETS`` numbers, are broadcast."""
    asked = materialize(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct().join(sets.select("sid", "key"), "sid"), "asked-texts")
    bucket = F.pmod(F.xxhash64("key"), F.lit(KEY_BUCKETS))
    bodies = docs.select(_key(text).alias("key"), text.cast("binary").alias("body")).withColumn("bucket", bucket)
    bodies = bodies.join(F.broadcast(asked.select(bucket.alias("bucket")).distinct()), "bucket", "left_semi")
    return materialize(asked.join(bodies.groupBy("key").agg(F.any_value("body").alias("body")), "key").select("sid", "body"), "candidate-texts")


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids whose sets are similar."""
    @F.pandas_udf("boolean")
    def links(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        known: OrderedDict[int, set] = OrderedDict()
        size = 0

        def of(sid: int, body: bytes) -> set:
            nonlocal size
            if (found := known.get(sid)) is None:
                found = known[sid] = shingles(bytes(body), k)
                size += len(found)
                while size > REMEMBERED and len(known) > 2:
                    size -= len(known.popitem(last=False)[1])
            else:
                known.move_to_end(sid)
            return found
        for a, ta, b, tb in batches:
            yield pd.Series([similar(of(*x), of(*y), percent) for x, y in zip(zip(a, ta), zip(b, tb))], dtype="bool")
    left, right = (texts.select(F.col("sid").alias(x), F.col("body").alias(f"t{x}")) for x in "ab")
    return pairs.join(left, "a").join(right, "b").where(links("a", "ta", "b", "tb")).select("a", "b")


# ----------------------------------------------------------------------------- join
def _compatible(x: Column, y: Column, percent: int) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _in_parts(lists: DataFrame, rows: DataFrame, by: str = "gid") -> DataFrame:
    """Rows (token, ``by``, ...) with the columns of their list (token, m, ...), ``parts`` and ``part``."""
    parts = F.ceil(F.col("m") / LIST_ROWS).cast("int")
    return rows.join(lists, "token").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64(by), F.col("parts")).cast("int"))


def _stars(shared: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of groups: each with the ends, the most copied group and neighbours of its lists."""
    near = shared.where(F.col("pos") < STAR_POSITIONS)
    me = F.struct("n", "gid")
    ends = near.groupBy("token").agg(F.count("*").alias("m"), F.min(me).alias("lo"), F.max(F.struct("copies", "n", "gid")).alias("top")).where("m > 1")
    part = Window.partitionBy("token", "part")
    order = part.orderBy("n", "gid")
    others = F.array("lo", F.struct("top.n", "top.gid"), F.min(me).over(part), *[F.lag(me, i).over(order) for i in NEIGHBOURS])
    met = _in_parts(ends, near).withColumn("others", others)
    met = met.select("gid", "n", F.explode("others").alias("o")).where(F.col("o").isNotNull() & (F.col("o.gid") != F.col("gid")) & _compatible(F.col("n"), F.col("o.n"), percent))
    return met.select(F.least("gid", "o.gid").alias("a"), F.greatest("gid", "o.gid").alias("b")).distinct()


def _mixed(postings: DataFrame, least: int = 2) -> DataFrame:
    """(token, m) of the lists with several components, of postings (token, c, ...)."""
    return (postings.groupBy("token").agg(F.count("*").alias("m"), F.min("c").alias("lo"), F.max("c").alias("hi"))
            .where((F.col("lo") < F.col("hi")) & (F.col("m") >= least)).select("token", "m"))


def _alike_pairs(rows: DataFrame, words: list[str]) -> DataFrame:
    """Pairs (a, b) of members of different components, of rows (sid, c, words): each with the
    members of least and greatest component that share one of the words."""
    flat = rows.select("sid", "c", F.posexplode(F.array(*words)).alias("i", "word")).where(F.bit_count("word") >= TELLING)
    ends = flat.groupBy("i", "word").agg(F.min(F.struct("c", "sid")).alias("lo"), F.max(F.struct("c", "sid")).alias("hi")).where("lo.c < hi.c")
    met = flat.join(ends, ["i", "word"]).select("sid", "c", F.explode(F.array("lo", "hi")).alias("o")).where("o.c <> c")
    return met.select(F.least("sid", "o.sid").alias("a"), F.greatest("sid", "o.sid").alias("b")).distinct()


def _units(joined: DataFrame) -> DataFrame:
    """The members with the unit that is searched for them: themselves, or where a group and component
    have over ``UNIT_MEMBERS`` members, the least one (not ``single``)."""
    many = joined.groupBy("gid", "c").agg(F.count("*").alias("members"), F.min("sid").alias("least"))
    single = F.col("members") <= UNIT_MEMBERS
    return joined.join(many, ["gid", "c"]).withColumns({"single": single, "unit": F.when(single, F.col("sid")).otherwise(F.col("least"))}).drop("members", "least")


def _unit_pairs(shared: DataFrame, units: DataFrame, member: DataFrame, percent: int) -> DataFrame:
    """(ua, ub): units of different groups and components whose members may still link."""
    heads = units.where("sid = unit")
    postings = shared.select("token", "pos", "n", "gid").join(heads.select("gid", "c", "unit", "single"), "gid")
    # the bitmaps, which are wider than all else, go along only where a list has several components
    met = materialize(_in_parts(_mixed(postings), postings, "unit").join(member.select(F.col("sid").alias("unit"), *WORDS), "unit"), "mixed-postings")
    x = met.alias("x")
    y = met.where("parts = 1").unionByName(met.where("parts > 1").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))).alias("y")
    # of the smaller set a shorter prefix is enough, as both have at least its share of common tokens
    short = {s: F.col(f"{s}.pos") <= F.col(f"{s}.n") - F.ceil(F.col(f"{s}.n") * (2 * percent) / (100 + percent) - 1e-6) for s in "xy"}
    indexed = F.when(F.struct("x.n", "x.unit") < F.struct("y.n", "y.unit"), short["x"]).otherwise(short["y"])
    # common tokens: at most those before this one in either prefix, and what is left from it on in the shorter rest
    reach = F.least("x.pos", "y.pos") + F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    both = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.c") < F.col("y.c")) & (F.col("x.gid") != F.col("y.gid"))
                  & _compatible(F.col("x.n"), F.col("y.n"), percent)
                  & indexed & (reach >= _needed(F.col("x.n"), F.col("y.n"), percent)) & (~(F.col("x.single") & F.col("y.single")) | _bitmaps_allow("x", "y", percent)))
    common = (both.groupBy(F.col("x.unit").alias("ua"), F.col("y.unit").alias("ub"))
              .agg(F.count("*").alias("same"), F.max("x.pos").alias("pa"), F.max("y.pos").alias("pb"), F.first("x.n").alias("na"), F.first("y.n").alias("nb")))
    most = F.col("same") + F.least(F.col("na") - 1 - F.col("pa"), F.col("nb") - 1 - F.col("pb"))
    return common.where(most >= _needed(F.col("na"), F.col("nb"), percent)).select("ua", "ub")


def set_components(rows: DataFrame, docs: DataFrame, text: Column, k: int, percent: int) -> DataFrame:
    """sig, n and component_id of every different set of ``rows`` (from ``document_sets``)."""
    sets = materialize(rows.where("n > 0").groupBy("n", "sig").agg(*[F.any_value(c).alias(c) for c in ("prefix", "head", *WORDS)], F.min("key").alias("key"),
                                                             F.count("*").alias("copies"), F.min("doc_id").alias("least_doc"))
                       .withColumn("sid", F.monotonically_increasing_id()), "different-sets")
    groups = materialize(sets.groupBy("n", "head").agg(F.any_value("prefix").alias("prefix"), F.min("sid").alias("gid"), F.sum("copies").alias("copies")), "prefix-groups")
    postings = groups.select("gid", "n", "copies", F.posexplode("prefix").alias("pos", "token"))
    shared = materialize(postings.join(postings.groupBy("token").agg(F.count("*").alias("m")).where("m > 1").select("token"), "token"), "shared-postings")
    member = materialize(sets.select("sid", "n", "head", *WORDS).join(groups.select("n", "head", "gid"), ["n", "head"]).drop("head"), "members")

    def links_of(pairs: DataFrame, name: str) -> DataFrame:
        left = materialize(bitmap_filter(pairs, member, percent), name)
        return verified(left, texts_of(left, sets, docs, text), k, percent)
    def merged(now: DataFrame, links: DataFrame, name: str) -> DataFrame:
        """The members with their components (c) after these links between them."""
        of = now.select("sid", "c")
        linked = of.join(links.withColumnRenamed("a", "sid"), "sid").select(F.col("c").alias("ca"), F.col("b").alias("sid"))
        found = components(linked.join(of, "sid").select(F.col("ca").alias("a"), F.col("c").alias("b"))).withColumnsRenamed({"node": "c", "root": "top"})
        return materialize(now.join(found, "c", "left").withColumn("c", F.coalesce("top", "c")).drop("top"), name)
    inside = member.where("sid <> gid").select(F.col("gid").alias("a"), F.col("sid").alias("b"))
    joined = merged(member.select("sid", "gid", F.col("sid").alias("c")), links_of(_stars(shared, percent).unionByName(inside), "star-pairs"), "first-components")
    per = BITS // 64
    for i in range(0, len(WORDS), per):
        heads = joined.where("sid = gid").select("gid", "c")
        postings = shared.select("token", "gid").join(heads, "gid")
        crowded = postings.join(_mixed(postings, CROWD).select("token"), "token", "left_semi").select("gid").distinct()
        rows = joined.join(crowded, "gid").join(member.select("sid", *WORDS[i:i + per]), "sid")
        new = materialize(links_of(_alike_pairs(rows, WORDS[i:i + per]), "alike-pairs"), "alike-links")
        if new.isEmpty():
            break
        joined = merged(joined, new, "more-components")
    units = materialize(_units(joined), "units")
    x, y = (units.select(F.col("sid").alias(s), F.col("unit").alias(f"u{s}")) for s in "ab")
    between = _unit_pairs(shared, units, member, percent).join(x, "ua").join(y, "ub").select("a", "b")
    split = joined.groupBy("gid").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("gid")
    parts = joined.join(split, "gid").join(member.select("sid", "n", *WORDS), "sid")
    own = (parts.alias("x").join(parts.alias("y"), (F.col("x.gid") == F.col("y.gid")) & (F.col("x.c") < F.col("y.c")) & _bitmaps_allow("x", "y", percent))
           .select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b")))
    links = links_of(between.unionByName(own), "member-pairs")
    comp = merged(joined.select("sid", "c"), links, "last-components").select("sid", F.col("c").alias("comp"))
    placed = materialize(sets.select("sid", "n", "sig", "least_doc").join(comp, "sid", "left").withColumn("comp", F.coalesce("comp", "sid")), "set-components")
    least = placed.groupBy("comp").agg(F.min("least_doc").alias("component_id"))
    return placed.join(least, "comp").select("n", "sig", "component_id")


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    bound_batches(docs.sparkSession)
    body = text_or_empty(text)
    rows = document_sets(docs, body, shingle, percent)
    found = set_components(rows, docs, body, shingle, percent)
    linked = rows.where("n > 0").join(found, ["n", "sig"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
