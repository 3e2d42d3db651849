"""Fitted feature transforms (T1-T5) in DataFrame form, plus Spark ML stages.

DataFrame forms are what the oracle checks and what the models consume: every
"fit" is a grouped aggregate on the training rows and every "transform" is a join
of those (small, per-category) statistics back to the rows.
"""

from __future__ import annotations

import math

from pyspark.ml import Estimator
from pyspark.ml.feature import (IDF, CountVectorizer, ElementwiseProduct, NGram, Normalizer,
                                OneHotEncoder,
                                RegexTokenizer, SQLTransformer, StandardScaler, StopWordsRemover,
                                StringIndexer, VectorAssembler)
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysight.config import OHE_MIN_FREQUENCY

INFREQUENT = "__infrequent__"


# ----------------------------------------------------------------------------- T1
def standardize(train: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population std with means and stds from ``train``.

    A zero-variance column is divided by 1. The statistics are one row,
    attached as a scalar subquery.
    """
    st = train.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in columns],
                            *[F.stddev_pop(c).alias(f"s_{c}") for c in columns])).scalar()
    out = {}
    for c in columns:
        s = st[f"s_{c}"]
        out[c] = (F.col(c) - st[f"m_{c}"]) / F.when(s == 0, F.lit(1.0)).otherwise(s)
    return df.withColumns(out)


# ----------------------------------------------------------------------------- T2
def frequent_categories(train: DataFrame, col: str,
                        min_frequency: int = OHE_MIN_FREQUENCY) -> DataFrame:
    """T2 fit: categories seen on train with their slot; rare ones share one slot."""
    return slots_of_counts(train.groupBy(F.col(col).alias("category")).agg(F.count("*").alias("n")), min_frequency)


def slots_of_counts(counts: DataFrame, min_frequency: int) -> DataFrame:
    """The slot of each (category, n)."""
    return counts.select("category", F.when(F.col("n") >= min_frequency, F.col("category"))
                         .otherwise(F.lit(INFREQUENT)).alias("slot"))


def one_hot_slot(df: DataFrame, fitted: DataFrame, col: str, out: str) -> DataFrame:
    """T2 transform: slot of each row; unseen categories get NULL (all-zero block).

    ``fitted`` has one row per distinct training category; Spark broadcasts it when
    its measured size is under the broadcast threshold and shuffles otherwise.
    """
    f = fitted.withColumnRenamed("category", col).withColumnRenamed("slot", out)
    return df.join(f, col, "left")


# ----------------------------------------------------------------------------- T3
def fold_statistics(train: DataFrame, y: str, fold: str) -> DataFrame:
    """Global mean / population variance of ``y`` over the *other* folds, one row per
    fold (k rows): fold sums subtracted from the totals. Shared by every encoded
    column of one training frame."""
    ft = train.groupBy(fold).agg(F.count("*").alias("fn"), F.sum(y).alias("fs"),
                                 F.sum(F.col(y) * F.col(y)).alias("fq"))
    tot = train.agg(F.struct(F.count("*").alias("n"), F.sum(y).alias("s"),
                             F.sum(F.col(y) * F.col(y)).alias("q"))).scalar()
    g = ft.select(fold, (tot["n"] - F.col("fn")).alias("gn"), (tot["s"] - F.col("fs")).alias("gs"),
                  (tot["q"] - F.col("fq")).alias("gq"))
    return g.select(fold, (F.col("gs") / F.col("gn")).alias("gmean"),
                    (F.col("gq") / F.col("gn") - F.pow(F.col("gs") / F.col("gn"), 2))
                    .alias("gvar"))


def target_encode_crossfit(train: DataFrame, col: str, y: str, fold: str,
                           gstats: DataFrame | None = None) -> DataFrame:
    """T3 (training rows): out-of-fold empirical-Bayes target encoding.

    One grouped aggregate of (n, sum y, sum y^2) per (category, fold); the
    out-of-fold statistics are category totals minus the own fold, and the
    global mean / variance likewise per fold (``fold_statistics``, pass it in to
    share it between columns). Encoding:
    lambda = n*var_y / (n*var_y + var_cat) (population variances);
    enc = lambda*mean_cat + (1-lambda)*mean_y; unseen -> mean_y.
    """
    g = train.groupBy(col, fold).agg(F.count("*").alias("n"), F.sum(y).alias("s"),
                                      F.sum(F.col(y) * F.col(y)).alias("q"))
    return crossfit_of_sums(g, col, fold, fold_statistics(train, y, fold) if gstats is None else gstats)


def crossfit_of_sums(g: DataFrame, col: str, fold: str, gstats: DataFrame) -> DataFrame:
    """The same from (category, fold, n, s, q) and the global statistics of the other folds."""
    cat_tot = g.groupBy(col).agg(F.sum("n").alias("tn"), F.sum("s").alias("ts"),
                                 F.sum("q").alias("tq"))
    # category statistics of the other folds, one row per (category, fold)
    oof = (g.join(cat_tot, col)
           .select(col, fold, (F.col("tn") - F.col("n")).alias("on"),
                   (F.col("ts") - F.col("s")).alias("os"), (F.col("tq") - F.col("q")).alias("oq")))
    oof = oof.join(F.broadcast(gstats), fold).withColumn(  # k rows
        "enc", _eb_encoding(F.col("on"), F.col("os"), F.col("oq"), F.col("gmean"),
                            F.col("gvar")))
    return oof.select(col, fold, "enc", "gmean")


def _eb_encoding(n: Column, s: Column, q: Column, gmean: Column, gvar: Column) -> Column:
    mean = F.try_divide(s, n)
    var = F.try_divide(q, n) - mean * mean
    var = F.when(var < 0, F.lit(0.0)).otherwise(var)
    lam = F.try_divide(n * gvar, n * gvar + var)
    return F.when((n <= 0) | lam.isNull() | F.isnan(lam), gmean) \
        .otherwise(lam * mean + (1 - lam) * gmean)


def apply_crossfit_encoding(rows: DataFrame, table: DataFrame, col: str, fold: str,
                            out: str) -> DataFrame:
    """Attach an out-of-fold encoding table (from ``target_encode_crossfit``) to the
    training rows; a category unseen in the other folds gets that fold's mean.

    The table is built from the base training frame, never from ``rows``, so
    chaining several encoded columns does not nest plans."""
    gm = table.select(fold, "gmean").distinct()  # k rows
    enc = table.select(col, fold, F.col("enc").alias(f"_{out}"))
    j = rows.join(enc, [col, fold], "left").join(F.broadcast(gm), fold, "left")
    return j.withColumn(out, F.coalesce(F.col(f"_{out}"), F.col("gmean"))).drop(f"_{out}", "gmean")


def fit_target_encoding(train: DataFrame, col: str, y: str) -> tuple[DataFrame, Column]:
    """T3 (inference): encoding per category from all training rows, and the
    global mean for unseen categories."""
    st = train.agg(F.struct(F.avg(y).alias("m"), F.var_pop(y).alias("v"))).scalar()
    g = train.groupBy(col).agg(F.count("*").alias("n"), F.sum(y).alias("s"),
                               F.sum(F.col(y) * F.col(y)).alias("q"))
    return encodings_of_sums(g, col, st["m"], st["v"]), st["m"]


def encodings_of_sums(g: DataFrame, col: str, mean: Column, var: Column) -> DataFrame:
    """The encoding of each (category, n, s, q)."""
    return g.select(col, _eb_encoding(F.col("n"), F.col("s"), F.col("q"), mean, var).alias("enc"))


def apply_target_encoding(df: DataFrame, enc: DataFrame, default: Column, col: str,
                          out: str) -> DataFrame:
    e = enc.withColumnRenamed("enc", f"_{out}")
    return (df.join(e, col, "left").withColumn(out, F.coalesce(F.col(f"_{out}"), default))
            .drop(f"_{out}"))


# ----------------------------------------------------------------------------- T4/T5
def tokens(df: DataFrame, id_col: str, text: str, pattern: str, lower: bool = True,
           min_len: int = 1) -> DataFrame:
    """(id, position, token) rows of a text column: regex matches, whole text."""
    t = F.lower(F.col(text)) if lower else F.col(text)
    arr = F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(pattern), 0)
    out = df.select(id_col, F.posexplode(arr).alias("pos", "token"))
    if min_len > 1:
        out = out.filter(F.length("token") >= min_len)
    return out


#: Buckets of a hash by which terms are counted before each term is.
TERM_BUCKETS = 2 ** 17


def most_frequent_terms(rows: DataFrame, wanted: int, least_count: int = 1) -> DataFrame:
    """(term, cf) of the ``wanted`` terms that occur most (ties by term) among ``rows``, of those
    that occur ``least_count`` times.

    Exact, but terms that cannot be among them are not counted one by one: no term occurs more
    often than its bucket, and buckets are few whatever the number of terms. Terms of the large
    buckets are counted; where the last one wanted is rarer than a bucket left out, that one's too."""
    from paysight.session import materialize
    bucket = F.pmod(F.xxhash64("term"), F.lit(TERM_BUCKETS)).cast("int")
    sizes = materialize(rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")), "term-buckets")
    top = sizes.orderBy(F.desc("n")).limit(wanted).agg(F.count("*"), F.min("n")).first()
    least = top[1] // 2 if top[0] == wanted else 0
    while True:
        asked = sizes.filter(F.col("n") >= least).select("bucket")  # TERM_BUCKETS rows at most
        counted = rows.withColumn("bucket", bucket).join(F.broadcast(asked), "bucket", "left_semi")
        found = materialize(counted.groupBy("term").agg(F.count("*").alias("cf")).filter(F.col("cf") >= least_count)
                            .orderBy(F.desc("cf"), "term").limit(wanted), "frequent-terms")
        n, last = found.agg(F.count("*"), F.min("cf")).first()
        if least <= least_count or (n == wanted and last >= least):
            return found
        least = last if n == wanted else 0


def tfidf_long(terms: DataFrame, id_col: str, fit_ids: DataFrame, vocab_size: int,
               min_df: int = 1, all_fit: bool = False) -> DataFrame:
    """TF-IDF in long form (id, term, weight), smooth idf ln((1+n)/(1+df)) + 1,
    raw counts, L2-normalised per document. Vocabulary: terms of the fitting
    documents with df >= min_df, the ``vocab_size`` most frequent by corpus count
    (ties by term). ``all_fit``: ``fit_ids`` are the ids of all documents of ``terms``.

    Counts by document, and with them df, are taken of the terms most frequent in the corpus
    only: of more and more of them, until enough have ``min_df`` or none is left."""
    from pyspark.sql.window import Window
    from paysight.session import materialize
    ids = None if all_fit else materialize(fit_ids.distinct(), "fit-ids")  # joined by its own size, not by its source's

    def fitting(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col(id_col).isNotNull()) if all_fit else rows.join(ids, id_col, "left_semi")
    n_docs = fit_ids.agg(F.count("*")).scalar()
    wanted = vocab_size + vocab_size // 4 + 1
    while True:
        # a term is in no more documents than it occurs
        first = most_frequent_terms(fitting(terms).select("term"), wanted, min_df)
        # read by the vocabulary and by the weighting: written once; ``wanted`` rows are broadcast
        tf = materialize(terms.join(F.broadcast(first.select("term")), "term").groupBy(id_col, "term")
                         .agg(F.count("*").alias("tf")), "term-counts")
        stats = fitting(tf).groupBy("term").agg(F.count("*").alias("df")).filter(F.col("df") >= min_df)
        vocab = materialize(stats.join(F.broadcast(first), "term").orderBy(F.desc("cf"), "term").limit(vocab_size), "vocabulary")
        if vocab.count() == vocab_size or first.count() < wanted:
            break
        wanted *= 4
    idf = vocab.select("term", (F.log((1 + n_docs) / (1 + F.col("df"))) + 1).alias("idf"))
    # the vocabulary is capped at ``vocab_size`` rows: a bounded broadcast
    w = tf.join(F.broadcast(idf), "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", (F.col("w") / norm).alias("weight"))


def skill_terms(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """T4 tokens: runs of non-space characters, lower-cased, unigrams."""
    return tokens(df, id_col, text, r"[^\s]+").select(id_col, F.col("token").alias("term"))


WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


def word_terms(df: DataFrame, id_col: str, text: str, stop_words: list[str],
               ngram_max: int = 2) -> DataFrame:
    """T5 tokens: word runs of >= 2 characters, lower-cased, stop words removed,
    then 1..n-grams over the remaining sequence. Per-row array work on the whole
    text, no shuffle; one explode at the end."""
    from paysight.session import spread
    df = spread(df)
    t = F.coalesce(F.lower(F.col(text)), F.lit(""))
    # a literal IN list is turned into a hash-set lookup by the optimizer
    words = F.filter(F.regexp_extract_all(t, F.lit(WORD_PATTERN), 0),
                     lambda x: ~x.isin(*stop_words))
    base = df.select(id_col, words.alias("_w"))
    w = F.col("_w")
    grams = w
    for k in range(2, ngram_max + 1):
        # k-grams by zipping the sequence with its shifted copies: one linear pass
        kg = w
        for j in range(1, k):
            shifted = F.slice(w, j + 1, F.greatest(F.size(w) - j, F.lit(0)))
            kg = F.zip_with(kg, shifted, lambda a, b: F.when(
                a.isNotNull() & b.isNotNull(), F.concat(a, F.lit(" "), b)))
        grams = F.concat(grams, F.filter(kg, lambda x: x.isNotNull()))
    return base.select(id_col, F.explode(grams).alias("term"))


# ----------------------------------------------------------------------------- ML stages
def smooth_idf(n_docs: int, df: int) -> float:
    return math.log((1 + n_docs) / (1 + df)) + 1.0


class SmoothIdf(Estimator):
    """Smooth idf ln((1+n)/(1+df)) + 1. Spark's IDF gives ln((n+1)/(df+1)); the fitted
    vector plus one becomes an ``ElementwiseProduct`` scaling (sparsity kept)."""

    def __init__(self, inputCol: str, outputCol: str, minDocFreq: int = 0):
        super().__init__()
        self.inputCol, self.outputCol, self.minDocFreq = inputCol, outputCol, minDocFreq

    def _fit(self, df: DataFrame):
        m = IDF(inputCol=self.inputCol, outputCol="_idf_tmp", minDocFreq=self.minDocFreq).fit(df)
        scale = DenseVector([v + 1.0 for v in m.idf.toArray()])
        return ElementwiseProduct(scalingVec=scale, inputCol=self.inputCol,
                                  outputCol=self.outputCol)


def feature_stages(numeric: list[str], ohe: list[str], te_cols: list[str],
                   skills_text: str, title_text: str, stop_words: list[str],
                   skills_vocab: int, title_vocab: int, title_min_df: int) -> list:
    """T6 stages: scaler, rare-bucket one-hot, target-encoded columns, two TF-IDF
    blocks, assembled into one sparse ``features`` vector."""
    stages = [VectorAssembler(inputCols=numeric, outputCol="_num", handleInvalid="keep"),
              StandardScaler(inputCol="_num", outputCol="_num_s", withMean=True, withStd=True)]
    for c in ohe:
        stages += [StringIndexer(inputCol=f"{c}__slot", outputCol=f"_{c}_i",
                                 handleInvalid="keep", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCol=f"_{c}_i", outputCol=f"_{c}_v", dropLast=True)]
    stages += [RegexTokenizer(inputCol=skills_text, outputCol="_sk_tok", pattern=r"\s+",
                              toLowercase=True),
               CountVectorizer(inputCol="_sk_tok", outputCol="_sk_tf", vocabSize=skills_vocab),
               SmoothIdf(inputCol="_sk_tf", outputCol="_sk_w"),
               Normalizer(inputCol="_sk_w", outputCol="_sk_v", p=2.0),
               RegexTokenizer(inputCol=title_text, outputCol="_ti_tok",
                              pattern=WORD_PATTERN, gaps=False,
                              toLowercase=True),
               StopWordsRemover(inputCol="_ti_tok", outputCol="_ti_sw", stopWords=stop_words),
               NGram(n=2, inputCol="_ti_sw", outputCol="_ti_bi"),
               SQLTransformer(statement="SELECT *, concat(_ti_sw, _ti_bi) AS _ti_all FROM __THIS__"),
               CountVectorizer(inputCol="_ti_all", outputCol="_ti_tf", vocabSize=title_vocab,
                               minDF=float(title_min_df)),
               SmoothIdf(inputCol="_ti_tf", outputCol="_ti_w"),
               Normalizer(inputCol="_ti_w", outputCol="_ti_v", p=2.0),
               VectorAssembler(inputCols=["_num_s", *[f"_{c}_v" for c in ohe], *te_cols,
                                          "_sk_v", "_ti_v"],
                               outputCol="features", handleInvalid="keep")]
    return stages

