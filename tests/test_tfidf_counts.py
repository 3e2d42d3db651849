"""TF-IDF counts terms over the corpus first, and by document only those that can be in the vocabulary."""

import math
from collections import Counter

import pytest

import paysight.session as session
from paysight.operators import encoders as T

DOCS = [(1, "a a b c"), (2, "a b b d"), (3, "c c c c c c c"), (1, "b e"), (None, "a a a z"), (4, None), (5, "f a"), (5, "f d"), (6, "g h i j k")]


def brute(docs, fit, size, min_df):
    tf = Counter((i, w) for i, t in docs for w in (t or "").split())
    ids = {i for i in fit if i is not None}
    cf, df = Counter(), Counter()
    for (i, w), n in tf.items():
        if i in ids:
            cf[w] += n
            df[w] += 1
    vocab = sorted((w for w in cf if df[w] >= min_df), key=lambda w: (-cf[w], w))[:size]
    weight = {(i, w): n * (math.log((1 + len(fit)) / (1 + df[w])) + 1) for (i, w), n in tf.items() if w in vocab}
    norm = Counter()
    for (i, _), x in weight.items():
        norm[i] += x * x
    return {k: pytest.approx(x / math.sqrt(norm[k[0]])) for k, x in weight.items()}


def got(rows):
    return {(r[0], r.term): r.weight for r in rows.collect()}


@pytest.mark.parametrize("size, min_df, buckets", [(3, 1, 2 ** 17), (3, 2, 4), (1, 3, 1), (100, 1, 7), (2, 4, 3)])
def test_repeated_and_null_ids(spark, monkeypatch, size, min_df, buckets):
    """Also where the most frequent term is in too few documents, and where terms share buckets."""
    monkeypatch.setattr(T, "TERM_BUCKETS", buckets)
    docs = spark.createDataFrame(DOCS, "id long, t string").repartition(3)
    terms = T.skill_terms(docs, "id", "t")
    whole = [i for i, _ in DOCS]
    assert got(T.tfidf_long(terms, "id", docs.select("id"), size, min_df, all_fit=True)) == brute(DOCS, whole, size, min_df)
    assert got(T.tfidf_long(terms, "id", docs.select("id"), size, min_df)) == brute(DOCS, whole, size, min_df)
    some = docs.filter("id in (1, 2, 5)").select("id")
    assert got(T.tfidf_long(terms, "id", some, size, min_df)) == brute(DOCS, [1, 2, 1, 5, 5], size, min_df)


def test_rare_terms_are_not_counted_by_document(spark, monkeypatch):
    written = {}
    write = session.materialize

    def noted(df, name):
        out = write(df, name)
        written.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(session, "materialize", noted)
    docs = spark.createDataFrame([(i, "x y " + " ".join(f"r{i}_{j}" for j in range(50))) for i in range(40)], "id long, t string")
    rows = T.tfidf_long(T.skill_terms(docs, "id", "t"), "id", docs.select("id"), 2, 2, all_fit=True)
    assert {r.term for r in rows.collect()} == {"x", "y"}
    assert max(written["term-counts"]) <= 3 * 40  # 2,080 (document, term) pairs in all
