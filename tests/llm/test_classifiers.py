"""Quality and language classifiers: held-out accuracy and edge rows."""
import zlib

import pytest

from paysight.llm import language, quality
from tests.llm.conftest import SF

SF10 = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 3 == 1


def test_quality_held_out(spark):
    rows = {r.doc_id: r for r in quality.op8_quality(spark, SF10).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF10}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF10}/documents.parquet").count()
    assert all(r.held_out == held(d) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in rows.items())
    test = [(rows[d].predicted, q) for d, q in labels.items() if held(d)]
    good, bad = [p for p, q in test if q == 1], [p for p, q in test if q == 0]
    assert sum(good) / len(good) > 0.97 and 1 - sum(bad) / len(bad) > 0.85


def test_quality_does_not_read_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - quality, quality) quality")
    a, b = ({r.doc_id: r.score for r in quality.quality_scores(docs, docs, x).collect()} for x in (labels, flipped))
    assert a == b


@pytest.mark.parametrize("rows", [[], [(5, 1)], [(5, 1), (6, None), (7, 3), (None, 0), (99999, 0)]])
def test_quality_without_two_labels(spark, edge_docs, no_docs, rows):
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    out = quality.quality_scores(edge_docs, edge_docs, labels).collect()
    assert len(out) == edge_docs.count() and len({r.score for r in out}) == 1
    assert quality.keep_good(no_docs, labels).count() == 0


def test_quality_edge_rows(spark, edge_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] * 2 + [(3, 0)], "doc_id long, quality int")
    out = quality.quality_scores(edge_docs, edge_docs, labels).collect()
    assert all(0 <= r.score <= 1 for r in out) and len(out) == edge_docs.count()
    kept = quality.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in out if r.score >= 0.5)


def test_votes_equal_brute_force():
    import numpy as np
    rng = np.random.default_rng(1)
    counts = rng.poisson(1, (60, quality.TERMS)).astype(np.float32)
    labels = (rng.random(60) < 0.5).astype(float)
    space = quality.Space(counts, labels)
    got = space.scores(counts[:10])
    z = space._latent(space._weighted(counts[:10]))
    for i in range(10):
        cos = sorted(((float(z[i] @ v), y) for v, y in zip(space.vectors, space.labels)), reverse=True)[:quality.NEIGHBOURS]
        w = [max(c, 0) for c, _ in cos]
        assert abs(got[i] - sum(a * y for a, (_, y) in zip(w, cos)) / sum(w)) < 1e-5


def test_language_held_out(spark):
    rows = {r.doc_id: r for r in language.op9_language(spark, SF10).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF10}/documents.parquet").collect()}
    assert rows.keys() == truth.keys() and all(r.held_out == held(d) and 0 <= r.score <= 1 for d, r in rows.items())
    test = [rows[d].lang_pred == lang for d, lang in truth.items() if held(d) and lang]
    assert sum(test) / len(test) > 0.95


def test_language_does_not_read_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    changed = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 'xx', lang) lang")
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in language.languages(docs.drop("lang"), x).collect()} for x in (docs, changed))
    assert a == b and all(x[0] != "xx" for x in a.values())


def test_language_edge_rows(spark, edge_docs, no_docs):
    out = language.languages(edge_docs, edge_docs).collect()
    assert len(out) == edge_docs.count()
    for r in out:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")), r.text
        assert r.lang_pred in ("en", "fr", "und")
    assert all(r.lang_pred == "und" and r.score == 0 for r in language.languages(edge_docs, no_docs.select("doc_id", "text", "lang")).collect())
    assert language.languages(no_docs, no_docs).count() == 0
    kept = language.keep_known(edge_docs)
    assert kept.columns == edge_docs.columns and all(any(c.isalpha() for c in r.text) for r in kept.collect())


def test_weights_are_sparse_and_calibrated(spark):
    import numpy as np
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    m = language.fit(docs)
    assert 0.05 <= m.temperature <= 20 and np.mean(m.weights == 0) > 0.3 and set(m.langs) <= {"en", "fr", "de", "es"}
