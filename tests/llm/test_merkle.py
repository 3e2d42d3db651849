import hashlib

from pyspark.sql import functions as F

from paysight.llm import merkle
from tests.llm.conftest import SF


def brute_edit(docs):
    """docs: (id, text, tie) in order; edited texts."""
    out = []
    for i, t in enumerate(docs):
        nxt = docs[(i + 1) % len(docs)]
        half = len(t) // 2
        out.append(t[:len(t) - half] + nxt[:half])
    return out


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_query_against_brute_force(spark):
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), reverse=True)
    edited = dict(zip((d for d, _ in docs), brute_edit([t for _, t in docs]), strict=True))
    rows = {r.doc_id: r for r in merkle.op4_merkle(spark, SF).collect()}
    assert rows.keys() == edited.keys()
    prints = {}
    for d, t in docs:
        r = rows[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(edited[d]))
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        assert (r.near_edited == 1) == (edited[d] == t) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert len(set(prints.values())) == len(prints)
    far = [r for r in rows.values() if r.n_chars > 1500]
    assert sum(r.near_edited > r.near_next for r in far) > 0.9 * len(far)


def test_edge_rows(spark, edge_docs):
    got = merkle.edited_and_next(edge_docs).collect()
    prints = {t: f for t, f in ((r.text, r.fingerprint) for r in got)}
    assert len(got) == edge_docs.count() and len(set(prints.values())) == len(prints)
    order = sorted(got, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.fingerprint[:64]))
    assert [r.edited for r in order] == brute_edit([r.text for r in order])


def test_few_ids(spark):
    for ids in ([5], [5, 5], [None, None], [1, None], [-3, 7], [2 ** 62, -2 ** 62, 0]):
        df = spark.createDataFrame([(d, f"text {i} " * 9) for i, d in enumerate(ids)], "doc_id long, text string")
        got = merkle.edited_and_next(df).collect()
        order = sorted(got, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.fingerprint[:64]))
        assert len(got) == len(ids) and [r.edited for r in order] == brute_edit([r.text for r in order]), ids


def test_tree(spark):
    a = "\n".join(f"paragraph number {i}" for i in range(100))
    b = a.replace("number 50", "changed 50")
    df = spark.createDataFrame([(a, b, "")], "a string, b string, e string")
    for c in "abe":
        df = merkle.with_fingerprint(df, c, "f" + c)
    r = df.select("*", merkle.edits(F.col("fa"), F.col("fb")).alias("at"), merkle.edits(F.col("fa"), F.col("fa")).alias("none"),
                  merkle.leaves_of(F.col("fa")).alias("la"), merkle.leaves_of(F.col("fe")).alias("le")).first()
    assert r["at"] == [50 // merkle.SECTION_LEAVES] and r.none == [] and len(r.la) == 100 and r.le == []
    leaves = [sha(x + "\n") for x in a.split("\n")]
    leaves[-1] = sha(a.split("\n")[-1])
    nodes = [sha("".join(leaves[i:i + 16])) for i in range(0, 100, 16)]
    assert r.fa.split(":")[0] == sha("".join(nodes)) and r.la == [x[:12] for x in leaves]
    assert r.fe == sha("") + ":"


def test_empty(spark, no_docs):
    assert merkle.edited_and_next(no_docs).count() == 0


def test_native_plan(spark):
    plan = merkle.op4_merkle(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan
