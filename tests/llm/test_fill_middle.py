import hashlib
import random

import pytest

from paysight.llm import fill_middle as fm
from paysight.session import materialize
from tests.llm.conftest import SF


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text, seed=1):
    text = text or ""
    n, digest = len(text), sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("size", [1, 2, 7, 64])
def test_frames_cut_seek_and_restore(size):
    rng = random.Random(size)
    for _ in range(60):
        text = "".join(rng.choice("ab <PSM>é日🙂\n") for _ in range(rng.randint(0, 90)))
        for m in ("<P>", "<S>", "<M>"):
            text = text.replace(m, "..")
        f = fm.Frames.of(text, size)
        assert len(f) == len(text) and "".join(f.read(0, len(text))) == text
        lo, hi = sorted(rng.randint(0, len(text)) for _ in range(2))
        assert "".join(f.read(lo, hi)) == text[lo:hi]
        mark = text[lo:lo + rng.randint(1, 3)] or "é"
        assert f.find(mark, lo // 2) == text.find(mark, lo // 2)
        for form, want in (("psm", f"<P>{text[:lo]}<S>{text[hi:]}<M>{text[lo:hi]}"), ("spm", f"<S>{text[hi:]}<P>{text[:lo]}<M>{text[lo:hi]}"), ("plain", text)):
            out = fm.arranged(f, form, lo, hi - lo)
            assert "".join(out.read(0, len(out))) == want and len(out) == len(want)
            assert "".join(fm.restored(out, form)) == text


def test_whole_frames_are_taken_over_without_decompression(monkeypatch):
    text = "".join(chr(97 + i % 26) for i in range(10_000))
    f, opened = fm.Frames.of(text, 100), []
    frame = fm.Frames.frame
    monkeypatch.setattr(fm.Frames, "frame", lambda self, i: opened.append(i) or frame(self, i))
    out = fm.arranged(f, "psm", 1234, 5555)
    assert sorted(set(opened)) == [12, 67]  # the two frames that hold a cut
    assert "".join(out.read(0, len(out))) == f"<P>{text[:1234]}<S>{text[6789:]}<M>{text[1234:6789]}"


def test_edge_rows(spark, edge_docs):
    marks = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(["a <P> b", "<S>", "x<M>", "<", "<P", "<<P", "P>", "<p>", "é" * 3])], "doc_id long, text string")
    docs = edge_docs.unionByName(marks, allowMissingColumns=True)
    done = fm.fill_in_middle(docs).withColumns({"whole": fm.text_of("output"), "back": fm.restored_text("output", "form"),
                                               "out_sha": fm.sha256_of("output"), "back_sha": fm.restored_sha256("output", "form")})
    rows = materialize(done, "fim-test").collect()
    assert len(rows) == docs.count() and {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.whole) == brute(r.doc_id, r.text)
        assert r.back == (r.text or "") and r.back_sha == sha(r.back) and r.out_sha == sha(r.whole)
    assert set(docs.columns) <= set(done.columns) and sum(r["a.b c"] == "o" for r in rows) > 40


def test_clashing_names_and_other_rates(spark):
    docs = spark.createDataFrame([(i, "some words of text " * i, "x", "y", "z", "w", "v") for i in range(40)],
                                 "doc_id long, text string, n string, form string, frames string, _frames string, _marked string")
    rows = fm.fill_in_middle(docs, rate=100, spm_rate=100, seed=5).collect()
    assert all(r.form == ("spm" if r.text else "plain") and r.n == len(r.text) for r in rows)
    assert all((r.frames, r["_frames"], r["_marked"]) == ("z", "w", "v") for r in rows)


def test_a_kept_store_gives_the_same(spark, edge_docs):
    kept = materialize(fm.store(edge_docs, out="kept", size=50), "store-test")
    a, b = (fm.fill_in_middle(*x).withColumn("out_sha", fm.sha256_of("output")).select("doc_id", "n", "form", "prefix_chars", "out_sha").collect()
            for x in ((edge_docs,), (kept, "doc_id", "text", 1, 90, 20, "kept")))
    assert sorted(a, key=str) == sorted(b, key=str) and max(len(r.kept.ends) for r in kept.collect()) > 100


def test_query(spark):
    rows = fm.op13_fill_middle(spark, SF).collect()
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(text)
    for r in rows:
        want = brute(r.doc_id, text[r.doc_id])
        assert tuple(r) == (r.doc_id, *want[:4], sha(want[4]), sha(text[r.doc_id]))


def test_empty(spark, no_docs):
    assert fm.fill_in_middle(no_docs).count() == 0
