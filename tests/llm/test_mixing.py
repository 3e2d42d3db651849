import hashlib
import re
from collections import Counter

import pytest

from paysight.llm import mixing


def targets(sizes, weights=(3, 1, 2)):
    """Water filling by repeated cutting and resharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while True:
        level = left / sum(w[s] for s in free) if free else 0
        over = {s for s in free if level * w[s] > 2 * sizes[s]}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= over
        if not over:
            return out | {s: level * w[s] for s in free}


def check(rows, docs):
    count = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, (_, t, _) in enumerate(docs)}
    sizes = Counter()
    for i, (_, _, s) in enumerate(docs):
        sizes[s] += count[i]
    want = targets(dict(sizes))
    got = sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in rows), key=str)
    expect = []
    for i, (d, _, s) in enumerate(docs):
        rate = want[s] / sizes[s] if sizes[s] else 0
        u = int(hashlib.md5(f"42:{'' if d is None else d}".encode()).hexdigest()[:13], 16) / 2 ** 52
        expect.append((d, count[i], sizes[s], round(want[s], 6), count[i] * (int(rate) + (u < rate - int(rate)))))
        assert expect[-1][4] <= 2 * count[i]
    assert got == sorted(expect, key=str)


def rows_of(df):
    return mixing.with_copies(df).selectExpr("doc_id", "_size size", "_source_size source_size", "_target target", "_size * _copies taken").collect()


@pytest.mark.parametrize("limit", [100_000, 0])
def test_edge_rows(spark, edge_docs, limit, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", limit)
    check(rows_of(edge_docs), [(r.doc_id, r.text, r.source) for r in edge_docs.collect()])


def test_mix_emits_whole_rows(spark, edge_docs):
    out = mixing.mix(edge_docs)
    assert out.columns == edge_docs.columns
    want = Counter()
    for r in mixing.with_copies(edge_docs).collect():
        want[r.doc_id, r.text] += r._copies
    assert Counter((r.doc_id, r.text) for r in out.collect()) == +want


def test_wordless_and_empty(spark, no_docs):
    df = spark.createDataFrame([(1, " ", "a"), (2, None, None), (3, "", "a")], "doc_id long, text string, source string")
    assert all(r.taken == 0 and r.target == 0 for r in rows_of(df))
    assert mixing.mix(no_docs).count() == 0
