import random
import re

import pytest
import xxhash

from paysight.llm import simhash
from tests.llm.conftest import SF


def brute_fp(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, bits=4):
    """{doc index: set of linked indices} closed, for a list of fingerprints."""
    distinct = sorted(set(fps))
    parent = {f: f for f in distinct}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                parent[find(a)] = find(b)
    return [find(f) for f in fps]


def check(rows):
    """rows: (doc_id, unsigned fp, component_id)."""
    roots = brute_components([r[1] for r in rows])
    least = {}
    for r, root in zip(rows, roots, strict=True):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    assert [r[2] for r in rows] == [least.get(root) for root in roots]


def test_fingerprints_on_edge_rows(spark, edge_docs):
    out = simhash.near_duplicates(edge_docs).collect()
    text = {r.doc_id: r.text for r in edge_docs.collect() if r.doc_id is not None}
    for r in out:
        if r.doc_id is not None:
            assert r.fp % 2 ** 64 == brute_fp(text[r.doc_id])
    check([(r.doc_id, r.fp % 2 ** 64, r.component_id) for r in out])
    assert len(out) == edge_docs.count()


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query(spark, sf):
    out = simhash.op6_simhash(spark, sf).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(out) == len(docs)
    assert all(int(r.fingerprint, 16) == brute_fp(docs[r.doc_id]) and len(r.fingerprint) == 16 for r in out)
    check([(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in out])


@pytest.mark.parametrize("part_rows, broadcast", [(simhash.VARIANT_ROWS, 100_000), (5, 100_000), (5, 0)])
def test_no_link_is_lost(spark, monkeypatch, part_rows, broadcast):
    """Chains, clouds of near fingerprints and bridges of exactly 4 and 5 bits; hot variants in parts."""
    monkeypatch.setattr(simhash, "VARIANT_ROWS", part_rows)
    monkeypatch.setattr(simhash, "BROADCAST_VARIANTS", broadcast)
    rng = random.Random(3)
    fps = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        fps.add(f)
        for _ in range(12):
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 4, 5, 5])):
                f ^= 1 << b
            fps.add(f)
    base = rng.getrandbits(64)
    fps |= {base ^ sum(1 << b for b in rng.sample(range(0, 64, 5), rng.randint(0, 9))) for _ in range(400)}
    signed = [(f - 2 ** 64 if f >= 2 ** 63 else f,) for f in fps]
    out = simhash.link_components(spark.createDataFrame(signed, "fp long")).collect()
    got, want = {}, {}
    roots = brute_components([r.fp % 2 ** 64 for r in out])
    for r, root in zip(out, roots, strict=True):
        got.setdefault(r.comp, set()).add(r.fp)
        want.setdefault(root, set()).add(r.fp)
    assert len(out) == len(fps) and sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_empty(spark, no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_one_each(no_docs).columns == no_docs.columns


def test_keep_one_each(spark, edge_docs):
    rows = edge_docs.collect()
    groups = {}
    for r, root in zip(rows, brute_components([brute_fp(r.text) for r in rows]), strict=True):
        groups.setdefault(root, []).append(r)
    kept = simhash.keep_one_each(edge_docs)
    assert kept.columns == edge_docs.columns
    got = {root: r for r, root in zip(kept.collect(), brute_components([brute_fp(r.text) for r in kept.collect()]), strict=True)}
    assert kept.count() == len(got) == len(groups)
    for root, members in groups.items():
        assert any(r == got[root] for r in members)
        assert got[root].doc_id == min((r.doc_id for r in members if r.doc_id is not None), default=None)


def test_keep_one_each_with_repeated_and_missing_ids(spark):
    """Different texts under one id, or none, are groups of their own."""
    texts = ["the first of all these texts", "quite another story told here", "a third one without any likeness"]
    rows = [(i, t) for i in (1, None) for t in texts[:2]] + [(None, texts[2])] * 2
    out = simhash.keep_one_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, out), key=str) == sorted([(1, texts[0]), (1, texts[1]), (None, texts[2])], key=str)
