import random
import re

import numpy as np
import pytest

from paysight.llm import group_join as gj
from tests.llm.conftest import SF


def brute_set(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return frozenset([" ".join(words)]) if words else frozenset()
    return frozenset(" ".join(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(docs, k=3, percent=90):
    """(doc_id, n, component_id) of (doc_id, text) rows, by all pairs of different sets."""
    sets = [brute_set(t, k) for _, t in docs]
    distinct = sorted({s for s in sets if s}, key=lambda s: (len(s), sorted(s)))
    parent = {s: s for s in distinct}

    def find(s):
        while parent[s] is not s:
            parent[s] = parent[parent[s]]
            s = parent[s]
        return s
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if 100 * len(a) < percent * len(b):
                break
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                parent[find(a)] = find(b)
    least = {}
    for (i, _), s in zip(docs, sets, strict=True):
        if s and i is not None:
            least[find(s)] = min(i, least.get(find(s), i))
    return sorted(((i, len(s), least.get(find(s)) if s else i) for (i, _), s in zip(docs, sets, strict=True)), key=str)


def got(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=str)


def near_copies(seed, n_bases=12, size=(4, 90), copies=25, shared=0):
    """Chains and clouds of edits around bases; ``shared`` words of a passage in all of them."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [word() for _ in range(shared)]
    out = []
    for _ in range(n_bases):
        base = [word() for _ in range(rng.randint(*size))] + passage
        out.append(base)
        for _ in range(rng.randint(0, copies)):
            t = list(rng.choice([base, out[-1]]))
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(t))
                t[at:at + rng.randint(0, 2)] = [word() for _ in range(rng.randint(0, 2))]
            out.append(t)
    rng.shuffle(out)
    return [(i, " ".join(t)) for i, t in enumerate(out)]


@pytest.mark.parametrize("seed, shared, list_rows, hot", [(1, 0, 2048, 32), (2, 0, 4, 32), (3, 60, 2048, 1), (4, 60, 3, 2), (5, 25, 5, 10 ** 6)])
def test_equals_all_pairs(spark, monkeypatch, seed, shared, list_rows, hot):
    """Cut posting lists, hot tokens first and last, a passage that all documents share."""
    monkeypatch.setattr(gj, "LIST_ROWS", list_rows)
    monkeypatch.setattr(gj, "HOT_DF", hot)
    docs = near_copies(seed, shared=shared)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert got(gj.jaccard_components(df)) == brute(docs)


def test_without_the_contraction(spark, monkeypatch):
    """All links by the join of groups: the contraction only saves work."""
    monkeypatch.setattr(gj, "STAR_POSITIONS", 0)
    docs = near_copies(6, n_bases=6, copies=12)
    assert got(gj.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_other_length_and_threshold(spark):
    docs = near_copies(7)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(gj.jaccard_components(df, 5, 80)) == brute(docs, 5, 80)


def test_edge_rows(spark, edge_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    found = gj.jaccard_components(edge_docs)
    assert got(found) == brute(docs) and found.columns == ["doc_id", "n_shingles", "component_id"]


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(1)
    for _ in range(300):
        universe = np.sort(rng.choice(10 ** 6, 400, replace=False))
        a = np.sort(rng.choice(universe, rng.integers(1, 200), replace=False))
        b = np.sort(np.unique(np.concatenate([rng.choice(a, max(1, int(len(a) * rng.uniform(.85, 1))), replace=False), rng.choice(universe, rng.integers(0, 1 + len(a) // 10))])))
        hot = np.sort(rng.choice(universe, 60, replace=False))
        place = rng.permutation(60)
        pa, pb = (set(gj.prefix_of(x, hot, place, 90).tolist()) for x in (a, b))
        assert len(pa) == gj.prefix_size(len(a), 90)
        if gj.similar(set(a.tolist()), set(b.tolist()), 90):
            assert pa & pb


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(gj.op11_ngram_join(spark, SF)) == brute(docs)


def test_empty(spark, no_docs):
    assert gj.jaccard_components(no_docs).count() == 0
    assert got(gj.jaccard_components(spark.createDataFrame([(3, None), (4, " ")], "doc_id long, text string"))) == [(3, 0, 3), (4, 0, 4)]


def test_prefixes_come_from_what_the_one_pass_over_the_texts_keeps():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 9, 40, 400):
        for low in (0, n // 8, n // 2, n):
            parts = rng.choice(gj.COUNTED_BELOW, low, replace=False), gj.COUNTED_BELOW + rng.choice(2 ** 62, n - low, replace=False)
            toks = np.sort(np.concatenate(parts).astype(np.int64))
            for share in (0, 0.3, 1):
                hot = np.sort(toks[:low][rng.random(low) < share])
                place = rng.permutation(len(hot))
                kept = np.concatenate(gj.leading(toks, 90))
                assert gj.prefix_of(kept, hot, place, 90, n).tolist() == gj.prefix_of(toks, hot, place, 90).tolist()
                assert len(kept) <= low + gj.prefix_size(n, 90)


def test_texts_are_cut_into_shingles_once_before_verifying(spark, monkeypatch):
    """The tokens to count and the sets were two passes over all texts."""
    plans = {}
    count, write = gj.hot_tokens, gj.materialize

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    def counted(sets):
        plans["counted"] = plan(sets)
        return count(sets)

    def noted(df, name):
        plans[name] = plan(df)
        return write(df, name)
    monkeypatch.setattr(gj, "hot_tokens", counted)
    monkeypatch.setattr(gj, "materialize", noted)
    docs = spark.createDataFrame([(i, f"a b c d e f g h {i % 3}") for i in range(60)], "doc_id long, text string")
    sets = gj.document_sets(docs, gj.text_or_empty(), 3, 90)
    assert "ArrowEvalPython" not in plans["counted"] and all("text#" not in p for p in plans.values())
    assert sets.count() == 60 and sets.where(gj.F.size("prefix") != gj.prefix_size(7, 90)).count() == 0
