import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from paysight.llm import lemp
from tests.llm.conftest import SF


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(docs, items, k=20):
    """Sorted (item row, rank, doc_id, score); docs and items are (id, text)."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(b) for _, b in bags)
    length = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, bag in bags:
            n, score = sum(bag.values()), 0
            m = 75 + 25 * n * n_docs // length if length else 0
            for t in terms(text):
                if t in bag:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1000000000 * bag[t] // (1000 * bag[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def got(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=str)


def corpus(spark, n, words, seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(words)]
    rows = [(i, " ".join(rng.choices(vocab, [1 / (j + 1) for j in range(words)], k=rng.choice([1, 3, 8, 30, 120])))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("k, head, rows_at_once, entries", [(20, 16_384, 4096, 250_000), (3, 40, 16, 250_000), (20, 1, 4096, 30)])
def test_equals_brute_force(spark, monkeypatch, k, head, rows_at_once, entries):
    """Whole corpus in one search, many small blocks with thresholds, items in several blocks."""
    monkeypatch.setattr(lemp, "HEAD", head)
    monkeypatch.setattr(lemp, "ROWS", rows_at_once)
    docs, df = corpus(spark, 400, 300)
    items = [(i, docs[i * 7][1] + " w1 nowhere") for i in range(12)]
    found = lemp.ranked_search(df, spark.createDataFrame(items, "item_id long, text string"), k, block_entries=entries)
    assert got(found) == brute(docs, items, k)


def test_edge_rows(spark, edge_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    items = [(0, "word two WORDS"), (1, None), (2, ""), (3, "日本語 x naïve naïve"), (None, "alpha beta"), (5, "x y z 42 ab"), (5, "x y z 42 ab"), (6, "unheard-of!")]
    stated = spark.createDataFrame([(*r, "c") for r in items], "item_id long, text string, score string")
    found = lemp.ranked_search(edge_docs, stated)
    assert got(found) == brute(docs, items) and found.columns == ["item_id", "rank", "doc_id", "score"]


def test_ties_and_repeated_rows(spark):
    docs = [(i % 50, "same text here") for i in range(120)] + [(None, "same text here")] * 2 + [(7, "other")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, "text")], "item_id long, text string")
    assert got(lemp.ranked_search(df, items, 30)) == brute(docs, [(1, "text")], 30)


def test_empty(spark, no_docs, edge_docs):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert lemp.ranked_search(no_docs, items).count() == 0
    assert lemp.ranked_search(edge_docs, items.limit(0)).count() == 0
    assert lemp.ranked_search(no_docs, items.limit(0)).count() == 0


def test_bounds_prune_and_lose_nothing():
    """With a threshold most vectors are never scored, and all that reach it are found."""
    rng = np.random.default_rng(3)
    weights = rng.integers(1, 9000, 200)
    rows = []
    for i in range(500):
        t = np.sort(rng.choice(200, rng.integers(1, 30), replace=False)).astype(np.int32)
        tf = rng.integers(1, 5, len(t)).astype(np.int32)
        imp = lemp.impacts(weights, t, tf, 100)
        rows.append((i, False, 100, t, tf, math.sqrt(float((imp.astype(float) ** 2).sum()))))
    block = lemp.Block(weights, pd.DataFrame(rows, columns=["id", "none", "m", "terms", "tfs", "norm"]))
    for _ in range(50):
        t = np.sort(rng.choice(220, 8, replace=False))
        c = rng.integers(1, 3, 8)
        exact = np.array([int(sum(v * dict(zip(t.tolist(), c.tolist())).get(x, 0) for x, v in zip(r[3].tolist(), lemp.impacts(weights, r[3], r[4], 100).tolist()))) for r in rows])
        for least in (1, int(np.sort(exact)[-20]), int(exact.max()), int(exact.max()) + 1):
            least = max(least, 1)
            found, scores = block.best(t, c, least)
            assert sorted(found.tolist()) == np.flatnonzero(exact >= least).tolist()
            assert scores.tolist() == exact[found].tolist()


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert got(lemp.op12_ranked_search(spark, SF)) == brute(docs, items)
