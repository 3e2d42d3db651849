"""The join's contraction by bitmap words, and its units."""

import random

import pytest

from paysight.llm import group_join as gj
from tests.llm.test_group_join import brute, got, near_copies


def cloud(seed, copies, words=140, edits=1):
    """Copies of one text, each with a few words replaced."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for i in range(copies):
        t = list(base)
        for _ in range(edits):
            t[rng.randrange(words)] = f"x{i}_{rng.randrange(1000)}"
        out.append((i, " ".join(t)))
    return out


def test_links_are_contracted_before_pairs_are_compared(spark, monkeypatch):
    """Without the neighbours in posting lists: 7,140 pairs of members were left to be compared."""
    written = {}
    write = gj.materialize

    def noted(df, name):
        out = write(df, name)
        written[name] = written.get(name, 0) + out.count()
        return out
    monkeypatch.setattr(gj, "materialize", noted)
    monkeypatch.setattr(gj, "STAR_POSITIONS", 0)
    docs = cloud(1, 120)
    assert got(gj.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))) == brute(docs)
    assert written["member-pairs"] < 1500


@pytest.mark.parametrize("seed, members, edits", [(2, 1, 2), (3, 0, 1), (4, 2, 3)])
def test_units_of_many_members(spark, monkeypatch, seed, members, edits):
    """Groups that are searched as one, and several components in one group."""
    monkeypatch.setattr(gj, "UNIT_MEMBERS", members)
    docs = cloud(seed, 40, 60, edits)
    docs += [(100 + i, t) for i, t in near_copies(seed, n_bases=5, copies=10)]
    assert got(gj.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))) == brute(docs)
