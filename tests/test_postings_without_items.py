"""Readers of no skill column do not read the order lines."""

from conftest import SF_SMALL
from paysight.plans import queries as Q
from paysight.sources.postings import postings


def test_the_rows_are_the_same_without_the_lines(spark):
    whole, narrow = postings(spark, SF_SMALL), postings(spark, SF_SMALL, with_items=False)
    assert narrow.columns == whole.columns
    rest = [c for c in whole.columns if c not in ("job_skills", "job_type_skills")]
    assert sorted(whole.select(rest).collect(), key=str) == sorted(narrow.select(rest).collect(), key=str)


def test_the_description_reads_no_lines(spark, monkeypatch):
    from paysight.operators import quantiles
    read = []
    write = quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda df, name: (read.extend(df.inputFiles()), write(df, name))[1])
    assert Q.QUERIES["v11_load_reports"](spark, SF_SMALL).count() > 0
    assert read and not any("lineitem" in f for f in read)
