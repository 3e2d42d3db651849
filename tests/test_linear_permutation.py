"""Permutation importance of a linear learner by contributions that change places."""

import pytest

from conftest import SF_SMALL
from paysight.config import COLS, FEATURE_COLUMNS
from paysight.operators import explain as XP
from paysight.operators import models as M


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_linear_permutation_importance_equals_scoring_all_variants(spark):
    from paysight.plans import model_queries as Q
    data, raw = Q._data(spark, SF_SMALL), Q._split_raw(spark, SF_SMALL)
    model = M.ridge(2.0, data.train.count()).fit(data.train)
    columns = ["n_skills", "job_title_short", "company_name", "skills_text", "job_title"]

    def score(frame):
        return M.score_usd(model, data.prep_model.transform(M.encode(frame, data.encoders)))
    test = raw.where("split = 'test'").select(COLS.id, COLS.target, *FEATURE_COLUMNS)
    want = {r.feature: r for r in XP.permutation_importance(score, test, COLS.id, COLS.target, columns, repeats=2).collect()}
    table = XP.linear_permutation_importance(model, data.test, COLS.id, COLS.target, columns, M.TE_COLS, repeats=2)
    got = {r.feature: r for r in table.collect()}
    assert got.keys() == want.keys() == set(columns)
    for c in columns:
        assert got[c].importance == pytest.approx(want[c].importance, abs=1e-9)
        assert got[c].importance_std == pytest.approx(want[c].importance_std, abs=1e-9)
    # the rows are not sent whole to the driver and back
    assert "SortMergeJoin [_pos" in plan_of(table)
