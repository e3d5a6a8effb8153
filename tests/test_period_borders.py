"""Bin borders of feature periods against the ranks of their rows by day."""

import math

from depotlens import params as P
from depotlens.operators import features as FE
from depotlens.plans import ml as ML
from depotlens.plans.boosting import BoostParams
from tests.test_model_periods import labelled  # noqa: F401

FP = P.FeatureParams()


def test_borders_are_the_ranks_of_the_rows_by_day_without_laying_them_out(spark, labelled, monkeypatch):  # noqa: F811
    by_day = FE.features_per_day(labelled, FP, "label_invest_T7")
    columns = ML.numeric_feature_columns(by_day, "label_invest_T7")
    rows = ML.clean_features(by_day, columns).select(*columns).collect()

    def laid_out(*_):
        raise AssertionError("rows by day")

    monkeypatch.setattr(FE, "features_per_day", laid_out)
    for bins in (7, 64):
        got = ML.period_borders(labelled, columns, BoostParams(bins=bins), FP)
        for i, c in enumerate(columns):
            v = sorted(r[c] for r in rows)
            want = {v[max(1, math.ceil(k / bins * len(v))) - 1] for k in range(1, bins + 1)} - {v[-1]}
            assert got[i].tolist() == sorted(want), c
    assert any(len(x) > 3 for x in got)
