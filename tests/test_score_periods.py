"""Several models trained on one set of binned periods, and a range of days scored by period."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.operators import features as FE
from depotlens.operators.timeline import Periods
from depotlens.plans import ml as ML
from depotlens.plans.boosting import BoostParams
from tests.test_model_periods import labelled  # noqa: F401

FP = P.FeatureParams()


def test_periods_binned_once_are_scored_and_ranked_like_their_days(spark, labelled, tmp_path, monkeypatch):  # noqa: F811
    both = Periods(labelled.rows.withColumn("label_b", 1 - F.col("label_invest_T7")), labelled.dates)
    columns = ML.numeric_feature_columns(FE.features_per_day(labelled, FP), "label_invest_T7")
    p = BoostParams(trees=3, max_depth=2, step=0.3, bins=16)
    train, calib = both.between("2024-04-01", "2024-07-31"), both.between("2024-08-01", "2024-09-30")
    labels = ["label_invest_T7", "label_b"]
    binned = ML.binned_periods(train, columns, labels, p, FP)
    registry, log = spark.createDataFrame([], ML.REGISTRY_SCHEMA), []
    for label, start in zip(labels, (dt.date(2024, 4, 2), dt.date(2024, 8, 1))):
        shared = ML.fit_calibrated(train, calib, columns, label, p, FP, binned)
        if label == "label_b":  # the second label's rows are those it would have on its own
            own = ML.fit_calibrated(train, None, columns, label, p, FP)
            for a, b in zip(shared.pipeline.trees, own.pipeline.trees, strict=True):
                assert np.array_equal(a.column, b.column) and np.array_equal(a.border, b.border) and np.array_equal(a.value, b.value)
        shared, registry = ML.publish(registry, shared, str(tmp_path), "m", 7)
        registry = registry.localCheckpoint()
        log.append(("m", 7, shared.version, start))
    activations = spark.createDataFrame(log, ML.ACTIVATION_SCHEMA)
    dates = labelled.dates.where("as_of >= '2024-06-01'")

    def rows(features):
        got = ML.score_range(features, registry, activations, dates, "m", 7, fp=FP)
        return {(r["run_date"], r["Depotnummer"]): (pytest.approx(r["p_invest"], abs=1e-12), r["score"], r["rank_in_run"], r["model_version"]) for r in got.collect()}

    want = rows(FE.features_per_day(Periods(both.rows, dates), FP))
    assert len(want) > 1000 and len({v[3] for v in want.values()}) == 2
    monkeypatch.setattr(FE, "features_per_day", None)
    got = rows(both)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert tuple(got[k][1:]) == tuple(v[1:]) and got[k][0].expected == v[0]
