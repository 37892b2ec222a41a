"""Fold errors of kNN and linear models in one pass, against a fit per fold."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.operators.models import fit_model, predict
from gridcast.plans import tuning

T0 = dt.datetime(2024, 1, 1)
Y = "production_normalized"


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(120):
        for g in "ab":
            # few values of x, so many distances are 0 or tied
            x1, x2 = float(rng.integers(0, 4)), float(rng.integers(0, 3))
            rows.append((g, T0 + dt.timedelta(hours=i), x1, x2, 2 * x1 - x2 + float(rng.random())))
    return spark.createDataFrame(rows, f"site_name string, delivery_time timestamp, x1 double, x2 double, {Y} double")


def brute(pdf, folds, k, weights, p):
    """MAE per fold; neighbours by distance, ties by row order."""
    times = sorted(pdf["delivery_time"].unique())
    n, s, out = len(times), len(times) // (folds + 1), []
    for f in range(folds):
        lo, hi = n - (folds - f) * s, n - (folds - f - 1) * s
        train = pdf[pdf["delivery_time"] < times[lo]]
        val = pdf[pdf["delivery_time"].isin(times[lo:hi])]
        errors = []
        for _, q in val.iterrows():
            d = np.abs(train[["x1", "x2"]].to_numpy() - q[["x1", "x2"]].to_numpy(float))
            d = d.sum(1) if p == 1 else np.sqrt((d * d).sum(1))
            near = np.lexsort((train["_tid"], d))[:k]
            d, y = d[near], train[Y].to_numpy()[near]
            if weights == "uniform":
                pred = y.mean()
            else:
                pred = y[d == 0].mean() if (d == 0).any() else (y / d).sum() / (1 / d).sum()
            errors.append(abs(pred - q[Y]))
        out.append(np.mean(errors))
    return out


def test_knn_trials_from_one_neighbour_list(spark, frame, monkeypatch):
    seen = {}
    keep = tuning.materialize

    def watch(df):
        out = keep(df)
        if "_tid" in out.columns and "_fold" in out.columns:
            seen["rows"] = out
        return out

    monkeypatch.setattr(tuning, "materialize", watch)
    # every row of time i has one id: the brute force breaks ties as the operator does
    trials = [{"n_neighbors": k, "weights": w, "p": p} for k, w, p in
              ((1, "uniform", 2), (5, "distance", 2), (25, "uniform", 1), (80, "distance", 1), (500, "uniform", 2), (500, "distance", 1))]
    timed = frame.withColumn("x3", F.unix_timestamp("delivery_time").cast("double"))
    got = {(r["trial"], r["fold"]): r["mae"] for r in tuning.knn_fold_errors(timed, trials, 3, features=["x1", "x2"]).collect()}
    # the operator's own ids, matched by the target (all different)
    ids = {r[Y]: r["_tid"] for r in seen["rows"].collect()}
    pdf = frame.toPandas()
    pdf["_tid"] = pdf[Y].map(ids)
    for i, t in enumerate(trials):
        want = brute(pdf, 3, t["n_neighbors"], t["weights"], t["p"])
        assert [got[i, f] for f in range(3)] == pytest.approx(want, rel=1e-12)


def test_search_has_own_scores_and_overrides(frame):
    trials = tuning.param_search(frame, "knn", 12, 3, seed=5, features=["x1", "x2"])
    one = tuning.param_search(frame, "knn", 2, 3, seed=5, features=["x1", "x2"], overrides={"n_neighbors": 7})
    rows = {r["trial"]: r for r in trials.collect()}
    assert sorted(rows) == list(range(12)) and len({r["cv_mae"] for r in rows.values()}) > 6
    assert all('"n_neighbors": 7' in r["params"] for r in one.collect())
    assert tuning.param_search(frame, "knn", 0, 3).collect() == []
    mean, _ = tuning.cross_validate(frame, "knn", json.loads(rows[3]["params"]), 3, features=["x1", "x2"])
    assert mean == pytest.approx(rows[3]["cv_mae"], rel=1e-12)


@pytest.mark.parametrize("decay", [0.0, 0.05])
def test_linear_folds_equal_single_fits(frame, decay):
    df = frame.withColumn("big", F.col("x1") * 3 + F.rand(3) + 10)
    feats = ["x1", "x2", "big"]
    df = tuning.materialize(df)
    got = [r["mae"] for r in tuning.linear_fold_errors(df, 4, features=feats, weight_decay=decay).orderBy("fold").collect()]
    assert got == pytest.approx(tuning.fold_maes(df, "linear", {"weight_decay": decay}, 4, features=feats), rel=1e-12)
    want = []
    for train, val in tuning.usable_folds(df, 4):
        m = fit_model(train, feats, Y, "linear", {"weight_decay": decay})
        want.append(tuning.mae(predict(m, val), Y))
    assert got == pytest.approx(want, rel=1e-6)


def test_folds_skip_incomplete_rows_and_null_times(spark, frame):
    gaps = frame.unionByName(spark.createDataFrame([("a", None, 1.0, 1.0, 9.0), ("a", T0, None, 1.0, 9.0)], frame.schema))
    full = tuning.linear_fold_errors(frame, 3, features=["x1", "x2"]).orderBy("fold").collect()
    assert [r["mae"] for r in tuning.linear_fold_errors(gaps, 3, features=["x1", "x2"]).orderBy("fold").collect()] == pytest.approx(
        [r["mae"] for r in full], rel=1e-12)
