"""Models, persistence, sinks and the sweep on small frames."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.operators import models, scale
from gridcast.plans import run, tuning

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(0)
    rows = []
    for g in ("a", "b"):
        for i in range(240):
            x1, x2 = float(rng.random()), float(rng.random())
            rows.append((g, T0 + dt.timedelta(hours=i), x1, x2, 2 * x1 - x2 + 0.01 * float(rng.random())))
    return spark.createDataFrame(rows, "site_name string, delivery_time timestamp, x1 double, x2 double, "
                                       "production_normalized double")


@pytest.mark.parametrize("mt,params", [("random_forest", {"n_estimators": 10, "max_depth": 5}),
                                       ("xgboost", {"n_estimators": 10, "max_depth": 3}),
                                       ("knn", {"n_neighbors": 5, "weights": "distance"})])
def test_models_beat_mean_predictor(frame, mt, params):
    tr, te = frame.where("delivery_time < '2024-01-09'"), frame.where("delivery_time >= '2024-01-09'")
    m = models.fit_model(tr, ["x1", "x2"], "production_normalized", mt, params)
    pred = models.predict(m, te)
    mae = pred.agg(F.avg(F.abs(F.col("prediction") - F.col("production_normalized")))).first()[0]
    mean = tr.agg(F.avg("production_normalized")).first()[0]
    base = te.agg(F.avg(F.abs(F.lit(mean) - F.col("production_normalized")))).first()[0]
    assert pred.count() == te.count() and mae < base


def test_model_save_load_and_json(spark, frame, tmp_path):
    m = models.fit_model(frame, ["x1", "x2"], "production_normalized", "random_forest",
                         {"n_estimators": 5, "max_depth": 3})
    path = str(tmp_path / "m")
    m.save(path)
    assert models.ForecastModel.exists(path)
    back = models.ForecastModel.load(path)
    assert back.features == ["x1", "x2"]
    a = models.predict(m, frame).select("prediction").collect()
    b = models.predict(back, frame).select("prediction").collect()
    assert a == b
    models.save_json(spark, {"k": [1, 2]}, str(tmp_path / "j"))
    assert models.load_json(spark, str(tmp_path / "j")) == {"k": [1, 2]}


def test_cv_and_search(frame):
    mean, std = tuning.cross_validate(frame, "random_forest", {"n_estimators": 5, "max_depth": 3}, 3)
    assert 0 <= mean < 1 and std >= 0
    trials = tuning.param_search(frame, "knn", 2, 3, seed=1)
    assert trials.count() == 2
    best = tuning.best_trial(trials).first()
    assert best["cv_mae"] == min(r["cv_mae"] for r in trials.collect())
    assert "n_neighbors" in json.loads(best["params"])


def test_scalers(frame):
    st = scale.fit_standard(frame, ["x1"])
    z = st.transform(frame).agg(F.avg("x1"), F.stddev_pop("x1")).first()
    assert abs(z[0]) < 1e-9 and abs(z[1] - 1) < 1e-9
    const = frame.withColumn("c", F.lit(3.0))
    assert scale.fit_standard(const, ["c"]).scale == (1.0,)
    mm = scale.fit_minmax(const, ["c", "x2"])
    assert mm.span[0] == 1.0
    back = mm.inverse(mm.transform(const), {"x2": "x2"}).select("x2").collect()
    assert np.allclose([r[0] for r in back], [r[0] for r in const.select("x2").collect()])


def test_run_tabular_modes(spark, frame, tmp_path):
    cfg = tuning.TabularConfig(model="random_forest", mode="train", n_splits=3, output_dir=str(tmp_path),
                               overrides={"n_estimators": 5, "max_depth": 3})
    res = tuning.run_tabular(spark, frame, cfg)
    assert set(res["random_forest"]) == {"cv_mae", "test_mae", "params"}
    base = str(tmp_path / "tabular_optimization")
    assert models.load_json(spark, f"{base}/random_forest_features.json") == ["x1", "x2"]
    assert models.ForecastModel.exists(f"{base}/random_forest_model")
    models.save_json(spark, {"n_estimators": 6, "max_depth": 2, "random_state": 7},
                     f"{base}/random_forest_best_params.json")
    res2 = tuning.run_tabular(spark, frame, cfg)
    assert res2["random_forest"]["params"]["max_depth"] == 2  # saved best params are reused


def test_run_pipeline_reuses_saved_model(spark, frame, tmp_path):
    path = str(tmp_path / "rf")
    a = run.run_pipeline(frame, model_type="random_forest", params={"n_estimators": 5, "max_depth": 3},
                         savepath=path)
    b = run.run_pipeline(frame, model_type="random_forest", params={"n_estimators": 50, "max_depth": 9},
                         savepath=path)
    assert a["eval_mae"] == b["eval_mae"]  # second run loaded the first model


def test_main_path_reports_cv_and_skip_train(spark, frame, tmp_path):
    path, params = str(tmp_path / "knn"), {"n_neighbors": 5, "weights": "distance"}
    with pytest.raises(ValueError, match="no saved model"):
        run.run_pipeline(frame, model_type="knn", params=params, savepath=path, skip_train=True)
    a = run.run_pipeline(frame, model_type="knn", params=params, savepath=path, n_splits=3)
    train, _ = run.split_time(frame, 0.8)
    mean, std = tuning.cross_validate(train, "knn", params, 3)
    assert (a["cv_mae"], a["cv_mae_std"]) == (mean, std)
    b = run.run_pipeline(frame, model_type="knn", savepath=path, skip_train=True)
    assert np.isclose(a["eval_mae"], b["eval_mae"]) and np.isnan(b["cv_mae"])


def test_sequence_model_is_saved_with_scalers(spark, frame, tmp_path):
    path = str(tmp_path / "seq")
    a = run.run_pipeline(frame, model_type="transformer", seq_len=3, savepath=path)
    b = run.run_pipeline(frame, model_type="transformer", seq_len=3, savepath=path, skip_train=True)
    assert np.isclose(a["eval_mae"], b["eval_mae"]) and a["cv_mae"] > 0


def test_parameters_are_checked():
    with pytest.raises(ValueError, match="reg_lambda"):
        models.build_regressor("xgboost", {"reg_lambda": 1.0})
    with pytest.raises(ValueError, match="30"):
        models.build_regressor("random_forest", {"max_depth": 35})
    assert models.effective_params("random_forest", {})["max_depth"] == models.MAX_DEPTH


def test_broken_write_leaves_the_old_version(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    assert models.versions(path) == [] and not models.ForecastModel.exists(path)
    with pytest.raises(ValueError, match="no saved model"):
        models.ForecastModel.load(path)
    fit = lambda k: models.fit_model(frame, ["x1", "x2"], "production_normalized", "knn", {"n_neighbors": k, "p": 2})
    fit(3).save(path)
    with monkeypatch.context() as m:  # the model is written, its description is not
        m.setattr(models.json, "dumps", lambda *a, **k: (_ for _ in ()).throw(OSError("disk full")))
        with pytest.raises(OSError):
            fit(5).save(path)
    assert sorted(models.versions(path)) == [(1, True), (2, False)]
    assert models.ForecastModel.load(path).model.params["n_neighbors"] == 3
    fit(7).save(path)
    assert sorted(models.versions(path)) == [(1, True), (2, False), (3, True)]
    assert models.ForecastModel.load(path).model.params["n_neighbors"] == 7
