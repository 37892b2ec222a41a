"""The sweep in one job against single runs, and its statistics."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridcast.operators.moments import Moments, merge_parts, packed, row_moments, total, unpacked
from gridcast.operators.sequences import head_weights, window_inputs
from gridcast.plans import run, sweep

T0 = dt.datetime(2024, 1, 1)
METRICS = ["mae", "rmse", "nrmse_pct", "portfolio_mae_total", "portfolio_rmse_total", "portfolio_nrmse_total", "portfolio_mae_per_site",
           "portfolio_rmse_per_site"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(0)
    rows = []
    for g, n in (("a", 240), ("b", 150), ("c", 9), ("d", 1)):
        for i in range(n):
            x1, x2, lag = (float(x) for x in rng.random(3))
            y = 2 * x1 - x2 + 0.5 * lag + 0.1 * float(rng.random())
            rows.append((g, T0 + dt.timedelta(hours=i), None if i % 37 == 5 else x1, x2, None if i < 8 else lag, y))
    return spark.createDataFrame(rows, "site_name string, delivery_time timestamp, x1 double, x2 double, old double, "
                                       "production_normalized double")


def test_sweep_equals_single_runs(spark, frame, tmp_path):
    grid = run.experiment_grid(frame, ("lstm", "transformer"), (3, 12, 500), (False, True))
    cfg = sweep.SweepConfig(test_size=0.25, output_dir=str(tmp_path), production_columns=("old",))
    rows = [r.asDict() for r in sweep.run_sweep(spark, frame, grid, cfg).collect()]
    assert len(rows) == 4 * 2 * 3 * 2
    checked = 0
    for r in rows:
        if r["site_index"] == 1 and r["seq_len"] == 12:
            continue  # enough single runs
        df = frame.drop("old") if r["drop_prod"] else frame
        if r["site_index"] > 1 or r["seq_len"] == 500:
            assert r["error"] and all(r[m] is None for m in METRICS)
            if r["drop_prod"] or r["model"] == "lstm" or r["seq_len"] == 12:
                continue
            with pytest.raises(ValueError) as failed:
                run.run_pipeline(df, model_type=r["model"], seq_len=r["seq_len"], test_size=0.25, one_site_only=True, idx_site=r["site_index"])
            assert str(failed.value) == r["error"]
            continue
        one = run.run_pipeline(df, model_type=r["model"], seq_len=r["seq_len"], test_size=0.25, one_site_only=True, idx_site=r["site_index"])
        want = [one["eval_mae"], one["eval_rmse"], one["eval_nrmse"] * 100, *[one[m] for m in METRICS[3:]]]
        assert r["error"] == "" and [r[m] for m in METRICS] == pytest.approx(want, rel=1e-9)
        checked += 1
    assert checked == 12
    assert len({r["mae"] for r in rows if r["mae"] is not None}) == 16  # 2 sites, 2 lengths, 2 options, 2 models: own fits

    base = f"{tmp_path}/sequence_optimization"
    assert spark.read.option("header", True).csv(f"{base}/all_sites").count() == len(rows)
    assert {r[0] for r in spark.read.option("header", True).csv(f"{base}/by_site").select("site_index").distinct().collect()} == {0, 1, 2, 3}
    # a saved model scores as the run did
    saved = spark.read.parquet(f"{base}/models")
    sites = grid.select("site_index", "site").distinct()
    data = sweep.sweep_rows(frame, sites, [False, True], cfg)
    by = [*sweep.KEYS, "seq_len", "model"]
    again = {tuple(r[c] for c in by): r["mae"] for r in sweep.run_metrics(sweep.score_windows(data, saved, [3, 12]), by).collect()}
    assert again == {tuple(r[c] for c in by): pytest.approx(r["mae"], rel=1e-12) for r in rows if r["mae"] is not None}


def test_sweep_jobs_do_not_grow_with_sites(spark, frame):
    def jobs(df):
        group = f"sweep-{df.select('site_name').distinct().count()}"
        spark.sparkContext.setJobGroup(group, group)
        grid = run.experiment_grid(df, ("lstm",), (3,), (False,))
        sweep.run_sweep(spark, df, grid, sweep.SweepConfig(test_size=0.25)).collect()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    more = frame
    for k in range(5):
        more = more.unionByName(frame.withColumn("site_name", F.concat("site_name", F.lit(f"-{k}"))))
    few, many = jobs(frame.where("site_name = 'a'")), jobs(more)
    assert few > 0 and many <= few + 6  # adaptive plans split some joins into a job more, whatever the sites


def test_windows_cross_chunks(spark, frame, monkeypatch):
    sites = spark.createDataFrame([(0, "a"), (1, "b")], "site_index int, site string")
    cfg = sweep.SweepConfig(test_size=0.25)
    data = sweep.sweep_rows(frame.drop("old"), sites, [False], cfg)
    whole = {(r["site_index"], r["seq_len"]): r for r in sweep.window_moments(data, [3, 12], cfg).toPandas().to_dict("records")}
    monkeypatch.setattr(sweep, "chunk_size", lambda *a: 13)
    parts = sweep.window_moments(data, [3, 12], cfg).toPandas()
    for (site, length), rows in parts.groupby(["site_index", "seq_len"]):
        m, w = total(unpacked(rows)), next(unpacked(pd.DataFrame([whole[site, length]])))
        assert m.n == w.n and np.allclose(m.mean, w.mean, rtol=1e-12) and np.allclose(m.dev, w.dev, rtol=1e-9, atol=1e-12)


def test_moments_merge_and_solve(spark):
    rng = np.random.default_rng(2)
    z = rng.normal(size=(300, 4)) * [1, 10, 0.1, 3] + [1e6, 0, 5, 2]
    z[:, 3] += z[:, :3] @ [1.0, -2.0, 4.0]
    one, split = Moments.of(z), total(Moments.of(p) for p in np.array_split(z, 7))
    assert split.n == one.n and np.allclose(split.dev, one.dev, rtol=1e-9)
    coef, b = split.ridge()
    want = np.linalg.lstsq(np.column_stack([z[:, :3] - z[:, :3].mean(0), np.ones(300)]), z[:, 3], rcond=None)[0]
    assert np.allclose(coef, want[:3], rtol=1e-9) and np.isclose(b, z[:, 3].mean() - z[:, :3].mean(0) @ coef)
    parts = spark.createDataFrame(packed([(("k", i), Moments.of(p)) for i, p in enumerate(np.array_split(z, 100))], ["key", "part"]))
    left = merge_parts(parts, ["key"], "part", 100).toPandas()
    assert len(left) <= 8 and np.allclose(total(unpacked(left)).dev, one.dev, rtol=1e-9)
    df = spark.createDataFrame([(i % 3 if i % 4 else None, *map(float, r)) for i, r in enumerate(z)], "fold int, a double, b double, c double, y double")
    got = row_moments(df, ["fold"], ["a", "b", "c"], "y").toPandas()
    assert got["n"].sum() == 300 and np.allclose(total(unpacked(got)).dev, one.dev, rtol=1e-9)


def test_window_inputs_are_projections(spark):
    w = [[1.0, 2.0], [3.0, 5.0], [7.0, 11.0]]
    df = spark.createDataFrame([(w,)], "seq array<array<double>>")
    assert df.select(window_inputs("lstm", 3)).first()[0] == [1.0, 2.0, 3.0, 5.0, 7.0, 11.0]
    got = df.select(window_inputs("transformer", 3)).first()[0]
    assert got == pytest.approx((head_weights("transformer", 3) @ np.array(w)).ravel().tolist())
