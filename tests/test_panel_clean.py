"""Panel projections, joins, clip rules and splits on hand-made frames."""

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridcast.operators import clean, panel, split
from gridcast.roles import DEFAULT_ROLES
from gridcast.sources.parquet import list_dataset_files, read_panel_files
from tests.helpers import gapped_panel, to_spark

T0 = dt.datetime(2024, 1, 1)


def test_panel_join_null_keys_and_suffixes(spark):
    a = spark.createDataFrame([("s", T0, 1.0, 10.0), (None, T0, 2.0, 20.0), ("s", None, 3.0, 30.0)],
                              "site_name string, delivery_time timestamp, x double, c double")
    b = spark.createDataFrame([("s", T0, 5.0, 7.0), (None, T0, 6.0, 8.0), ("s", None, 9.0, 1.0)],
                              "site_name string, delivery_time timestamp, y double, c double")
    out = panel.panel_join([a, b]).toPandas()
    assert len(out) == 3  # NULL keys match NULL keys
    assert {"c_x", "c_y", "x", "y"} <= set(out.columns)


def test_validate_and_normalize(spark):
    df = spark.createDataFrame([("s", T0, 10.0, 0.0), ("s", T0, 10.0, None), ("s", T0, 10.0, 5.0)],
                               "site_name string, delivery_time timestamp, production double, "
                               "installed_capacity double")
    out = panel.normalize_target(df).toPandas()
    assert len(out) == 2 and out["production_normalized"].dropna().tolist() == [2.0]
    with pytest.raises(ValueError, match="installed_capacity"):
        panel.normalize_target(df.drop("installed_capacity"))
    req = panel.required_rows(panel.normalize_target(df)).toPandas()
    assert len(req) == 1


def test_single_group(spark):
    df = to_spark(spark, gapped_panel(0))
    assert {r[0] for r in panel.single_group(df, index=1).select("site_name").distinct().collect()} == {"b"}
    assert panel.single_group(df, name="c").count() > 0
    with pytest.raises(ValueError):
        panel.single_group(df, index=7)


def test_file_listing_excludes_by_substring(spark, tmp_path):
    pdf = gapped_panel(0, groups=("a",), n=20)
    for name in ("dataset_1", "dataset_2", "dataset_20", "dataset_3"):
        spark.createDataFrame(pdf.assign(**{f"v_{name}": 1.0})).write.parquet(str(tmp_path / f"{name}.parquet"))
    files = list_dataset_files(spark, str(tmp_path))
    names = [f.rsplit("/", 1)[-1] for f in files]
    assert names == ["dataset_1.parquet", "dataset_3.parquet"]  # dataset_2 also drops dataset_20
    joined = read_panel_files(spark, str(tmp_path))
    assert "production_normalized_x" in joined.columns and joined.count() == len(pdf)


def test_clip_rules_nan_inf_null(spark):
    inf = float("inf")
    df = spark.createDataFrame(
        [(inf, -inf, None, 100.0), (float("nan"), 3.0, inf, -1.0), (None, 50.0, -inf, 2.0)],
        "wind_speed_10m double, wind_gusts_x double, wind_shear_alpha double, theoretical_power double")
    got = clean.clip_rules(df).toPandas()
    assert got["wind_speed_10m"].tolist()[0] == 45.0 and math.isnan(got["wind_speed_10m"].tolist()[1])
    assert got["wind_gusts_x"].tolist() == [0.0, 3.0, 45.0]
    assert got["wind_shear_alpha"].tolist() == [0.0, 0.0, 0.0]  # inf -> 0, NULL -> 0, clamp
    assert got["theoretical_power"].tolist() == [5.0, 0.0, 2.0]


def test_inf_to_null_and_model_matrix(spark):
    df = spark.createDataFrame([(1.0, float("inf"), 1), (2.0, 3.0, 1), (float("nan"), 1.0, 2)],
                               "a double, b double, hour int")
    out = clean.model_matrix(clean.inf_to_null(df)).toPandas()
    assert out.columns.tolist() == ["a", "b"] and out.values.tolist() == [[2.0, 3.0]]


def test_drop_columns_follow_delay():
    assert "production_lag240h" in clean.drop_columns(True, delay_days=10)
    assert "production_lag240h" not in clean.drop_columns(False, delay_days=10)


def test_time_folds_match_expanding_split(spark):
    pdf = gapped_panel(1, groups=("a", "b"), n=100)
    df = to_spark(spark, pdf)
    times = sorted(pdf["delivery_time"].unique())
    n, k = len(times), 5
    s = n // (k + 1)
    folds = split.time_folds(df, k)
    assert len(folds) == k
    for i, (tr, va) in enumerate(folds):
        start = n - (k - i) * s
        exp_val = set(times[start:start + s])
        got_val = {pd.Timestamp(r[0]).to_datetime64() for r in va.select("delivery_time").distinct().collect()}
        assert got_val == {pd.Timestamp(t).to_datetime64() for t in exp_val}
        assert tr.agg(F.max("delivery_time")).first()[0] < min(exp_val)
    with pytest.raises(ValueError):
        split.fold_bounds(df.limit(3), 5, "delivery_time")


def test_split_time_and_holdout(spark):
    df = to_spark(spark, gapped_panel(2))
    tr, te = split.split_time(df, 0.8)
    assert tr.count() + te.count() == df.count()
    assert tr.agg(F.max("delivery_time")).first()[0] < te.agg(F.min("delivery_time")).first()[0]
    htr, hte = split.holdout_split(df, 0.2, 0)
    assert {r[0] for r in hte.select("site_name").distinct().collect()} == {"a"}
    assert "a" not in {r[0] for r in htr.select("site_name").distinct().collect()}


def test_sequence_holdout_small_and_large(spark):
    rows = [("g", T0 + dt.timedelta(hours=i), 0.0) for i in range(30)]
    df = spark.createDataFrame(rows, "site_name string, delivery_time timestamp, production_normalized double")
    out = split.sequence_holdout(df, DEFAULT_ROLES, val_fraction=0.2)
    assert out.where("is_val").count() == 6
    small = split.sequence_holdout(df.limit(10), DEFAULT_ROLES)
    assert small.where("is_val").count() == 0
    assert split.sequence_holdout(df, DEFAULT_ROLES, no_cv=True).where("is_val").count() == 0
