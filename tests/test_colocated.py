"""Bucketed panels: the rows of the ordinary join, without an exchange."""

import datetime as dt
import uuid

import pytest

from gridcast.operators.panel import panel_join
from gridcast.sources.colocated import colocated_join, open_colocated, write_colocated

T0 = dt.datetime(2024, 1, 1)


def panels(spark, nulls=True):
    hours = [T0 + dt.timedelta(hours=i) for i in range(200)]
    a = [("hot" if i % 3 else f"g{i % 7}", t, float(i)) for i, t in enumerate(hours)]
    b = [(g, t, -v, "x") for g, t, v in a if v % 5]
    c = [(g, t, v * 2) for g, t, v in a[::2]]
    if nulls:
        a += [(None, hours[0], 1.0), ("hot", None, 2.0), (None, None, 3.0)]
        b += [(None, hours[0], 4.0, "y"), (None, None, 5.0, "z"), (None, None, 6.0, "w")]
        c += [(None, None, 7.0)]
    key = "site_name string, delivery_time timestamp"
    return [spark.createDataFrame(a, f"{key}, v double"), spark.createDataFrame(b, f"{key}, v double, `odd name` string"),
            spark.createDataFrame(c, f"{key}, z double")]


def store(frames, tmp_path, buckets=4):
    run = uuid.uuid4().hex
    return [write_colocated(f, f"p_{run}_{i}", str(tmp_path / str(i)), buckets) for i, f in enumerate(frames)]


def content(df):
    return df.columns, sorted(map(repr, df.collect()))


@pytest.mark.parametrize("nulls", [False, True])
def test_rows_of_the_ordinary_join(spark, tmp_path, nulls):
    frames = panels(spark, nulls)
    stored = store(frames, tmp_path)
    assert [p.null_keys for p in stored] == ([3, 3, 1] if nulls else [0, 0, 0])
    got = content(colocated_join(stored))
    assert got == content(panel_join(frames)) and len(got[1]) > 50
    for i in range(3):  # one file per bucket
        assert 1 <= len(list((tmp_path / str(i)).glob("part-*.parquet"))) <= 4


def test_no_exchange(spark, tmp_path):
    plan = colocated_join(store(panels(spark, False), tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    assert "Exchange" in panel_join(panels(spark, False))._jdf.queryExecution().executedPlan().toString()


def test_opened_by_its_folder(spark, tmp_path):
    frames = panels(spark)
    store(frames, tmp_path)
    run = uuid.uuid4().hex
    again = [open_colocated(spark, f"q_{run}_{i}", str(tmp_path / str(i)), 4) for i in range(3)]
    joined = colocated_join(again)
    assert content(joined) == content(panel_join(frames))


def test_empty_and_wrong(spark, tmp_path):
    frames = panels(spark)
    frames[1] = frames[1].where("false")
    stored = store(frames, tmp_path)
    assert colocated_join(stored).count() == 0
    assert content(colocated_join(stored[:1])) == content(frames[0])
    with pytest.raises(ValueError, match="at least one panel"):
        colocated_join([])
    stored[1].buckets = 8
    with pytest.raises(ValueError, match="different buckets"):
        colocated_join(stored)
    with pytest.raises(ValueError, match="no table name"):
        open_colocated(spark, "a; b", str(tmp_path), 4)
