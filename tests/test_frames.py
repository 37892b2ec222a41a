"""Frame statistics and band counts in NumPy against a plain loop."""

import datetime as dt

import numpy as np
import pytest

from gridcast.operators.lags import frame_moments
from gridcast.operators.neighbours import positional_neighbours
from gridcast.operators.quality import band_counts


def test_frame_moments_against_loops():
    rng = np.random.default_rng(1)
    y = np.concatenate([rng.normal(size=200) * 1e-3 + 1e6, np.full(150, 0.1), rng.normal(size=77)])
    first = rng.integers(0, len(y), 600)
    end = np.minimum(first + rng.integers(-3, 180, 600), len(y))
    n, mean, dev = frame_moments(y, first, end)
    for a, b, k, m, d in zip(first, end, n, mean, dev, strict=True):
        part = y[a:max(a, b)]
        assert k == len(part)
        if k:
            assert m == pytest.approx(part.mean(), rel=1e-13)
            assert d == pytest.approx(((part - part.mean()) ** 2).sum(), rel=1e-7, abs=1e-24)
            if (part == part[0]).all():
                assert d == 0 and m == part[0]
    assert [x.tolist() for x in frame_moments(np.empty(0), np.array([0]), np.array([0]))] == [[0], [0.0], [0.0]]


@pytest.mark.parametrize("tolerance", [0.01, 0.3, 100.0, 0.0])
def test_band_counts_against_loops(tolerance):
    rng = np.random.default_rng(2)
    for size in (0, 1, 5, 300):
        y = np.round(rng.normal(size=size), 2)
        y[rng.random(size) < 0.2] = np.nan
        pos = np.arange(size) + 17
        reach = np.full(size, int(rng.integers(1, 40)))
        got = band_counts(pos, y, reach, tolerance)
        want = [sum(abs(j - i) <= reach[i] and abs(y[j] - y[i]) < tolerance for j in range(size)) for i in range(size)]
        assert got.tolist() == want


def test_positional_neighbours_against_loops(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(g, t0 + dt.timedelta(minutes=7 * i), float(i)) for g, n in (("a", 50), ("b", 9), ("c", 1), ("d", 5)) for i in range(n)]
    rows += [(None, t0, 1.0), ("a", None, 1.0)]
    df = spark.createDataFrame(rows, "site_name string, delivery_time timestamp, v double")
    reach = spark.createDataFrame([("a", 4), ("b", 30), ("c", 2), ("x", 3)], "site_name string, n long")
    size, n = {"a": 50, "b": 9, "c": 1}, {"a": 4, "b": 30, "c": 2}
    for own in (False, True):
        got = sorted((r["site_name"], r["v"], r["near_v"]) for r in positional_neighbours(df, reach, ["v"], include_self=own).collect())
        want = sorted((g, float(i), float(j)) for g, m in size.items() for i in range(m) for j in range(m)
                      if abs(i - j) <= n[g] and (own or i != j))
        assert got == want


def test_many_small_runs_come_in_one_call_and_large_ones_stay_whole(spark):
    """A call gets about a batch of rows, however many runs that is; no run is split."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    from gridcast.operators.chunks import CHUNK_COL, map_chunks, run_starts

    def fn(rows: pa.Table) -> pa.Table:
        starts = run_starts(rows, "g")
        ends = np.append(starts[1:], rows.num_rows) - 1
        return pa.table({"g": rows["g"].take(pa.array(starts)), "runs": pa.array(np.full(len(starts), len(starts))),
                         "n": pa.array(ends - starts + 1), "first": rows["v"].take(pa.array(starts)), "last": rows["v"].take(pa.array(ends))})

    small = spark.range(30_000).select((F.col("id") % 6000).cast("string").alias("g"), F.lit(0).cast("long").alias(CHUNK_COL), F.col("id").alias("v"))
    large = spark.range(25_000).select(F.lit("whole").alias("g"), F.lit(0).cast("long").alias(CHUNK_COL), F.col("id").alias("v"))
    got = map_chunks(small.unionByName(large), "g", "v", fn, "g string, runs long, n long, first long, last long").collect()
    assert sorted(r["g"] for r in got) == sorted(["whole", *map(str, range(6000))])
    assert all((r["n"], r["first"], r["last"]) == ((25_000, 0, 24_999) if r["g"] == "whole" else (5, int(r["g"]), int(r["g"]) + 24_000)) for r in got)
    assert np.median([r["runs"] for r in got]) > 200


def test_next_valid_value_is_found_without_a_frame_that_is_folded_anew(spark):
    """No window frame ends at the partition's end: Spark folds such a frame again for every row."""
    from gridcast.operators.impute import interpolate_gaps

    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", t0 + dt.timedelta(hours=i), float(i) if i % 5 == 0 else None, i) for i in range(40)]
    df = spark.createDataFrame(rows, "site_name string, delivery_time timestamp, v double, _pos long")
    out = interpolate_gaps(df, value="v")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    per_chunk = [line for line in plan.splitlines() if "Window [" in line and "_rec" in line]
    assert per_chunk and not any("1, unboundedfollowing" in line.lower() for line in per_chunk)
    assert [r["v"] for r in out.orderBy("_pos").collect()] == [float(min(i, 35)) for i in range(40)]


def test_duplicate_off_the_grid_raises_from_the_chunks(spark):
    from gridcast.operators.lags import lag_features

    t0 = dt.datetime(2024, 1, 1)
    times = [t0 + dt.timedelta(hours=i) for i in range(6)] + [t0 + dt.timedelta(minutes=30)] * 2
    df = spark.createDataFrame([("a", t, 1.0, True) for t in times], "site_name string, delivery_time timestamp, production_normalized double, is_not_plateau boolean")
    with pytest.raises(Exception, match="duplicate labels"):
        lag_features(df, lags=[1], rolling=()).collect()
    kept = lag_features(df.dropDuplicates(["delivery_time"]), lags=[1], rolling=()).orderBy("delivery_time").collect()
    assert [r["production_lag1h"] for r in kept] == [None, 1.0, 1.0, 1.0, 1.0, 1.0]
