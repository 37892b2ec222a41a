"""Window operators against pandas on random gapped panels."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridcast.operators import chunks, impute, lags, quality
from tests.helpers import close, gapped_panel, pandas_interpolate, sql_lags, sql_plateau, to_spark


def _sorted(pdf):
    return pdf.sort_values(["site_name", "delivery_time"]).reset_index(drop=True)


@pytest.mark.parametrize("seed", [0, 1])
def test_plateau_matches_band_join(spark, seed):
    pdf = gapped_panel(seed)
    got = _sorted(quality.plateau_flags(to_spark(spark, pdf)).toPandas())
    exp = _sorted(sql_plateau(pdf))
    assert (got["is_not_plateau"].to_numpy() == exp["is_not_plateau"].to_numpy()).all()
    assert (~exp["is_not_plateau"]).sum() > 0


def test_plateau_irregular_interval_and_window(spark):
    pdf = gapped_panel(3, step_h=2)
    got = _sorted(quality.plateau_flags(to_spark(spark, pdf), window="36h").toPandas())
    exp = _sorted(sql_plateau(pdf, hours=36.0))
    assert (got["is_not_plateau"].to_numpy() == exp["is_not_plateau"].to_numpy()).all()


def test_plateau_without_target_is_true(spark):
    df = to_spark(spark, gapped_panel(0)).drop("production_normalized")
    assert quality.plateau_flags(df).where(~F.col("is_not_plateau")).count() == 0


def test_plateau_null_value_never_matches(spark):
    pdf = gapped_panel(0, groups=("a",), n=60, plateau_runs=1)
    pdf.loc[5, "production_normalized"] = None
    got = quality.plateau_flags(to_spark(spark, pdf)).toPandas()
    row = got[got["delivery_time"] == pdf.loc[5, "delivery_time"]]
    assert bool(row["is_not_plateau"].iloc[0]) is True


@pytest.mark.parametrize("seed", [0, 2])
def test_interpolation_matches_pandas(spark, seed):
    pdf = gapped_panel(seed)
    rng = np.random.default_rng(seed + 10)
    mask = rng.random(len(pdf)) < 0.3
    pdf.loc[mask, "production_normalized"] = np.nan
    pdf.loc[pdf.index[:3], "production_normalized"] = np.nan          # leading gap stays
    got = _sorted(impute.interpolate_gaps(to_spark(spark, pdf)).toPandas())
    exp = _sorted(pandas_interpolate(pdf))
    assert close(got["production_normalized"], exp["production_normalized"], 1e-12)


def test_interpolation_long_and_trailing_gaps(spark):
    pdf = gapped_panel(0, groups=("a",), n=40, gap_p=0.0, plateau_runs=0)
    pdf.loc[10:19, "production_normalized"] = np.nan   # 10-row gap: only 6 filled
    pdf.loc[35:, "production_normalized"] = np.nan     # trailing: last value repeated
    got = _sorted(impute.interpolate_gaps(to_spark(spark, pdf)).toPandas())
    exp = _sorted(pandas_interpolate(pdf))
    assert close(got["production_normalized"], exp["production_normalized"], 1e-12)
    assert got["production_normalized"].isna().sum() == 4  # 10-row gap: 6 filled; 5 trailing: all filled


def test_impute_cascade_matches_pandas(spark):
    pdf = gapped_panel(4)
    flagged = sql_plateau(pdf)
    # reference cascade: mask, interpolate, hour mean, group median, ffill/bfill
    exp = []
    for _, g in flagged.groupby("site_name"):
        g = g.sort_values("delivery_time").copy()
        g.loc[~g["is_not_plateau"], "production_normalized"] = np.nan
        g = g.set_index("delivery_time")
        g["production_normalized"] = g["production_normalized"].interpolate(method="time", limit=6)
        g = g.reset_index()
        h = g["delivery_time"].dt.hour
        hm = g.groupby(h)["production_normalized"].mean().fillna(g["production_normalized"].median())
        g["production_normalized"] = g["production_normalized"].fillna(h.map(hm)).ffill().bfill()
        exp.append(g)
    exp = _sorted(pd.concat(exp))
    got = _sorted(impute.impute_target(quality.plateau_flags(to_spark(spark, pdf))).toPandas())
    assert close(got["production_normalized"], exp["production_normalized"], 1e-12)


LAGS, SHIFT, ROLL = [3, 5, 24], 3, ((12, 6, "a"), (24, 12, "b"))


def test_lags_and_rolling_match_self_joins_on_grid(spark):
    pdf = gapped_panel(5)
    got = _sorted(lags.lag_features(to_spark(spark, pdf), lags=LAGS, roll_shift=SHIFT, rolling=ROLL).toPandas())
    exp = _sorted(sql_lags(pdf, LAGS, SHIFT, ROLL))
    assert len(got) == len(exp)  # no flag: gap rows are materialised (quirk 16)
    for c in [f"production_lag{L}h" for L in LAGS] + lags.rolling_names(ROLL):
        assert close(got[c], exp[c], 1e-9), c


def test_lags_with_flags_drop_gaps_and_plateaus(spark):
    pdf = gapped_panel(6)
    flagged = quality.plateau_flags(to_spark(spark, pdf))
    got = _sorted(lags.lag_features(flagged, lags=LAGS, roll_shift=SHIFT, rolling=ROLL).toPandas())
    flags = sql_plateau(pdf)[["site_name", "delivery_time", "is_not_plateau"]]
    exp = sql_lags(pdf, LAGS, SHIFT, ROLL).merge(flags, on=["site_name", "delivery_time"])
    exp = _sorted(exp[exp["is_not_plateau"].astype(bool)])
    assert len(got) == len(exp)
    for c in [f"production_lag{L}h" for L in LAGS] + lags.rolling_names(ROLL):
        assert close(got[c], exp[c], 1e-9), c


def test_grid_drops_off_grid_and_rejects_duplicates(spark):
    pdf = gapped_panel(0, groups=("a",), n=30, plateau_runs=0)
    off = pdf.iloc[[3]].copy()
    off["delivery_time"] = off["delivery_time"] + pd.Timedelta(minutes=30)
    g = lags.hourly_grid(to_spark(spark, pd.concat([pdf, off]))).toPandas()
    assert len(g) == int((pdf.delivery_time.max() - pdf.delivery_time.min()) / pd.Timedelta("1h")) + 1
    assert not (g["delivery_time"].dt.minute != 0).any()
    dup = pd.concat([pdf, pdf.iloc[[2]]])
    with pytest.raises(Exception, match="duplicate"):
        lags.hourly_grid(to_spark(spark, dup)).collect()


def test_chunked_windows_survive_small_chunks(spark, monkeypatch):
    """Forcing tiny chunks (many halo copies) must not change any result."""
    pdf = gapped_panel(7)
    ref = _sorted(lags.lag_features(to_spark(spark, pdf), lags=LAGS, roll_shift=SHIFT, rolling=ROLL).toPandas())
    monkeypatch.setattr(lags, "GRID_CHUNK_STEPS", 7)
    monkeypatch.setattr(lags, "chunk_size", lambda b, a, m: 7 * 3_600_000_000)
    got = _sorted(lags.lag_features(to_spark(spark, pdf), lags=LAGS, roll_shift=SHIFT, rolling=ROLL).toPandas())
    for c in [f"production_lag{L}h" for L in LAGS] + lags.rolling_names(ROLL):
        assert close(got[c], ref[c], 1e-12), c
    monkeypatch.setattr(quality, "chunk_size", lambda b, a, m: 5)
    got_p = _sorted(quality.plateau_flags(to_spark(spark, pdf)).toPandas())
    exp_p = _sorted(sql_plateau(pdf))
    assert (got_p["is_not_plateau"].to_numpy() == exp_p["is_not_plateau"].to_numpy()).all()


def test_positions_and_median(spark):
    pdf = gapped_panel(8)
    df = to_spark(spark, pdf).repartition(5)
    pos = chunks.positions(df, "site_name", ["delivery_time"]).toPandas()
    exp = pdf.sort_values(["site_name", "delivery_time"]).groupby("site_name").cumcount()
    got = pos.sort_values(["site_name", "delivery_time"])["_pos"].to_numpy()
    assert (got == exp.to_numpy()).all()
    med = chunks.group_median(df, "site_name", "production_normalized").toPandas().set_index("site_name")
    emed = pdf.groupby("site_name")["production_normalized"].median()
    assert close(med.loc[emed.index, "median"], emed, 1e-12)


@pytest.mark.parametrize("parts,merge", [("4", "true"), ("16", "true"), ("16", "false"), ("200", "true")])
def test_positions_keep_every_row(spark, parts, merge):
    """Rows in = rows out and positions = row numbers, however many partitions
    the range exchange has; one group holds over a third of the rows."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)
    try:
        df = spark.range(60_000).select(
            F.when(F.col("id") % 5 < 2, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 97)).alias("site"),
            ((F.col("id") * 7919) % 60_000).alias("t"), F.repeat(F.lit("x"), 40).alias("extra"))
        rank = F.row_number().over(Window.partitionBy("site").orderBy("t")) - 1
        got = chunks.positions(df, "site", ["t"])
        r = got.withColumn("rank", rank).agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("rank") != F.col("_pos")).cast("int"))
                                             .alias("bad")).first()
        assert (r["n"], r["bad"]) == (60_000, 0)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_supplier_panel_keeps_every_row(spark):
    """The supplier panel at sf0.1: 465,019 rows come back positioned."""
    from gridcast.plans.queries import panel
    from gridcast.sources import fixtures as fx

    p = panel.normalize_target(fx.ship_day(spark, "/root/testdata/sf0.1", site_col="l_suppkey"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert chunks.positions(p, "site_name", ["delivery_time"]).count() == p.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_sampling_interval(spark):
    pdf = gapped_panel(9, step_h=3)
    got = quality.sampling_interval(to_spark(spark, pdf)).toPandas().set_index("site_name")["interval_s"]
    exp = pdf.sort_values("delivery_time").groupby("site_name")["delivery_time"].apply(
        lambda s: s.diff().median().total_seconds())
    assert close(got.loc[exp.index], exp, 1e-9)


def test_repartitioned_input_gives_same_flags(spark):
    pdf = gapped_panel(11)
    a = _sorted(quality.plateau_flags(to_spark(spark, pdf)).toPandas())
    b = _sorted(quality.plateau_flags(to_spark(spark, pdf.sample(frac=1, random_state=1)).repartition(7)).toPandas())
    assert (a["is_not_plateau"].to_numpy() == b["is_not_plateau"].to_numpy()).all()


def test_weighted_median_matches_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [(g, float(v)) for g in ("a", "b", "c") for v in rng.integers(0, 7, size=int(rng.integers(1, 60)))]
    rows.append(("d", 2.5))
    df = spark.createDataFrame(rows, "g string, v double")
    got = chunks.group_median_weighted(df, "g", "v", chunk_rows=2).toPandas().set_index("g")["median"]
    exp = pd.DataFrame(rows, columns=["g", "v"]).groupby("g")["v"].median()
    assert close(got.loc[exp.index], exp, 0)
    plain = chunks.group_median(df, "g", "v").toPandas().set_index("g")["median"]
    assert close(plain.loc[exp.index], exp, 0)
