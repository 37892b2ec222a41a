"""The experiment sweep (E3, J8, M10, M4, S5): all sites in one job.

Every run of the grid (site x model x length x drop option) splits its site by
time, scales on its training rows, fits a sequence regressor on the windows of
a length and is scored on its test rows. Nothing here loops over sites:

1. Per drop option, the complete rows of all sites are tagged with their
   role by their site's threshold and numbered per (option, site, role).
2. Tasks get chunks of a site's training rows with a halo of the longest window
   and return, per length, a statistic of the windows
   (:mod:`gridcast.operators.moments`); the statistics are merged per site.
3. Per (site, option, length), one task scales the statistic, solves it once for each
   model and writes the models as rows. Both models are linear in the window: ``lstm``
   weighs every step and feature, ``transformer`` the window's projections on sinusoidal
   positions, so both come from the same statistic.
4. Chunks of test rows meet their site's model rows; all metrics are aggregates
   by run.

The number of Spark jobs depends on the option lists and on the logarithm of the
largest site's rows, not on the number of sites. A run that fails is a row with
NULL metrics and an error text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.operators import clean, metrics
from gridcast.operators.chunks import CHUNK_COL, OWN_COL, POS_COL, chunk_size, halo_explode, positions
from gridcast.operators.moments import COLUMNS, ROWS, Moments, merge_parts, packed, total, unpacked
from gridcast.operators.sequences import HEADS, RIDGE, head_weights
from gridcast.roles import DEFAULT_ROLES, Roles
from gridcast.session import materialize

NO_SIDE = "the split leaves one side without rows"
NO_WINDOW = "no group has more rows than the sequence length"
NO_TEST = "the prediction frame has no rows to evaluate"

RESULT_SCHEMA = T.StructType([
    T.StructField("site_index", T.IntegerType()), T.StructField("name", T.StringType()),
    T.StructField("model", T.StringType()), T.StructField("seq_len", T.IntegerType()),
    T.StructField("drop_prod", T.BooleanType()), T.StructField("mae", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()), T.StructField("nrmse_pct", T.DoubleType()),
    T.StructField("portfolio_mae_total", T.DoubleType()), T.StructField("portfolio_rmse_total", T.DoubleType()),
    T.StructField("portfolio_nrmse_total", T.DoubleType()),
    T.StructField("portfolio_mae_per_site", T.DoubleType()),
    T.StructField("portfolio_rmse_per_site", T.DoubleType()), T.StructField("error", T.StringType()),
])
KEYS = ["site_index", "drop_prod"]
MODEL_COLUMNS = "site_index int, drop_prod boolean, seq_len int, model string, coef array<double>, intercept double, error string"


@dataclass
class SweepConfig:
    test_size: float = 0.2
    no_cv: bool = False
    output_dir: str | None = None
    val_fraction: float = 0.2
    delay_days: int = 15
    production_columns: tuple[str, ...] | None = None  # dropped with ``drop_prod``; by default the names of ``delay_days``


@dataclass
class SweepRows:
    """The numbered rows of all sites and options, and what is known per site."""

    rows: DataFrame      # site_index, drop_prod, role, POS_COL, time, y, x
    counts: DataFrame    # site_index, drop_prod, train, test (complete rows)
    scales: DataFrame    # site_index, drop_prod, x_mean, x_std, y_min, y_range (of the training rows)
    splits: DataFrame    # site_index, train_raw, test_raw (rows before the complete-case filter)
    most: int            # rows of the largest (site, option, role)


def sweep_rows(frame: DataFrame, sites: DataFrame, options: list[bool], cfg: SweepConfig, roles: Roles = DEFAULT_ROLES) -> SweepRows:
    """``sites``: ``site_index, site``, one row per site."""
    G, t, y = roles.group, F.unix_micros(F.col(roles.time)), roles.target
    frame = materialize(frame.join(sites.select(F.col("site").alias(G), "site_index"), G))
    lo, hi = F.col("_lo"), F.col("_hi")
    at = lo + F.floor((hi - lo).cast("double") * (1 - cfg.test_size)).cast("long")
    bounds = frame.groupBy("site_index").agg(F.min(t).alias("_lo"), F.max(t).alias("_hi")).select("site_index", at.alias("_thr"))
    tagged = frame.join(bounds, "site_index").withColumn("role", F.when(t < F.col("_thr"), "train").otherwise("test")).drop("_thr")
    splits = tagged.groupBy("site_index").agg(F.count_if(F.col("role") == "train").alias("train_raw"),
                                              F.count_if(F.col("role") == "test").alias("test_raw"))
    parts, scales = None, None
    for drop in options:
        gone = clean.drop_columns(drop, cfg.delay_days)
        if drop and cfg.production_columns is not None:
            gone = [*clean.drop_columns(False), *cfg.production_columns]
        own = {"site_index", "role"}
        feats = [c for c in frame.columns if c not in {*gone, *own, G, roles.time, y}]
        matrix = (tagged.select("site_index", "role", F.col(roles.time).alias("time"), F.col(y).cast("double").alias("y"),
                                *[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(feats)])
                  .dropna(how="any").withColumn("drop_prod", F.lit(drop)))
        fs = [f"f{i}" for i in range(len(feats))]
        sd = [F.stddev_pop(c) for c in fs]
        span = F.max("y") - F.min("y")
        scale = matrix.where(F.col("role") == "train").groupBy(*KEYS).agg(
            F.array(*[F.avg(c) for c in fs]).alias("x_mean"), F.array(*[F.when(s == 0, 1.0).otherwise(s) for s in sd]).alias("x_std"),
            F.min("y").alias("y_min"), F.when(span == 0, 1.0).otherwise(span).alias("y_range"))
        part = matrix.select(*KEYS, "role", "time", "y", F.array(*fs).alias("x"))
        parts = part if parts is None else parts.unionByName(part)
        scales = scale if scales is None else scales.unionByName(scale)
    rows = positions(parts.withColumn("_key", F.struct(*KEYS, "role")), "_key", ["time"]).drop("_key")
    counts = materialize(rows.groupBy(*KEYS).agg(F.count_if(F.col("role") == "train").alias("train"),
                                                 F.count_if(F.col("role") == "test").alias("test")))
    most = counts.agg(F.max(F.greatest("train", "test"))).first()[0] or 0
    return SweepRows(rows, counts, materialize(scales), splits, most)


def _windows(rows: pd.DataFrame, length: int, upto: int) -> tuple[np.ndarray, pd.DataFrame]:
    """Windows (steps in time order, each with all features) before the chunk's
    own rows with a position of ``length`` to ``upto``, and these rows."""
    rows = rows.sort_values(POS_COL, ignore_index=True)
    pos = rows[POS_COL].to_numpy()
    own = np.flatnonzero(rows[OWN_COL].to_numpy() & (pos >= length) & (pos < upto))
    if not len(own):
        return np.empty((0, 0)), rows.iloc[:0]
    x = np.stack(rows["x"].to_numpy())
    view = np.lib.stride_tricks.sliding_window_view(x, length, axis=0)  # start, feature, step
    return view[own - length].transpose(0, 2, 1).reshape(len(own), -1), rows.iloc[own]


def _fit_until(n_rows: int, length: int, cfg: SweepConfig) -> int:
    """The position at which the validation tail of the windows begins."""
    n = n_rows - length
    tail = 0 if cfg.no_cv or n < 20 else max(1, int(min(max(cfg.val_fraction, 0.05), 0.5) * n))
    return n_rows - tail


def window_moments(data: SweepRows, lengths: list[int], cfg: SweepConfig) -> DataFrame:
    """Statistics of the training windows: at most ``MERGE`` per site, option and length."""
    size = chunk_size(max(lengths), 0, 4096)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out, chunk, n = [], int(rows[CHUNK_COL].iat[0]), int(rows["train"].iat[0])
        site, drop = int(rows["site_index"].iat[0]), bool(rows["drop_prod"].iat[0])
        for length in lengths:
            x, own = _windows(rows, length, _fit_until(n, length, cfg))
            if len(own):
                z = np.column_stack((x, own["y"]))
                out.append(((site, drop, length, chunk), total(Moments.of(z[i:i + ROWS]) for i in range(0, len(z), ROWS))))
        return packed(out, [*KEYS, "seq_len", "part"])

    train = halo_explode(data.rows.where(F.col("role") == "train"), F.col(POS_COL), size, before=max(lengths), after=0)
    parts = (train.join(data.counts.select(*KEYS, "train"), KEYS).groupBy(*KEYS, CHUNK_COL)
             .applyInPandas(run, f"site_index int, drop_prod boolean, seq_len int, part long, {COLUMNS}"))
    return merge_parts(materialize(parts), [*KEYS, "seq_len"], "part", -(-data.most // size) + 1)


def fit_windows(moments: DataFrame, scales: DataFrame, models: list[str]) -> DataFrame:
    """One row per site, option, length and model: coefficients of the flattened
    window and an intercept, both in the units of the rows."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        one = rows.iloc[0]
        length, out = int(one["seq_len"]), []
        for model in models:
            key = (int(one["site_index"]), bool(one["drop_prod"]), length, model)
            try:
                whole = total(unpacked(rows))
                mean, std = (np.tile(np.asarray(one[c], float), length) for c in ("x_mean", "x_std"))
                y0, yr = float(one["y_min"]), float(one["y_range"])
                m = whole.scaled(np.append(mean, y0), np.append(std, yr))
                if model in HEADS:
                    w = head_weights(model, length)
                    w = np.kron(w, np.eye(len(mean) // length))
                    full = np.zeros((len(w) + 1, len(mean) + 1))
                    full[:-1, :-1], full[-1, -1] = w, 1
                    m = Moments(m.n, full @ m.mean, full @ m.dev @ full.T)
                coef, b = m.fit(RIDGE)
                if model in HEADS:
                    coef = coef @ w
                coef = coef * yr / std
                out.append((*key, coef, b * yr + y0 - float(coef @ mean), None))
            except Exception as exc:  # noqa: BLE001 - a failed fit is a result row
                out.append((*key, None, None, str(exc) or type(exc).__name__))
        return pd.DataFrame(out, columns=["site_index", "drop_prod", "seq_len", "model", "coef", "intercept", "error"])

    return moments.join(scales, KEYS).groupBy(*KEYS, "seq_len").applyInPandas(run, MODEL_COLUMNS)


def score_windows(data: SweepRows, fitted: DataFrame, lengths: list[int], role: str = "test") -> DataFrame:
    """Predictions ``site_index, drop_prod, seq_len, model, timestamp, y_true, y_pred`` of all rows of a
    ``role`` with enough rows before them; ``fitted`` may come from a saved table."""
    size = chunk_size(max(lengths), 0, 4096)
    keys = [*KEYS, CHUNK_COL]
    none = {"site_index": "int32", "drop_prod": "bool", "seq_len": "int32", "model": "object", "timestamp": "datetime64[us]",
            "y_true": "float64", "y_pred": "float64"}

    def run(rows: pd.DataFrame, models: pd.DataFrame) -> pd.DataFrame:
        out, windows = [], {}
        for m in models.itertuples():
            length = int(m.seq_len)
            if len(rows) and length not in windows:
                windows[length] = _windows(rows, length, 1 << 62)
            x, own = windows.get(length, (None, ()))
            if len(own):
                out.append(pd.DataFrame({"site_index": m.site_index, "drop_prod": m.drop_prod, "seq_len": length, "model": m.model,
                                         "timestamp": own["time"].to_numpy(), "y_true": own["y"].to_numpy(),
                                         "y_pred": x @ np.asarray(m.coef, float) + m.intercept}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({c: pd.Series(dtype=t) for c, t in none.items()})

    rows = halo_explode(data.rows.where(F.col("role") == role), F.col(POS_COL), size, before=max(lengths), after=0)
    chunks = data.counts.where(F.col(role) > 0).select(*KEYS, F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col(role) - 1) / size))).alias(CHUNK_COL))
    placed = fitted.where("error is null").join(chunks, KEYS)
    return rows.groupBy(*keys).cogroup(placed.groupBy(*keys)).applyInPandas(
        run, "site_index int, drop_prod boolean, seq_len int, model string, timestamp timestamp, y_true double, y_pred double")


def run_metrics(pred: DataFrame, by: list[str]) -> DataFrame:
    """All metrics per run: of the rows, and of the sums per timestamp (one site a run)."""
    rows = pred.groupBy(*by).agg(*metrics.errors()).withColumn("nrmse_pct", metrics.nrmse() * 100).drop("_mean")
    sums = pred.groupBy(*by, "timestamp").agg(F.sum("y_true").alias("y_true"), F.sum("y_pred").alias("y_pred"))
    whole = (sums.groupBy(*by).agg(*metrics.errors("p_")).withColumn("p_nrmse", metrics.nrmse("p_"))
             .select(*by, F.col("p_mae").alias("portfolio_mae_total"), F.col("p_rmse").alias("portfolio_rmse_total"),
                     F.col("p_nrmse").alias("portfolio_nrmse_total"), F.col("p_mae").alias("portfolio_mae_per_site"),
                     F.col("p_rmse").alias("portfolio_rmse_per_site")))
    return rows.join(whole, by)


def run_sweep(spark: SparkSession, frame: DataFrame, grid: DataFrame, cfg: SweepConfig, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Fit and score every row of the grid (:func:`~gridcast.plans.run.experiment_grid`). With ``output_dir``, the
    results are written as CSV per site and combined (S5), and every run's model as a Parquet
    folder ``models/site_index=../name=..`` that :func:`score_windows` can score again."""
    grid = materialize(grid)
    options = grid.agg(*[F.collect_set(c).alias(c) for c in ("model", "seq_len", "drop_prod")]).first()  # the option lists
    models, lengths, drops = sorted(options["model"]), sorted(options["seq_len"]), sorted(options["drop_prod"])
    if not models:
        return spark.createDataFrame([], RESULT_SCHEMA)
    data = sweep_rows(frame, grid.select("site_index", "site").distinct(), drops, cfg, roles)
    fitted = materialize(fit_windows(window_moments(data, lengths, cfg), data.scales, models))
    by = [*KEYS, "seq_len", "model"]
    pred = materialize(score_windows(data, fitted, lengths))
    out = (grid.join(data.splits, "site_index", "left").join(data.counts, KEYS, "left")
           .join(fitted.select(*by, F.col("error").alias("fit_error")), by, "left").join(run_metrics(pred, by), by, "left"))
    none = lambda c: F.coalesce(F.col(c), F.lit(0))
    error = (F.when((none("train_raw") == 0) | (none("test_raw") == 0), NO_SIDE).when(none("train") <= F.col("seq_len"), NO_WINDOW)
             .when(F.col("fit_error").isNotNull(), F.col("fit_error")).when(none("test") <= F.col("seq_len"), NO_TEST).otherwise(""))
    out = materialize(out.withColumn("error", error).select(*[F.col(f.name).cast(f.dataType) for f in RESULT_SCHEMA.fields]))
    if cfg.output_dir:
        base = cfg.output_dir.rstrip("/") + "/sequence_optimization"
        out.write.mode("overwrite").option("header", True).partitionBy("site_index").csv(f"{base}/by_site")
        out.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{base}/all_sites")
        named = fitted.join(grid.select(*by, "name"), by)
        named.write.mode("overwrite").partitionBy("site_index", "name").parquet(f"{base}/models")
    return out
