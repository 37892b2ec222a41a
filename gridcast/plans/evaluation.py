"""Evaluation plans built from operators: cross-validated baselines and a
small search over persistence lags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.operators import lags as lagops
from gridcast.operators.split import fold_bounds, with_fold
from gridcast.roles import DEFAULT_ROLES, Roles


def group_mean_cv(df: DataFrame, n_splits: int = 5, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Expanding-fold CV of a per-group mean predictor (global mean for a
    group unseen in training): ``cv_mae`` (mean of fold MAEs), ``cv_mae_std``
    (population std) and ``n_folds``.

    Rows are tagged with their validation fold once; each fold's training
    means are prefix sums over a small (group, fold) table, so no row is
    copied per fold.
    """
    G, y = roles.group, roles.target
    tagged = with_fold(df, fold_bounds(df, n_splits, roles.time), roles.time)
    f = F.coalesce(F.col("fold"), F.lit(-1))
    per = tagged.groupBy(G, f.alias("_f")).agg(F.sum(y).alias("_s"), F.count(y).alias("_c"))
    before_g = Window.partitionBy(G).orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)
    gmean = per.select(G, F.col("_f").alias("fold"),
                       (F.sum("_s").over(before_g) / F.sum("_c").over(before_g)).alias("_gm"))
    tot = per.groupBy("_f").agg(F.sum("_s").alias("_s"), F.sum("_c").alias("_c"))
    before = Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)  # <= k + 1 rows
    amean = tot.select(F.col("_f").alias("fold"), (F.sum("_s").over(before) / F.sum("_c").over(before)).alias("_am"))
    val = tagged.where(F.col("fold").isNotNull()).join(gmean, [G, "fold"], "left").join(amean, "fold", "left")
    fold_mae = (val.withColumn("_e", F.abs(F.coalesce("_gm", "_am") - F.col(y)))
                .groupBy("fold").agg(F.avg("_e").alias("mae")))
    return fold_mae.agg(F.avg("mae").alias("cv_mae"), F.stddev_pop("mae").alias("cv_mae_std"),
                        F.count(F.lit(1)).alias("n_folds"))


def persistence_errors(df: DataFrame, candidates: Sequence[int], roles: Roles = DEFAULT_ROLES,
                       step: str = "1h") -> DataFrame:
    """MAE of each ``lag`` persistence forecast: ``(lag_hours, mae)``. All
    lags come from one windowed pass, then are unpivoted."""
    lf = lagops.lag_features(df, roles, lags=list(candidates), rolling=(), step=step,
                             materialize_grid=False, keep_flagged=True)
    names = lagops.lag_names(candidates)
    long = lf.select(roles.target, F.inline(F.array(*[
        F.struct(F.lit(L).alias("lag_hours"), F.col(n).alias("_p")) for L, n in zip(candidates, names)])))
    return (long.where(F.col("_p").isNotNull())
            .groupBy("lag_hours").agg(F.avg(F.abs(F.col("_p") - F.col(roles.target))).alias("mae")))


def best_persistence_lag(df: DataFrame, candidates: Sequence[int], roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Arg-min of :func:`persistence_errors` (ties to the shorter lag)."""
    return persistence_errors(df, candidates, roles).orderBy("mae", "lag_hours").limit(1)
