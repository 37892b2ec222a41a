"""Prediction frame (M6) and error metrics.

MAE, RMSE and nRMSE = RMSE / mean(y_true) (0 when that mean is 0) per
group, over all rows, and for the portfolio (sums over groups per
timestamp). All are aggregations with map-side partial combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.roles import DEFAULT_ROLES, Roles
from gridcast.session import materialize

PRED_COLS = ["timestamp", "group", "y_true", "y_pred"]


def prediction_frame(df: DataFrame, pred: str, roles: Roles = DEFAULT_ROLES,
                     y_true: str | None = None) -> DataFrame:
    """``(timestamp, group, y_true, y_pred)``; group is cast to string or is
    the literal ``global`` when the frame has no group column."""
    g = F.col(roles.group).cast("string") if roles.group in df.columns else F.lit("global")
    return df.select(F.col(roles.time).alias("timestamp"), g.alias("group"),
                     F.col(y_true or roles.target).cast("double").alias("y_true"),
                     F.col(pred).cast("double").alias("y_pred"))


def errors(prefix: str = "") -> list[Column]:
    e = F.col("y_pred") - F.col("y_true")
    return [F.avg(F.abs(e)).alias(f"{prefix}mae"),
            F.sqrt(F.avg(e * e)).alias(f"{prefix}rmse"),
            F.avg("y_true").alias(f"_{prefix}mean")]


def nrmse(prefix: str = "") -> Column:
    m = F.col(f"_{prefix}mean")
    return F.when(m != 0, F.col(f"{prefix}rmse") / m).otherwise(F.lit(0.0))


def group_metrics(pred: DataFrame) -> DataFrame:
    """Per-group MAE/RMSE/nRMSE ordered by MAE (ties by group)."""
    return (pred.groupBy("group").agg(*errors())
            .withColumn("nrmse", nrmse()).drop("_mean")
            .orderBy("mae", "group"))


def global_metrics(pred: DataFrame) -> DataFrame:
    """One row: ``eval_mae, eval_rmse, eval_nrmse, n_rows``."""
    return (pred.agg(*errors("eval_"), F.count(F.lit(1)).alias("n_rows"))
            .withColumn("eval_nrmse", nrmse("eval_")).drop("_eval_mean"))


def portfolio_metrics(pred: DataFrame) -> DataFrame:
    """Errors of the per-timestamp sums, plus those divided by the number of
    distinct groups. Both one-row aggregates are combined by an equi-join on
    a constant key (1 x 1 rows)."""
    summed = (pred.groupBy("timestamp")
              .agg(F.sum("y_true").alias("y_true"), F.sum("y_pred").alias("y_pred")))
    total = (summed.agg(*errors("portfolio_"))
             .select(F.col("portfolio_mae").alias("portfolio_mae_total"),
                     F.col("portfolio_rmse").alias("portfolio_rmse_total"),
                     F.when(F.col("_portfolio_mean") != 0,
                            F.col("portfolio_rmse") / F.col("_portfolio_mean"))
                     .otherwise(F.lit(0.0)).alias("portfolio_nrmse_total"),
                     F.lit(0).alias("_k")))
    groups = pred.agg(F.countDistinct("group").alias("n_groups")).withColumn("_k", F.lit(0))
    per = lambda c: F.when(F.col("n_groups") > 0, F.col(c) / F.col("n_groups")).otherwise(F.lit(0.0))
    return (total.join(groups, "_k").drop("_k")
            .withColumn("portfolio_mae_per_site", per("portfolio_mae_total"))
            .withColumn("portfolio_rmse_per_site", per("portfolio_rmse_total")))


def evaluate(pred: DataFrame) -> dict:
    """All metrics as a dict; raises when the prediction frame is empty. The
    frame is written once for its three aggregates. ``per_site_metrics`` is a
    DataFrame with one row per group: it grows with the groups and stays
    distributed."""
    pred = materialize(pred)
    g = global_metrics(pred).first()
    if g is None or not g["n_rows"]:
        raise ValueError("the prediction frame has no rows to evaluate")
    out = {k: g[k] for k in ("eval_mae", "eval_rmse", "eval_nrmse")}
    p = portfolio_metrics(pred).first().asDict()
    out.update(p)
    out["portfolio_mae_per_group"] = out["portfolio_mae_per_site"]
    out["portfolio_rmse_per_group"] = out["portfolio_rmse_per_site"]
    out["n_sites"] = out["n_groups"] = int(p["n_groups"])
    out["per_site_metrics"] = group_metrics(pred)
    return out


def split_summary(parts: dict[str, DataFrame], time: str) -> DataFrame:
    """Count and time range per named part (``full``, ``train``, ``test``)."""
    frames = [df.select(F.lit(name).alias("part"), F.col(time).alias("_t")) for name, df in parts.items()]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    return u.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.min("_t").alias("t_min"),
                                 F.max("_t").alias("t_max"))
