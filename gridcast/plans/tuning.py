"""Cross-validation, parameter search and train-and-evaluate.

Folds are time bounds on the training frame (no ``isin`` over collected
times). Where a model allows it, all folds and trials are one set of jobs: kNN
trials are read off one list of neighbours per row and distance
(:func:`knn_fold_errors`), linear folds come from merged statistics of the fold ranges
(:func:`linear_fold_errors`). Every tree fit is a distributed ``spark.ml`` job per fold
and trial; the trial table is a small DataFrame of parameter rows and scores.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridcast.operators.models import (DEFAULT_PARAMS, MAX_DEPTH, TRAIN_ID, ForecastModel, effective_params, fit_model, load_json,
                                       path_exists, predict, save_json)
from gridcast.operators.knn import knn_neighbors, neighbour_sums, weighted_mean
from gridcast.operators.moments import row_moments, total, unpacked
from gridcast.operators.split import fold_bounds, split_time, time_folds, with_fold
from gridcast.roles import DEFAULT_ROLES, Roles
from gridcast.session import materialize

# Fixed values that must equal the reference's: search spaces
# (name, kind, low, high[, step]) and categorical choices.
SEARCH_SPACES: dict[str, list[tuple]] = {
    "random_forest": [("n_estimators", "int", 100, 600, 50), ("max_depth", "int", 5, 40),
                      ("min_samples_leaf", "int", 1, 20)],
    "xgboost": [("n_estimators", "int", 100, 1000, 50), ("learning_rate", "logfloat", 0.01, 0.2),
                ("max_depth", "int", 3, 12), ("subsample", "float", 0.6, 1.0),
                ("colsample_bytree", "float", 0.5, 1.0)],
    "lightgbm": [("n_estimators", "int", 100, 1000, 50), ("learning_rate", "logfloat", 0.01, 0.2),
                 ("num_leaves", "int", 31, 255), ("min_child_samples", "int", 5, 80),
                 ("subsample", "float", 0.6, 1.0), ("colsample_bytree", "float", 0.5, 1.0)],
    "knn": [("n_neighbors", "int", 5, 80), ("weights", "cat", ["uniform", "distance"]), ("p", "int", 1, 2)],
}
RANDOM_SEED = 42


def feature_columns(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> list[str]:
    skip = {roles.time, roles.target, roles.group}
    return [c for c in df.columns if c not in skip]


def mae(pred: DataFrame, target: str) -> float:
    r = pred.agg(F.avg(F.abs(F.col("prediction") - F.col(target))).alias("m")).first()
    return float(r["m"]) if r and r["m"] is not None else float("nan")


def usable_folds(df: DataFrame, n_splits: int, roles: Roles = DEFAULT_ROLES) -> list[tuple[DataFrame, DataFrame]]:
    """The non-empty (train, validation) folds: their bounds are found once."""
    return [(t, v) for t, v in time_folds(df, n_splits, roles) if not t.isEmpty() and not v.isEmpty()]


def folded(df: DataFrame, n_splits: int, roles: Roles, features: Sequence[str]) -> DataFrame:
    """Features, target and ``_fold``: the fold that validates on the row (-1:
    none). Fold f trains on the rows with a smaller ``_fold``."""
    timed = df.where(F.col(roles.time).isNotNull())
    tagged = with_fold(timed, fold_bounds(timed, n_splits, roles.time), roles.time, "_fold")
    return tagged.select(*features, roles.target, F.coalesce("_fold", F.lit(-1)).alias("_fold"))


def knn_fold_errors(df: DataFrame, trials: Sequence[dict[str, Any]], n_splits: int = 5, roles: Roles = DEFAULT_ROLES,
                    features: Sequence[str] | None = None) -> DataFrame:
    """``trial, fold, mae`` of kNN parameter sets over all folds.

    Per distance (``p``), one join gives every validation row its nearest training rows, as many
    as the largest trial takes; running sums over their ranks hold the prediction of
    every trial at the rank where it ends. So the joins do not grow with trials or folds.
    """
    feats = list(features) if features is not None else feature_columns(df, roles)
    sets = [effective_params("knn", t) for t in trials]
    rows = materialize(folded(df, n_splits, roles, feats).withColumn(TRAIN_ID, F.monotonically_increasing_id()))
    val = rows.where("_fold >= 0")
    truth = val.select(F.col(TRAIN_ID).alias("_qid"), F.col("_fold").alias("fold"), F.col(roles.target).alias("_truth"))
    out = None
    for p in sorted({int(t.get("p", 2)) for t in sets}):
        mine = [(i, int(t.get("n_neighbors", 25)), t.get("weights", "uniform")) for i, t in enumerate(sets) if int(t.get("p", 2)) == p]
        top = knn_neighbors(rows, val, features=feats, target=roles.target, train_id=TRAIN_ID, query_id=TRAIN_ID,
                            k=max(k for _, k, _ in mine), p=p, segment="_fold")
        whole = Window.partitionBy("_qid")
        first = whole.orderBy("_rn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = neighbour_sums(lambda c: F.sum(c).over(first))
        curve = top.select("_qid", "_rn", F.max("_rn").over(whole).alias("_all"), *[c.alias(n) for n, c in sums.items()])
        sums = {n: F.col(n) for n in sums}
        ends = F.array(*[F.struct(F.lit(i).alias("trial"), F.lit(k).alias("k"), F.lit(w).alias("weights")) for i, k, w in mine])
        here = F.filter(ends, lambda t: (t["k"] == F.col("_rn")) | ((F.col("_rn") == F.col("_all")) & (t["k"] > F.col("_all"))))
        pred: Column = F.when(F.col("t.weights") == "uniform", weighted_mean(weights="uniform", **sums)).otherwise(
            weighted_mean(weights="distance", **sums))
        scored = (curve.withColumn("t", F.explode(here)).select("_qid", F.col("t.trial").alias("trial"), pred.alias("_pred"))
                  .join(truth, "_qid").groupBy("trial", "fold").agg(F.avg(F.abs(F.col("_pred") - F.col("_truth"))).alias("mae")))
        out = scored if out is None else out.unionByName(scored)
    return out


def linear_fits(df: DataFrame, n_splits: int, roles: Roles, features: Sequence[str], weight_decay: float = 0.0) -> DataFrame:
    """``fold, coef, intercept``: the linear regression of every fold's training
    rows, from the statistics of the fold ranges; each is read once and merged into all later folds."""
    parts = row_moments(df, ["_fold"], list(features), roles.target).where(F.col("_fold") < n_splits - 1)

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        coef, intercept = total(unpacked(rows)).fit(weight_decay)
        return pd.DataFrame({"fold": [rows["fold"].iat[0]], "coef": [coef], "intercept": [intercept]})

    later = parts.withColumn("fold", F.explode(F.sequence(F.col("_fold") + 1, F.lit(n_splits - 1))))
    return later.groupBy("fold").applyInPandas(solve, "fold int, coef array<double>, intercept double")


def linear_fold_errors(df: DataFrame, n_splits: int = 5, roles: Roles = DEFAULT_ROLES, features: Sequence[str] | None = None,
                       weight_decay: float = 0.0) -> DataFrame:
    """``fold, mae`` of a linear regression; the number of jobs does not depend on the folds."""
    feats = list(features) if features is not None else feature_columns(df, roles)
    rows = folded(df, n_splits, roles, feats)
    fits = F.broadcast(linear_fits(rows, n_splits, roles, feats, weight_decay))  # n_splits rows
    pred = F.col("intercept")
    for i, c in enumerate(feats):
        pred = pred + F.col("coef")[i] * F.col(c).cast("double")
    return (rows.withColumnRenamed("_fold", "fold").dropna(subset=[*feats, roles.target]).join(fits, "fold")
            .groupBy("fold").agg(F.avg(F.abs(pred - F.col(roles.target))).alias("mae")))


def fold_maes(df: DataFrame, model_type: str, params: dict[str, Any], n_splits: int = 5,
              roles: Roles = DEFAULT_ROLES, features: Sequence[str] | None = None,
              folds: list[tuple[DataFrame, DataFrame]] | None = None) -> list[float]:
    """MAE per expanding time fold (M7); empty folds are skipped. kNN and linear
    models score all folds in one set of jobs; other models are fitted fold by fold, on ``folds``
    (from :func:`usable_folds`) if many parameter sets are tried."""
    feats = list(features) if features is not None else feature_columns(df, roles)
    if model_type in ("knn", "linear"):
        errors = (knn_fold_errors(df, [params], n_splits, roles, feats) if model_type == "knn" else
                  linear_fold_errors(df, n_splits, roles, feats, float(effective_params("linear", params).get("weight_decay", 0.0))))
        return [r["mae"] for r in errors.orderBy("fold").collect()]  # n_splits rows
    out = []
    for train, val in usable_folds(df, n_splits, roles) if folds is None else folds:
        m = fit_model(train, feats, roles.target, model_type, params)
        out.append(mae(predict(m, val), roles.target))
    return out


def cross_validate(df: DataFrame, model_type: str, params: dict[str, Any], n_splits: int = 5,
                   roles: Roles = DEFAULT_ROLES, features=None, empty: float = float("inf"),
                   folds=None) -> tuple[float, float]:
    """Mean and population std of the fold MAEs (``empty`` when no fold)."""
    maes = fold_maes(df, model_type, params, n_splits, roles, features, folds)
    if not maes:
        return empty, empty
    mean = sum(maes) / len(maes)
    return mean, math.sqrt(sum((m - mean) ** 2 for m in maes) / len(maes))


def sample_params(model_type: str, rng: random.Random) -> dict[str, Any]:
    """One random draw from the model's search space (int / float /
    log-float / categorical); fixed parameters such as the seed are kept."""
    out: dict[str, Any] = {}
    for spec in SEARCH_SPACES[model_type]:
        name, kind = spec[0], spec[1]
        if kind == "int":
            lo, hi = spec[2], spec[3]
            step = spec[4] if len(spec) > 4 else 1
            out[name] = lo + step * rng.randint(0, (hi - lo) // step)
        elif kind == "float":
            out[name] = rng.uniform(spec[2], spec[3])
        elif kind == "logfloat":
            out[name] = math.exp(rng.uniform(math.log(spec[2]), math.log(spec[3])))
        elif kind == "cat":
            out[name] = rng.choice(spec[2])
    if model_type != "knn":
        out["random_state"] = RANDOM_SEED
    if "max_depth" in out:  # Spark trees end at MAX_DEPTH, so the space ends there; recorded as fitted
        out["max_depth"] = min(out["max_depth"], MAX_DEPTH)
    return out


def param_search(df: DataFrame, model_type: str, n_trials: int, n_splits: int = 5,
                 roles: Roles = DEFAULT_ROLES, seed: int = RANDOM_SEED, features=None,
                 overrides: dict[str, Any] | None = None) -> DataFrame:
    """Random search (M8): ``(trial, params, cv_mae)`` per sampled parameter
    set; pick the best with :func:`best_trial`. ``overrides`` pins values
    (for example a cap on the tree count)."""
    rng = random.Random(seed)
    spark = df.sparkSession
    sets = [sample_params(model_type, rng) | (overrides or {}) for _ in range(int(n_trials))]
    names = [json.dumps(p, sort_keys=True) for p in sets]
    if model_type == "knn" and sets:
        trials = spark.createDataFrame(list(enumerate(names)), "trial int, params string")
        errors = knn_fold_errors(df, sets, n_splits, roles, features).groupBy("trial").agg(F.avg("mae").alias("cv_mae"))
        return materialize(trials.join(errors, "trial", "left").select("trial", "params", F.coalesce("cv_mae", F.lit(float("inf"))).alias(
            "cv_mae")))
    folds = usable_folds(df, n_splits, roles)
    rows = [(i, name, float(cross_validate(df, model_type, p, n_splits, roles, features, folds=folds)[0]))
            for i, (name, p) in enumerate(zip(names, sets, strict=True))]
    return spark.createDataFrame(rows, "trial int, params string, cv_mae double")


def best_trial(trials: DataFrame) -> DataFrame:
    """Arg-min of the CV MAE (O2); ties go to the earlier trial."""
    return trials.orderBy("cv_mae", "trial").limit(1)


@dataclass
class TabularConfig:
    model: str = "random_forest"
    site: str = "all"
    train_percent: float = 0.8
    n_trials: int = 50
    mode: str = "all"           # tune | train | all
    output_dir: str = "outputs"
    n_splits: int = 5
    overrides: dict[str, Any] = field(default_factory=dict)


def resolve_models(selection: str) -> list[str]:
    if selection == "all":
        return list(SEARCH_SPACES)
    if selection not in SEARCH_SPACES:
        raise ValueError(f"unknown model {selection!r}; known: {sorted(SEARCH_SPACES)}")
    return [selection]


def run_tabular(spark: SparkSession, dataset: DataFrame, cfg: TabularConfig,
                roles: Roles = DEFAULT_ROLES) -> dict[str, dict[str, Any]]:
    """Tune / train / evaluate each selected model (M9).

    ``dataset`` is the processed, complete-case model frame. Parameters come
    from tuning (``tune``/``all``), else from a saved best-params JSON, else
    the defaults. Writes model, metrics, features and a summary (S6-S8).
    """
    if cfg.site != "all":
        dataset = dataset.where(F.col(roles.group) == F.lit(cfg.site))
        if dataset.isEmpty():
            raise ValueError(f"site {cfg.site!r} has no rows")
    dataset = materialize(dataset)  # every fold, fit and score reads this copy
    train, test = split_time(dataset, cfg.train_percent, roles)
    folds = usable_folds(train, cfg.n_splits, roles)
    out_dir = cfg.output_dir.rstrip("/") + "/tabular_optimization"
    feats = feature_columns(dataset, roles)
    results: dict[str, dict[str, Any]] = {}
    for model_type in resolve_models(cfg.model):
        best_path = f"{out_dir}/{model_type}_best_params.json"
        if cfg.mode in ("tune", "all"):
            trials = param_search(train, model_type, cfg.n_trials, cfg.n_splits, roles,
                                  features=feats, overrides=cfg.overrides)
            params = json.loads(best_trial(trials).first()["params"])
            save_json(spark, params, best_path)
            if cfg.mode == "tune":
                continue
        elif path_exists(spark, best_path):
            params = load_json(spark, best_path)
        else:
            params = dict(DEFAULT_PARAMS[model_type], **cfg.overrides)
        model = fit_model(train, feats, roles.target, model_type, params)
        cv, _ = cross_validate(train, model_type, params, cfg.n_splits, roles, feats, folds=folds)
        metrics = {"cv_mae": cv, "test_mae": mae(predict(model, test), roles.target), "params": params}
        model.save(f"{out_dir}/{model_type}_model")
        save_json(spark, metrics, f"{out_dir}/{model_type}_metrics.json")
        save_json(spark, feats, f"{out_dir}/{model_type}_features.json")
        results[model_type] = metrics
    if results:
        save_json(spark, results, f"{out_dir}/summary_{cfg.model}.json")
    return results


def load_or_train(path: str | None, train: DataFrame, features: Sequence[str], target: str,
                  model_type: str, params: dict[str, Any] | None = None) -> ForecastModel:
    """Reuse a saved model when one exists at ``path``, else fit and save."""
    if path and ForecastModel.exists(path):
        return ForecastModel.load(path)
    m = fit_model(train, features, target, model_type, params)
    if path:
        m.save(path)
    return m
