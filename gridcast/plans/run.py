"""Train-and-evaluate runs (E1) and the experiment grid (J8); the sweep over
it is in :mod:`gridcast.plans.sweep`."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass
from typing import Any

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.names import run_name
from gridcast.operators import clean, metrics
from gridcast.operators.chunks import positions
from gridcast.operators.models import MAIN_PARAMS, SEQUENCE_MODELS, ForecastModel, fit_model, predict
from gridcast.operators.panel import group_at
from gridcast.operators.scale import MinMaxScaling, StandardScaling, fit_minmax, fit_standard
from gridcast.operators.sequences import RIDGE, sequence_windows, window_inputs
from gridcast.operators.split import holdout_split, sequence_holdout, split_time
from gridcast.plans.tuning import cross_validate, feature_columns, load_or_train
from gridcast.roles import DEFAULT_ROLES, Roles
from gridcast.session import materialize


def _require_rows(*frames: DataFrame) -> None:
    if any(f.isEmpty() for f in frames):
        raise ValueError("the split leaves one side without rows")


def _windows(df: DataFrame, feats: Sequence[str], seq_len: int, model_type: str, roles: Roles) -> DataFrame:
    """Key, target and the model's inputs of the window as one vector."""
    w = sequence_windows(df, feats, seq_len, roles)
    return w.select(roles.group, roles.time, roles.target, array_to_vector(window_inputs(model_type, seq_len)).alias("seq_vec"))


@dataclass
class SequenceModel:
    """A window regressor with its scalers."""

    model: ForecastModel
    features: list[str]
    seq_len: int
    x_scale: StandardScaling
    y_scale: MinMaxScaling
    model_type: str = "lstm"

    def predict(self, df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
        scaled = self.y_scale.transform(self.x_scale.transform(df))
        out = predict(self.model, _windows(scaled, self.features, self.seq_len, self.model_type, roles))
        return self.y_scale.inverse(out, {"prediction": roles.target, roles.target: roles.target})

    def save(self, path: str) -> None:
        """Model, window shape and scalers as one version."""
        self.model.save(path, sequence={"features": self.features, "seq_len": self.seq_len, "model_type": self.model_type,
                                        "x": asdict(self.x_scale), "y": asdict(self.y_scale)})

    @staticmethod
    def load(path: str) -> SequenceModel:
        d = ForecastModel.meta(path)["sequence"]
        fields = lambda x: {k: tuple(v) for k, v in x.items()}
        return SequenceModel(ForecastModel.load(path), d["features"], d["seq_len"], StandardScaling(**fields(d["x"])),
                             MinMaxScaling(**fields(d["y"])), d["model_type"])


def train_sequence(train: DataFrame, features: Sequence[str], seq_len: int, model_type: str = "lstm",
                   params: dict[str, Any] | None = None, roles: Roles = DEFAULT_ROLES, no_cv: bool = False,
                   val_fraction: float = 0.2) -> tuple[SequenceModel, dict[str, float]]:
    """Sequence model re-aimed on Spark (M4): features are standard-scaled
    and the target min-max scaled on the training rows (A12/A13), windows
    of ``seq_len`` rows become the inputs of ``model_type`` (:func:`window_inputs`) and are fed
    to a ridge regression (penalty ``weight_decay``, at least ``RIDGE``) or another regressor; the last
    sequences form the validation tail (X4), whose MAE is returned too."""
    feats, y = list(features), roles.target
    if train.isEmpty():
        raise ValueError("no group has more rows than the sequence length")
    sx, sy = fit_standard(train, feats), fit_minmax(train, [y])
    tr = _windows(sy.transform(sx.transform(train)), feats, seq_len, model_type, roles)
    if tr.isEmpty():
        raise ValueError("no group has more rows than the sequence length")
    tr = materialize(sequence_holdout(tr, roles, val_fraction=val_fraction, no_cv=no_cv))
    params = dict(params or {})
    if model_type in SEQUENCE_MODELS:
        params["weight_decay"] = max(RIDGE, float(params.get("weight_decay", 0.0)))
    fitted = fit_model(tr.where(~F.col("is_val")), ["seq_vec"], y, "linear" if model_type in SEQUENCE_MODELS else model_type, params)
    info = {"cv_mae": float("nan"), "cv_mae_std": float("nan")}
    val = tr.where(F.col("is_val"))
    if not val.isEmpty():
        vp = sy.inverse(predict(fitted, val), {"prediction": y, y: y})
        info = {"cv_mae": float(vp.agg(F.avg(F.abs(F.col("prediction") - F.col(y)))).first()[0]), "cv_mae_std": 0.0}
    return SequenceModel(fitted, feats, seq_len, sx, sy, model_type), info


def sequence_predictions(train: DataFrame, test: DataFrame, features: Sequence[str], seq_len: int,
                         model_type: str = "lstm", params: dict[str, Any] | None = None,
                         roles: Roles = DEFAULT_ROLES, no_cv: bool = False,
                         val_fraction: float = 0.2) -> tuple[DataFrame, dict[str, float]]:
    """Prediction frame of the test sequences, and the validation MAE."""
    model, info = train_sequence(train, features, seq_len, model_type, params, roles, no_cv, val_fraction)
    return metrics.prediction_frame(model.predict(test, roles), "prediction", roles), info


def run_pipeline(frame: DataFrame, *, model_type: str = "random_forest", test_size: float = 0.2,
                 one_site_only: bool = False, idx_site: int = 0, on_nine_sites: bool = False,
                 drop_prod: bool = False, no_cv: bool = False, seq_len: int | None = None,
                 params: dict[str, Any] | None = None, savepath: str | None = None, skip_train: bool = False,
                 n_splits: int = 5, delay_days: int = 15, roles: Roles = DEFAULT_ROLES) -> dict[str, Any]:
    """Split, finalise, train (or reuse a saved model) and evaluate.

    ``frame`` is the processed and clipped feature frame (before the
    complete-case filter). A fit reports ``cv_mae`` and ``cv_mae_std``: of
    ``n_splits`` expanding time folds for tabular models (always), of the
    validation tail for sequence models (not with ``no_cv``); NaN for a model
    that was loaded. ``skip_train`` evaluates the model at ``savepath`` and fails
    if there is none. The arguments ``params`` and ``seq_len`` win over
    :data:`MAIN_PARAMS` (quirk 11 fixed); failures raise ``ValueError`` (quirk
    13 fixed).
    """
    df = frame
    if one_site_only:
        df = df.where(F.col(roles.group) == F.lit(group_at(df, idx_site, roles)))
    if on_nine_sites:
        train, test = holdout_split(df, test_size, idx_site, roles)
    else:
        train, test = split_time(df, 1 - test_size, roles)
    _require_rows(train, test)
    if model_type not in MAIN_PARAMS:
        raise ValueError(f"unknown model {model_type!r}; known: {sorted(MAIN_PARAMS)}")
    drop = clean.drop_columns(drop_prod, delay_days)
    # the fits, folds and scores below all read these written parts
    train_m, test_m = materialize(clean.model_matrix(train, drop)), materialize(clean.model_matrix(test, drop))
    feats = feature_columns(train_m, roles)
    params = dict(MAIN_PARAMS[model_type] if params is None else params)
    saved = bool(savepath) and ForecastModel.exists(savepath)
    if skip_train and not saved:
        raise ValueError(f"there is no saved model at {savepath!r} to evaluate")
    info = {"cv_mae": float("nan"), "cv_mae_std": float("nan")}
    if model_type in SEQUENCE_MODELS:
        n = int(seq_len or params.get("seq_len", MAIN_PARAMS[model_type]["seq_len"]))
        if saved:
            model = SequenceModel.load(savepath)
        else:
            model, info = train_sequence(train_m, feats, n, model_type, params, roles, no_cv)
            if savepath:
                model.save(savepath)
        pred = model.predict(test_m, roles)
    else:
        if saved:
            fitted = ForecastModel.load(savepath)
        else:
            mean, std = cross_validate(train_m, model_type, params, n_splits, roles, feats, empty=float("nan"))
            info = {"cv_mae": mean, "cv_mae_std": std}
            fitted = load_or_train(savepath, train_m, feats, roles.target, model_type, params)
        pred = predict(fitted, test_m)
    return metrics.evaluate(metrics.prediction_frame(pred, "prediction", roles)) | info


# ------------------------------------------------------------------ sweep


def experiment_grid(frame: DataFrame, models: Sequence[str], seq_lengths: Sequence[int],
                    drop_options: Sequence[bool], site_start: int = 0, site_end: int | None = None,
                    roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Site x model x length x drop-option rows with their run names (J8,
    F12). Sites are positions in sorted group order (from the data); the
    parameter lists are expanded with ``explode`` of literal arrays, so no
    join is needed."""
    if site_end is not None and site_start > site_end:
        raise ValueError("the first site of the sweep lies behind the last")
    groups = positions(frame.select(roles.group).where(F.col(roles.group).isNotNull()).distinct()
                       .withColumn("_all", F.lit(0)), "_all", [roles.group], "site_index")
    sites = groups.where(F.col("site_index") >= site_start)
    if site_end is not None:
        sites = sites.where(F.col("site_index") <= site_end)
    g = (sites.select(F.col("site_index").cast("int").alias("site_index"), F.col(roles.group).alias("site"))
         .withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
         .withColumn("seq_len", F.explode(F.array(*[F.lit(int(n)) for n in seq_lengths])))
         .withColumn("drop_prod", F.explode(F.array(*[F.lit(bool(b)) for b in drop_options]))))
    return g.withColumn("name", run_name(F.col("model"), F.col("seq_len"), F.col("drop_prod")))
