"""Forecasting models on Spark ML (M1, M2, M4, M5, S8) and the kNN model.

The reference's tree libraries map to ``spark.ml`` regressors:
random forest -> ``RandomForestRegressor``; both boosted-tree libraries ->
``GBTRegressor``; sequence networks are re-aimed as a regressor on flattened
windows (``LinearRegression`` or trees). Trees train distributed. Spark grows
trees to at most ``MAX_DEPTH`` levels: an unlimited depth means that many, and
a larger number is an error. :func:`effective_params` gives the parameters a fit
really uses, and an unsupported parameter is an error, never ignored.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.operators.knn import knn_regress
from gridcast.session import materialize

TABULAR_MODELS = ("random_forest", "xgboost", "lightgbm", "knn")
SEQUENCE_MODELS = ("lstm", "transformer")
TRAIN_ID = "_tid"
MAX_DEPTH = 30

# Fixed values that must equal the reference's: default parameters.
DEFAULT_PARAMS: dict[str, dict[str, Any]] = {
    "random_forest": {"n_estimators": 200, "random_state": 42, "max_depth": None},
    "xgboost": {"n_estimators": 200, "random_state": 42, "learning_rate": 0.05, "max_depth": 6},
    "lightgbm": {"n_estimators": 300, "random_state": 42, "learning_rate": 0.05, "num_leaves": 63},
    "knn": {"n_neighbors": 25, "weights": "distance"},
    "lstm": {"seq_len": 48},
    "transformer": {"seq_len": 48},
}


# Fixed values that must equal the reference's: main-path parameters that Spark's estimators have.
MAIN_PARAMS: dict[str, dict[str, Any]] = {
    "random_forest": {"n_estimators": 200, "random_state": 42, "max_depth": None, "min_samples_leaf": 1,
                      "max_features": 1.0, "bootstrap": True},
    "xgboost": {"n_estimators": 200, "random_state": 42, "learning_rate": 0.05, "max_depth": 6, "subsample": 0.8,
                "colsample_bytree": 0.8},
    "lightgbm": {"n_estimators": 200, "random_state": 42, "learning_rate": 0.05, "num_leaves": 63, "max_depth": -1,
                 "min_child_samples": 20, "subsample": 0.8, "colsample_bytree": 0.8},
    "knn": {"n_neighbors": 25, "weights": "distance", "p": 2},
    "lstm": {"seq_len": 168, "weight_decay": 0.0},
    "transformer": {"seq_len": 8, "weight_decay": 0.0},
}

SUPPORTED_PARAMS: dict[str, frozenset[str]] = {
    "random_forest": frozenset({"n_estimators", "max_depth", "min_samples_leaf", "max_features", "bootstrap",
                                "random_state", "seed"}),
    "xgboost": frozenset({"n_estimators", "learning_rate", "max_depth", "subsample", "colsample_bytree",
                          "min_child_samples", "random_state", "seed"}),
    "knn": frozenset({"n_neighbors", "weights", "p"}),
    "linear": frozenset({"weight_decay", "seq_len", "random_state", "seed"}),
}
SUPPORTED_PARAMS["boosted"] = SUPPORTED_PARAMS["xgboost"]
SUPPORTED_PARAMS["lightgbm"] = SUPPORTED_PARAMS["xgboost"] | {"num_leaves"}
for _name in SEQUENCE_MODELS:
    SUPPORTED_PARAMS[_name] = SUPPORTED_PARAMS["linear"]


def _depth(v) -> int:
    if v is None or (isinstance(v, (int, float)) and v < 0):
        return MAX_DEPTH
    if int(v) > MAX_DEPTH:
        raise ValueError(f"max_depth {v} exceeds the {MAX_DEPTH} levels that Spark trees can have")
    return max(1, int(v))


def effective_params(model_type: str, params: dict[str, Any]) -> dict[str, Any]:
    """The parameters as a fit uses them: unlimited depths as numbers. Raises
    on names that the model does not support."""
    if model_type not in SUPPORTED_PARAMS:
        raise ValueError(f"unknown model {model_type!r}")
    unknown = sorted(set(params) - SUPPORTED_PARAMS[model_type])
    if unknown:
        raise ValueError(f"{model_type} has no parameters {unknown}; supported: {sorted(SUPPORTED_PARAMS[model_type])}")
    out = dict(params)
    if model_type in ("random_forest", "xgboost", "boosted"):
        out["max_depth"] = _depth(params.get("max_depth", 6 if model_type != "random_forest" else None))
    elif model_type == "lightgbm":
        depth = params.get("max_depth")
        if params.get("num_leaves") and (depth is None or depth < 0):
            depth = max(1, int(params["num_leaves"]).bit_length() - 1)
        out["max_depth"] = _depth(depth)
    return out


def session() -> SparkSession:
    """The session, also from a thread that has none active."""
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def _subset(frac) -> str:
    if frac is None or float(frac) >= 1.0:
        return "all"
    return str(float(frac))


def build_regressor(model_type: str, params: dict[str, Any], label: str = "label",
                    features: str = "features"):
    """A ``spark.ml`` estimator for a reference model name and parameters."""
    params = effective_params(model_type, params)
    seed = int(params.get("random_state", params.get("seed", 42)))
    common = dict(featuresCol=features, labelCol=label, predictionCol="prediction")
    if model_type == "random_forest":
        return RandomForestRegressor(
            numTrees=int(params.get("n_estimators", 100)), maxDepth=params["max_depth"],
            minInstancesPerNode=int(params.get("min_samples_leaf", 1)),
            featureSubsetStrategy=_subset(params.get("max_features", 1.0)),
            bootstrap=bool(params.get("bootstrap", True)), seed=seed, **common)
    if model_type in ("xgboost", "lightgbm", "boosted"):
        return GBTRegressor(
            maxIter=int(params.get("n_estimators", 100)), stepSize=float(params.get("learning_rate", 0.1)),
            maxDepth=params["max_depth"], subsamplingRate=float(params.get("subsample", 1.0)),
            featureSubsetStrategy=_subset(params.get("colsample_bytree", 1.0)),
            minInstancesPerNode=int(params.get("min_child_samples", 1)), seed=seed, **common)
    if model_type in ("linear",) + SEQUENCE_MODELS:
        return LinearRegression(regParam=float(params.get("weight_decay", 0.0)), standardization=False, **common)
    raise ValueError(f"unknown model {model_type!r}")


@dataclass
class KNNModel:
    """Fitted kNN regressor: the training rows, written once with their ids,
    are the model."""

    train: DataFrame
    features: list[str]
    target: str
    params: dict[str, Any] = field(default_factory=dict)

    def transform(self, df: DataFrame, id_col: str = "_row") -> DataFrame:
        # the ids are written before their two uses: an id that is evaluated twice
        # on an unwritten frame need not be the same both times
        q = materialize(df.withColumn(id_col, F.monotonically_increasing_id())) if id_col not in df.columns else df
        pred = knn_regress(self.train, q, features=self.features, target=self.target, train_id=TRAIN_ID,
                           query_id=id_col, k=int(self.params.get("n_neighbors", 25)),
                           p=int(self.params.get("p", 2)), weights=self.params.get("weights", "uniform"))
        return q.join(pred.select(id_col, "prediction"), id_col, "left").drop(id_col)


@dataclass
class ForecastModel:
    """A fitted model plus its feature columns."""

    model_type: str
    features: list[str]
    target: str
    model: Any

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)

    def save(self, path: str, **more: Any) -> None:
        """Write a new version of the model under ``path``: first the model, then
        its description with ``more``, whose success marker publishes the version. A
        write that breaks off leaves the version before it the one that readers get."""
        meta = {"model_type": self.model_type, "features": self.features, "target": self.target} | more
        at = f"{path.rstrip('/')}/v{max((n for n, _ in versions(path)), default=0) + 1}"
        if isinstance(self.model, KNNModel):  # the training table
            self.model.train.write.parquet(at + "/model")
            meta["params"] = self.model.params
        else:
            self.model.write().save(at + "/model")
        session().createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.text(at + "/meta")

    @staticmethod
    def exists(path: str) -> bool:
        return any(done for _, done in versions(path))

    @staticmethod
    def meta(path: str) -> dict[str, Any]:
        """Description of the last published version, with its folder as ``at``."""
        done = [n for n, done in versions(path) if done]
        if not done:
            raise ValueError(f"there is no saved model at {path!r}")
        at = f"{path.rstrip('/')}/v{max(done)}"
        return json.loads(session().read.text(at + "/meta").first()[0]) | {"at": at}

    @staticmethod
    def load(path: str) -> ForecastModel:
        meta = ForecastModel.meta(path)
        at = meta["at"] + "/model"
        if meta["model_type"] == "knn":
            model: Any = KNNModel(session().read.parquet(at), meta["features"], meta["target"], meta["params"])
        else:
            model = PipelineModel.load(at)
        return ForecastModel(meta["model_type"], meta["features"], meta["target"], model)


def versions(path: str) -> list[tuple[int, bool]]:
    """The versions begun under ``path`` and whether each was published."""
    s = session()
    root = s.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = root.getFileSystem(s.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(root)]
    return [(int(n[1:]), path_exists(s, f"{path.rstrip('/')}/{n}/meta/_SUCCESS")) for n in names if n[:1] == "v" and n[1:].isdigit()]


def fit_model(df: DataFrame, features: Sequence[str], target: str, model_type: str,
              params: dict[str, Any] | None = None) -> ForecastModel:
    """Fit one model on ``df`` (M1/M2/M3/M4)."""
    params = dict(DEFAULT_PARAMS.get(model_type, {}) if params is None else params)
    feats = list(features)
    if not feats:
        raise ValueError("there is no feature column to train on")
    if model_type == "knn":
        params = effective_params(model_type, params)
        rows = materialize(df.select(*feats, target).withColumn(TRAIN_ID, F.monotonically_increasing_id()))
        return ForecastModel(model_type, feats, target, KNNModel(rows, feats, target, params))
    from pyspark.ml.linalg import VectorUDT

    has_vec = any(isinstance(df.schema[c].dataType, VectorUDT) for c in feats)
    # vector inputs carry no size metadata, so they cannot use "keep"
    assembler = VectorAssembler(inputCols=feats, outputCol="features",
                                handleInvalid="error" if has_vec else "keep")
    est = build_regressor(model_type, params, label="label")
    pipe = Pipeline(stages=[assembler, est])
    fitted = pipe.fit(df.withColumn("label", F.col(target).cast("double")))
    return ForecastModel(model_type, feats, target, fitted)


def predict(model: ForecastModel, df: DataFrame) -> DataFrame:
    """Batch prediction (M5): ``df`` plus ``prediction``."""
    out = model.transform(df)
    return out.drop("features") if "features" in out.columns else out


def save_json(spark, obj: Any, path: str) -> None:
    """JSON sink (S6): one JSON document written through Spark."""
    spark.createDataFrame([(json.dumps(obj, default=str),)], "value string").coalesce(1).write.mode(
        "overwrite").text(path)


def load_json(spark, path: str) -> Any:
    """JSON source (S7): read back a document written by :func:`save_json`."""
    rows = spark.read.text(path).collect()
    return json.loads("".join(r[0] for r in rows)) if rows else None


def path_exists(spark, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
