"""Tree ensembles as node tables against the models they were read from and against a plain fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.operators import trees
from gridcast.operators.models import ForecastModel, fit_model, predict


def rows(n, seed=0, gaps=True):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, size=(n, 3)).astype(float)
    y = x[:, 0] * (x[:, 1] > 5) - 3 * (x[:, 2] > 8) + rng.random(n)
    hole = rng.random((n, 3)) < (0.1 if gaps else 0)
    return [(i, *[None if h else float(v) for v, h in zip(a, b)], float(t)) for i, (a, b, t) in enumerate(zip(x, hole, y))]


SCHEMA = "id long, a double, b double, c double, y double"


@pytest.mark.parametrize("kind,params", [("random_forest", {"n_estimators": 12, "max_depth": 6}),
                                         ("xgboost", {"n_estimators": 8, "max_depth": 4, "learning_rate": 0.3, "subsample": 0.8})])
@pytest.mark.parametrize("bound", [0, 200_000])
def test_walk_equals_the_model(spark, tmp_path, monkeypatch, kind, params, bound):
    """Broadcast and shuffled levels, missing features and repeated rows."""
    monkeypatch.setattr(trees, "BROADCAST_NODES", bound)
    df = spark.createDataFrame(rows(300) + rows(40, seed=0), SCHEMA)
    model = fit_model(spark.createDataFrame(rows(300, gaps=False), SCHEMA), ["a", "b", "c"], "y", kind, params)
    model.save(str(tmp_path / "m"))
    table = trees.read_trees(spark, str(tmp_path / "m"))
    assert table.trees == params["n_estimators"] and sum(table.levels) == table.nodes.count() and len(table.levels) <= params["max_depth"] + 1
    got = sorted((r["id"], r["prediction"]) for r in table.predict(df).collect())
    want = sorted((r["id"], r["prediction"]) for r in predict(model, df).collect())
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([p for _, p in got], [p for _, p in want], rtol=0, atol=1e-9)
    assert table.predict(df.where("false")).count() == 0


def greedy(x, y, where, depth):
    """Depth-first variance splits over all midpoints; gives the prediction as a function."""
    mean, best = y[where].mean(), None
    if depth:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = where & (x[:, f] <= cut)
                right = where & (x[:, f] > cut)
                if left.any() and right.any():
                    gain = left.sum() * (y[left].mean() - mean) ** 2 + right.sum() * (y[right].mean() - mean) ** 2
                    if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, cut, left, right)
    if best is None:
        return lambda v: mean
    _, f, cut, left, right = best
    low, high = greedy(x, y, left, depth - 1), greedy(x, y, right, depth - 1)
    return lambda v: low(v) if v[f] <= cut else high(v)


@pytest.mark.parametrize("depth", [1, 4])
def test_one_tree_is_the_greedy_tree(spark, tmp_path, depth):
    data = rows(400, seed=3, gaps=False)
    df = spark.createDataFrame(data, SCHEMA)
    model = fit_model(df, ["a", "b", "c"], "y", "random_forest", {"n_estimators": 1, "max_depth": depth, "bootstrap": False})
    model.save(str(tmp_path / "m"))
    x, y = np.array([r[1:4] for r in data]), np.array([r[4] for r in data])
    plain = greedy(x, y, np.ones(len(y), bool), depth)
    got = {r["id"]: r["prediction"] for r in trees.read_trees(spark, str(tmp_path / "m")).predict(df).collect()}
    assert all(abs(got[i] - plain(v)) < 1e-9 for i, v in enumerate(x))


def test_only_tree_models_have_trees(spark, tmp_path):
    df = spark.createDataFrame(rows(30), SCHEMA)
    fit_model(df.select("id", F.coalesce("a", F.lit(0.0)).alias("a"), "y"), ["a"], "y", "knn", {"n_neighbors": 1}).save(str(tmp_path / "k"))
    assert ForecastModel.exists(str(tmp_path / "k"))
    with pytest.raises(ValueError, match="no trees"):
        trees.read_trees(spark, str(tmp_path / "k"))
