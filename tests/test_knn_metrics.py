"""kNN against brute force; metrics against NumPy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.operators import metrics
from gridcast.operators.knn import knn_regress


def brute_knn(X, y, Q, k, p, weights, exclude_self):
    preds = []
    for i, q in enumerate(Q):
        d = np.abs(X - q).sum(1) if p == 1 else np.sqrt(((X - q) ** 2).sum(1))
        idx = [j for j in np.lexsort((np.arange(len(X)), d)) if not (exclude_self and j == i)][:k]
        dd, yy = d[idx], y[idx]
        if weights == "uniform":
            preds.append(yy.mean())
        elif (dd == 0).any():
            preds.append(yy[dd == 0].mean())
        else:
            preds.append((yy / dd).sum() / (1 / dd).sum())
    return np.array(preds)


@pytest.mark.parametrize("p,weights", [(2, "distance"), (1, "uniform"), (2, "uniform")])
def test_knn_matches_brute_force(spark, p, weights):
    rng = np.random.default_rng(p)
    X = rng.integers(0, 6, size=(120, 3)).astype(float)  # many ties and duplicates
    y = rng.random(120)
    rows = [(i, [float(v) for v in X[i]], float(y[i])) for i in range(len(X))]
    df = spark.createDataFrame(rows, "id long, v array<double>, y double")
    got = knn_regress(df, df, features="v", target="y", train_id="id", query_id="id", k=7, p=p,
                      weights=weights, exclude_self=True, n_pivots=6).toPandas().sort_values("id")
    exp = brute_knn(X, y, X, 7, p, weights, True)
    if weights == "uniform":
        # with tied distances any 7 nearest are valid; the chosen set follows (distance, id)
        assert np.allclose(got["prediction"].to_numpy(), exp, atol=1e-9)
    else:
        assert np.allclose(got["prediction"].to_numpy(), exp, atol=1e-9)
    assert (got["n_neighbors"] == 7).all()


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(0)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(hours=i % 50), f"g{i % 3}", float(a), float(b))
            for i, (a, b) in enumerate(zip(rng.random(150), rng.random(150)))]
    pdf_rows = np.array([(r[2], r[3]) for r in rows])
    pred = spark.createDataFrame(rows, "timestamp timestamp, group string, y_true double, y_pred double")
    g = metrics.global_metrics(pred).first()
    e = pdf_rows[:, 1] - pdf_rows[:, 0]
    assert abs(g["eval_mae"] - np.abs(e).mean()) < 1e-12
    assert abs(g["eval_rmse"] - np.sqrt((e ** 2).mean())) < 1e-12
    assert abs(g["eval_nrmse"] - np.sqrt((e ** 2).mean()) / pdf_rows[:, 0].mean()) < 1e-12
    res = metrics.evaluate(pred)
    assert res["n_groups"] == 3 and {r["group"] for r in res["per_site_metrics"].collect()} == {"g0", "g1", "g2"}
    gm = metrics.group_metrics(pred).toPandas()
    assert list(gm["mae"]) == sorted(gm["mae"])
    empty = pred.where("false")
    with pytest.raises(ValueError, match="no rows to evaluate"):
        metrics.evaluate(empty)


def test_zero_mean_gives_zero_nrmse(spark):
    t0 = dt.datetime(2024, 1, 1)
    pred = spark.createDataFrame([(t0, "g", 1.0, 0.5), (t0, "h", -1.0, 0.0)],
                                 "timestamp timestamp, group string, y_true double, y_pred double")
    assert metrics.global_metrics(pred).first()["eval_nrmse"] == 0.0
    assert metrics.portfolio_metrics(pred).first()["portfolio_nrmse_total"] == 0.0


def test_knn_ties_return_k_rows_per_query(spark):
    """Equal training vectors: the least ids win and k rows come back."""
    train = spark.range(10_000).select(F.col("id"), F.array(F.lit(1.0), F.lit(2.0)).alias("v"), F.col("id").cast("double").alias("y"))
    got = knn_regress(train, train.where("id < 50").withColumnRenamed("id", "q"), features="v", target="y", train_id="id",
                          query_id="q", k=5, weights="uniform").collect()
    assert len(got) == 50 and all(r["n_neighbors"] == 5 and r["prediction"] == 2.0 for r in got)


def test_knn_model_on_an_unwritten_frame(spark, tmp_path):
    """Predictions sit on their own rows although the frame is shuffled and not written; a saved model gives the same."""
    from gridcast.operators.models import ForecastModel, fit_model, predict

    base = spark.range(20_000).select(F.col("id"), (F.col("id") % 1000).cast("double").alias("x"))
    train = base.where("id < 1000").withColumn("y", F.col("x") * 2)
    query = base.repartition(7, F.xxhash64("id")).withColumn("z", F.rand(1)).where("z >= 0")
    m = fit_model(train, ["x"], "y", "knn", {"n_neighbors": 1, "weights": "uniform"})
    m.save(str(tmp_path / "m"))
    for model in (m, ForecastModel.load(str(tmp_path / "m"))):
        r = predict(model, query).agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("prediction") == F.col("x") * 2).cast("int")).alias("ok")).first()
        assert (r["n"], r["ok"]) == (20_000, 20_000)


def test_large_values_pass_finish_unchanged(spark):
    from gridcast.plans.queries import finish

    df = spark.createDataFrame([(1e11, 0.1234567891234)], "a double, b double")
    assert tuple(finish(df, frozenset({"a"})).first()) == (1e11, 0.1234567891234)


def _block(n, dims, seed, copies=1):
    import pyarrow as pa

    rng = np.random.default_rng(seed)
    V = np.repeat(rng.normal(size=(n // copies, dims)), copies, axis=0).astype(np.float32)
    ids = rng.permutation(n).astype(np.int64)
    rows = pa.table({"_tid": ids, "_v": pa.array(list(V), pa.list_(pa.float32())), "_y": ids / 7.0, "_seg": pa.array([-1] * n, pa.int32())})
    queries = pa.table({"_qid": ids, "_qv": rows["_v"], "_B": np.full(n, np.inf), "_lim": pa.array([0] * n, pa.int32())}).slice(0, 300)
    return V.astype(float), ids, rows, queries


@pytest.mark.parametrize("dims,copies,p,shift", [(64, 1, 2, 0.0), (64, 1000, 2, 0.0), (5, 1, 1, 0.0), (8, 4, 2, 1e6), (8, 1, 2, 1e200)])
def test_knn_block_measures_few_pairs_and_loses_none(monkeypatch, dims, copies, p, shift):
    """Most pairs of a block are ruled out by a matrix product, copies too; ids, ties and distances are those of the plain formula."""
    import pyarrow as pa

    from gridcast.operators import knn

    V, ids, rows, queries = _block(3000, dims, 3, copies)
    V = V + shift if shift < 1e100 else V * shift
    again = lambda t, c, v: t.set_column(t.schema.get_field_index(c), c, pa.array(list(v), pa.list_(pa.float64())))
    rows, queries = again(rows, "_v", V), again(queries, "_qv", V[:300])
    pairs = []
    plain = knn.measured
    monkeypatch.setattr(knn, "measured", lambda Q, T, p: pairs.append(len(Q)) or plain(Q, T, p))
    got = knn._block_topk(5, p, True)(queries, rows).to_pandas()
    with np.errstate(over="ignore"):
        for i in range(0, 300, 7):
            diff = V[i] - V
            d = np.abs(diff).sum(1) if p == 1 else np.sqrt((diff * diff).sum(1))
            best = [j for j in np.lexsort((ids, d)) if ids[j] != ids[i] and np.isfinite(d[j])][:6]
            mine = got[got["_qid"] == ids[i]]
            assert list(mine["_tid"]) == list(ids[best]) and list(mine["_d"]) == list(d[best])
    if shift < 1e100:  # what is too large for the product is measured whole
        assert sum(pairs) < 0.02 * 300 * 3000
