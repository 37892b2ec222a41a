"""Exact k-nearest-neighbour regression (J7, M3, O3) without a cross join.

Training rows are split into Voronoi cells around a few pivot rows (a
deterministic hash sample; pivots, cell sizes and cell radii are ``P``
numbers each, so their size is bounded by ``P``). For a query ``q`` the
triangle inequality gives

* an upper bound ``B`` on its k-th neighbour distance: walk the cells by
  distance to their pivot until they hold ``k`` rows; every row of a walked
  cell ``c`` lies within ``d(q, pivot_c) + radius_c``;
* a lower bound ``d(q, pivot_c) - radius_c`` for any row of cell ``c``.

Only cells whose lower bound is at most ``B`` are visited by ``q`` (rows are
co-grouped on the cell id), so the answer is exact while far cells are never
paired. Within a visited cell, blocks of rows meet blocks of queries in NumPy:
a matrix product gives all their distances up to a known rounding error, and only
the pairs that can be among a query's k nearest of the block are measured by the
plain formula and returned. Where pruning finds nothing (many evenly spread
dimensions) the pairs stay quadratic, at about the cost of the product.
Neighbours are ranked by ``(distance, id)``; prediction follows the
usual rules: uniform mean, or ``1/d`` weights where a zero distance makes
only the zero-distance neighbours count.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

BLOCK_ROWS = 32_768  # most rows and queries of a block
BLOCK_VALUES = 2**21  # most vector components of a block's rows


def _vec(df: DataFrame, features: str | Sequence[str]) -> Column:
    if isinstance(features, str):
        if isinstance(df.schema[features].dataType.elementType, FloatType):
            return F.col(features)  # travels as it is, half as wide
        return F.transform(F.col(features), lambda x: x.cast("double"))
    return F.array(*[F.col(c).cast("double") for c in features])


def distance(a: Column, b: Column, p: int = 2) -> Column:
    """Minkowski distance for p in {1, 2} on equal-length double arrays."""
    if p == 1:
        terms = F.zip_with(a, b, lambda x, y: F.abs(x - y))
        return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    if p == 2:
        terms = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
        return F.sqrt(F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x))
    raise ValueError("p must be 1 or 2")


def weighted_mean(n: Column, y: Column, zeros: Column, zero_y: Column, inverse: Column, inverse_y: Column, weights: str) -> Column:
    """Prediction from sums over the neighbours: their number and targets, those at
    distance 0, and 1/d and y/d of the others."""
    if weights == "uniform":
        return y / n
    if weights == "distance":
        return F.when(zeros > 0, F.try_divide(zero_y, zeros)).otherwise(F.try_divide(inverse_y, inverse))
    raise ValueError(f"unknown weights {weights!r}")


def neighbour_sums(agg) -> dict[str, Column]:
    """The sums of :func:`weighted_mean`; ``agg`` makes an aggregate of a column."""
    zero = F.col("_d") == 0
    return {"n": agg(F.lit(1)), "y": agg(F.col("_y")), "zeros": agg(F.when(zero, 1).otherwise(0)),
            "zero_y": agg(F.when(zero, F.col("_y")).otherwise(0.0)),
            "inverse": agg(F.when(zero, 0.0).otherwise(F.try_divide(F.lit(1.0), F.col("_d")))),
            "inverse_y": agg(F.when(zero, 0.0).otherwise(F.try_divide(F.col("_y"), F.col("_d"))))}


def knn_regress(train: DataFrame, query: DataFrame, *, features: str | Sequence[str], target: str,
                train_id: str, query_id: str, k: int = 25, p: int = 2, weights: str = "distance",
                exclude_self: bool = False, keep: Sequence[str] = (), **how) -> DataFrame:
    """Predict ``target`` for every query row from its ``k`` nearest training
    rows. Returns ``(query_id, *keep, prediction, n_neighbors)``; ``how`` goes to
    :func:`knn_neighbors`."""
    top = knn_neighbors(train, query, features=features, target=target, train_id=train_id, query_id=query_id, k=k, p=p,
                        exclude_self=exclude_self, **how)
    pred = weighted_mean(weights=weights, **neighbour_sums(F.sum))
    out = top.groupBy("_qid").agg(pred.alias("prediction"), F.count(F.lit(1)).alias("n_neighbors"))
    if keep:
        out = query.select(F.col(query_id).alias("_qid"), *keep).join(out, "_qid", "left")
    return out.withColumnRenamed("_qid", query_id)


def knn_neighbors(train: DataFrame, query: DataFrame, *, features: str | Sequence[str], target: str, train_id: str, query_id: str,
                  k: int = 25, p: int = 2, exclude_self: bool = False, n_pivots: int = 16, seed: int = 42, block_rows: int | None = None,
                  segment: str | None = None) -> DataFrame:
    """The ``k`` nearest training rows of every query row: ``_qid, _tid, _d, _y``
    and the rank ``_rn`` from 1, ties by id.

    ``exclude_self`` skips the training row whose id equals the query id
    (leave-one-out when both sides are the same table). ``segment`` names an integer
    column of both sides (few values, from -1 on); a query then only sees training rows of
    smaller segments, so the expanding folds of one table are one join.
    """
    need = k + (1 if exclude_self else 0)
    seg = F.col(segment).cast("int") if segment else F.lit(-1)
    lim = F.col(segment).cast("int") if segment else F.lit(0)
    t = train.select(F.col(train_id).alias("_tid"), _vec(train, features).alias("_v"),
                     F.col(target).cast("double").alias("_y"), seg.alias("_seg"))
    pivots = [r["_v"] for r in t.orderBy(F.xxhash64("_tid", F.lit(seed)), "_tid").limit(n_pivots).collect()]
    if not pivots:
        raise ValueError("knn_regress needs training rows")
    P = len(pivots)
    block_rows = block_rows or min(BLOCK_ROWS, max(256, BLOCK_VALUES // max(1, len(pivots[0]))))
    piv = [F.array(*[F.lit(float(x)) for x in v]) for v in pivots]

    def pivot_dists(v: Column) -> Column:
        v = F.transform(v, lambda x: x.cast("double"))
        return F.array(*[distance(v, pv, p) for pv in piv])

    t = (t.withColumn("_pd", pivot_dists(F.col("_v")))
         .withColumn("_r", F.array_min("_pd"))
         .withColumn("_cell", (F.array_position("_pd", F.col("_r")) - 1).cast("int"))
         .drop("_pd"))
    found = t.groupBy("_cell", "_seg").agg(F.count(F.lit(1)).alias("n"), F.max("_r").alias("rad")).collect()  # cells x segments
    last = max(0, *(r["_seg"] + 1 for r in found))
    # per limit and cell: the number and the radius of the rows that a query with this limit sees
    seen = [[[r for r in found if r["_cell"] == j and r["_seg"] < f] for j in range(P)] for f in range(last + 1)]
    by_limit = lambda pick: F.element_at(F.array(*[F.array(*[F.lit(pick(c)) for c in cells]) for cells in seen]),
                                         F.least(F.col("_lim"), F.lit(last)) + 1)
    rows = [sum(r["n"] for r in found if r["_cell"] == j) for j in range(P)]

    q = query.select(F.col(query_id).alias("_qid"), _vec(query, features).alias("_qv"), lim.alias("_lim"))
    q = q.withColumns({"_cnt": by_limit(lambda c: int(sum(r["n"] for r in c))),
                       "_rad": by_limit(lambda c: float(max((r["rad"] for r in c), default=0.0)))})
    cnt, rad = F.col("_cnt"), F.col("_rad")
    q = q.withColumn("_qd", pivot_dists(F.col("_qv")))
    order = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(P - 1)),
                                     lambda j: F.struct(F.element_at("_qd", j + 1).alias("d"), j.alias("c"))))
    init = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("b"))
    walk = F.aggregate(order, init, lambda acc, x: F.when(acc["n"] >= need, acc).otherwise(F.struct(
        (acc["n"] + F.element_at(cnt, x["c"] + 1)).cast("long").alias("n"),
        F.greatest(acc["b"], x["d"] + F.element_at(rad, x["c"] + 1)).alias("b"))))
    # small slack so rounding in the bound arithmetic never drops a true neighbour
    q = q.withColumn("_B", walk["b"] * F.lit(1 + 1e-9) + F.lit(1e-12))
    cand = F.filter(F.sequence(F.lit(0), F.lit(P - 1)), lambda j: (F.element_at(cnt, j + 1) > 0) & (
        F.element_at("_qd", j + 1) - F.element_at(rad, j + 1) <= F.col("_B")))
    # Large cells are split into sub-blocks of at most ``block_rows`` training
    # rows and query batches of at most ``block_rows`` queries, so no group of
    # the co-grouping grows with the data (a hot cell never lands in one task).
    nblk = [max(1, -(-n // block_rows)) for n in rows]
    nblk_arr = F.array(*[F.lit(b) for b in nblk])
    tb = t.withColumn("_blk", F.pmod(F.xxhash64("_tid"), F.element_at(nblk_arr, F.col("_cell") + 1)).cast("int"))
    qc = q.withColumn("_cell", F.explode(cand)).drop("_qd", "_cnt", "_rad")
    # the queries visiting one cell are split the same way (P counts)
    visits = {r["_cell"]: r["n"] for r in qc.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    nq = [max(1, -(-int(visits.get(j, 0)) // block_rows)) for j in range(P)]
    nq_arr = F.array(*[F.lit(b) for b in nq])
    qc = (qc.withColumn("_qb", F.pmod(F.xxhash64("_qid"), F.element_at(nq_arr, F.col("_cell") + 1)).cast("int"))
          .withColumn("_blk", F.explode(F.sequence(F.lit(0), F.element_at(nblk_arr, F.col("_cell") + 1) - 1))))
    tb = tb.withColumn("_qb", F.explode(F.sequence(F.lit(0), F.element_at(nq_arr, F.col("_cell") + 1) - 1)))
    keys = ["_cell", "_blk", "_qb"]
    # a stated number of partitions: merged by their bytes, few tasks would get most of the pairs
    parts = min(2000, 2 * sum(a * b for a, b in zip(nblk, nq, strict=True)))
    pairs = (qc.select(*keys, "_qid", "_qv", "_B", "_lim").repartition(parts, *keys).groupBy(*keys)
             .cogroup(tb.select(*keys, "_tid", "_v", "_y", "_seg").repartition(parts, *keys).groupBy(*keys))
             .applyInArrow(_block_topk(k, p, exclude_self), "_qid long, _tid long, _d double, _y double"))
    w = Window.partitionBy("_qid").orderBy("_d", "_tid")
    return pairs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(vectors).to_numpy().astype(np.float64).reshape(len(vectors), -1)


def _ids(ids: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(ids, np.iinfo(np.int64).min).to_numpy()


def measured(Q: np.ndarray, T: np.ndarray, p: int, pairs: int = 65_536) -> np.ndarray:
    """Distances of the rows of ``Q`` to those of ``T``, pair by pair."""
    out = np.empty(len(Q))
    for s in range(0, len(Q), pairs):
        diff = Q[s:s + pairs] - T[s:s + pairs]
        out[s:s + pairs] = np.abs(diff).sum(-1) if p == 1 else np.sqrt((diff * diff).sum(-1))
    return out


def first_copies(T: np.ndarray, seg: np.ndarray, least: int) -> np.ndarray:
    """Places of the first ``least`` rows of every vector and segment: of equal rows, the others never rank."""
    whole = np.ascontiguousarray(np.column_stack((T, seg.astype(np.float64))))
    _, group, size = np.unique(whole.view(np.dtype((np.void, whole.itemsize * whole.shape[1]))).ravel(),
                               return_inverse=True, return_counts=True)
    if size.max(initial=0) <= least:
        return np.arange(len(T))
    order = np.argsort(group, kind="stable")
    place = np.empty(len(T), np.int64)
    place[order] = np.arange(len(T)) - np.repeat(np.cumsum(size) - size, size)
    return np.flatnonzero(place < least)


def screened(Q: np.ndarray, T: np.ndarray, p: int, work: int = 2**20):
    """Batches of queries: their slice, a number per training row that ascends with the distance,
    the numbers of given distances, and how far rounding may have moved any two numbers apart.

    Single precision serves where the rows' spread is not small beside their size; the
    rounding allowed for follows the precision, so it decides how many pairs are measured and nothing else."""
    norm = (lambda V: np.abs(V).sum(1)) if p == 1 else (lambda V: (V * V).sum(1))
    with np.errstate(over="ignore", invalid="ignore"):
        qn, tn = norm(Q), norm(T)
        size = qn.max() + tn.max()
        kind = np.float32 if p == 2 and 1e-12 < size < 1e30 and norm(T - T.mean(0)).mean() > size / 100 else np.float64
        slack = 16 * (Q.shape[1] + 8) * (np.finfo(kind).eps * (qn + tn.max()) + np.finfo(kind).tiny)
        wild = ~np.isfinite(slack)  # too large to screen: all are measured
        slack[wild] = 0.0
        T2 = np.ascontiguousarray(np.column_stack((-2 * T, tn)).T, dtype=kind)
        Q2 = np.column_stack((Q, np.ones(len(Q)))).astype(kind)
    step = max(1, work // len(T))
    room = np.empty((step, len(T)), kind)
    for s in range(0, len(Q), step):
        at = slice(s, min(s + step, len(Q)))
        A = room[:at.stop - s]
        with np.errstate(over="ignore", invalid="ignore"):
            if p == 1:
                A[:] = 0.0
                for j in range(Q.shape[1]):
                    A += np.abs(Q[at, j, None] - T[None, :, j])
            else:
                np.matmul(Q2[at], T2, out=A)
        A[wild[at]] = 0.0
        yield at, A, (lambda d, at=at: d if p == 1 else np.where(wild[at], np.inf, d * d - qn[at])), slack[at]


def kth_bound(A: np.ndarray, k: int) -> np.ndarray:
    """An upper bound, close, on the k-th smallest number of every row: that of the minima of strips."""
    strips = max(8 * k, 256)
    if A.shape[1] >= 2 * strips:
        each = A.shape[1] // strips
        A = A[:, :each * strips].reshape(len(A), each, strips).min(axis=1)
    return np.partition(A, k - 1, axis=1)[:, k - 1]


def _block_topk(k: int, p: int, exclude_self: bool):
    """Per block of rows and block of queries: every query's first ``k`` rows in
    ``(distance, id)`` order, the order of the final ranking in Spark; a
    block returns at most ``k`` rows per query however many are tied."""
    def fn(qp: pa.Table, tp: pa.Table) -> pa.Table:
        found = []
        if qp.num_rows and tp.num_rows:
            need = k + (1 if exclude_self else 0)
            tid = _ids(tp["_tid"])
            order = np.argsort(tid, kind="stable")
            tid, T, seg = tid[order], _matrix(tp["_v"])[order], tp["_seg"].to_numpy()[order]
            same_id = int(np.unique(tid, return_counts=True)[1].max()) if exclude_self else 0
            use = np.flatnonzero(np.isfinite(T).all(1))
            use = use[first_copies(T[use], seg[use], need + same_id)]
            order, tid, T, seg = order[use], tid[use], T[use], seg[use]
            Q, qid, lim, bound = _matrix(qp["_qv"]), _ids(qp["_qid"]), qp["_lim"].to_numpy(), qp["_B"].to_numpy()
            ok = np.isfinite(Q).all(1)
            Q, qid, lim, bound = Q[ok], qid[ok], lim[ok], bound[ok]
            if len(Q) and len(T):
                y = tp["_y"].to_numpy()[order]
                hides = seg.max() >= lim.min()
                for at, A, as_screened, slack in screened(Q, T, p):
                    if hides:
                        A[seg[None, :] >= lim[at, None]] = np.inf
                    if exclude_self:
                        first, end = np.searchsorted(tid, qid[at]), np.searchsorted(tid, qid[at], side="right")
                        for i in np.flatnonzero(end > first):
                            A[i, first[i]:end[i]] = np.inf
                    with np.errstate(over="ignore", invalid="ignore"):
                        cut = np.minimum(kth_bound(A, min(need, len(T))), as_screened(bound[at])) + slack
                        cut = np.nextafter(cut.astype(A.dtype), A.dtype.type(np.inf))
                    cut = np.minimum(cut, np.finfo(A.dtype).max)  # what is hidden never passes
                    qi, ti = np.divmod(np.flatnonzero(A <= cut[:, None]), len(T))
                    d = measured(Q[at][qi], T[ti], p)
                    rank = np.lexsort((ti, d, qi))
                    qi, ti, d = qi[rank], ti[rank], d[rank]
                    keep = np.arange(len(qi)) - np.searchsorted(qi, qi) < need
                    keep &= (d <= bound[at][qi]) & np.isfinite(d)
                    found.append((qid[at][qi[keep]], tid[ti[keep]], d[keep], y[ti[keep]]))
        parts = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0)] * 4
        types = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table([pa.array(c, t, from_pandas=True) for c, t in zip(parts, types, strict=True)],
                        names=["_qid", "_tid", "_d", "_y"])

    return fn
