"""Dataset splits: time fraction (X1), hold-out group (X3, J3), expanding
time folds (X2, J2, A11) and the sequence validation tail (X4).

Thresholds are scalars from one-row aggregates; rows are then assigned by
comparisons on the time column, which Spark pushes into the scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.operators.chunks import positions
from gridcast.roles import DEFAULT_ROLES, Roles

_EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)


def _ts(us: int) -> _dt.datetime:
    return _EPOCH + _dt.timedelta(microseconds=int(us))


def _lit_ts(us: int):
    return F.timestamp_micros(F.lit(int(us)))


def time_threshold(df: DataFrame, fraction: float, time: str) -> int:
    """``t_min + (t_max - t_min) * fraction`` in epoch microseconds."""
    t = F.unix_micros(F.col(time))
    r = df.agg(F.min(t).alias("lo"), F.max(t).alias("hi")).first()
    if r is None or r["lo"] is None:
        raise ValueError("Cannot split an empty frame")
    return int(r["lo"] + int((r["hi"] - r["lo"]) * float(fraction)))


def split_time(df: DataFrame, train_fraction: float, roles: Roles = DEFAULT_ROLES) -> tuple[DataFrame, DataFrame]:
    """Rows before the threshold train, the rest test."""
    thr = time_threshold(df, train_fraction, roles.time)
    return (df.where(F.col(roles.time) < _lit_ts(thr)), df.where(F.col(roles.time) >= _lit_ts(thr)))


def with_split_role(df: DataFrame, train_fraction: float, roles: Roles = DEFAULT_ROLES,
                    col: str = "role") -> DataFrame:
    thr = time_threshold(df, train_fraction, roles.time)
    return df.withColumn(col, F.when(F.col(roles.time) < _lit_ts(thr), F.lit("train")).otherwise(F.lit("test")))


def holdout_split(df: DataFrame, test_size: float, index: int, roles: Roles = DEFAULT_ROLES,
                  ) -> tuple[DataFrame, DataFrame]:
    """Train on the other groups before the threshold; test on the group at
    ``index`` (sorted order) from the threshold on."""
    from gridcast.operators.panel import group_at

    test_group = group_at(df, index, roles)
    thr = time_threshold(df, 1 - test_size, roles.time)
    g, t = F.col(roles.group), F.col(roles.time)
    train = df.where((t < _lit_ts(thr)) & g.isNotNull() & (g != F.lit(test_group)))
    test = df.where((t >= _lit_ts(thr)) & (g == F.lit(test_group)))
    return train, test


def fold_bounds(df: DataFrame, n_splits: int, time: str) -> list[tuple[int, int, int]]:
    """Expanding-window folds over the sorted distinct times.

    With ``N`` distinct times and ``s = N // (k + 1)``, fold ``i`` validates
    on positions ``[N - (k - i) s, N - (k - i - 1) s)`` and trains on all
    earlier ones. Returns ``(fold, val_start_us, val_end_us)`` with an open
    end for the last fold; only the ``k + 1`` boundary times reach the
    driver, found by rank on a range-partitioned sort.
    """
    t = df.select(F.unix_micros(F.col(time)).alias("_t")).where(F.col("_t").isNotNull()).distinct()
    n = t.count()
    k = int(n_splits)
    if n < k + 1:
        raise ValueError(f"{k} expanding folds need at least {k + 1} distinct times, found {n}")
    s = n // (k + 1)
    starts = [n - (k - i) * s for i in range(k)]
    ranked = positions(t.withColumn("_all", F.lit(0)), "_all", ["_t"], "_r")
    at = {r["_r"]: r["_t"] for r in ranked.where(F.col("_r").isin(starts)).select("_r", "_t").collect()}
    out = []
    for i, st in enumerate(starts):
        end = at[starts[i + 1]] if i + 1 < k else None
        out.append((i, at[st], end))
    return out


def with_fold(df: DataFrame, bounds: list[tuple[int, int, int]], time: str, col: str = "fold") -> DataFrame:
    """Tag each row with the fold whose validation range holds it (NULL for
    rows before the first validation range)."""
    t = F.unix_micros(F.col(time))
    e = F.lit(None).cast("int")
    for i, lo, hi in reversed(bounds):
        cond = (t >= F.lit(lo)) if hi is None else ((t >= F.lit(lo)) & (t < F.lit(hi)))
        e = F.when(cond, F.lit(i)).otherwise(e)
    return df.withColumn(col, e)


def time_folds(df: DataFrame, n_splits: int, roles: Roles = DEFAULT_ROLES) -> list[tuple[DataFrame, DataFrame]]:
    """``(train, validation)`` frames per fold: time bounds, not ``isin``."""
    bounds = fold_bounds(df, n_splits, roles.time)
    t = F.col(roles.time)
    out = []
    for _, lo, hi in bounds:
        train = df.where(t < _lit_ts(lo))
        val = df.where((t >= _lit_ts(lo)) & ((t < _lit_ts(hi)) if hi is not None else F.lit(True)))
        out.append((train, val))
    return out


def fold_summary(df: DataFrame, n_splits: int, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Rows and time range per (fold, role) without copying rows per fold:
    rows are tagged with their validation fold, aggregated once, and the
    expanding train parts are prefix sums over the small fold table."""
    from pyspark.sql import Window

    bounds = fold_bounds(df, n_splits, roles.time)
    k = len(bounds)
    tagged = with_fold(df, bounds, roles.time).withColumn(
        "_f", F.coalesce(F.col("fold"), F.lit(-1)))
    per = tagged.groupBy("_f").agg(F.count(F.lit(1)).alias("rows"), F.min(roles.time).alias("t_min"),
                                   F.max(roles.time).alias("t_max"))
    val = per.where(F.col("_f") >= 0).select(F.col("_f").alias("fold"), F.lit("validation").alias("role"),
                                             "rows", "t_min", "t_max")
    w = Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, 0)
    cum = per.select(F.col("_f"), F.sum("rows").over(w).alias("rows"), F.min("t_min").over(w).alias("t_min"),
                     F.max("t_max").over(w).alias("t_max"))
    train = (cum.where(F.col("_f") < k - 1)
             .select((F.col("_f") + 1).cast("int").alias("fold"), F.lit("train").alias("role"),
                     "rows", "t_min", "t_max"))
    return val.unionByName(train)


def sequence_holdout(seqs: DataFrame, roles: Roles = DEFAULT_ROLES, *, val_fraction: float = 0.2,
                     no_cv: bool = False, min_sequences: int = 20, col: str = "is_val") -> DataFrame:
    """Mark the last ``max(1, int(clamp(f, .05, .5) * n))`` sequences in
    (group, time) order as validation; none when ``no_cv`` or ``n < 20``."""
    frac = min(max(float(val_fraction), 0.05), 0.5)
    # only the keys are sorted and counted; the boundary is one key
    keys = positions(seqs.select(F.lit(0).alias("_all"), roles.group, roles.time), "_all", [roles.group, roles.time], "_r")
    n = keys.count()
    if no_cv or n < min_sequences:
        return seqs.withColumn(col, F.lit(False))
    first = n - max(1, int(frac * n))
    at = keys.where(F.col("_r") == first).select(roles.group, F.unix_micros(roles.time).alias("t")).first()
    g, t = F.col(roles.group), F.unix_micros(F.col(roles.time))
    return seqs.withColumn(col, (g > F.lit(at[0])) | ((g == F.lit(at[0])) & (t >= F.lit(at["t"]))))
