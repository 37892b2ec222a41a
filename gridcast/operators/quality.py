"""Sampling interval (A2) and plateau flags."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gridcast.operators.chunks import (CHUNK_COL, OWN_COL, POS_COL, chunk_size,
                                       group_median_weighted, halo_explode, join_groups, map_chunks, positions, run_starts,
                                       set_apart, spread)
from gridcast.roles import DEFAULT_ROLES, Roles
from gridcast.session import materialize

FLAG = "is_not_plateau"
NARROW = 16  # positions of a frame that is compared row by row
DEFAULT_INTERVAL_S = 3600.0  # fall back to one hour


def _parse_seconds(window: str | float | int) -> float:
    if isinstance(window, (int, float)):
        return float(window)
    w = window.strip().lower()
    units = {"d": 86400.0, "h": 3600.0, "min": 60.0, "m": 60.0, "s": 1.0}
    for u in ("min", "d", "h", "m", "s"):
        if w.endswith(u):
            return float(w[: -len(u)]) * units[u]
    return float(w)


def _with_positions(df: DataFrame, roles: Roles) -> DataFrame:
    if POS_COL in df.columns:
        return df
    keyed = df.where(F.col(roles.group).isNotNull() & F.col(roles.time).isNotNull())
    return positions(keyed, roles.group, [roles.time])


def sampling_interval(df: DataFrame, roles: Roles = DEFAULT_ROLES, *also: Column) -> DataFrame:
    """Per group: median of consecutive time differences in seconds;
    NULL or non-positive becomes one hour. Returns ``(group, interval_s)`` and
    the aggregates ``also`` of the rows with their positions."""
    whole = df
    p = _with_positions(df.select(roles.group, roles.time, *([POS_COL] if POS_COL in df.columns else [])), roles)
    size = chunk_size(1, 0, 4096)
    h = spread(halo_explode(p, F.col(POS_COL), size, before=1, after=0), roles.group)
    w = Window.partitionBy(roles.group, CHUNK_COL).orderBy(POS_COL)
    t = F.unix_micros(F.col(roles.time))
    diffs = (h.withColumn("_dt", (t - F.lag(t).over(w)) / F.lit(1e6))
             .where(F.col(OWN_COL) & F.col("_dt").isNotNull())
             .select(roles.group, "_dt"))
    # time steps repeat: rank the distinct steps with their counts
    med = group_median_weighted(diffs, roles.group, "_dt", "_med")
    groups = whole.groupBy(roles.group).agg(*also) if also else p.select(roles.group).distinct()
    return (groups.join(med, roles.group, "left")
            .select(*groups.columns, F.when(F.col("_med") > 0, F.col("_med"))
                    .otherwise(F.lit(DEFAULT_INTERVAL_S)).alias("interval_s")))


def band_counts(pos: np.ndarray, value: np.ndarray, reach: np.ndarray, tolerance: float) -> np.ndarray:
    """For every row, how many rows at most ``reach`` positions away (itself included) have a value
    that differs by less than ``tolerance``; NaN matches nothing. ``pos`` ascends.

    The values' ranks stand in a wavelet matrix: level by level, from the highest bit of the rank on,
    they are dealt stably into zeros and ones, and a prefix count of the zeros carries every row's
    frame along. So a row costs O(log rows), however wide its frame.
    """
    known = np.flatnonzero(~np.isnan(value))
    out = np.zeros(len(value), np.int64)
    if not len(known) or not tolerance > 0:
        return out
    at, y, n = pos[known], value[known], reach[known]
    if n.max() <= NARROW:  # rows in reach are few places apart
        count = np.ones(len(y), np.int64)
        for d in range(1, min(int(n.max()), len(y) - 1) + 1):
            apart, near = at[d:] - at[:-d], np.abs(y[d:] - y[:-d]) < tolerance
            count[:-d] += near & (apart <= n[:-d])
            count[d:] += near & (apart <= n[d:])
        out[known] = np.where(np.isfinite(y), count, count - 1)  # an infinity differs from itself by no number
        return out
    levels, rank = np.unique(y, return_inverse=True)
    # ranks in reach of each value: the bounds of y +- tolerance, moved to where the comparison itself turns
    low, high = np.searchsorted(levels, y - tolerance), np.searchsorted(levels, y + tolerance)
    near = lambda k: np.abs(levels[np.clip(k, 0, len(levels) - 1)] - y) < tolerance
    while (step := (low > 0) & near(low - 1)).any():
        low = low - step
    while (step := ~near(low)).any():
        low = low + step
    while (step := (high < len(levels)) & near(high)).any():
        high = high + step
    while (step := ~near(high - 1)).any():
        high = high - step
    first, end = np.searchsorted(at, at - n), np.searchsorted(at, at + n, side="right")
    # numbers of ranks below `high` and below `low` in the frame, both at once
    want = np.concatenate((high, low))
    left, right, below = np.tile(first, 2), np.tile(end, 2), np.zeros(2 * len(y), np.int64)
    for bit in range(len(levels).bit_length() - 1, -1, -1):
        one = (rank >> bit) & 1
        zeros = np.concatenate(([0], np.cumsum(1 - one)))
        l0, r0, take = zeros[left], zeros[right], (want >> bit) & 1 == 1
        below += np.where(take, r0 - l0, 0)
        left, right = np.where(take, zeros[-1] + left - l0, l0), np.where(take, zeros[-1] + right - r0, r0)
        rank = np.concatenate((rank[one == 0], rank[one == 1]))
    out[known] = below[:len(y)] - below[len(y):]
    return out


def _chunk_counts(group: str, y: str, tolerance: float, keep: list[str]):
    """The band counts of the chunks' own rows; every other column passes as it is."""
    def run(rows: pa.Table) -> pa.Table:
        value, reach = pc.fill_null(pc.cast(rows[y], pa.float64()), float("nan")).to_numpy(), rows["_n"].to_numpy()
        pos = set_apart(rows[POS_COL].to_numpy(), run_starts(rows, group), reach.max())
        count = band_counts(pos, value, reach, tolerance)
        return rows.append_column("_cnt", pa.array(count)).filter(rows[OWN_COL]).select([*keep, "_cnt"])

    return run


def plateau_flags(df: DataFrame, roles: Roles = DEFAULT_ROLES, *, N: int = 5,
                  window: str | float = "24h", tolerance: float = 0.01,
                  low_thresh: float = 0.1, high_thresh: float = 0.9,
                  keep_positions: bool = False) -> DataFrame:
    """Add ``is_not_plateau``.

    Per group ordered by time, count rows within ``n`` positions either side
    (self included) whose target differs by less than ``tolerance``; with
    ``n = max(1, trunc(window / 2 / interval))`` from the group's median
    sampling interval. A row is a plateau when that count is ``>= N`` and its
    value lies in ``[low, high] * max(target)`` of the group.

    Groups are bucketed by the next power of two of ``n`` (a handful of
    branches), the halo of each branch's ``(group, chunk)`` groups; the
    counts come from :func:`band_counts`, so no row holds its frame.
    """
    if roles.target not in df.columns:
        return df.withColumn(FLAG, F.lit(True))
    G, y = roles.group, roles.target
    half_s = _parse_seconds(window) / 2.0
    had_pos = POS_COL in df.columns
    p = _with_positions(df, roles)
    per_group = (sampling_interval(p, roles, F.max(y).alias("_pmax"))
                 .withColumn("_n", F.greatest(F.lit(1), F.floor(F.lit(half_s) / F.col("interval_s")).cast("long")))
                 .withColumn("_nf", F.pow(F.lit(2), F.ceil(F.log2(F.col("_n")))).cast("long"))
                 .drop("interval_s"))
    # one row per group; written once so the width lookup below and the
    # main plan do not both recompute the interval medians
    per_group = materialize(per_group)
    joined = join_groups(p, per_group, [G])
    widths = sorted(r[0] for r in per_group.select("_nf").distinct().collect())
    branches = []
    for nf in widths:
        part = joined.where(F.col("_nf") == nf)
        size = chunk_size(nf, nf, 4096)
        h = halo_explode(part, F.col(POS_COL), size, before=nf, after=nf)
        schema = StructType([*part.schema.fields, StructField("_cnt", LongType())])
        branches.append(map_chunks(h, G, POS_COL, _chunk_counts(G, y, tolerance, part.columns), schema))
    if not branches:
        return df.withColumn(FLAG, F.lit(True)).where(F.lit(False))
    out = branches[0]
    for b in branches[1:]:
        out = out.unionByName(b)
    in_zone = ((F.col(y) >= F.col("_pmax") * F.lit(low_thresh))
               & (F.col(y) <= F.col("_pmax") * F.lit(high_thresh)))
    flag = ~((F.col("_cnt") >= F.lit(N)) & in_zone)
    out = out.withColumn(FLAG, F.coalesce(flag, F.lit(True))).drop("_cnt", "_n", "_nf", "_pmax")
    return out if (had_pos or keep_positions) else out.drop(POS_COL)
