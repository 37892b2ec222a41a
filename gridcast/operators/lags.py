"""Grid alignment (J4), lag features (W6) and lagged rolling statistics.

On a regular, unique grid a shift by ``L`` rows is the value exactly
``L * step`` earlier, and the rolling mean/std of the shifted series is one frame
``[-(L + w - 1) * step, -L * step]``. All frames are evaluated in a single
pass over ``(group, time chunk)`` groups with a halo as long as the
deepest frame, so a large group is spread over many tasks. A window function would
fold every row's frame anew; here a group's statistics (number, mean, squared
deviations) of 1, 2, 4 .. neighbouring rows are merged once, and every frame is put
together from those of its length's binary digits: O(log w) a row. Merging
subtracts no large sums, so a constant window has a deviation of exactly 0.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from gridcast.operators.chunks import OWN_COL, chunk_size, halo_explode, join_groups, map_chunks, run_starts, set_apart
from gridcast.operators.quality import FLAG, _parse_seconds
from gridcast.roles import DEFAULT_ROLES, Roles
from gridcast.session import materialize

GRID_CHUNK_STEPS = 4096
# Fixed values that must equal the reference's: lag set and rolling specs.
LONG_LAG_STEPS = 720
DUPLICATE = "cannot reindex on an axis with duplicate labels"
DEFAULT_ROLLING = ((168, 84, "7d"), (336, 168, "14d"))


def _step_us(step) -> int:
    return int(round(_parse_seconds(step) * 1_000_000))


def _dup_guard(df: DataFrame, roles: Roles) -> DataFrame:
    """Fail lazily (inside the job) on a duplicate ``(group, time)`` key.

    The count window is partitioned by the same key as the following join,
    so it adds no shuffle of its own."""
    cnt = F.count(F.lit(1)).over(Window.partitionBy(roles.group, roles.time))
    bad = F.when(F.col("_dup") > 1, F.raise_error(F.lit(DUPLICATE)))
    return df.withColumn("_dup", cnt).where(bad.isNull()).drop("_dup")


def group_bounds(df: DataFrame, roles: Roles) -> DataFrame:
    t = F.unix_micros(F.col(roles.time))
    return df.groupBy(roles.group).agg(F.min(t).alias("_t0"), F.max(t).alias("_t1"))


def hourly_grid(df: DataFrame, roles: Roles = DEFAULT_ROLES, *, step="1h") -> DataFrame:
    """Reindex every group onto a complete grid from its first to its last
    time: off-grid rows are dropped, gaps become rows with NULL values, a
    duplicate key raises.

    Grid rows are generated in two levels (chunks of 4096 steps, then the
    steps of each chunk) so a long group is generated by many tasks.
    """
    G, T = roles.group, roles.time
    s = _step_us(step)
    keyed = df.where(F.col(G).isNotNull() & F.col(T).isNotNull())
    nsteps = F.floor((F.col("_t1") - F.col("_t0")) / F.lit(s)).cast("long")
    chunks = (group_bounds(keyed, roles)
              .withColumn("_n", nsteps)
              .withColumn("_k0", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n"),
                                                      F.lit(GRID_CHUNK_STEPS).cast("long"))))
              .repartition(G, "_k0"))
    grid = (chunks.withColumn("_k", F.explode(F.sequence(
                F.col("_k0"), F.least(F.col("_k0") + F.lit(GRID_CHUNK_STEPS - 1), F.col("_n")))))
            .select(G, F.timestamp_micros(F.col("_t0") + F.col("_k") * F.lit(s)).alias(T)))
    return grid.join(_dup_guard(keyed, roles), [G, T], "left")


def _marked(df: DataFrame, roles: Roles, step) -> DataFrame:
    """Rows with a group and a time; ``_on``: on the group's grid."""
    keyed = df.where(F.col(roles.group).isNotNull() & F.col(roles.time).isNotNull())
    b = materialize(group_bounds(keyed, roles).select(roles.group, "_t0"))
    on = ((F.unix_micros(F.col(roles.time)) - F.col("_t0")) % F.lit(_step_us(step))) == 0
    return join_groups(keyed, b, [roles.group]).withColumn("_on", on).drop("_t0")


def align_to_grid(df: DataFrame, roles: Roles = DEFAULT_ROLES, *, step="1h") -> DataFrame:
    """Keep only on-grid rows (time = group start + k * step) without adding
    gap rows; a duplicate key raises. Same rows as :func:`hourly_grid` minus
    the gap rows."""
    # duplicates are checked before off-grid rows go, as in hourly_grid
    return _dup_guard(_marked(df, roles, step), roles).where("_on").drop("_on")


def lag_names(lags: Sequence[int], prefix: str = "production", unit: str = "h") -> list[str]:
    return [f"{prefix}_lag{L}{unit}" for L in lags]


def rolling_names(rolling=DEFAULT_ROLLING, prefix: str = "production") -> list[str]:
    out = []
    for _, _, label in rolling:
        out += [f"{prefix}_rolling_mean_{label}", f"{prefix}_rolling_std_{label}"]
    return out


def default_lags(delay_days: int = 15) -> list[int]:
    """Lags of the reference: ``24 d``, ``24 d + 24`` and 720 steps."""
    return [24 * delay_days, 24 * delay_days + 24, LONG_LAG_STEPS]


def lag_feature_names(delay_days: int = 15, prefix: str = "production") -> list[str]:
    """Names written by :func:`lag_features` for a delay (quirk 15 fixed:
    the production-drop list follows the delay)."""
    return lag_names(default_lags(delay_days), prefix) + rolling_names(DEFAULT_ROLLING, prefix)


def frame_moments(y: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, mean and sum of squared deviations of ``y[first:end]`` for every frame."""
    count = np.maximum(end - first, 0)
    n, mean, dev = (np.zeros(len(first)) for _ in range(3))
    at, size = first.copy(), 1
    level_mean, level_dev = np.asarray(y, float), np.zeros(len(y))  # of `size` rows from each row on
    while size <= count.max(initial=0):
        use = np.flatnonzero(count & size)
        i = at[use]
        gap, whole = level_mean[i] - mean[use], n[use] + size
        dev[use] += level_dev[i] + gap * gap * (n[use] * size / whole)
        mean[use] += gap * (size / whole)
        n[use] = whole
        at[use] += size
        gap = level_mean[size:] - level_mean[:-size]  # two neighbouring runs make one of twice the size
        level_mean, level_dev = level_mean[:-size] + gap / 2, level_dev[:-size] + level_dev[size:] + gap * gap * (size / 2)
        size *= 2
    return count, mean, dev


def _chunk_features(group: str, y: str, lags: Sequence[int], shift: int, rolling, s: int, names: Sequence[str], keep: Sequence[str],
                    depth: int):
    """Lags and rolling statistics of the chunks' own rows; every other column passes as it is."""
    def run(rows: pa.Table) -> pa.Table:
        starts, t = run_starts(rows, group), rows["_t"].to_numpy()
        same = t[1:] == t[:-1]
        same[starts[1:] - 1] = False
        if same.any():  # off the grid too
            raise ValueError(DUPLICATE)
        rows = rows.filter(rows["_on"])
        starts, t = run_starts(rows, group), rows["_t"].to_numpy()
        # a group's times lie whole steps apart
        step = set_apart((t - np.repeat(t[starts], np.diff(np.append(starts, len(t))))) // s, starts, depth)
        known = np.flatnonzero(rows[y].is_valid().to_numpy())  # rows with a value, by chunk and time
        at, value = step[known], pc.cast(rows[y], pa.float64()).to_numpy()[known]
        own = rows.filter(rows[OWN_COL])
        now = step[rows[OWN_COL].to_numpy()]
        cols = []
        for lag in lags:
            i = np.searchsorted(at, now - lag)
            found = i < len(at)
            found[found] = at[i[found]] == (now - lag)[found]
            cols.append(rows[y].take(pa.array(known[np.minimum(i, max(len(at) - 1, 0))] if len(at) else i, mask=~found)))
        for win, least, _ in rolling:
            first, end = np.searchsorted(at, now - (shift + win - 1)), np.searchsorted(at, now - shift, side="right")
            n, mean, dev = frame_moments(value, first, end)
            cols.append(pa.array(mean, mask=(n < least) | (n < 1)))
            cols.append(pa.array(np.sqrt(dev / np.maximum(n - 1, 1)), mask=(n < least) | (n < 2)))
        out = own.select(keep)
        for name, col in zip(names, cols, strict=True):
            out = out.append_column(name, col)
        return out

    return run


def lag_features(df: DataFrame, roles: Roles = DEFAULT_ROLES, *, lags: Sequence[int] | None = None,
                 roll_shift: int | None = None, rolling=DEFAULT_ROLLING, step="1h",
                 prefix: str = "production", unit: str = "h", delay_days: int = 15,
                 materialize_grid: bool | None = None, keep_flagged: bool = False) -> DataFrame:
    """Add lags and lagged rolling mean/std of the target.

    ``lags`` and ``roll_shift`` count grid steps (defaults from
    ``delay_days``). When ``is_not_plateau`` exists, only rows with a true
    flag are kept (grid gap rows have a NULL flag and go too), so gap rows
    need not be materialised; without the flag the grid is materialised and
    gap rows are kept, as in the reference.
    """
    G, T, y = roles.group, roles.time, roles.target
    lags = list(lags) if lags is not None else default_lags(delay_days)
    roll_shift = lags[0] if roll_shift is None else roll_shift
    has_flag = FLAG in df.columns
    if materialize_grid is None:
        materialize_grid = not has_flag
    s = _step_us(step)
    # the chunks' rows are sorted by time, so that duplicates show there and cost no exchange of their own
    base = hourly_grid(df, roles, step=step).withColumn("_on", F.lit(True)) if materialize_grid else _marked(df, roles, step)
    kept = [c for c in base.columns if c != "_on"]
    deep = max([*lags, *[roll_shift + w - 1 for w, _, _ in rolling], 1])
    depth = deep * s
    size = chunk_size(depth, 0, GRID_CHUNK_STEPS * s)
    t_us = F.unix_micros(F.col(T))
    h = halo_explode(base.withColumn("_t", t_us), F.col("_t"), size, before=depth, after=0)
    long, rolled = lag_names(lags, prefix, unit), rolling_names(rolling, prefix)
    schema = StructType([*[f for f in base.schema.fields if f.name != "_on"], *[StructField(n, base.schema[y].dataType) for n in long],
                           *[StructField(n, DoubleType()) for n in rolled]])
    run = _chunk_features(G, y, lags, roll_shift, list(rolling), s, [*long, *rolled], kept, deep)
    out = map_chunks(h, G, "_t", run, schema)
    if has_flag and not keep_flagged:
        out = out.where(F.coalesce(F.col(FLAG), F.lit(False)))
    return out
