"""Panel-level projections, filters and joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.roles import DEFAULT_ROLES, Roles


def panel_join(frames: Sequence[DataFrame], roles: Roles = DEFAULT_ROLES,
               suffixes: tuple[str, str] = ("_x", "_y"), null_keys: bool = True) -> DataFrame:
    """Inner-join panels on ``(group, time)``, folding left to right.

    NULL keys match NULL keys (null-safe equality; still an equi-join, so
    Spark plans a hash/sort-merge join shuffled on the key). Non-key names
    present on both sides get ``_x`` (left) / ``_y`` (right) suffixes.
    ``null_keys=False`` leaves rows with NULL keys out: a sort-merge join on the
    plain keys, which bucketed tables need no shuffle for.
    """
    if not frames:
        raise ValueError("panel_join needs at least one frame")
    keys = [roles.group, roles.time]
    out = frames[0]
    for right in frames[1:]:
        clash = (set(out.columns) & set(right.columns)) - set(keys)
        left = out.select(*[F.col(c).alias(c + suffixes[0]) if c in clash else F.col(c) for c in out.columns])
        r = right.select(*[F.col(c).alias(c + suffixes[1]) if c in clash else F.col(c) for c in right.columns])
        rk = {k: f"__r_{k}" for k in keys}
        r = r.withColumnsRenamed(rk)
        cond = None
        for k in keys:
            e = left[k].eqNullSafe(r[rk[k]]) if null_keys else left[k] == r[rk[k]]
            cond = e if cond is None else cond & e
        out = left.join(r if null_keys else r.hint("merge"), cond, "inner").drop(*rk.values())
    return out


def validate_required(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Raise listing missing columns: group and time always; raw target and
    capacity when the normalised target is absent."""
    required = [roles.group, roles.time]
    if roles.target not in df.columns:
        required += [roles.raw, roles.capacity]
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"the panel lacks the columns {missing}")
    return df


def _cap_nonzero(cap: str):
    # the reference tests ``cap != 0`` on floats where NaN passes; NULL is our NaN
    return F.col(cap).isNull() | (F.col(cap) != 0)


def normalize_target(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """If the target is absent: drop zero-capacity rows (NULL capacity is
    kept) and add ``target = raw / capacity``."""
    validate_required(df, roles)
    if roles.target in df.columns:
        return df
    return (df.where(_cap_nonzero(roles.capacity))
            .withColumn(roles.target, F.try_divide(F.col(roles.raw), F.col(roles.capacity))))


def required_rows(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Drop rows with NULL time/target/group (and raw/capacity when both
    exist), then zero-capacity rows."""
    subset = [roles.time, roles.target, roles.group]
    if roles.raw in df.columns and roles.capacity in df.columns:
        subset += [roles.raw, roles.capacity]
    out = df.dropna(subset=subset)
    if roles.capacity in df.columns:
        out = out.where(_cap_nonzero(roles.capacity))
    return out


def recompute_target(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """``target = raw / capacity`` when both exist (P5, quirk 3)."""
    if roles.raw in df.columns and roles.capacity in df.columns:
        return df.withColumn(roles.target, F.try_divide(F.col(roles.raw), F.col(roles.capacity)))
    return df


def group_at(df: DataFrame, index: int, roles: Roles = DEFAULT_ROLES):
    """Name of the ``index``-th group in sorted order (one value to the driver)."""
    rows = (df.select(roles.group).where(F.col(roles.group).isNotNull()).distinct()
            .orderBy(roles.group).offset(index).limit(1).collect())
    if not rows:
        raise ValueError(f"No group at position {index}")
    return rows[0][0]


def single_group(df: DataFrame, roles: Roles = DEFAULT_ROLES, *, name=None,
                 index: int | None = None) -> DataFrame:
    """Keep one group, chosen by name or by position in sorted group order.

    The filter is on the group key, so Catalyst pushes it below windows
    partitioned by the group and down to the scan.
    """
    if name is None:
        if index is None:
            raise ValueError("single_group needs name or index")
        name = group_at(df, index, roles)
    return df.where(F.col(roles.group) == F.lit(name))
