"""Positional neighbourhood join (J6): every row with the rows at most n
positions away in its group, n given per group.

A band join on positions: positions fall into buckets as wide as the group's
reach, a row meets the rows of its own and the two adjoining buckets by an
equi-join on ``(group, bucket)``, and the pairs beyond the reach go. A bucket
holds at most n rows on one side and 3n on the other, so a group of any size spreads over
many tasks, and the rows sent are three times the neighbours' side whatever n is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.operators.chunks import POS_COL
from gridcast.operators.quality import _with_positions
from gridcast.roles import DEFAULT_ROLES, Roles

NEAR = "near_"


def positional_neighbours(df: DataFrame, reach: DataFrame, columns: Sequence[str], roles: Roles = DEFAULT_ROLES,
                          include_self: bool = False) -> DataFrame:
    """Pairs of rows: the columns of ``df`` with ``_pos``, and ``near_pos`` and ``near_<column>`` of
    the neighbour. ``reach`` has the group and ``n`` (at least 1), one row per group; groups without
    a reach, and rows without a group or time, have no pairs."""
    G = roles.group
    p = _with_positions(df, roles).join(reach.select(G, F.greatest(F.col("n"), F.lit(1)).cast("long").alias("_reach")), G)
    bucket = F.floor(F.col(POS_COL) / F.col("_reach"))
    left = p.withColumn("_bucket", bucket)
    right = p.select(G, F.col(POS_COL).alias(NEAR + "pos"), *[F.col(c).alias(NEAR + c) for c in columns],
                     F.explode(F.sequence(bucket - 1, bucket + 1)).alias("_bucket"))
    apart = F.abs(F.col(NEAR + "pos") - F.col(POS_COL))
    near = (apart <= F.col("_reach")) & ((apart > 0) | F.lit(include_self))
    return left.join(right, [G, "_bucket"]).where(near).drop("_bucket", "_reach")


def reach_of_window(df: DataFrame, seconds: float, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """``group, n``: the positions on either side that a time window takes at the
    group's median sampling interval, at least 1."""
    from gridcast.operators.quality import sampling_interval

    n = F.floor(F.lit(seconds / 2.0) / F.col("interval_s")).cast("long")
    return sampling_interval(df, roles).select(roles.group, F.greatest(F.lit(1).cast("long"), n).alias("n"))
