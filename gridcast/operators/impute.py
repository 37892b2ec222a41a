"""Target imputation.

The cascade matches the reference: plateau rows are masked, gaps are
interpolated linearly in time over at most ``max_fill_rows`` rows after the
last valid value (a trailing gap repeats it, a leading gap stays NULL), then
the group's hour-of-day mean fills the rest, then the group median. After
that step a NULL remains only in a group without any valid value, where a
forward/backward fill has nothing to carry, so no fill windows are needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.operators.chunks import CHUNK_COL, POS_COL, group_median_weighted, join_groups, positions, spread
from gridcast.operators.quality import FLAG
from gridcast.roles import DEFAULT_ROLES, Roles
from gridcast.session import materialize

CHUNK_ROWS = 4096


def _with_positions(df: DataFrame, roles: Roles) -> DataFrame:
    if POS_COL in df.columns:
        return df
    keyed = df.where(F.col(roles.group).isNotNull() & F.col(roles.time).isNotNull())
    return positions(keyed, roles.group, [roles.time])


def interpolate_gaps(df: DataFrame, roles: Roles = DEFAULT_ROLES, *, value: str | None = None,
                     max_fill_rows: int = 6, out: str | None = None) -> DataFrame:
    """Time-weighted linear interpolation of ``value`` within each group.

    The previous and next valid rows can be any distance away, so they are
    found per ``(group, chunk)`` and carried across chunks through a small
    per-chunk summary (a segmented scan); no task holds a whole group.
    """
    G = roles.group
    v = value or roles.target
    out = out or v
    had_pos = POS_COL in df.columns
    p = _with_positions(df, roles)
    t_us = F.unix_micros(F.col(roles.time))
    rec = F.when(F.col(v).isNotNull(),
                 F.struct(F.col(POS_COL).alias("p"), t_us.alias("t"), F.col(v).alias("v")))
    c = (p.withColumn(CHUNK_COL, F.floor(F.col(POS_COL) / F.lit(CHUNK_ROWS)))
         .withColumn("_rec", rec))
    ws = Window.partitionBy(G).orderBy(CHUNK_COL)
    # summed up where the rows lie: only a row per chunk moves
    carry = (c.groupBy(G, CHUNK_COL)
             .agg(F.max("_rec").alias("_last"), F.min("_rec").alias("_first"))
             .withColumn("_cprev", F.last("_last", ignorenulls=True).over(
                 ws.rowsBetween(Window.unboundedPreceding, -1)))
             .withColumn("_cnext", F.first("_first", ignorenulls=True).over(
                 ws.rowsBetween(1, Window.unboundedFollowing)))
             .select(G, CHUNK_COL, "_cprev", "_cnext"))
    # the next valid row is the last one in falling order: a frame that ends at the chunk's end
    # would be folded anew for every row
    back = [F.last("_rec", ignorenulls=True).over(Window.partitionBy(G, CHUNK_COL).orderBy(o)
                                                  .rowsBetween(Window.unboundedPreceding, -1))
            for o in (F.col(POS_COL).desc(), F.col(POS_COL))]
    c = spread(c, G).withColumn("_next", back[0]).withColumn("_prev", back[1])
    c = (c.join(carry, [G, CHUNK_COL], "left")
         .withColumn("_prev", F.coalesce("_prev", "_cprev"))
         .withColumn("_next", F.coalesce("_next", "_cnext")))
    prev, nxt = F.col("_prev"), F.col("_next")
    slope = F.try_divide(nxt["v"] - prev["v"], (nxt["t"] - prev["t"]).cast("double"))
    filled = (F.when(F.col(v).isNotNull(), F.col(v))
              .when(prev.isNull(), F.lit(None))
              .when(F.col(POS_COL) - prev["p"] > F.lit(max_fill_rows), F.lit(None))
              .when(nxt.isNull(), prev["v"])
              .otherwise(slope * (t_us - prev["t"]).cast("double") + prev["v"]))
    res = c.withColumn(out, filled.cast("double")).drop("_rec", "_prev", "_next", "_cprev", "_cnext", CHUNK_COL)
    return res if had_pos else res.drop(POS_COL)


def hourly_profile(df: DataFrame, roles: Roles = DEFAULT_ROLES, value: str | None = None) -> DataFrame:
    """Mean of ``value`` by (group, hour of day): ``(group, hour, hour_mean)``."""
    v = value or roles.target
    return (df.where(F.col(roles.group).isNotNull())
            .groupBy(roles.group, F.hour(roles.time).alias("hour"))
            .agg(F.avg(v).alias("hour_mean")))


def impute_target(df: DataFrame, roles: Roles = DEFAULT_ROLES, *, max_fill_rows: int = 6,
                  keep_positions: bool = False) -> DataFrame:
    """Mask plateau rows, interpolate, then fill by hour-of-day mean and group
    median. Per-group tables are joined back on the group key (small)."""
    G, y = roles.group, roles.target
    had_pos = POS_COL in df.columns
    p = _with_positions(df, roles)
    if FLAG in p.columns:
        # written: the chunks' summary and the rows are two uses of the flags
        p = materialize(p).withColumn(y, F.when(F.col(FLAG) == F.lit(False), F.lit(None)).otherwise(F.col(y)))
    # z feeds the hour profile, the median and the fill: write it once
    z = materialize(interpolate_gaps(p, roles, value=y, max_fill_rows=max_fill_rows))
    prof = materialize(hourly_profile(z, roles, y).withColumnRenamed("hour", "_hour"))
    med = materialize(group_median_weighted(z, G, y, "_median"))
    out = join_groups(z.withColumn("_hour", F.hour(roles.time)), prof, [G, "_hour"], "left")
    out = (join_groups(out, med, [G], "left")
           .withColumn(y, F.coalesce(F.col(y), F.col("hour_mean"), F.col("_median")))
           .drop("_hour", "hour_mean", "_median"))
    return out if (had_pos or keep_positions) else out.drop(POS_COL)
