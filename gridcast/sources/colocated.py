"""Panels stored for joins without a shuffle.

A co-located panel is a bucketed and sorted parquet table on ``(group, time)``. Panels of the
same number of buckets are joined bucket by bucket: no side moves, however many panels there
are. The time is part of the bucket key, so a group with a third of all rows is spread like the
others; windows over a group are laid out by ``(group, chunk)`` as ever.

Rows whose group or time is NULL match only each other. They are counted when a panel is
written; only where every panel has some is a second, ordinary join of those rows added.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridcast.operators.panel import panel_join
from gridcast.roles import DEFAULT_ROLES, Roles


@dataclass
class Colocated:
    """A stored panel; ``null_keys`` is the number of its rows without a group or time."""

    spark: SparkSession
    table: str
    buckets: int
    null_keys: int
    roles: Roles = DEFAULT_ROLES

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)


def _no_key(roles: Roles):
    return F.col(roles.group).isNull() | F.col(roles.time).isNull()


def write_colocated(df: DataFrame, table: str, path: str, buckets: int, roles: Roles = DEFAULT_ROLES) -> Colocated:
    """Write ``df`` as a table at ``path`` (shared storage), one file per bucket. An
    existing table or folder is an error."""
    if buckets < 1:
        raise ValueError("a panel needs at least one bucket")
    keys, seen = [roles.group, roles.time], Observation()
    (df.observe(seen, F.count_if(_no_key(roles)).alias("n"))
     .repartition(buckets, *keys).write.mode("error").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return Colocated(df.sparkSession, table, buckets, int(seen.get.get("n") or 0), roles)


def open_colocated(spark: SparkSession, table: str, path: str, buckets: int, roles: Roles = DEFAULT_ROLES) -> Colocated:
    """Register the panel that another session wrote at ``path``."""
    if not re.fullmatch(r"\w+", table):
        raise ValueError(f"{table!r} is no table name")
    schema = spark.read.parquet(path).schema
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    keys, place = f"`{roles.group}`, `{roles.time}`", path.replace("'", "\\'")
    spark.sql(f"create table {table} ({columns}) using parquet clustered by ({keys}) sorted by ({keys}) "
              f"into {int(buckets)} buckets location '{place}'")
    return Colocated(spark, table, buckets, spark.table(table).where(_no_key(roles)).count(), roles)


def colocated_join(panels: Sequence[Colocated], suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Inner join of the panels on ``(group, time)``, folding left to right; the rows
    and names of :func:`~gridcast.operators.panel.panel_join`."""
    if not panels:
        raise ValueError("colocated_join needs at least one panel")
    if len({(p.buckets, p.roles) for p in panels}) > 1:
        raise ValueError("panels with different buckets or roles do not join without a shuffle")
    roles = panels[0].roles
    out = panel_join([p.rows() for p in panels], roles, suffixes, null_keys=False)
    if len(panels) > 1 and all(p.null_keys for p in panels):
        out = out.unionByName(panel_join([p.rows().where(_no_key(roles)) for p in panels], roles, suffixes))
    return out
