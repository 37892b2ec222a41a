"""Skew-safe building blocks for per-group ordered work.

A per-group window (``Window.partitionBy(group)``) sends a whole group to
one task; one site may hold a third of all rows. Bounded frames are
therefore evaluated on ``(group, chunk)`` partitions: every row is copied
into the neighbouring chunks whose frames reach it (a *halo*), the window
runs per chunk, and only the copy in the row's own chunk is kept.

Positions within a group (needed for row-count frames) come from a
range-partitioned sort, which splits a hot group over many tasks, plus
per-partition offsets computed on a small summary table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridcast.session import materialize

CHUNK_COL = "_ck"
OWN_COL = "_own"
POS_COL = "_pos"
GROUP_ROWS = 500_000  # most rows of a written table with a row per group that is broadcast


def spread(df: DataFrame, group: str) -> DataFrame:
    """Hash-partition on ``(group, chunk)`` before a chunked window.

    Without it Spark accepts any upstream ``hash(group)`` partitioning (for
    example from a join on the group key) as satisfying the window's
    ``(group, chunk)`` clustering, and a large group stays in one task."""
    return df.repartition(group, CHUNK_COL)


def run_starts(rows: pa.Table | pa.RecordBatch, group: str) -> np.ndarray:
    """Where a new ``(group, chunk)`` begins in rows sorted by both."""
    key = rows[group].combine_chunks() if isinstance(rows, pa.Table) else rows[group]
    key, chunk = key.dictionary_encode().indices.to_numpy(zero_copy_only=False), rows[CHUNK_COL].to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])) + 1))[:len(chunk)]


def set_apart(at: np.ndarray, starts: np.ndarray, gap: int) -> np.ndarray:
    """Ascending places of several runs on one line: every run ascends from its first place,
    more than ``gap`` beyond the run before, so that a frame shorter than that stays in its run."""
    size = np.diff(np.append(starts, len(at)))
    span = at[starts + size - 1] - at[starts] + int(gap) + 1
    return at - np.repeat(at[starts] - (np.cumsum(span) - span), size)


def map_chunks(df: DataFrame, group: str, order: str, fn: Callable[[pa.Table], pa.Table], schema: StructType) -> DataFrame:
    """``fn`` on Arrow tables of whole ``(group, chunk)`` runs, sorted by ``order``.

    Many small runs come in one table (about a batch of rows), so the cost of a call does not
    grow with the number of groups; a run is never split, and a task holds one batch and one run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            last = int(run_starts(b, group)[-1])
            follows = held and all(held[-1][c][-1].as_py() == b[c][0].as_py() for c in (group, CHUNK_COL))
            if last or (held and not follows):
                done = [*held, b.slice(0, last)] if last else held
                yield from fn(pa.Table.from_batches(done)).to_batches()
                held = [b.slice(last)]
            else:
                held.append(b)
        if held:
            yield from fn(pa.Table.from_batches(held)).to_batches()

    return spread(df, group).sortWithinPartitions(group, CHUNK_COL, order).mapInArrow(run, schema)


def join_groups(df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a written table with few rows per group: broadcast up to :data:`GROUP_ROWS`
    rows (counted), by a shuffle beyond."""
    return df.join(F.broadcast(table) if table.count() <= GROUP_ROWS else table, list(on), how)


def halo_explode(df: DataFrame, value: Column, size: int, before: int, after: int) -> DataFrame:
    """Copy each row into every chunk (of ``size`` units of ``value``) whose
    rows can reach it with a frame ``[-before, +after]``.

    Adds ``_ck`` (the chunk this copy serves) and ``_own`` (copy is the
    row's home chunk). Copies per row: ``1 + (before + after) / size``.
    """
    size = max(int(size), 1)
    own = F.floor(value / F.lit(size))
    lo = F.floor((value - F.lit(int(after))) / F.lit(size))
    hi = F.floor((value + F.lit(int(before))) / F.lit(size))
    return (df.withColumn("_ck_own", own)
            .withColumn(CHUNK_COL, F.explode(F.sequence(lo, hi)))
            .withColumn(OWN_COL, F.col(CHUNK_COL) == F.col("_ck_own"))
            .drop("_ck_own"))


def chunk_size(before: int, after: int, minimum: int) -> int:
    """Chunk length that keeps the halo copy overhead at or below 25 %."""
    return max(int(minimum), 4 * (int(before) + int(after)), 1)


def positions(df: DataFrame, group: str, order: Sequence[str], pos_col: str = POS_COL) -> DataFrame:
    """Add the 0-based row position within ``group`` ordered by ``order``.

    The frame is range-partitioned on ``(group, *order)`` (Spark samples the
    keys, so one large group is split over many partitions) and sorted per
    partition. The sorted frame is written once *with* its row and partition
    ids: the offsets of the ``(group, partition)`` runs and the rows they are
    joined to then come from the same files, whatever bounds a second range
    exchange would sample. No task ever holds a whole group.
    """
    keys = [group, *order]
    s = materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumn("_rid", F.monotonically_increasing_id())
                    .withColumn("_pid", F.spark_partition_id()))
    # written: every reader of the positions joins it, and its rows are counted
    stats = materialize(s.groupBy(group, "_pid")
                        .agg(F.min("_rid").alias("_rid0"), F.count(F.lit(1)).alias("_n"))
                        .withColumn("_off", F.coalesce(F.sum("_n").over(
                            Window.partitionBy(group).orderBy("_pid")
                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                        .drop("_n"))
    return (join_groups(s, stats, [group, "_pid"])
            .withColumn(pos_col, F.col("_off") + F.col("_rid") - F.col("_rid0"))
            .drop("_rid", "_pid", "_rid0", "_off"))


def group_median(df: DataFrame, group: str, value: str, out: str = "median") -> DataFrame:
    """Exact median of ``value`` per group (mean of the two middle values).

    A built-in ``median`` keeps every distinct value of a group in one task;
    here the values are range-partitioned and sorted, ranks come from
    per-partition offsets, and only the one or two middle rows per group
    are selected.
    """
    v = df.select(group, value).where(F.col(value).isNotNull() & F.col(group).isNotNull())
    ranked = positions(v, group, [value], "_r")
    counts = ranked.groupBy(group).agg(F.count(F.lit(1)).alias("_cnt"))
    mids = (ranked.join(counts, group)
            .where((F.col("_r") == F.floor((F.col("_cnt") - 1) / 2))
                   | (F.col("_r") == F.ceil((F.col("_cnt") - 1) / 2))))
    return mids.groupBy(group).agg(F.avg(value).alias(out))


def group_median_weighted(df: DataFrame, group: str, value: str, out: str = "median",
                          chunk_rows: int = 4096) -> DataFrame:
    """Exact median per group after collapsing repeated values.

    ``(group, value)`` pairs are counted first (map-side combine, so a hot
    group with few distinct values shrinks to a handful of rows before any
    shuffle); the distinct values are ranked with :func:`positions` and the
    weight before each one is a prefix sum computed per ``(group, chunk)``
    plus a carry over the per-chunk totals. Same result as
    :func:`group_median`; much less to sort when values repeat (time steps).
    """
    w = (df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
         .groupBy(group, value).agg(F.count(F.lit(1)).alias("_w")))
    r = positions(w, group, [value], "_r").withColumn("_c", F.floor(F.col("_r") / F.lit(chunk_rows)))
    local = Window.partitionBy(group, "_c").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("_before", F.coalesce(F.sum("_w").over(local), F.lit(0)))
    tot = r.groupBy(group, "_c").agg(F.sum("_w").alias("_cw"))
    carry = (tot.withColumn("_carry", F.coalesce(F.sum("_cw").over(
                 Window.partitionBy(group).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("_n", F.sum("_cw").over(Window.partitionBy(group)))
             .select(group, "_c", "_carry", "_n"))
    ranked = r.join(carry, [group, "_c"]).withColumn("_lo0", F.col("_carry") + F.col("_before"))
    lo, hi = F.floor((F.col("_n") - 1) / 2), F.ceil((F.col("_n") - 1) / 2)
    covers = lambda k: (F.col("_lo0") <= k) & (k < F.col("_lo0") + F.col("_w"))
    mids = ranked.where(covers(lo) | covers(hi))
    return mids.groupBy(group).agg(
        ((F.sum(F.when(covers(lo), F.col(value))) + F.sum(F.when(covers(hi), F.col(value)))) / F.lit(2.0))
        .alias(out))
