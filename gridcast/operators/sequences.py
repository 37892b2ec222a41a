"""Sliding sequences (W8): the features of the previous ``seq_len`` rows of
a group, paired with the target of the next row.

Sequences are by row position (after row filters, quirk 7). Positions come
from a range-partitioned sort; the window runs on ``(group, chunk)``
partitions with a halo of ``seq_len`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.operators.chunks import CHUNK_COL, OWN_COL, POS_COL, chunk_size, halo_explode, positions, spread
from gridcast.roles import DEFAULT_ROLES, Roles

# The sequence models are linear in the window. One weighs every step and feature; one pools each feature
# by this many sinusoidal weightings of the steps' positions first.
HEADS = {"transformer": 4}
RIDGE = 1e-3  # least penalty: windows often have more inputs than a site has rows


def sequence_windows(df: DataFrame, features: Sequence[str], seq_len: int,
                     roles: Roles = DEFAULT_ROLES, out: str = "seq") -> DataFrame:
    """Rows ``(group, time, target, seq_start, seq)`` for every row with at
    least ``seq_len`` earlier rows in its group; ``seq`` is an array of
    ``seq_len`` feature arrays in time order.

    Rows with a NULL in any used column are dropped first (the reference
    drops them before building sequences).
    """
    G, T, y = roles.group, roles.time, roles.target
    L = int(seq_len)
    base = df.select(G, T, y, *features).dropna()
    p = positions(base, G, [T])
    h = spread(halo_explode(p, F.col(POS_COL), chunk_size(L, 0, 4096), before=L, after=0), G)
    w = Window.partitionBy(G, CHUNK_COL).orderBy(POS_COL).rowsBetween(-L, -1)
    vec = F.array(*[F.col(c).cast("double") for c in features])
    return (h.withColumn(out, F.collect_list(vec).over(w))
            .withColumn("seq_start", F.first(T).over(w))
            .where(F.col(OWN_COL) & (F.col(POS_COL) >= L))
            .select(G, T, y, "seq_start", out))


def head_weights(model: str, seq_len: int) -> np.ndarray:
    """Weights of a pooled model: one row per head, one column per step."""
    step = (np.arange(seq_len) + 0.5) * np.pi / seq_len
    return np.cos(np.outer(np.arange(min(HEADS[model], seq_len)), step)) / seq_len


def window_inputs(model: str, seq_len: int, col: str = "seq") -> Column:
    """Inputs of a sequence model as one array: the flattened window (step by
    step), or for a pooled model the window's weighted sums (head by head)."""
    seq = F.col(col)
    if model not in HEADS:
        return F.flatten(seq)
    heads = F.array(*[F.array(*[F.lit(float(x)) for x in w]) for w in head_weights(model, seq_len)])
    zero = F.transform(F.element_at(seq, 1), lambda x: F.lit(0.0))

    def pooled(w: Column) -> Column:
        steps = F.zip_with(seq, w, lambda row, k: F.transform(row, lambda x: x * k))
        return F.aggregate(steps, zero, lambda acc, row: F.zip_with(acc, row, lambda a, b: a + b))

    return F.flatten(F.transform(heads, pooled))
