"""Feature scalers.

Statistics are one global aggregate (partial per task, then merged); the
fitted values are a few numbers per feature and are applied as literals.
``ml.StandardScaler`` uses the sample std and ``ml.MinMaxScaler`` maps a
constant to 0.5, so neither matches the reference's scalers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StandardScaling:
    columns: tuple[str, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns({c + suffix: (F.col(c) - F.lit(m)) / F.lit(s)
                               for c, m, s in zip(self.columns, self.mean, self.scale)})


@dataclass(frozen=True)
class MinMaxScaling:
    columns: tuple[str, ...]
    lo: tuple[float, ...]
    span: tuple[float, ...]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns({c + suffix: (F.col(c) - F.lit(lo)) / F.lit(sp)
                               for c, lo, sp in zip(self.columns, self.lo, self.span)})

    def inverse(self, df: DataFrame, cols: dict[str, str]) -> DataFrame:
        """``cols`` maps output column -> fitted column whose range to use."""
        idx = {c: i for i, c in enumerate(self.columns)}
        return df.withColumns({c: F.col(c) * F.lit(self.span[idx[src]]) + F.lit(self.lo[idx[src]])
                               for c, src in cols.items()})


def standard_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with ``{c}_mean`` and ``{c}_std`` (population; 0 -> 1)."""
    aggs = []
    for c in cols:
        sd = F.stddev_pop(F.col(c))
        aggs += [F.avg(c).alias(f"{c}_mean"), F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias(f"{c}_std")]
    return df.agg(*aggs)


def fit_standard(df: DataFrame, cols: Sequence[str]) -> StandardScaling:
    r = standard_stats(df, cols).first()
    return StandardScaling(tuple(cols), tuple(float(r[f"{c}_mean"]) for c in cols),
                           tuple(float(r[f"{c}_std"]) for c in cols))


def minmax_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with ``{c}_min`` and ``{c}_range`` (0 -> 1)."""
    aggs = []
    for c in cols:
        rng = F.max(c) - F.min(c)
        aggs += [F.min(c).cast("double").alias(f"{c}_min"),
                 F.when(rng == 0, F.lit(1.0)).otherwise(rng).cast("double").alias(f"{c}_range")]
    return df.agg(*aggs)


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> MinMaxScaling:
    r = minmax_stats(df, cols).first()
    return MinMaxScaling(tuple(cols), tuple(float(r[f"{c}_min"]) for c in cols),
                         tuple(float(r[f"{c}_range"]) for c in cols))
