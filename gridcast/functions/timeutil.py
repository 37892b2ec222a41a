"""Time normalisation and timestamp arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_utc_time(df: DataFrame, col: str) -> DataFrame:
    """Normalise ``col`` to a UTC ``timestamp``.

    Strings are parsed, dates and ``timestamp_ntz`` values are read as UTC
    wall-clock times (the session time zone is pinned to UTC).
    """
    if col not in df.columns:
        return df
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampType):
        return df
    if isinstance(dtype, T.StringType):
        return df.withColumn(col, F.to_timestamp(F.col(col)))
    return df.withColumn(col, F.col(col).cast(T.TimestampType()))


def epoch_micros(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c)


def lerp_time(t_min: Column, t_max: Column, fraction: float | Column) -> Column:
    """``t_min + (t_max - t_min) * fraction`` on timestamps (microsecond exact)."""
    lo = F.unix_micros(t_min)
    span = F.unix_micros(t_max) - lo
    frac = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    return F.timestamp_micros(lo + (span.cast("double") * frac).cast("long"))
