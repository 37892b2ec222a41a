"""Calendar features (F1-F3): hour, Monday-based weekday, month, flags, cycles."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar_features(df: DataFrame, time: str = "delivery_time") -> DataFrame:
    """Add hour/day_of_week/month, weekend and night flags and sin/cos cycles.

    ``day_of_week`` is 0 for Monday (``weekday``), as in the reference.
    """
    t = F.col(time)
    hour, dow, month = F.hour(t), F.weekday(t), F.month(t)
    two_pi = 2 * math.pi
    return df.select(
        "*",
        hour.alias("hour"),
        dow.alias("day_of_week"),
        month.alias("month"),
        F.sin(two_pi * month / 12).alias("month_sin"),
        F.cos(two_pi * month / 12).alias("month_cos"),
        (dow >= 5).cast("int").alias("is_weekend"),
        ((hour < 6) | (hour >= 22)).cast("int").alias("is_night"),
        F.sin(two_pi * hour / 24).alias("hour_sin"),
        F.cos(two_pi * hour / 24).alias("hour_cos"),
        F.sin(two_pi * dow / 7).alias("dow_sin"),
        F.cos(two_pi * dow / 7).alias("dow_cos"),
    )
