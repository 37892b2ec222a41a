"""Weather and physics features.

Features appear only when their input columns exist, as in the reference.
Divisions use ``try_divide``: a zero divisor gives NULL, the same end state
as the reference's infinity-then-NaN.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
EPS_RATIO = 1e-8          # added to the 10 m speed in the speed ratio
SHEAR_FLOOR = 0.5         # speeds are floored here before the shear log
SHEAR_HEIGHT_RATIO = 10.0  # 100 m / 10 m
GAS_CONSTANT_DRY_AIR = 287.05
KELVIN_OFFSET = 273.15


def _floor(c: Column, lo: float) -> Column:
    # pandas clip(lower=lo): NULL stays NULL
    return F.when(c < lo, F.lit(lo)).otherwise(c)


def weather_features(df: DataFrame, skip_precipitation: bool = False) -> DataFrame:
    """log1p precipitation (in place), wind difference/powers/ratio/shear."""
    cols = set(df.columns)
    out = df
    if "precipitation" in cols and not skip_precipitation:
        out = out.withColumn("precipitation", F.log1p(_floor(F.col("precipitation"), 0.0)))
    if {"wind_speed_100m", "wind_speed_10m"} <= cols:
        v10, v100 = F.col("wind_speed_10m"), F.col("wind_speed_100m")
        out = out.select(
            "*",
            (v100 - v10).alias("wind_speed_diff"),
            (v10 * v10).alias("wind_speed_10m_squared"),
            F.pow(v10, 3).alias("wind_speed_10m_cubed"),
            (v100 * v100).alias("wind_speed_100m_squared"),
            F.pow(v100, 3).alias("wind_speed_100m_cubed"),
            F.try_divide(v100, v10 + F.lit(EPS_RATIO)).alias("wind_speed_ratio"),
            (F.log(F.try_divide(_floor(v100, SHEAR_FLOOR), _floor(v10, SHEAR_FLOOR)))
             / F.lit(math.log(SHEAR_HEIGHT_RATIO))).alias("wind_shear_alpha"),
        )
    return out


def physics_features(df: DataFrame) -> DataFrame:
    """Wind vector components, air density and theoretical power."""
    cols = set(df.columns)
    adds = []
    for h in ("100m", "10m"):
        d, v = f"wind_direction_{h}", f"wind_speed_{h}"
        if {d, v} <= cols:
            rad = F.radians(F.col(d))
            adds += [(-F.col(v) * F.sin(rad)).alias(f"wind_u_{h}"),
                     (-F.col(v) * F.cos(rad)).alias(f"wind_v_{h}")]
    out = df.select("*", *adds) if adds else df
    if {"temperature_2m", "pressure_msl", "wind_speed_100m"} <= cols:
        density = F.try_divide(
            F.col("pressure_msl"),
            F.lit(GAS_CONSTANT_DRY_AIR) * (F.col("temperature_2m") + F.lit(KELVIN_OFFSET)))
        v = F.col("wind_speed_100m")
        out = out.withColumn("air_density", density).withColumn(
            "theoretical_power", F.col("air_density") * F.pow(v, 3))
    return out
