"""Scalar column functions (calendar, weather, physics, time arithmetic, names)."""

from gridcast.functions.calendar import calendar_features
from gridcast.functions.weather import weather_features, physics_features
from gridcast.functions.timeutil import to_utc_time, lerp_time, epoch_micros
from gridcast.functions.names import columns_matching, run_name

__all__ = [
    "calendar_features", "weather_features", "physics_features",
    "to_utc_time", "lerp_time", "epoch_micros", "columns_matching", "run_name",
]
