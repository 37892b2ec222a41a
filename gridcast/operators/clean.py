"""Cleaning projections: infinities (P11), clip rules (P12), column pruning
(P7) and the complete-case filter (P8)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.functions.names import columns_matching

# Fixed values that must equal the reference's: default clip rules and the
# default drop lists.
DEFAULT_CLIP_RULES: list[dict[str, Any]] = [
    {"contains_any": ["wind_speed", "wind_gusts"], "lower": 0.0, "upper": 45.0},
    {"columns": ["theoretical_power"], "lower": 0.0, "upper": 5.0},
    {"columns": ["wind_shear_alpha"], "replace_inf_with": 0.0, "fillna": 0.0,
     "lower": -0.5, "upper": 1.0},
]
DEFAULT_DROP_COLUMNS = [
    "production", "installed_capacity", "wind_speed_ratio", "snowfall", "shortwave_radiation",
    "direct_radiation", "diffuse_radiation", "sunshine_duration", "dewpoint_2m",
    "apparent_temperature", "wind_direction_100m", "wind_direction_10m", "weather_code",
    "cloud_cover_low", "cloud_cover_mid", "cloud_cover_high", "is_weekend", "is_night", "hour",
    "day_of_week", "month", "is_not_plateau",
]


def _floating(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def _missing_if_not_finite(c: Column) -> Column:
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def inf_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """±inf and NaN become NULL (the single missing marker here)."""
    names = set(cols) if cols is not None else set(_floating(df))
    return df.select(*[_missing_if_not_finite(F.col(c)).cast(df.schema[c].dataType).alias(c)
                       if c in names else F.col(c) for c in df.columns])


def clamp(c: Column, lower: float | None, upper: float | None) -> Column:
    """pandas ``clip``: NULL stays NULL, ±inf go to the bounds.

    ``greatest``/``least`` would replace NULL by the bound, so ``when`` is used."""
    out = c
    if lower is not None:
        out = F.when(out < F.lit(float(lower)), F.lit(float(lower))).otherwise(out)
    if upper is not None:
        out = F.when(out > F.lit(float(upper)), F.lit(float(upper))).otherwise(out)
    return out


@dataclass(frozen=True)
class ClipRule:
    """One rule, resolved against a schema: its columns and its repair steps."""

    columns: tuple[str, ...]
    for_inf: float | None = None
    for_null: float | None = None
    lower: float | None = None
    upper: float | None = None

    @classmethod
    def resolve(cls, spec: dict[str, Any], available: Sequence[str]) -> ClipRule:
        """Explicit names win over name fragments; unknown names drop out."""
        named = spec.get("columns") or columns_matching(available, spec.get("contains_any") or ())
        number = lambda key: None if spec.get(key) is None else float(spec[key])
        known = set(available)
        return cls(tuple(c for c in named if c in known), number("replace_inf_with"), number("fillna"),
                   number("lower"), number("upper"))

    def repair(self, value: Column) -> Column:
        steps = [
            (self.for_inf, lambda v: F.when(F.abs(v) == F.lit(float("inf")), F.lit(self.for_inf)).otherwise(v)),
            (self.for_null, lambda v: F.coalesce(v, F.lit(self.for_null))),
            (self.lower, lambda v: clamp(v, self.lower, None)),
            (self.upper, lambda v: clamp(v, None, self.upper)),
        ]
        return reduce(lambda v, step: v if step[0] is None else step[1](v), steps, value)


def clip_rules(df: DataFrame, rules: Sequence[dict[str, Any]] | None = None) -> DataFrame:
    """Apply clip rules in one projection: each column passes through the rules
    that name it, in the order of the rules. Entries that are no mappings are
    skipped."""
    specs = [r for r in (DEFAULT_CLIP_RULES if rules is None else rules) if isinstance(r, dict)]
    resolved = [ClipRule.resolve(r, df.columns) for r in specs]
    floating = set(_floating(df))

    def output(name: str) -> Column:
        mine = [r for r in resolved if name in r.columns]
        if not mine:
            return F.col(name)
        value = F.nanvl(F.col(name), F.lit(None).cast("double")) if name in floating else F.col(name)
        for rule in mine:
            value = rule.repair(value)
        return value.cast(df.schema[name].dataType).alias(name)

    return df.select(*[output(c) for c in df.columns])


def drop_columns(drop_prod: bool = False, delay_days: int = 15,
                 base: Sequence[str] = DEFAULT_DROP_COLUMNS) -> list[str]:
    """Configured drop list, plus the production lag/rolling names when
    ``drop_prod`` (names derived from the delay, quirk 15 fixed)."""
    from gridcast.operators.lags import lag_feature_names

    cols = list(base)
    if drop_prod:
        cols += lag_feature_names(delay_days)
    return list(dict.fromkeys(cols))


def model_matrix(df: DataFrame, drop: Iterable[str] | None = None) -> DataFrame:
    """Drop the configured columns, then keep complete rows only."""
    dropped = set(DEFAULT_DROP_COLUMNS if drop is None else drop)
    keep = [c for c in df.columns if c not in dropped]
    return df.select(*keep).dropna(how="any")
