"""Registered queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)``, reads the driver's tables (through a
fixture derived from them) and returns a DataFrame; :data:`ORACLE` holds the
matching DuckDB SQL for the SQL-expressible ones. Outputs pass through
:func:`finish` (UTC times back to ``timestamp_ntz``, irrational doubles
rounded, integers widened) so both engines produce comparable values.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.functions.calendar import calendar_features
from gridcast.functions.weather import physics_features, weather_features
from gridcast.operators.chunks import POS_COL
from gridcast.operators import clean, lags, metrics, panel, quality, impute, scale, split
from gridcast.operators.sequences import sequence_windows
from gridcast.plans import oracle as O
from gridcast.plans.pipeline import FeatureConfig, PlateauConfig, process
from gridcast.roles import DEFAULT_ROLES
from gridcast.session import checkpoint_dir, use_utc
from gridcast.sources import fixtures as fx
from gridcast.sources import results
from gridcast.sources.parquet import read_panel_files

R = DEFAULT_ROLES
Y = R.target

# Parameters of the registered queries (the events span exactly 720 hours,
# so the hourly panel uses short lags; the daily panel uses the defaults).
POWER_LAGS = (24, 48, 72)
POWER_ROLLING = ((24, 12, "1d"), (48, 24, "2d"))
POWER_CFG = FeatureConfig(lags=POWER_LAGS, roll_shift=24, rolling=POWER_ROLLING, delay_days=1)
SHIP_CFG = FeatureConfig(step="1d", lag_unit="d")
SPLIT_FRACTION = 0.8
N_FOLDS = 5
SEQ_LEN = 24
KNN_K = 5


def finish(df: DataFrame, rounded: frozenset[str] = frozenset()) -> DataFrame:
    """Types that both engines write alike. Only the columns that the SQL side
    rounds too (``rounded``: engines differ in their last digit) are rounded;
    every other value, and every value of 9e6 or more, passes as it is."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = c.cast("double")
            if f.name in rounded:
                # the same IEEE steps as the SQL side, so ties at the last digit round alike;
                # the bound keeps floor() inside 64-bit integers
                c = F.when(F.abs(c) < F.lit(9e6), F.floor(c * F.lit(1e9) + F.lit(0.5)).cast("double") / F.lit(1e9)
                           ).otherwise(c)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ------------------------------------------------------------- fixtures

def _power(spark, d):
    return panel.normalize_target(fx.power_hour(spark, d))


def _ship(spark, d):
    return panel.normalize_target(fx.ship_day(spark, d))


def _joined(spark, d):
    return panel.panel_join([fx.power_hour(spark, d), fx.weather_hour(spark, d)])


def _persistence(spark, d, lag_hours: int = 24) -> DataFrame:
    """Prediction frame of a ``lag_hours`` persistence forecast."""
    p = _power(spark, d)
    lf = lags.lag_features(p, lags=[lag_hours], rolling=(), materialize_grid=False)
    pred = lf.where(F.col(f"production_lag{lag_hours}h").isNotNull())
    return metrics.prediction_frame(pred, f"production_lag{lag_hours}h")


Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    rounded = frozenset(O.rounded_columns(sql or ""))

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return finish(fn(spark, sf_dir), rounded)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        Q[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


# ----------------------------------------------------------- 2.1 / 2.2

PN = ("pn", O.normalized("power_hour"))
SN = ("sn", O.normalized("ship_day"))


@query("normalize_target", O.with_ctes(O.base_ctes("power_hour") + [PN], f"""
select site_name, delivery_time, production, installed_capacity, {O.rd(Y, Y)} from pn"""))
def q_normalize_target(spark, d):
    """Capacity filter (NULL kept) and target = raw / capacity."""
    return _power(spark, d)


_PANEL_SQL = O.with_ctes(O.base_ctes("power_hour", "weather_hour"), f"""
select p.*, {', '.join(O.rd('w.' + c, c) for c in ['wind_speed_10m', 'wind_speed_100m', 'wind_gusts_10m',
   'wind_direction_10m', 'wind_direction_100m', 'temperature_2m', 'pressure_msl', 'precipitation',
   'cloud_cover_low'])}
from power_hour p join weather_hour w
  on p.site_name is not distinct from w.site_name and p.delivery_time is not distinct from w.delivery_time""")


@query("panel_join", _PANEL_SQL)
def q_panel_join(spark, d):
    """Inner null-safe join of the production and weather panels."""
    return _joined(spark, d)


@query("panel_scan", _PANEL_SQL)
def q_panel_scan(spark, d):
    """The panels written as dataset files in the shared folder, listed
    (one file is excluded by name), read with UTC times and joined."""
    folder = f"{checkpoint_dir(spark)}/panel-scan-{uuid.uuid4().hex}"
    power, weather = fx.power_hour(spark, d), fx.weather_hour(spark, d)
    for name, df in (("dataset_1", power), ("dataset_2", power), ("dataset_3", weather)):
        df.write.parquet(f"{folder}/{name}.parquet")
    return read_panel_files(spark, folder)


@query("colocated_join", _PANEL_SQL)
def q_colocated_join(spark, d):
    """Three panels stored as bucketed tables and joined without a shuffle."""
    from gridcast.sources.colocated import colocated_join, write_colocated

    weather = fx.weather_hour(spark, d)
    wind = [c for c in weather.columns if c.startswith("wind")]
    parts = (fx.power_hour(spark, d), weather.select(R.group, R.time, *wind), weather.drop(*wind))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    run = uuid.uuid4().hex
    return colocated_join([write_colocated(p, f"panel_{run}_{i}", f"{checkpoint_dir(spark)}/panel-{run}/{i}", buckets)
                           for i, p in enumerate(parts)])


@query("hourly_grid", O.with_ctes(O.base_ctes("power_hour") + [PN, ("b", f"""
select site_name, unnest(generate_series(min(delivery_time), max(delivery_time), interval 1 hour)) as delivery_time
from pn group by site_name""")], f"""
select b.site_name, b.delivery_time, pn.production, pn.installed_capacity, {O.rd('pn.' + Y, Y)}
from b left join pn on pn.site_name = b.site_name and pn.delivery_time = b.delivery_time"""))
def q_hourly_grid(spark, d):
    """Complete hourly grid per site, gaps as NULL rows."""
    return lags.hourly_grid(_power(spark, d))


@query("required_rows", O.with_ctes(O.base_ctes("power_hour") + [PN, ("b", f"""
select site_name, unnest(generate_series(min(delivery_time), max(delivery_time), interval 1 hour)) as delivery_time
from pn group by site_name"""), ("g", f"""
select b.site_name, b.delivery_time, pn.production, pn.installed_capacity, pn.{Y}
from b left join pn on pn.site_name = b.site_name and pn.delivery_time = b.delivery_time""")], f"""
select site_name, delivery_time, production, installed_capacity, {O.rd(Y, Y)}
from ({O.required_sql('g')}) r"""))
def q_required_rows(spark, d):
    """Drop rows missing time/target/group/raw/capacity, then zero capacity."""
    return panel.required_rows(lags.hourly_grid(_power(spark, d)))


@query("single_group", O.with_ctes(O.base_ctes("power_hour") + [PN], f"""
select site_name, delivery_time, production, installed_capacity, {O.rd(Y, Y)} from pn
where site_name = (select site_name from (select distinct site_name from pn where site_name is not null)
                   order by site_name limit 1 offset 1)"""))
def q_single_group(spark, d):
    """P10: keep the group at position 1 of the sorted group list."""
    return panel.single_group(_power(spark, d), index=1)


@query("calendar_features", O.with_ctes(O.base_ctes("power_hour"), f"""
select site_name, delivery_time, production, installed_capacity, hour, day_of_week, month, is_weekend, is_night,
  {', '.join(O.rd(c, c) for c in ['month_sin', 'month_cos', 'hour_sin', 'hour_cos', 'dow_sin', 'dow_cos'])}
from ({O.calendar_sql('power_hour')}) c"""))
def q_calendar_features(spark, d):
    """Hour, Monday-based weekday, month, flags and cycles."""
    return calendar_features(fx.power_hour(spark, d))


_W_BASE = ["wind_speed_10m", "wind_speed_100m", "wind_gusts_10m", "wind_direction_10m", "wind_direction_100m",
           "temperature_2m", "pressure_msl", "precipitation", "cloud_cover_low"]


@query("weather_features", O.with_ctes(O.base_ctes("weather_hour"), f"""
select site_name, delivery_time, {', '.join(O.rd(c, c) for c in _W_BASE + O.WEATHER_COLS)}
from ({O.weather_sql('weather_hour')}) w"""))
def q_weather_features(spark, d):
    """log1p precipitation, wind difference, powers, ratio, shear."""
    return weather_features(fx.weather_hour(spark, d))


@query("physics_features", O.with_ctes(O.base_ctes("weather_hour"), f"""
select site_name, delivery_time, {', '.join(O.rd(c, c) for c in _W_BASE + O.PHYSICS_COLS)}
from ({O.physics_sql('weather_hour')}) p"""))
def q_physics_features(spark, d):
    """Wind vectors, air density, theoretical power, inf -> NULL."""
    return clean.inf_to_null(physics_features(fx.weather_hour(spark, d)))


_CLIP_COLS = _W_BASE + O.WEATHER_COLS + O.PHYSICS_COLS


@query("clip_rules", O.with_ctes(O.base_ctes("weather_hour") + [
    ("w", O.weather_sql("weather_hour")), ("p", O.physics_sql("w"))], f"""
select site_name, delivery_time, {', '.join(O.rd(c, c) for c in _CLIP_COLS)}
from ({O.clip_sql('p', _CLIP_COLS)}) c"""))
def q_clip_rules(spark, d):
    """Ordered clip rules by name and by substring."""
    w = clean.inf_to_null(physics_features(weather_features(fx.weather_hour(spark, d))))
    return clean.clip_rules(w)


# ------------------------------------------------------------ 2.4 / 2.5

@query("sampling_interval", O.with_ctes(O.base_ctes("ship_day") + O.positions_cte("ship_day", "sp")
                                        + O.interval_cte("sp", "iv"), f"""
select site_name, {O.rd('interval_s', 'interval_s')} from iv"""))
def q_sampling_interval(spark, d):
    """A2: median spacing of consecutive times per site (seconds)."""
    return quality.sampling_interval(fx.ship_day(spark, d))


@query("plateau_flags", O.with_ctes(O.base_ctes("power_hour") + [PN] + O.plateau_ctes("pn", "pf"), f"""
select site_name, delivery_time, {O.rd(Y, Y)}, is_not_plateau from pf"""))
def q_plateau_flags(spark, d):
    """Plateau flags with the default parameters on the hourly panel."""
    return quality.plateau_flags(_power(spark, d)).select(R.group, R.time, Y, "is_not_plateau")


@query("positional_neighbours", O.with_ctes(O.base_ctes("power_hour") + [PN] + O.plateau_ctes("pn", "pf", half_s=21600.0), f"""
select p.site_name, p.delivery_time, count(*) as neighbours, {O.rd(f'min(q.{Y})', 'lowest')}, {O.rd(f'max(q.{Y})', 'highest')},
  max(abs(q._pos - p._pos)) as farthest
from pf_p p join pf_g g on g.site_name = p.site_name
join pf_p q on q.site_name = p.site_name and q._pos <> p._pos and q._pos between p._pos - g.n and p._pos + g.n
group by p.site_name, p.delivery_time"""))
def q_positional_neighbours(spark, d):
    """Range of the targets within half of a 12-hour window in positions, the row itself left out."""
    from gridcast.operators.neighbours import NEAR, positional_neighbours, reach_of_window

    power = _power(spark, d)
    pairs = positional_neighbours(power, reach_of_window(power, 43200.0), [Y])
    return pairs.groupBy(R.group, R.time).agg(
        F.count(F.lit(1)).alias("neighbours"), F.min(NEAR + Y).alias("lowest"), F.max(NEAR + Y).alias("highest"),
        F.max(F.abs(F.col(NEAR + "pos") - F.col(POS_COL))).alias("farthest"))


@query("plateau_flags_daily", O.with_ctes(O.base_ctes("ship_day") + [SN] + O.plateau_ctes(
        "sn", "pf", half_s=6 * 86400.0, n_min=5, tol=0.02), f"""
select site_name, delivery_time, {O.rd(Y, Y)}, is_not_plateau from pf"""))
def q_plateau_flags_daily(spark, d):
    """W1 on the daily panel with a 12-day window (n = 6 positions)."""
    return (quality.plateau_flags(_ship(spark, d), window="12d", tolerance=0.02)
            .select(R.group, R.time, Y, "is_not_plateau"))


@query("interpolate_gaps", O.with_ctes(O.base_ctes("power_hour") + [PN, ("b", f"""
select site_name, unnest(generate_series(min(delivery_time), max(delivery_time), interval 1 hour)) as delivery_time
from pn group by site_name"""), ("g", f"""
select b.site_name, b.delivery_time, pn.{Y}
from b left join pn on pn.site_name = b.site_name and pn.delivery_time = b.delivery_time""")]
    + O.positions_cte("g", "gp") + O.interpolate_ctes("gp", "iz"), f"""
select site_name, delivery_time, {O.rd(Y, Y)} from iz"""))
def q_interpolate_gaps(spark, d):
    """Time-linear fill of grid gaps, at most 6 rows after a valid value."""
    g = lags.hourly_grid(_power(spark, d)).select(R.group, R.time, Y)
    return impute.interpolate_gaps(g)


@query("hourly_profile", O.with_ctes(O.base_ctes("power_hour") + [PN], f"""
select site_name, hour(delivery_time) as hour, {O.rd(f'avg({Y})', 'hour_mean')} from pn group by 1, 2"""))
def q_hourly_profile(spark, d):
    """A3: mean target by site and hour of day."""
    return impute.hourly_profile(_power(spark, d))


@query("impute_target", O.with_ctes(O.base_ctes("power_hour") + [PN] + O.plateau_ctes("pn", "pf")
                                    + O.impute_ctes("pf", "im"), f"""
select site_name, delivery_time, {O.rd(Y, Y)}, is_not_plateau from im"""))
def q_impute_target(spark, d):
    """Mask plateaus, interpolate, hour-of-day mean, group median."""
    return impute.impute_target(quality.plateau_flags(_power(spark, d))).select(
        R.group, R.time, Y, "is_not_plateau")


def _ship_ready_ctes(base=None):
    return ((base or O.base_ctes("ship_day")) + [SN] + O.plateau_ctes("sn", "pf") + O.impute_ctes("pf", "im")
            + [("rq", O.required_sql("im")),
               ("rc", f"select * replace (production / installed_capacity as {Y}) from rq")])


_SHIP_LAGS = [360, 384, 720]
_SHIP_ROLL = [(168, 84, "7d"), (336, 168, "14d")]


def _ship_lagged(spark, d):
    c = SHIP_CFG
    x = impute.impute_target(quality.plateau_flags(_ship(spark, d), keep_positions=True)).drop(POS_COL)
    x = panel.recompute_target(panel.required_rows(x))
    return lags.lag_features(x, step=c.step, unit=c.lag_unit)


@query("lag_features", O.with_ctes(_ship_ready_ctes() + [
        ("lg", O.lag_sql("rc", _SHIP_LAGS, 360, [], O.DAY_US, "d"))], f"""
select site_name, delivery_time, {O.rd(Y, Y)},
  {', '.join(O.rd(f'production_lag{L}d', f'production_lag{L}d') for L in _SHIP_LAGS)} from lg"""))
def q_lag_features(spark, d):
    """360/384/720-step lags on the daily panel, plateau rows dropped."""
    return _ship_lagged(spark, d).select(R.group, R.time, Y, *[f"production_lag{L}d" for L in _SHIP_LAGS])


_ROLL_COLS = lags.rolling_names()


@query("rolling_features", O.with_ctes(_ship_ready_ctes() + [
        ("lg", O.lag_sql("rc", [], 360, _SHIP_ROLL, O.DAY_US, "d"))], f"""
select site_name, delivery_time, {', '.join(O.rd(c, c) for c in _ROLL_COLS)} from lg"""))
def q_rolling_features(spark, d):
    """Rolling mean/std (168/84 and 336/168 steps) of the 360-step lag."""
    return _ship_lagged(spark, d).select(R.group, R.time, *_ROLL_COLS)


_SUPP_COLS = [f"production_lag{L}d" for L in _SHIP_LAGS] + _ROLL_COLS


@query("supplier_features", O.with_ctes(_ship_ready_ctes([("ship_day", O.ship_day_by("cast(l_suppkey as varchar)"))]) + [
        ("lg", O.lag_sql("rc", _SHIP_LAGS, 360, _SHIP_ROLL, O.DAY_US, "d"))], f"""
select site_name, delivery_time, {O.rd(Y, Y)}, {', '.join(O.rd(c, c) for c in _SUPP_COLS)} from lg"""))
def q_supplier_features(spark, d):
    """E1 daily stages with one site per supplier (many groups): plateau,
    impute, lags and rolling statistics."""
    c = SHIP_CFG
    x = panel.normalize_target(fx.ship_day(spark, d, site_col="l_suppkey"))
    x = impute.impute_target(quality.plateau_flags(x, keep_positions=True)).drop(POS_COL)
    x = panel.recompute_target(panel.required_rows(x))
    return lags.lag_features(x, step=c.step, unit=c.lag_unit).select(R.group, R.time, Y, *_SUPP_COLS)


# ---------------------------------------------------------- full pipeline

_MM_DROP = set(clean.DEFAULT_DROP_COLUMNS)


def _mm_columns() -> list[str]:
    base = ["site_name", "delivery_time", *_W_BASE, "production", "installed_capacity", Y]
    cols = (base + O.CALENDAR_COLS + O.WEATHER_COLS + [f"production_lag{L}h" for L in POWER_LAGS]
            + lags.rolling_names(POWER_ROLLING) + O.PHYSICS_COLS)
    return [c for c in cols if c not in _MM_DROP]


def _pipeline_ctes() -> list[tuple[str, str]]:
    ctes = (O.base_ctes("power_hour", "weather_hour") + [
        ("j", "select p.*, w.* exclude (site_name, delivery_time) from power_hour p join weather_hour w "
              "on p.site_name = w.site_name and p.delivery_time = w.delivery_time"),
        ("jn", O.normalized("j"))]
        + O.plateau_ctes("jn", "pf") + O.impute_ctes("pf", "im")
        + [("rq", O.required_sql("im")),
           ("cal", O.calendar_sql("rq")),
           ("rc", f"select * replace (production / installed_capacity as {Y}) from cal"),
           ("wf", O.weather_sql("rc")),
           ("lg", O.lag_sql("wf", list(POWER_LAGS), 24, list(POWER_ROLLING), O.HOUR_US, "h")),
           ("ph", O.physics_sql("lg"))])
    all_cols = _mm_columns()
    ctes.append(("cl", O.clip_sql("ph", [c for c in all_cols])))
    return ctes


def _pipeline_sql(final_cols: list[str]) -> str:
    all_cols = _mm_columns()
    dbl = set(all_cols) - {"site_name", "delivery_time"}
    not_null = " and ".join(f"{c} is not null" for c in all_cols)
    sel = ", ".join(O.rd(c, c) if c in dbl else c for c in final_cols)
    return O.with_ctes(_pipeline_ctes(), f"select {sel} from cl where {not_null}")


def model_frame(spark, d) -> DataFrame:
    """Feature pipeline on the joined hourly panel, clipped, complete cases."""
    x = clean.clip_rules(process(_joined(spark, d), R, POWER_CFG))
    return clean.model_matrix(x, clean.drop_columns(False, POWER_CFG.delay_days))


@query("model_matrix", _pipeline_sql(_mm_columns()))
def q_model_matrix(spark, d):
    """P7/P8/P9 over the whole pipeline (E1 up to the model input)."""
    return model_frame(spark, d)


# the toggles: no plateau flags, imputation, weather or lag columns; flags and lags, but no imputation
_BARE_CFG = POWER_CFG.with_(plateau=PlateauConfig(enabled=False), imputation=False, weather_features=False, lag_features=False)
_UNFILLED_CFG = POWER_CFG.with_(imputation=False)


def _toggled_sql(weather: bool, lagged: bool) -> str:
    """The feature pipeline without imputation, and without the parts that are off."""
    stages = O.base_ctes("power_hour", "weather_hour") + [
        ("j", "select p.*, w.* exclude (site_name, delivery_time) from power_hour p join weather_hour w "
              "on p.site_name = w.site_name and p.delivery_time = w.delivery_time"), ("jn", O.normalized("j"))]
    stages += O.plateau_ctes("jn", "pf") if lagged else []
    stages += [("rq", O.required_sql("pf" if lagged else "jn")), ("cal", O.calendar_sql("rq")),
               ("rc", f"select * replace (production / installed_capacity as {Y}) from cal"),
               ("wf", O.weather_sql("rc") if weather else "select * from rc"),
               ("lg", O.lag_sql("wf", list(POWER_LAGS), 24, list(POWER_ROLLING), O.HOUR_US, "h") if lagged else "select * from wf"),
               ("ph", O.physics_sql("lg"))]
    whole = {"site_name", "delivery_time", "hour", "day_of_week", "month", "is_weekend", "is_night"}
    cols = [c if c in whole else O.rd(c, c) for c in _toggled_columns(weather, lagged)]
    return O.with_ctes(stages, f"select {', '.join(cols)} from ph")


def _toggled_columns(weather: bool, lagged: bool) -> list[str]:
    return (["site_name", "delivery_time", "production", "installed_capacity", Y, *_W_BASE] + O.CALENDAR_COLS
            + (O.WEATHER_COLS if weather else []) + O.PHYSICS_COLS
            + ([f"production_lag{L}h" for L in POWER_LAGS] + lags.rolling_names(POWER_ROLLING) if lagged else []))


@query("features_toggled_off", _toggled_sql(False, False))
def q_features_toggled_off(spark, d):
    """Plateau flags, imputation, weather and lag columns switched off; physics stays (quirk 18)."""
    x = process(_joined(spark, d), R, _BARE_CFG)
    spare = set(O.WEATHER_COLS) | {"is_not_plateau"}
    if extra := [c for c in x.columns if c in spare or c.startswith("production_") and c != Y]:
        raise ValueError(f"columns of features that are off: {extra}")
    return x.select(*_toggled_columns(False, False))


@query("features_unimputed", _toggled_sql(True, True))
def q_features_unimputed(spark, d):
    """Imputation switched off, plateau flags, weather and lag columns on."""
    return process(_joined(spark, d), R, _UNFILLED_CFG).select(*_toggled_columns(True, True))


@query("untargeted_flags", O.with_ctes(O.base_ctes("weather_hour"), """
select site_name, delivery_time, wind_speed_100m * 1.0e0 as wind_speed_100m, true as is_not_plateau from weather_hour"""))
def q_untargeted_flags(spark, d):
    """A panel without the target column has no plateau."""
    w = fx.weather_hour(spark, d)
    return quality.plateau_flags(w.select(R.group, R.time, "wind_speed_100m"))


# ------------------------------------------------------------- sequences

def _seq_ctes():
    return (O.base_ctes("ship_day") + [SN] + [("sq0", f"select * from sn where {Y} is not null and "
                                                      "production is not null and installed_capacity is not null")]
            + O.positions_cte("sq0", "sqp")
            + [("sq", f"""select site_name, delivery_time, {Y}, _pos,
  count(*) over w as n_steps,
  sum(production + installed_capacity) over w as seq_sum,
  sum(_pos * (production + 2 * installed_capacity)) over w
    - (_pos - %d) * sum(production + 2 * installed_capacity) over w as seq_order,
  first_value(delivery_time) over w as seq_start
from sqp window w as (partition by site_name order by _pos rows between {SEQ_LEN} preceding and 1 preceding)"""
                .replace("%d", str(SEQ_LEN)))])


def _sequences(spark, d):
    s = sequence_windows(_ship(spark, d), ["production", "installed_capacity"], SEQ_LEN)
    return s.select(R.group, R.time, Y, "seq_start", F.size("seq").alias("n_steps"),
                    F.aggregate(F.flatten("seq"), F.lit(0.0), lambda a, x: a + x).alias("seq_sum"),
                    F.aggregate(F.transform("seq", lambda v, i: i * (v[0] + 2 * v[1])), F.lit(0.0),
                                lambda a, x: a + x).alias("seq_order"))


@query("sequence_windows", O.with_ctes(_seq_ctes(), f"""
select site_name, delivery_time, {O.rd(Y, Y)}, seq_start, n_steps, {O.rd('seq_sum', 'seq_sum')},
  {O.rd('seq_order', 'seq_order')}
from sq where _pos >= {SEQ_LEN}"""))
def q_sequence_windows(spark, d):
    """Previous 24 rows of features per target row (checked by count,
    start time, element sum and the sum weighted by place)."""
    return _sequences(spark, d)


@query("sequence_holdout", O.with_ctes(_seq_ctes() + [
        ("s2", f"select *, row_number() over (order by site_name, delivery_time) - 1 as r, "
               f"count(*) over () as n from sq where _pos >= {SEQ_LEN}")], """
select site_name, delivery_time, case when n < 20 then false
  else r >= n - greatest(1, cast(floor(0.2 * n) as bigint)) end as is_val from s2"""))
def q_sequence_holdout(spark, d):
    """Last 20 % of sequences in (group, time) order are validation."""
    s = _sequences(spark, d)
    return split.sequence_holdout(s, val_fraction=0.2).select(R.group, R.time, "is_val")


# ------------------------------------------------------------- splits

_THR = f"""(select make_timestamp(lo + cast(floor((hi - lo) * {SPLIT_FRACTION}) as bigint)) as thr
   from (select min(epoch_us(delivery_time)) lo, max(epoch_us(delivery_time)) hi from pn) x)"""


@query("time_split", O.with_ctes(O.base_ctes("power_hour") + [PN, ("th", _THR)], f"""
select site_name, delivery_time, {O.rd(Y, Y)}, case when delivery_time < th.thr then 'train' else 'test' end as role
from pn, th"""))
def q_time_split(spark, d):
    """Rows before min + 0.8 (max - min) train, the rest test."""
    return split.with_split_role(_power(spark, d), SPLIT_FRACTION).select(R.group, R.time, Y, "role")


@query("split_summary", O.with_ctes(O.base_ctes("power_hour") + [PN, ("th", _THR), ("parts", """
select 'full' as part, delivery_time from pn
union all select case when delivery_time < th.thr then 'train' else 'test' end, delivery_time from pn, th""")], """
select part, count(*) as rows, min(delivery_time) as t_min, max(delivery_time) as t_max from parts group by part"""))
def q_split_summary(spark, d):
    """A10: rows and time range of full, train and test."""
    p = _power(spark, d)
    tr, te = split.split_time(p, SPLIT_FRACTION)
    return metrics.split_summary({"full": p, "train": tr, "test": te}, R.time)


@query("holdout_split", O.with_ctes(O.base_ctes("power_hour") + [PN, ("th", _THR), ("tg", """
select site_name as tg from (select distinct site_name from pn where site_name is not null)
order by site_name limit 1 offset 1""")], f"""
select site_name, delivery_time, {O.rd(Y, Y)}, 'train' as role from pn, th, tg
  where delivery_time < th.thr and site_name <> tg.tg
union all
select site_name, delivery_time, {O.rd(Y, Y)}, 'test' from pn, th, tg
  where delivery_time >= th.thr and site_name = tg.tg"""))
def q_holdout_split(spark, d):
    """Train on other sites before the threshold, test one site after."""
    tr, te = split.holdout_split(_power(spark, d), 1 - SPLIT_FRACTION, 1)
    cols = [R.group, R.time, Y]
    return tr.select(*cols, F.lit("train").alias("role")).unionByName(te.select(*cols, F.lit("test").alias("role")))


_FOLD_CTES = [("ut", "select distinct delivery_time from pn where delivery_time is not null"),
              ("un", "select count(*) as n, count(*) // 6 as s from ut"),
              ("ur", "select delivery_time, row_number() over (order by delivery_time) - 1 as r from ut"),
              ("fb", """select i as fold, (select delivery_time from ur where r = un.n - (5 - i) * un.s) as lo,
  (select delivery_time from ur where r = un.n - (4 - i) * un.s) as hi
from un, range(5) t(i)"""),
              ("tagged", f"""select pn.*, (select max(fold) from fb where pn.delivery_time >= fb.lo) as fold from pn""")]


@query("time_folds", O.with_ctes(O.base_ctes("power_hour") + [PN] + _FOLD_CTES, """
select cast(fold as bigint) as fold, 'validation' as role, count(*) as rows,
       min(delivery_time) as t_min, max(delivery_time) as t_max
from tagged where fold is not null group by fold
union all
select cast(fb.fold as bigint), 'train', count(*), min(t.delivery_time), max(t.delivery_time)
from fb join tagged t on t.delivery_time < fb.lo group by fb.fold"""))
def q_time_folds(spark, d):
    """Five expanding folds over the distinct times."""
    return split.fold_summary(_power(spark, d), N_FOLDS)


@query("cv_summary", O.with_ctes(O.base_ctes("power_hour") + [PN] + _FOLD_CTES + [("fm", f"""
select v.fold, avg(abs(coalesce(g.m, a.m) - v.{Y})) as mae
from tagged v
join fb on fb.fold = v.fold
left join (select fb.fold, t.site_name, avg(t.{Y}) as m from fb join tagged t on t.delivery_time < fb.lo
           group by 1, 2) g on g.fold = v.fold and g.site_name = v.site_name
join (select fb.fold, avg(t.{Y}) as m from fb join tagged t on t.delivery_time < fb.lo group by 1) a
  on a.fold = v.fold
where v.fold is not null group by v.fold""")], f"""
select {O.rd('avg(mae)', 'cv_mae')}, {O.rd('stddev_pop(mae)', 'cv_mae_std')}, count(*) as n_folds from fm"""))
def q_cv_summary(spark, d):
    """Mean and population std of fold MAEs of a per-site mean predictor."""
    from gridcast.plans.evaluation import group_mean_cv

    return group_mean_cv(_power(spark, d), N_FOLDS)


# ------------------------------------------------------------- metrics

_PERSIST = [("lg", O.lag_sql("pn", [24], 24, [], O.HOUR_US, "h", keep_flag_filter=False)),
            ("pf", f"select delivery_time as timestamp, site_name as \"group\", {Y} as y_true, "
                   f"production_lag24h as y_pred from lg where production_lag24h is not null")]


@query("prediction_frame", O.with_ctes(O.base_ctes("power_hour") + [PN] + _PERSIST, f"""
select timestamp, "group", {O.rd('y_true', 'y_true')}, {O.rd('y_pred', 'y_pred')} from pf"""))
def q_prediction_frame(spark, d):
    """(timestamp, group, y_true, y_pred) of a 24 h persistence forecast."""
    return _persistence(spark, d).orderBy("timestamp", "group")


@query("group_metrics", O.with_ctes(O.base_ctes("power_hour") + [PN] + _PERSIST, f"""
select "group", {O.rd('avg(abs(y_pred - y_true))', 'mae')}, {O.rd('sqrt(avg((y_pred - y_true)^2))', 'rmse')},
  {O.rd('case when avg(y_true) <> 0 then sqrt(avg((y_pred - y_true)^2)) / avg(y_true) else 0 end', 'nrmse')}
from pf group by "group" """))
def q_group_metrics(spark, d):
    """Per-site MAE, RMSE, nRMSE sorted by MAE."""
    return metrics.group_metrics(_persistence(spark, d))


@query("result_files", O.with_ctes(O.base_ctes("power_hour") + [PN] + _PERSIST, f"""
select k.kind, "group", {O.rd('avg(abs(y_pred - y_true))', 'mae')}, {O.rd('sqrt(avg((y_pred - y_true)^2))', 'rmse')}
from pf cross join (select unnest(['by_group', 'combined']) as kind) k group by k.kind, "group" """))
def q_result_files(spark, d):
    """Errors per site written as CSV, one folder per site and one combined file, and both read back."""
    rows = metrics.group_metrics(_persistence(spark, d)).select("group", "mae", "rmse")
    base = f"{checkpoint_dir(spark)}/results-{uuid.uuid4().hex}"
    results.write_csv(rows, base, "group")
    return results.read_csv(spark, base, rows.schema, "group")


@query("global_metrics", O.with_ctes(O.base_ctes("power_hour") + [PN] + _PERSIST, f"""
select {O.rd('avg(abs(y_pred - y_true))', 'eval_mae')}, {O.rd('sqrt(avg((y_pred - y_true)^2))', 'eval_rmse')},
  {O.rd('case when avg(y_true) <> 0 then sqrt(avg((y_pred - y_true)^2)) / avg(y_true) else 0 end', 'eval_nrmse')},
  count(*) as n_rows from pf"""))
def q_global_metrics(spark, d):
    """A5: MAE, RMSE, nRMSE over all rows."""
    return metrics.global_metrics(_persistence(spark, d))


@query("portfolio_metrics", O.with_ctes(O.base_ctes("power_hour") + [PN] + _PERSIST + [
        ("ps", "select timestamp, sum(y_true) as y_true, sum(y_pred) as y_pred from pf group by timestamp"),
        ("pt", """select avg(abs(y_pred - y_true)) as mae, sqrt(avg((y_pred - y_true)^2)) as rmse,
                  avg(y_true) as m from ps"""),
        ("ng", 'select count(distinct "group") as n from pf')], f"""
select {O.rd('mae', 'portfolio_mae_total')}, {O.rd('rmse', 'portfolio_rmse_total')},
  {O.rd('case when m <> 0 then rmse / m else 0 end', 'portfolio_nrmse_total')}, n as n_groups,
  {O.rd('case when n > 0 then mae / n else 0 end', 'portfolio_mae_per_site')},
  {O.rd('case when n > 0 then rmse / n else 0 end', 'portfolio_rmse_per_site')}
from pt, ng"""))
def q_portfolio_metrics(spark, d):
    """Errors of the summed portfolio, total and per site."""
    return metrics.portfolio_metrics(_persistence(spark, d))


_BEST_LAGS = (1, 2, 3, 6, 12, 24, 48)


@query("best_trial", O.with_ctes(O.base_ctes("power_hour") + [PN, ("tr", " union all ".join(
    f"select {L} as lag_hours, avg(abs(l.{Y} - p.{Y})) as mae from pn p join pn l on l.site_name = p.site_name "
    f"and epoch_us(l.delivery_time) = epoch_us(p.delivery_time) - {L * O.HOUR_US}" for L in _BEST_LAGS))], f"""
select cast(lag_hours as bigint) as lag_hours, {O.rd('mae', 'mae')} from tr order by mae, lag_hours limit 1"""))
def q_best_trial(spark, d):
    """O2: the persistence lag with the lowest MAE among the candidates."""
    from gridcast.plans.evaluation import best_persistence_lag

    return best_persistence_lag(_power(spark, d), _BEST_LAGS)


# --------------------------------------------------------------- scalers

_SCALE = ["wind_speed_10m", "wind_speed_100m", "temperature_2m", "pressure_msl", "cloud_cover_low"]


@query("standard_scale", O.with_ctes(O.base_ctes("weather_hour") + [("st", "select " + ", ".join(
    f"avg({c}) as {c}_m, case when stddev_pop({c}) = 0 then 1 else stddev_pop({c}) end as {c}_s"
    for c in _SCALE) + " from weather_hour")], f"""
select site_name, delivery_time, {', '.join(O.rd(f'({c} - st.{c}_m) / st.{c}_s', c) for c in _SCALE)}
from weather_hour, st"""))
def q_standard_scale(spark, d):
    """Mean / population-std scaling (zero std -> 1)."""
    w = fx.weather_hour(spark, d)
    return scale.fit_standard(w, _SCALE).transform(w).select(R.group, R.time, *_SCALE)


@query("minmax_scale", O.with_ctes(O.base_ctes("weather_hour") + [("st", "select " + ", ".join(
    f"min({c}) as {c}_lo, case when max({c}) - min({c}) = 0 then 1 else max({c}) - min({c}) end as {c}_r"
    for c in _SCALE) + " from weather_hour")], f"""
select site_name, delivery_time, {', '.join(O.rd(f'({c} - st.{c}_lo) / st.{c}_r', c) for c in _SCALE)}
from weather_hour, st"""))
def q_minmax_scale(spark, d):
    """Min-max scaling to [0, 1] (zero range -> 1)."""
    w = fx.weather_hour(spark, d)
    return scale.fit_minmax(w, _SCALE).transform(w).select(R.group, R.time, *_SCALE)


# ------------------------------------------------------------------ kNN

@query("knn_regression", f"""
with e as (select vec_id, cast(embedding as double[]) as v, cast(label as double) as y from embeddings),
pr as (select a.vec_id as q, b.vec_id as r, b.y,
         sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))) as d
       from e a join e b on a.vec_id <> b.vec_id),
tk as (select * from (select *, row_number() over (partition by q order by d, r) as rn from pr) t
       where rn <= {KNN_K})
select q as vec_id, {O.rd('case when min(d) = 0 then avg(case when d = 0 then y end) '
                          'else sum(y / d) / sum(1.0e0 / d) end', 'prediction')},
       count(*) as n_neighbors
from tk group by q""")
def q_knn_regression(spark, d):
    """Leave-one-out 5-NN regression of the label over the
    embeddings (Euclidean, 1/d weights), exact via pivot cells."""
    from gridcast.operators.knn import knn_regress

    e = fx.table(spark, d, "embeddings")
    return knn_regress(e, e, features="embedding", target="label", train_id="vec_id", query_id="vec_id",
                       k=KNN_K, p=2, weights="distance", exclude_self=True)


# -------------------------------------------------------- experiments

SWEEP_MODELS = ("lstm", "transformer")
SWEEP_LENGTHS = (6, 12, 24, 48)
SWEEP_DROP = (False, True)


@query("experiment_grid", O.with_ctes(O.base_ctes("power_hour") + [PN, ("s", """
select site_name as site, row_number() over (order by site_name) - 1 as site_index
from (select distinct site_name from pn where site_name is not null) x""")], """
select cast(s.site_index as bigint) as site_index, s.site, m.model, cast(l.seq_len as bigint) as seq_len,
  dp.drop_prod,
  m.model || '_seq' || cast(l.seq_len as varchar) || '_' || case when dp.drop_prod then 'no_prod' else 'with_prod' end
    as name
from s, (values ('lstm'), ('transformer')) m(model), (values (6), (12), (24), (48)) l(seq_len),
     (values (false), (true)) dp(drop_prod)"""))
def q_experiment_grid(spark, d):
    """Site x model x sequence length x drop option, with run names."""
    from gridcast.plans.run import experiment_grid

    return experiment_grid(_power(spark, d), SWEEP_MODELS, SWEEP_LENGTHS, SWEEP_DROP)


# ------------------------------------------------- models (rows-only checks)

FOREST = {"n_estimators": 200, "max_depth": 10, "random_state": 42}


def _model_split(spark, d):
    from gridcast.plans.tuning import feature_columns

    from gridcast.session import materialize

    # one written copy of the feature frame feeds every fit and prediction
    mf = materialize(model_frame(spark, d))
    train, test = split.split_time(mf, SPLIT_FRACTION)
    return train, test, feature_columns(mf)


def _forecast(spark, d, model_type, params):
    from gridcast.operators.models import fit_model, predict

    train, test, feats = _model_split(spark, d)
    m = fit_model(train, feats, Y, model_type, params)
    return metrics.prediction_frame(predict(m, test), "prediction")


@query("forest_forecast")
def q_forest_forecast(spark, d):
    """M1/M5: random-forest forecast of the test period (prediction frame)."""
    return _forecast(spark, d, "random_forest", FOREST)


@query("boosted_forecast")
def q_boosted_forecast(spark, d):
    """M2/M5: gradient-boosted trees forecast of the test period."""
    from gridcast.operators.models import MAIN_PARAMS

    return _forecast(spark, d, "xgboost", MAIN_PARAMS["xgboost"])


# Trees whose every split SQL can find: few distinct values a feature, so all midpoints are tried.
TREE_FEATURES = ("hour", "day_of_week", "precipitation")
TREE_DEPTH, BOOST_ROUNDS, BOOST_RATE = 3, 3, 0.5


def _tree_frame_ctes() -> list[tuple[str, str]]:
    values = "union all ".join(f"select r, tr, {i} as f, v{i} as v from b0 " for i in range(len(TREE_FEATURES)))
    return O.base_ctes("power_hour", "weather_hour") + [
        PN, ("mm", f"""select p.site_name, p.delivery_time, p.{Y} as y, cast(hour(p.delivery_time) as double) as v0,
  isodow(p.delivery_time) - 1.0e0 as v1, precipitation as v2
from pn p join weather_hour w on p.site_name = w.site_name and p.delivery_time = w.delivery_time"""),
        ("th", _THR.replace("from pn)", "from mm)")),
        ("b0", "select *, row_number() over (order by delivery_time, site_name) as r, delivery_time < thr as tr from mm, th"),
        ("lg", values),
        ("cd", """select f, (v + nx) / 2 as thr from (select f, v, lead(v) over (partition by f order by v) as nx
  from (select distinct f, v from lg where tr) x) y where nx is not null""")]


def _tree_ctes(name: str, target: str, depth: int) -> list[tuple[str, str]]:
    """Greedy variance splits of ``target`` (a table ``r, t``), ending in ``name`` (``r, p``)."""
    ctes = [(f"{name}_n0", f"select r, t, tr, 0 as node from {target} join b0 using (r)")]
    for k in range(depth):
        n = f"{name}_n{k}"
        ctes += [
            (f"{name}_s{k}", f"select node, f, v, count(*) as c, sum(t) as s from {n} join lg using (r) where {n}.tr group by node, f, v"),
            (f"{name}_g{k}", f"""select node, f, thr, sum(case when v <= thr then c else 0 end) as nl, sum(case when v <= thr then s else 0 end) as sl,
  sum(c) as n, sum(s) as t from {name}_s{k} join cd using (f) group by node, f, thr"""),
            (f"{name}_b{k}", f"""select node, f, thr from (select *, sl * sl / nl + (t - sl) * (t - sl) / (n - nl) - t * t / n as gain from {name}_g{k}
  where nl > 0 and nl < n) x where gain > 1e-12 qualify row_number() over (partition by node order by round(gain, 9) desc, f, thr) = 1"""),
            (f"{name}_n{k + 1}", f"""select a.r, a.t, a.tr, case when b.node is null then a.node when lg.v <= b.thr then 2 * a.node + 1
  else 2 * a.node + 2 end as node from {n} a left join {name}_b{k} b on a.node = b.node left join lg on lg.r = a.r and lg.f = b.f""")]
    last = f"{name}_n{depth}"
    return ctes + [(name, f"select r, p from {last} join (select node, avg(t) as p from {last} where tr group by node) x using (node)")]


def _tree_sql(rounds: int) -> str:
    """The sum of ``rounds`` trees, each on twice the residual of those before it (squared loss)."""
    ctes, before = _tree_frame_ctes() + [("t0", "select r, y as t from b0")], ""
    for i in range(rounds):
        ctes += _tree_ctes(f"tree{i}", f"t{i}", TREE_DEPTH)
        score = f"select r, p from tree{i}" if not before else f"select r, a.p + {BOOST_RATE}e0 * b.p as p from {before} a join tree{i} b using (r)"
        before = f"f{i}"
        ctes += [(before, score), (f"t{i + 1}", f"select r, 2 * (y - p) as t from b0 join {before} using (r)")]
    return O.with_ctes(ctes, f"""select delivery_time as timestamp, site_name as "group", {O.rd('y', 'y_true')}, {O.rd('p', 'y_pred')}
from b0 join {before} using (r) where not tr""")


def _tree_table_forecast(spark, d, model_type, params):
    from gridcast.operators.models import fit_model
    from gridcast.operators.trees import read_trees
    from gridcast.session import materialize

    frame = materialize(calendar_features(panel.normalize_target(_joined(spark, d))).select(R.group, R.time, Y, *TREE_FEATURES))
    train, test = split.split_time(frame, SPLIT_FRACTION)
    path = f"{checkpoint_dir(spark)}/models-{uuid.uuid4().hex}"
    fit_model(train, TREE_FEATURES, Y, model_type, params).save(path)
    return metrics.prediction_frame(read_trees(spark, path).predict(test), "prediction")


@query("regression_tree", _tree_sql(1))
def q_regression_tree(spark, d):
    """A saved tree without bootstrap, read as node rows and walked by joins."""
    return _tree_table_forecast(spark, d, "random_forest", {"n_estimators": 1, "max_depth": TREE_DEPTH, "bootstrap": False})


@query("boosted_trees", _tree_sql(BOOST_ROUNDS))
def q_boosted_trees(spark, d):
    """Saved boosted trees, read as node rows and walked by joins."""
    return _tree_table_forecast(spark, d, "boosted", {"n_estimators": BOOST_ROUNDS, "max_depth": TREE_DEPTH, "learning_rate": BOOST_RATE})


def _model_rows_ctes() -> list[tuple[str, str]]:
    """Complete model rows with their feature list, split at the threshold."""
    cols = _mm_columns()
    feats = ", ".join(f"cast({c} as double)" for c in cols if c not in ("site_name", "delivery_time", Y))
    complete = " and ".join(f"{c} is not null" for c in cols)
    return _pipeline_ctes() + [
        ("mm", f"select site_name, delivery_time, {Y} as y, [{feats}] as v, "
               f"row_number() over (order by site_name, delivery_time) as r from cl where {complete}"),
        ("th", _THR.replace("from pn)", "from mm)")),
        ("tr", "select mm.* from mm, th where delivery_time < th.thr"),
        ("te", "select mm.* from mm, th where delivery_time >= th.thr")]


_L1 = "list_sum(list_transform(list_zip(a.v, b.v), lambda x: abs(x[1] - x[2])))"
_L2 = "sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))))"
_BY_DISTANCE = "case when min(d) = 0 then avg(case when d = 0 then y end) else sum(y / d) / sum(1.0e0 / d) end"


def _knn_forecast_sql(k: int) -> str:
    ctes = _model_rows_ctes() + [
        ("pr", f"select a.r as q, b.r, b.y, {_L2} as d from te a cross join tr b"),
        ("tk", f"select * from (select *, row_number() over (partition by q order by d, r) as rn from pr) t where rn <= {k}"),
        ("kp", f"select q, {_BY_DISTANCE} as p from tk group by q")]
    return O.with_ctes(ctes, f"""select te.delivery_time as timestamp, te.site_name as "group", {O.rd('te.y', 'y_true')},
  {O.rd('kp.p', 'y_pred')} from te join kp on kp.q = te.r""")


def _knn_cv_ctes(trials: list[dict]) -> list[tuple[str, str]]:
    """Fold errors ``trial, fold, mae`` of kNN parameter sets over the folds."""
    ctes = _model_rows_ctes() + [
        ("ut", "select distinct delivery_time from tr"),
        ("un", f"select count(*) as n, count(*) // {N_FOLDS + 1} as s from ut"),
        ("ur", "select delivery_time, row_number() over (order by delivery_time) - 1 as r from ut"),
        ("fb", f"""select i as fold, (select delivery_time from ur where r = un.n - ({N_FOLDS} - i) * un.s) as lo,
  (select delivery_time from ur where r = un.n - ({N_FOLDS - 1} - i) * un.s) as hi from un, range({N_FOLDS}) t(i)"""),
        ("pr", f"""select fb.fold, a.r as q, a.y as truth, b.r, b.y, {_L1} as d1, {_L2} as d2 from fb
  join tr a on a.delivery_time >= fb.lo and (fb.hi is null or a.delivery_time < fb.hi) join tr b on b.delivery_time < fb.lo""")]
    kinds = sorted({t["p"] for t in trials})
    most = {p: max(t["n_neighbors"] for t in trials if t["p"] == p) for p in kinds}
    ranked = " union all ".join(f"""select {p} as p, fold, q, truth, y, d{p} as d,
  row_number() over (partition by fold, q order by d{p}, r) as rn from pr qualify rn <= {most[p]}""" for p in kinds)
    table = ", ".join(f"({i}, {t['n_neighbors']}, '{t['weights']}', {t['p']})" for i, t in enumerate(trials))
    return ctes + [
        ("rk", ranked), ("tt", f"select * from (values {table}) x(trial, k, weights, p)"),
        ("fm", f"""select trial, fold, avg(abs(pr - truth)) as mae from (
  select trial, fold, q, any_value(truth) as truth, case when weights = 'uniform' then avg(y) else {_BY_DISTANCE} end as pr
  from rk join tt on rk.p = tt.p and rn <= k group by trial, fold, q, weights) x group by trial, fold""")]


KNN_PARAMS = {"n_neighbors": 25, "weights": "distance", "p": 2}


def _search_trials(n: int) -> list[dict]:
    import random

    from gridcast.plans.tuning import RANDOM_SEED, sample_params

    rng = random.Random(RANDOM_SEED)
    return [sample_params("knn", rng) for _ in range(n)]


def _param_search_sql(n: int) -> str:
    trials = _search_trials(n)
    names = ", ".join(f"({i}, '{json.dumps(t, sort_keys=True)}')" for i, t in enumerate(trials))
    return O.with_ctes(_knn_cv_ctes(trials), f"""select cast(trial as bigint) as trial, params, {O.rd('avg(mae)', 'cv_mae')}
from fm join (values {names}) n(trial, params) using (trial) group by trial, params""")


@query("knn_forecast", _knn_forecast_sql(25))
def q_knn_forecast(spark, d):
    """M3/M5: kNN forecast of the test period on the model features."""
    return _forecast(spark, d, "knn", {"n_neighbors": 25, "weights": "distance"})


@query("saved_knn_forecast", _knn_forecast_sql(25))
def q_saved_knn_forecast(spark, d):
    """The kNN forecast by a model that was saved, saved again and read back."""
    from gridcast.operators.models import ForecastModel, fit_model, predict

    train, test, feats = _model_split(spark, d)
    path = f"{checkpoint_dir(spark)}/models-{uuid.uuid4().hex}"
    fit_model(train, feats, Y, "knn", {"n_neighbors": 3, "weights": "uniform"}).save(path)  # an older version
    fit_model(train, feats, Y, "knn", {"n_neighbors": 25, "weights": "distance"}).save(path)
    return metrics.prediction_frame(predict(ForecastModel.load(path), test), "prediction")


@query("sequence_forecast")
def q_sequence_forecast(spark, d):
    """12-step sequence regression of the test period."""
    from gridcast.plans.run import sequence_predictions

    train, test, feats = _model_split(spark, d)
    pred, _ = sequence_predictions(train, test, feats, 12, "lstm")
    return pred


@query("cv_mae", O.with_ctes(_knn_cv_ctes([KNN_PARAMS]), f"""
select cast(fold as bigint) as fold, {O.rd('mae', 'mae')} from fm"""))
def q_cv_mae(spark, d):
    """M7: fold MAEs of a kNN regression over five expanding time folds."""
    from gridcast.plans.tuning import knn_fold_errors

    train, _, feats = _model_split(spark, d)
    return knn_fold_errors(train, [KNN_PARAMS], N_FOLDS, features=feats).select("fold", "mae")


N_TRIALS = 50


@query("param_search", _param_search_sql(N_TRIALS))
def q_param_search(spark, d):
    """M8/O2: fifty kNN trials over its whole search space, best first."""
    from gridcast.plans.tuning import param_search

    train, _, feats = _model_split(spark, d)
    trials = param_search(train, "knn", N_TRIALS, N_FOLDS, features=feats)
    return trials.orderBy("cv_mae", "trial")


LINEAR_FEATURES = ("production_lag24h", "wind_speed_100m", "temperature_2m", "pressure_msl")


def _linear_cv_sql() -> str:
    """Least squares per fold: covariances of the training rows, then Gaussian
    elimination written out for the four features."""
    n = len(LINEAR_FEATURES)
    v = [f"cast({c} as double)" for c in LINEAR_FEATURES]
    terms = [f"covar_pop(b.{x}, b.{z}) as a{i}{j}" for i, x in enumerate(LINEAR_FEATURES) for j, z in enumerate(LINEAR_FEATURES)]
    terms += [f"covar_pop(b.{x}, b.y) as b{i}" for i, x in enumerate(LINEAR_FEATURES)]
    terms += [f"avg(b.{x}) as m{i}" for i, x in enumerate(LINEAR_FEATURES)] + ["avg(b.y) as my"]
    ctes = [c for c in _knn_cv_ctes([KNN_PARAMS]) if c[0] not in ("pr", "rk", "tt", "fm", "tr", "te")]
    ctes = [(k, q.replace("select site_name", "select " + ", ".join(f"{x} as {c}" for x, c in zip(v, LINEAR_FEATURES)) + ", site_name", 1))
            if k == "mm" else (k, q) for k, q in ctes]
    at = next(i for i, c in enumerate(ctes) if c[0] == "th") + 1
    ctes.insert(at, ("tr", "select mm.* from mm, th where delivery_time < th.thr"))
    ctes.append(("e0", f"select fb.fold, {', '.join(terms)} from fb join tr b on b.delivery_time < fb.lo group by fb.fold"))
    for k in range(n - 1):
        new = [f"a{i}{j} - a{i}{k} / a{k}{k} * a{k}{j} as a{i}{j}" for i in range(k + 1, n) for j in range(k + 1, n)]
        new += [f"b{i} - a{i}{k} / a{k}{k} * b{k} as b{i}" for i in range(k + 1, n)]
        ctes.append((f"e{k + 1}", f"select * replace ({', '.join(new)}) from e{k}"))
    prev = f"e{n - 1}"
    for k in range(n - 1, -1, -1):
        rest = "".join(f" - a{k}{j} * c{j}" for j in range(k + 1, n))
        ctes.append((f"s{k}", f"select *, (b{k}{rest}) / a{k}{k} as c{k} from {prev}"))
        prev = f"s{k}"
    pred = "s0.my" + "".join(f" + s0.c{i} * (a.{c} - s0.m{i})" for i, c in enumerate(LINEAR_FEATURES))
    return O.with_ctes(ctes, f"""select cast(s0.fold as bigint) as fold, {O.rd(f'avg(abs({pred} - a.y))', 'mae')} from s0
  join fb on fb.fold = s0.fold join tr a on a.delivery_time >= fb.lo and (fb.hi is null or a.delivery_time < fb.hi) group by s0.fold""")


@query("linear_cv", _linear_cv_sql())
def q_linear_cv(spark, d):
    """M7: fold MAEs of a linear regression, all folds from merged statistics of the fold ranges."""
    from gridcast.plans.tuning import linear_fold_errors

    train, _, _ = _model_split(spark, d)
    return linear_fold_errors(train, N_FOLDS, features=LINEAR_FEATURES)


@query("experiment_results")
def q_experiment_results(spark, d):
    """Sequence sweep over all sites, models, lengths and drop options, each
    fitted by itself; failed runs are rows with an error text."""
    from gridcast.plans.run import experiment_grid
    from gridcast.plans.sweep import SweepConfig, run_sweep

    frame = clean.clip_rules(process(_joined(spark, d), R, POWER_CFG))
    grid = experiment_grid(frame, SWEEP_MODELS, SWEEP_LENGTHS, SWEEP_DROP)
    production = (*lags.lag_names(POWER_LAGS), *lags.rolling_names(POWER_ROLLING))
    return run_sweep(spark, frame, grid, SweepConfig(test_size=0.2, production_columns=production))
