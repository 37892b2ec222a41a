"""Independent DuckDB SQL for every SQL-expressible registered query.

Written from the operator semantics, not from the Spark plans: windows use
plain ``partition by site`` frames and band joins, which is fine at the
check's scale. Each builder returns CTE text so queries compose like the
Spark pipeline does. Output doubles are rounded to 9 places with the same
binary formula as :func:`gridcast.plans.queries.finish` does.
"""

from __future__ import annotations

import re

# ---------------------------------------------------------------- fixtures

POWER_HOUR = """select event_type as site_name, date_trunc('hour', ts) as delivery_time,
       sum(cast(round(value*100) as bigint))/100.0e0 as production,
       case when event_type='error' then 0.0e0 else 500.0e0 end as installed_capacity
from events group by event_type, date_trunc('hour', ts)"""

WEATHER_HOUR = """select event_type as site_name, date_trunc('hour', ts) as delivery_time,
       sum(user_id % 25)*1.0e0/count(*) as wind_speed_10m,
       max(user_id % 40)*1.0e0 as wind_speed_100m,
       max(event_id % 50)*1.0e0 as wind_gusts_10m,
       max(event_id*53 % 360)*1.0e0 as wind_direction_10m,
       min(event_id*37 % 360)*1.0e0 as wind_direction_100m,
       min(event_id % 35)-5.0e0 as temperature_2m,
       980.0e0+max(event_id % 60) as pressure_msl,
       min(event_id % 7)-1.0e0 as precipitation,
       count(*)*1.0e0 as cloud_cover_low
from events group by event_type, date_trunc('hour', ts)"""

SHIP_DAY = """select l_returnflag as site_name, l_shipdate as delivery_time,
       sum(l_quantity) as production, 50.0e0*count(*) as installed_capacity
from lineitem group by l_returnflag, l_shipdate"""



def ship_day_by(site_expr: str) -> str:
    """``ship_day`` with another site column (e.g. one site per supplier)."""
    return SHIP_DAY.replace("select l_returnflag as site_name", f"select {site_expr} as site_name").replace(
        "group by l_returnflag, l_shipdate", f"group by {site_expr}, l_shipdate")


Y = "production_normalized"
HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


def rd(expr: str, alias: str | None = None, digits: int = 9) -> str:
    """Round half up in binary arithmetic (identical in both engines); values
    of 9e6 or more stay as they are."""
    k, x = f"1e{digits}", f"cast({expr} as double)"
    out = f"(case when abs({x}) < 9e6 then floor({x} * {k} + 0.5e0) / {k} else {x} end)"
    return f"{out} as {alias}" if alias else out


def rounded_columns(sql: str) -> list[str]:
    """Output columns that :func:`rd` rounds in a query."""
    return re.findall(r" end\) as \"?(\w+)", sql)


def normalized(src: str) -> str:
    return (f"select *, {src}_n.production / {src}_n.installed_capacity as {Y} "
            f"from {src} as {src}_n where installed_capacity is null or installed_capacity <> 0")


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} as (\n{sql}\n)" for name, sql in ctes)
    return f"with {body}\n{final}"


def base_ctes(*names: str) -> list[tuple[str, str]]:
    table = {"power_hour": POWER_HOUR, "weather_hour": WEATHER_HOUR, "ship_day": SHIP_DAY}
    out = []
    for n in names:
        out.append((n, table[n]))
    return out


# ------------------------------------------------------------ operators

def positions_cte(src: str, out: str) -> list[tuple[str, str]]:
    return [(out, f"select *, row_number() over (partition by site_name order by delivery_time) - 1 as _pos "
                  f"from {src} where site_name is not null and delivery_time is not null")]


def interval_cte(src_pos: str, out: str) -> list[tuple[str, str]]:
    return [(out, f"""select g.site_name, case when m.med > 0 then m.med else 3600.0e0 end as interval_s
from (select distinct site_name from {src_pos}) g left join (
  select site_name, median(d) as med from (
    select site_name, (epoch_us(delivery_time) - lag(epoch_us(delivery_time))
           over (partition by site_name order by _pos)) / 1e6 as d from {src_pos}) x
  where d is not null group by site_name) m on m.site_name = g.site_name""")]


def plateau_ctes(src: str, out: str, half_s: float = 43200.0, n_min: int = 5, tol: float = 0.01,
                 low: float = 0.1, high: float = 0.9) -> list[tuple[str, str]]:
    """Adds ``is_not_plateau`` and ``_pos`` to ``src`` rows."""
    ctes = positions_cte(src, f"{out}_p") + interval_cte(f"{out}_p", f"{out}_iv")
    ctes.append((f"{out}_g", f"""select iv.site_name,
  greatest(1, cast(floor({half_s}e0 / iv.interval_s) as bigint)) as n, mx.pmax
from {out}_iv iv join (select site_name, max({Y}) as pmax from {out}_p group by site_name) mx
  on mx.site_name = iv.site_name"""))
    ctes.append((f"{out}_c", f"""select p.site_name, p._pos, count(*) as c
from {out}_p p join {out}_g g on g.site_name = p.site_name
join {out}_p q on q.site_name = p.site_name and q._pos between p._pos - g.n and p._pos + g.n
where abs(q.{Y} - p.{Y}) < {tol}e0
group by p.site_name, p._pos"""))
    ctes.append((out, f"""select p.*, coalesce(not (coalesce(c.c, 0) >= {n_min}
    and p.{Y} >= g.pmax * {low}e0 and p.{Y} <= g.pmax * {high}e0), true) as is_not_plateau
from {out}_p p join {out}_g g on g.site_name = p.site_name
left join {out}_c c on c.site_name = p.site_name and c._pos = p._pos"""))
    return ctes


def interpolate_ctes(src_pos: str, out: str, limit: int = 6, y: str = Y) -> list[tuple[str, str]]:
    """Linear-in-time interpolation over at most ``limit`` rows; ``src_pos`` has ``_pos``."""
    rec = f"case when {y} is not null then struct_pack(p := _pos, t := epoch_us(delivery_time), v := {y}) end"
    return [(f"{out}_w", f"""select *,
  last_value({rec} ignore nulls) over (partition by site_name order by _pos
      rows between unbounded preceding and 1 preceding) as _prv,
  first_value({rec} ignore nulls) over (partition by site_name order by _pos
      rows between 1 following and unbounded following) as _nxt
from {src_pos}"""),
            (out, f"""select * exclude (_prv, _nxt) replace (cast(case
    when {y} is not null then {y}
    when _prv is null then null
    when _pos - _prv.p > {limit} then null
    when _nxt is null then _prv.v
    else (_nxt.v - _prv.v) / cast(_nxt.t - _prv.t as double)
         * cast(epoch_us(delivery_time) - _prv.t as double) + _prv.v end as double) as {y})
from {out}_w""")]


def impute_ctes(src_flagged: str, out: str, limit: int = 6) -> list[tuple[str, str]]:
    ctes = [(f"{out}_m", f"select * replace (case when is_not_plateau = false then null else {Y} end as {Y}) "
                         f"from {src_flagged}")]
    ctes += interpolate_ctes(f"{out}_m", f"{out}_z", limit)
    ctes.append((f"{out}_hp", f"select site_name, hour(delivery_time) as h, avg({Y}) as hm from {out}_z group by 1, 2"))
    ctes.append((f"{out}_md", f"select site_name, median({Y}) as md from {out}_z group by 1"))
    ctes.append((out, f"""select z.* replace (coalesce(z.{Y}, hp.hm, md.md) as {Y})
from {out}_z z left join {out}_hp hp on hp.site_name = z.site_name and hp.h = hour(z.delivery_time)
left join {out}_md md on md.site_name = z.site_name"""))
    return ctes


def required_sql(src: str, with_raw: bool = True) -> str:
    cond = f"delivery_time is not null and {Y} is not null and site_name is not null"
    if with_raw:
        cond += " and production is not null and installed_capacity is not null"
    return f"select * from {src} where {cond} and (installed_capacity is null or installed_capacity <> 0)"


CALENDAR_COLS = ["hour", "day_of_week", "month", "month_sin", "month_cos", "is_weekend", "is_night",
                 "hour_sin", "hour_cos", "dow_sin", "dow_cos"]


def calendar_sql(src: str) -> str:
    return f"""select *,
  sin(2*pi() * month / 12) as month_sin, cos(2*pi() * month / 12) as month_cos,
  cast(day_of_week >= 5 as bigint) as is_weekend, cast(hour < 6 or hour >= 22 as bigint) as is_night,
  sin(2*pi() * hour / 24) as hour_sin, cos(2*pi() * hour / 24) as hour_cos,
  sin(2*pi() * day_of_week / 7) as dow_sin, cos(2*pi() * day_of_week / 7) as dow_cos
from (select *, hour(delivery_time) as hour, isodow(delivery_time) - 1 as day_of_week,
             month(delivery_time) as month from {src}) c"""


WEATHER_COLS = ["wind_speed_diff", "wind_speed_10m_squared", "wind_speed_10m_cubed", "wind_speed_100m_squared",
                "wind_speed_100m_cubed", "wind_speed_ratio", "wind_shear_alpha"]


def _floor(c: str, lo: str) -> str:
    return f"(case when {c} < {lo} then {lo} else {c} end)"


def weather_sql(src: str) -> str:
    return f"""select * replace (ln(1 + {_floor('precipitation', '0.0e0')}) as precipitation),
  wind_speed_100m - wind_speed_10m as wind_speed_diff,
  wind_speed_10m * wind_speed_10m as wind_speed_10m_squared, pow(wind_speed_10m, 3) as wind_speed_10m_cubed,
  wind_speed_100m * wind_speed_100m as wind_speed_100m_squared, pow(wind_speed_100m, 3) as wind_speed_100m_cubed,
  wind_speed_100m / (wind_speed_10m + 1e-8) as wind_speed_ratio,
  ln({_floor('wind_speed_100m', '0.5e0')} / {_floor('wind_speed_10m', '0.5e0')}) / ln(10.0e0) as wind_shear_alpha
from {src}"""


PHYSICS_COLS = ["wind_u_100m", "wind_v_100m", "wind_u_10m", "wind_v_10m", "air_density", "theoretical_power"]


def physics_sql(src: str) -> str:
    return f"""select *, air_density * pow(wind_speed_100m, 3) as theoretical_power from (
select *,
  -wind_speed_100m * sin(radians(wind_direction_100m)) as wind_u_100m,
  -wind_speed_100m * cos(radians(wind_direction_100m)) as wind_v_100m,
  -wind_speed_10m * sin(radians(wind_direction_10m)) as wind_u_10m,
  -wind_speed_10m * cos(radians(wind_direction_10m)) as wind_v_10m,
  pressure_msl / (287.05e0 * (temperature_2m + 273.15e0)) as air_density
from {src}) ph"""


def clamp(c: str, lo: float | None, hi: float | None) -> str:
    e = c
    if lo is not None:
        e = f"(case when {e} < {lo}e0 then {lo}e0 else {e} end)"
    if hi is not None:
        e = f"(case when {e} > {hi}e0 then {hi}e0 else {e} end)"
    return e


def clip_sql(src: str, columns: list[str]) -> str:
    """The default clip rules over the given column list."""
    reps = []
    for c in columns:
        if "wind_speed" in c or "wind_gusts" in c:
            reps.append(f"{clamp(c, 0.0, 45.0)} as {c}")
    if "theoretical_power" in columns:
        reps.append(f"{clamp('theoretical_power', 0.0, 5.0)} as theoretical_power")
    if "wind_shear_alpha" in columns:
        inner = ("coalesce(case when abs(wind_shear_alpha) = 'inf'::double then 0.0e0 "
                 "else wind_shear_alpha end, 0.0e0)")
        reps.append(f"{clamp(inner, -0.5, 1.0)} as wind_shear_alpha")
    return f"select * replace ({', '.join(reps)}) from {src}"


def lag_sql(src: str, lags: list[int], shift: int, rolling: list[tuple[int, int, str]], step_us: int,
            unit: str = "h", keep_flag_filter: bool = True) -> str:
    """Lags as equality joins on time and rolling stats as range frames over
    on-grid rows (the fixtures are on their grid and unique)."""
    t = "epoch_us(delivery_time)"
    cols, joins = [], []
    for i, L in enumerate(lags):
        joins.append(f"left join {src} l{i} on l{i}.site_name = s.site_name "
                     f"and epoch_us(l{i}.delivery_time) = epoch_us(s.delivery_time) - {L * step_us}")
        cols.append(f"l{i}.{Y} as production_lag{L}{unit}")
    for w, minp, label in rolling:
        fr = (f"over (partition by site_name order by {t} range between {(shift + w - 1) * step_us} preceding "
              f"and {shift * step_us} preceding)")
        cols.append(f"case when count({Y}) {fr} >= {minp} then avg({Y}) {fr} end as production_rolling_mean_{label}")
        cols.append(f"case when count({Y}) {fr} >= {minp} then stddev_samp({Y}) {fr} end "
                    f"as production_rolling_std_{label}")
    roll = [c for c in cols if "rolling" in c]
    lagc = [c for c in cols if "rolling" not in c]
    inner = f"select s.*, {', '.join(lagc)} from {src} s {' '.join(joins)}" if lagc else f"select * from {src}"
    out = f"select *{', ' if roll else ''}{', '.join(roll)} from ({inner}) lg"
    if keep_flag_filter:
        out = f"select * from ({out}) f where coalesce(is_not_plateau, false)"
    return out
