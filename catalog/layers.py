"""Whole layers: staging, analytics, SQL preset, visibility enrichment, windows of a job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog import views
from catalog.registry import big, block, query, r
from daypanel.constants import (
    CONTEXT_COLUMNS, FILL_STRATEGIES, OUTLIER_COLUMNS, SECTORS, STAGING_DECIMALS, STAGING_INTEGERS,
    VISIBILITY_MEASURES, WEATHER_MEASURES,
)
from daypanel.operators import clean, rollup
from daypanel.plans import jobs, layers

MEASURES = WEATHER_MEASURES + VISIBILITY_MEASURES

block(
    "joined", "weather,vis",
    f"SELECT w.*, v.visibility_mean, v.visibility_min, CAST(v.visibility_hours_below_1km AS INTEGER) AS visibility_hours_below_1km, "
    "CASE WHEN v.visibility_mean IS NOT NULL THEN 1 ELSE 0 END AS visibility_is_known "
    "FROM weather w LEFT JOIN vis v USING (city, date)",
)


def _filled(c: str, strategy: str) -> str:
    if strategy == "zero":
        return f"coalesce({c}, 0) AS {c}"
    if strategy == "ffill":
        return (
            f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY city ORDER BY date ROWS UNBOUNDED PRECEDING), "
            f"first_value({c} IGNORE NULLS) OVER (PARTITION BY city ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS {c}"
        )
    if strategy == "median":
        return f"coalesce({c}, median({c}) OVER (PARTITION BY city)) AS {c}"
    if strategy == "mode":
        return f"coalesce({c}, (SELECT m FROM mode_{c} x WHERE x.city = joined.city)) AS {c}"
    return c


def mode_block(source: str, c: str) -> str:
    return (
        f"SELECT city, {c} AS m FROM (SELECT city, {c}, row_number() OVER (PARTITION BY city ORDER BY count(*) DESC, {c}) AS i "
        f"FROM {source} WHERE {c} IS NOT NULL GROUP BY city, {c}) WHERE i = 1"
    )


block("mode_weather_code", "joined", mode_block("joined", "weather_code"))
block(
    "filled", "joined,mode_weather_code",
    f"SELECT city, date, {', '.join(_filled(c, FILL_STRATEGIES[c]) for c in MEASURES)}, visibility_is_known FROM joined",
)


def _cap_case(c: str) -> str:
    cases = " ".join(f"WHEN city = '{n}' AND {c} > {v} THEN {v}" for n, v in views.CAPS[c].items())
    return f"CAST(CASE {cases} ELSE {c} END AS DOUBLE) AS {c}"


block(
    "capped", "filled",
    "SELECT city, date, "
    + ", ".join(_cap_case(c) if c in views.CAPS else c for c in MEASURES)
    + ", visibility_is_known FROM filled",
)


def _iqr_flag(c: str, k: float = 1.5) -> str:
    q1, q3 = (f"quantile_cont({c}, {p}) OVER (PARTITION BY city)" for p in (0.25, 0.75))
    return (
        f"coalesce(({q3} - {q1}) <> 0 AND ({c} < {q1} - {k} * ({q3} - {q1}) OR {c} > {q3} + {k} * ({q3} - {q1})), false) "
        f"AS {c}_is_outlier"
    )


block("staging", "capped", f"SELECT *, {', '.join(_iqr_flag(c) for c in OUTLIER_COLUMNS)} FROM capped")


def season_case(month: str) -> str:
    return (
        f"CASE WHEN {month} IN (12, 1, 2) THEN 'Winter' WHEN {month} IN (3, 4, 5) THEN 'Spring' "
        f"WHEN {month} IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END"
    )


SECTOR_SQL = (
    "(CAST(floor(((coalesce(wind_direction_10m_dominant, 0) + 22.5) % 360) / 45) AS INTEGER) % 8)"
)
FETCH_ROWS = ", ".join(
    f"('{n}', {i}, {float(km)})" for n, row in views.FETCH.items() for i, km in enumerate(row)
)
block("fetch_km", "", f"SELECT * FROM (VALUES {FETCH_ROWS}) AS x(fcity, fsector, km)")


def wave_sql(speed: str, km: str) -> str:
    u = f"CAST({speed} / 3.6::DOUBLE AS DOUBLE)"
    safe = f"(CASE WHEN {u} < 0.5 THEN 0.5 ELSE {u} END)"
    height = f"({safe} * {safe} * 0.283 / 9.81 * tanh(pow({km} * 1000.0 * 9.81 / ({safe} * {safe}), 0.42) * 0.0125))"
    return f"CASE WHEN {u} < 0.5 THEN 0.0 ELSE least({height}, 6.0) END"


block(
    "waved", "staging,fetch_km",
    f"SELECT s.*, {r(wave_sql('wind_speed_10m_max', 'coalesce(CAST(km AS DOUBLE), 200.0::DOUBLE)'), 2)} AS wave_height "
    f"FROM staging s LEFT JOIN fetch_km ON city = fcity AND {SECTOR_SQL} = fsector",
)


def roll(f: str, c: str, n: int) -> str:
    return f"{f}({c}) OVER (PARTITION BY city ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def lag(c: str, n: int = 1) -> str:
    return f"lag({c}, {n}) OVER (PARTITION BY city ORDER BY date)"


def anomaly(c: str) -> str:
    same = "OVER (PARTITION BY city, dayofyear(date))"
    z = f"({c} - avg({c}) {same}) / nullif(stddev_samp({c}) {same}, 0)"
    return f"coalesce({r(z, 3)}, 0.0::DOUBLE) AS {c}_anom"


TAU = "6.283185307179586::DOUBLE"
CALENDAR_SQL = f"""CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(dayofyear(date) AS INTEGER) AS day_of_year, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
  CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, {season_case('month(date)')} AS season,
  round(sin(month(date) * {TAU} / 12), 9) AS month_sin, round(cos(month(date) * {TAU} / 12), 9) AS month_cos,
  round(sin(dayofyear(date) * {TAU} / 365.25::DOUBLE), 9) AS doy_sin, round(cos(dayofyear(date) * {TAU} / 365.25::DOUBLE), 9) AS doy_cos"""
block(
    "featured", "waved",
    f"""SELECT *, {CALENDAR_SQL},
  temperature_2m_max - temperature_2m_min AS temp_range_c,
  {r(roll('avg', '(temperature_2m_max - temperature_2m_min)', 7), 2)} AS temp_range_7d,
  greatest(18.0::DOUBLE - temperature_2m_mean, 0) AS hdd, greatest(temperature_2m_mean - 18.0::DOUBLE, 0) AS cdd,
  {', '.join(f"{roll('avg', c, n)} AS {c}_{n}d_mean, {roll('max', c, n)} AS {c}_{n}d_max" for c in CONTEXT_COLUMNS for n in (7, 30))},
  {', '.join(anomaly(c) for c in CONTEXT_COLUMNS)},
  {', '.join(f"{lag(c, n)} AS {c}_lag{n}" for c in CONTEXT_COLUMNS for n in (1, 2))},
  coalesce(wind_speed_10m_max - {lag('wind_speed_10m_max')}, 0) AS wind_change_1d,
  {roll('max', 'wind_speed_10m_max', 3)} AS wind_3d_max,
  coalesce(precipitation_sum - {lag('precipitation_sum')}, 0) AS precip_change_1d,
  {roll('sum', 'precipitation_sum', 3)} AS precip_3d_sum,
  CAST(coalesce({roll('min', 'visibility_min', 3)} < 3000, false) AS INTEGER) AS low_visibility_recent
FROM waved""",
)
RISK_SQL = {
    "risk_wind": "wind_speed_10m_max > 50", "risk_gust": "wind_gusts_10m_max > 75", "risk_precip": "precipitation_sum > 15",
    "risk_snow": "snowfall_sum > 5", "risk_wave": "wave_height > 2.5::DOUBLE", "risk_visibility": "visibility_mean < 1000",
    "risk_fog_min": "visibility_min < 500",
}


def flag(test: str) -> str:
    return f"CAST(coalesce({test}, false) AS INTEGER)"


block(
    "daily", "featured",
    f"""SELECT *, {flag('wind_3d_max >= 40')} AS strong_wind_recent,
  {flag('wind_3d_max >= 40 AND precip_3d_sum >= 5')} AS wind_precip_combo,
  greatest({', '.join(flag(t) for t in [*RISK_SQL.values(), 'visibility_hours_below_1km > 4'])}) AS is_risk_day,
  {', '.join(f'{flag(t)} AS {n}' for n, t in RISK_SQL.items())}
FROM featured""",
)
CORE_SQL = f"""count(*) AS total_days, {big('sum(is_risk_day)')} AS risk_days,
  {r('sum(is_risk_day) * 100.0::DOUBLE / count(*)', 1)} AS risk_day_pct,
  CASE WHEN sum(is_risk_day) >= 5 THEN 1 ELSE 0 END AS high_risk_month,
  {', '.join(f"{big(f'sum(risk_{n})')} AS {n}_risk_days" for n in ('wind', 'gust', 'precip', 'snow', 'visibility'))},
  {r('avg(temperature_2m_mean)', 2)} AS temp_mean, max(temperature_2m_max) AS temp_max, min(temperature_2m_min) AS temp_min,
  {r('stddev_samp(temperature_2m_mean)', 2)} AS temp_std,
  {r('avg(wind_speed_10m_max)', 2)} AS wind_mean, max(wind_speed_10m_max) AS wind_max, {r('stddev_samp(wind_speed_10m_max)', 2)} AS wind_std,
  {r('sum(precipitation_sum)', 2)} AS precip_total, {r('avg(precipitation_sum)', 2)} AS precip_daily_avg, max(precipitation_sum) AS precip_max,
  {r('avg(visibility_mean)', 1)} AS vis_mean_avg, min(visibility_min) AS vis_min_worst"""
MONTH_KEYS_SQL = (
    "city, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(date_trunc('month', date) AS DATE) AS month_start"
)
MONTH_GROUP_SQL = "GROUP BY city, year(date), month(date), CAST(date_trunc('month', date) AS DATE)"
block(
    "monthly", "daily",
    f"""SELECT {MONTH_KEYS_SQL}, {CORE_SQL}, {big('sum(risk_wave)')} AS wave_risk_days, {big('sum(risk_fog_min)')} AS severe_fog_days,
  {r('sum(hdd)', 1)} AS hdd_total, {r('sum(cdd)', 1)} AS cdd_total, {r('avg(wave_height)', 2)} AS wave_mean, max(wave_height) AS wave_max
FROM daily {MONTH_GROUP_SQL}""",
)

# The SQL preset
KEYS = ("city", "date")


def _rounded(c: str) -> str:
    if c in STAGING_INTEGERS:
        return f"CAST({c} AS INTEGER) AS {c}"
    return f"round({c}, {STAGING_DECIMALS.get(c, 2)}) AS {c}"


block(
    "preset_staging", "weather,vis",
    f"SELECT city, date, {', '.join(_rounded(c) for c in MEASURES)} FROM weather LEFT JOIN vis USING (city, date) "
    "WHERE city IS NOT NULL AND date IS NOT NULL",
)
PRESET_SQL = {n: RISK_SQL[n] for n in ("risk_wind", "risk_gust", "risk_precip", "risk_snow", "risk_visibility")}
block(
    "preset_daily", "preset_staging",
    f"""SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(dayofweek(date) AS INTEGER) AS day_of_week,
  CAST(dayofyear(date) AS INTEGER) AS day_of_year, {season_case('month(date)')} AS season,
  {', '.join(f'{flag(t)} AS {n}' for n, t in PRESET_SQL.items())},
  greatest({', '.join(flag(t) for t in PRESET_SQL.values())}) AS is_risk_day,
  {roll('avg', 'wind_speed_10m_max', 7)} AS wind_speed_7d_avg, {roll('max', 'wind_speed_10m_max', 7)} AS wind_speed_7d_max,
  {roll('avg', 'precipitation_sum', 7)} AS precip_7d_avg, {roll('sum', 'precipitation_sum', 7)} AS precip_7d_sum,
  {roll('avg', 'temperature_2m_mean', 7)} AS temp_7d_avg, {lag('wind_speed_10m_max')} AS wind_speed_lag1,
  {lag('precipitation_sum')} AS precip_lag1, {lag('temperature_2m_mean')} AS temp_lag1
FROM preset_staging""",
)
block(
    "preset_monthly", "preset_daily",
    f"""SELECT {MONTH_KEYS_SQL}, {CORE_SQL},
  {r('avg(wind_gusts_10m_max)', 2)} AS gust_mean, max(wind_gusts_10m_max) AS gust_max,
  {big("count(*) FILTER (precipitation_sum = 0)")} AS dry_days, {r('sum(snowfall_sum)', 2)} AS snow_total, max(snowfall_sum) AS snow_max,
  {r('avg(surface_pressure_mean)', 2)} AS pressure_mean, {r('stddev_samp(surface_pressure_mean)', 2)} AS pressure_std,
  min(surface_pressure_mean) AS pressure_min, {r('avg(relative_humidity_2m_mean)', 2)} AS humidity_mean,
  max(relative_humidity_2m_mean) AS humidity_max, {big("count(*) FILTER (visibility_hours_below_1km >= 4)")} AS sustained_fog_days
FROM preset_daily {MONTH_GROUP_SQL}""",
)

# float sums of wave heights keep six digits, sines nine
NOISY = [f"wave_height_{n}d_mean" for n in (7, 30)]
CYCLIC = ["month_sin", "month_cos", "doy_sin", "doy_cos"]


def shown(df):
    new = {c: F.round(c, 6) for c in NOISY if c in df.columns}
    new.update({c: F.round(c, 9) for c in CYCLIC if c in df.columns})
    return df.withColumns(new)


SHOWN_SQL = "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in NOISY) + ") FROM "


@query("c1_staging", "@staging|SELECT * FROM staging")
def c1_staging(spark, sf):
    return views.staging(spark, sf)


@query("c2_feature_chain", "@featured|" + SHOWN_SQL + f"(SELECT *, {flag('wind_3d_max >= 40')} AS strong_wind_recent, {flag('wind_3d_max >= 40 AND precip_3d_sum >= 5')} AS wind_precip_combo FROM featured)")
def c2_feature_chain(spark, sf):
    from daypanel.operators.features import engineer_all_features

    return shown(engineer_all_features(views.staging(spark, sf), views.fetch(spark)))


@query("c3_analytics_daily", "@daily|" + SHOWN_SQL + "daily")
def c3_analytics_daily(spark, sf):
    return shown(views.daily(spark, sf))


@query("c4_preset_staging", "@preset_staging|SELECT * FROM preset_staging")
def c4_preset_staging(spark, sf):
    return views.preset(spark, sf)[0]


@query("c4_preset_daily", "@preset_daily|SELECT * FROM preset_daily")
def c4_preset_daily(spark, sf):
    return views.preset(spark, sf)[1]


@query("a2_monthly_summary", "@monthly|SELECT * FROM monthly")
def a2_monthly_summary(spark, sf):
    return views.monthly(spark, sf)


@query("a3_preset_monthly", "@preset_monthly|SELECT * FROM preset_monthly")
def a3_preset_monthly(spark, sf):
    return views.preset(spark, sf)[2]


ENRICHED_SQL = f"""@joined,hourly|WITH h AS (
  SELECT city, CAST(datetime AS DATE) AS date, {r('avg(visibility)', 1)} AS visibility_mean, min(visibility) AS visibility_min,
    {big('count(*) FILTER (visibility < 1000)')} AS visibility_hours_below_1km
  FROM hourly WHERE datetime >= DATE '2024-01-05' GROUP BY ALL),
d AS (SELECT city, CAST(datetime AS DATE) AS date, count(*) AS n_rows FROM hourly GROUP BY ALL)
SELECT * FROM d LEFT JOIN h USING (city, date)"""


@query("c7_enrich_visibility", ENRICHED_SQL)
def c7_enrich_visibility(spark, sf):
    hours = views.hourly(spark, sf)
    days = hours.groupBy("city", F.to_date("datetime").alias("date")).agg(F.count(F.lit(1)).alias("n_rows"))
    return layers.enrich_visibility(days, hours, "2024-01-05")


@query(
    "j2_visibility_coverage",
    f"@joined|SELECT count(visibility_mean) AS covered, count(*) AS rows, {r('count(visibility_mean) * 100.0::DOUBLE / count(*)', 1)} AS covered_pct FROM joined",
)
def j2_visibility_coverage(spark, sf):
    return layers.visibility_coverage(views.joined(spark, sf))


AS_OF = dt.date(2001, 11, 10)


@query(
    "x16_fetch_window",
    "@weather|SELECT CAST(min(m) - INTERVAL 3 DAY AS DATE) AS fetch_start, DATE '2001-11-09' AS fetch_end FROM (SELECT city, max(date) AS m FROM weather GROUP BY city)",
)
def x16_fetch_window(spark, sf):
    weather = views.weather(spark, sf)
    latest = rollup.latest_dates(weather.select("city").distinct(), weather)
    return jobs.fetch_window(latest, "incremental", AS_OF)


NULLS_SUM = lambda cols: " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in cols)


@query(
    "q15_cleaning_summary",
    f"""@joined,staging|SELECT (SELECT count(*) FROM joined) AS rows_in, count(*) AS rows_out,
  (SELECT {big(f'sum({NULLS_SUM(MEASURES)})')} FROM joined) - {big(f'sum({NULLS_SUM(MEASURES)})')} AS missing_filled,
  {big(f'sum({NULLS_SUM(MEASURES)})')} AS missing_remaining,
  (SELECT {big("sum(" + " + ".join(f"CAST(coalesce(city = '{n}' AND {c} > {v}, false) AS BIGINT)" for c, m in views.CAPS.items() for n, v in m.items()) + ")")} FROM weather) AS values_winsorized,
  {big("sum(" + " + ".join(f"CAST({c}_is_outlier AS BIGINT)" for c in OUTLIER_COLUMNS) + ")")} AS outlier_flags_set,
  (SELECT {big("sum(date_diff('day', a, b) + 1 - n)")} FROM (SELECT city, min(date) AS a, max(date) AS b, count(*) AS n FROM weather GROUP BY city)) AS date_gaps
FROM staging""",
)
def q15_cleaning_summary(spark, sf):
    from daypanel.operators.clean import add_known_flag

    before = add_known_flag(views.joined(spark, sf))
    return clean.cleaning_summary(before, views.staging(spark, sf), views.weather(spark, sf), views.caps(spark))
