"""Forecast table: features of future rows, offshore risk, daily rows and window summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog import views
from catalog.layers import SECTOR_SQL, lag, roll, shown, wave_sql
from catalog.learning import CLIM_SQL
from catalog.registry import big, block, query, r
from daypanel.operators import forecast as fc
from daypanel.operators import timeseries

START = dt.date(2001, 9, 1)


def future(spark, sf):
    """Open lines of the horizon stand for the forecast rows."""
    d = F.col("date")
    return views.forecast(spark, sf).where((d >= START) & (d <= START + dt.timedelta(days=15)))


F1_SQL = (
    "@staging,fetch_km|WITH u AS (SELECT * FROM staging WHERE date >= DATE '2001-09-01' - 7 AND date < DATE '2001-09-01' "
    "UNION ALL BY NAME SELECT * FROM {forecast} WHERE date BETWEEN DATE '2001-09-01' AND DATE '2001-09-16'), "
    f"w AS (SELECT u.*, {r(wave_sql('wind_speed_10m_max', 'coalesce(CAST(km AS DOUBLE), 200.0::DOUBLE)'), 2)} AS wave_height FROM u LEFT JOIN fetch_km ON city = fcity AND {SECTOR_SQL} = fsector), "
    f"f AS (SELECT city, date, {roll('max', 'wind_speed_10m_max', 3)} AS wind_3d_max, coalesce(wind_speed_10m_max - {lag('wind_speed_10m_max')}, 0) AS wind_change_1d, {roll('sum', 'precipitation_sum', 3)} AS precip_3d_sum, "
    f"wave_height, {roll('max', 'wave_height', 7)} AS wave_height_7d_max, temperature_2m_max - temperature_2m_min AS temp_range_c, CAST(NULL AS DOUBLE) AS not_there FROM w) "
    "SELECT * FROM f WHERE date >= DATE '2001-09-01'"
).replace("{forecast}", "forecast").replace("@staging,", "@staging,forecast,")


@query("f1_forecast_features", F1_SQL)
def f1(spark, sf):
    out = fc.forecast_features(views.staging(spark, sf), future(spark, sf), views.fetch(spark), ["temp_range_c", "not_there"])
    return shown(out).select("city", "date", "wind_3d_max", "wind_change_1d", "precip_3d_sum", "wave_height", "wave_height_7d_max", "temp_range_c", "not_there")


LAST = "OVER (PARTITION BY city ORDER BY date ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


@query(
    "f1_forecast_windows",
    "@staging,forecast|WITH u AS (SELECT city, date, wind_speed_10m_max FROM staging WHERE date >= DATE '2001-09-01' - 7 AND date < DATE '2001-09-01' "
    "UNION ALL SELECT city, date, wind_speed_10m_max FROM forecast WHERE date BETWEEN DATE '2001-09-01' AND DATE '2001-09-16') "
    "SELECT city, date, wind_3d_max, wind_7d FROM (SELECT city, date, max(wind_speed_10m_max) " + LAST.format(n=2) + " AS wind_3d_max, avg(wind_speed_10m_max) " + LAST.format(n=6) + " AS wind_7d FROM u) WHERE date >= DATE '2001-09-01'",
)
def f1_windows(spark, sf):
    out = fc.forecast_features(views.staging(spark, sf), future(spark, sf), views.fetch(spark))
    return out.select("city", "date", "wind_3d_max", F.col("wind_speed_10m_max_7d_mean").alias("wind_7d"))


@query("f4_offshore_rows", "@sea|SELECT city, date, offshore_sea_probability, offshore_driver, offshore_wave_height_m, offshore_source FROM sea")
def f4(spark, sf):
    return fc.offshore_rows(views.marine(spark, sf))


def score_sql(v: str) -> str:
    return f"CASE WHEN {v} IS NULL THEN 0.0::DOUBLE ELSE round(0.85::DOUBLE / (exp((greatest({v}, 0) / 2.5::DOUBLE - 1.0) * -6.0) + 1.0), 4) END"


# a wave of 0.0 is unknown here, because a later alternative name exists
block(
    "sea_climate", "daily",
    f"SELECT city, CAST(dayofyear(date) AS INTEGER) AS day_of_year, {r('avg(' + score_sql('nullif(wave_height, 0)') + ')', 4)} AS offshore_sea_probability, {r('avg(wave_height)', 2)} AS offshore_wave_height_m FROM daily WHERE wave_height IS NOT NULL GROUP BY ALL",
)


@query("f5_offshore_climatology", "@sea_climate|SELECT * FROM sea_climate")
def f5(spark, sf):
    return fc.offshore_climatology(views.daily(spark, sf))


@query(
    "j6_climatology_lookup",
    "@daily,vis|WITH known AS (SELECT * FROM daily WHERE city <> 'ASIA'), " + CLIM_SQL("known", "is_risk_day")
    + " SELECT v.city, v.date, round(coalesce(rate, (SELECT avg(is_risk_day) FROM known)), 9) AS climatology_rate FROM vis v LEFT JOIN clim c ON c.city = v.city AND c.day_of_year = dayofyear(v.date)",
)
def j6(spark, sf):
    known = views.daily(spark, sf).where(F.col("city") != "ASIA")
    rows = views.visibility(spark, sf).select("city", "date")
    out = timeseries.climatology_lookup(rows, timeseries.climatology(known), timeseries.global_rate(known))
    return out.withColumn("climatology_rate", F.round("climatology_rate", 9))


def daily_table(spark, sf):
    daily = views.daily(spark, sf)
    model = future(spark, sf).withColumn("model_probability", F.col("wind_speed_10m_max") / 100)
    state = fc.day_of_year_state(daily)
    return fc.daily_forecast(state.entities(), START, model, state.rates(), state.global_rate(), None, state.sea_climate())


block(
    "forecast_base", "daily,forecast,sea_climate",
    "SELECT city, date, base, source, sea, wave FROM (WITH " + CLIM_SQL("daily", "is_risk_day") + """,
s AS (SELECT city, CAST(d AS DATE) AS date FROM (SELECT DISTINCT city FROM daily), generate_series(DATE '2001-09-01', DATE '2001-10-01', INTERVAL 1 DAY) AS g(d)),
m AS (SELECT city, date, wind_speed_10m_max / 100 AS p FROM forecast WHERE date BETWEEN DATE '2001-09-01' AND DATE '2001-09-16')
SELECT s.city, s.date, coalesce(m.p, clim.rate, (SELECT avg(is_risk_day) FROM daily)) AS base, CASE WHEN m.p IS NOT NULL THEN 'short_horizon' ELSE 'climatology' END AS source,
  coalesce(k.offshore_sea_probability, 0) AS sea, k.offshore_wave_height_m AS wave
FROM s LEFT JOIN m ON m.city = s.city AND m.date = s.date LEFT JOIN clim ON clim.city = s.city AND clim.day_of_year = dayofyear(s.date)
LEFT JOIN sea_climate k ON k.city = s.city AND k.day_of_year = dayofyear(s.date))""",
)
block("forecast_rows", "forecast_base", "SELECT *, least(1.0 - (1.0 - base) * (1.0 - 0.45::DOUBLE * sea), 0.95) AS adjusted FROM forecast_base")


@query(
    "f2_f3_j7_j8_daily_forecast",
    "@forecast_rows|SELECT city, date, CAST(day(date) AS INTEGER) AS day_of_month, " + r("base", 4) + " AS port_weather_probability, source, CAST(adjusted >= 0.1 AS INTEGER) AS prediction, "
    "CASE WHEN wave IS NULL THEN 'not_available' ELSE 'wave_climatology' END AS offshore_source, 0 AS probability_calibrated FROM forecast_rows",
)
def f2(spark, sf):
    return daily_table(spark, sf).select(
        "city", "date", "day_of_month", "port_weather_probability", "source", "prediction", "offshore_source", "probability_calibrated"
    )


@query(
    "f2_daily_forecast_all_columns",
    "@forecast_rows,forecast|SELECT city, date, CAST(day(date) AS INTEGER) AS day_of_month, " + r("base", 4) + " AS port_weather_probability, " + r("sea", 4) + " AS offshore_sea_probability, "
    + r("least(1.0 - (1.0 - base) * (1.0 - 0.45::DOUBLE * sea), 0.95)", 4) + " AS uncalibrated_maritime_probability, " + r("adjusted", 4) + """ AS probability, 0 AS probability_calibrated,
  CAST(adjusted >= 0.1 AS INTEGER) AS prediction, source, CASE WHEN wave IS NULL THEN 'not_available' ELSE 'wave_climatology' END AS offshore_source,
  CASE WHEN wave IS NULL THEN 'offshore sea-state data unavailable' ELSE 'historical offshore wave exposure' END AS offshore_driver, wave AS offshore_wave_height_m,
  CASE WHEN len(drivers) > 0 THEN array_to_string(list_slice(drivers, 1, 3), ', ') WHEN adjusted >= 0.1::DOUBLE AND base >= 0.1::DOUBLE THEN 'model signal from recent weather trends'
    WHEN adjusted >= 0.1::DOUBLE AND sea > 0 THEN 'offshore sea-state adjustment raised the risk' ELSE 'no major maritime risk driver' END AS risk_reason
FROM (SELECT *, list_filter(CASE WHEN source = 'climatology' THEN [seatext, CASE WHEN seatext IS NULL THEN 'historical city/date risk pattern' END]
  ELSE [seatext, CASE WHEN gust >= 75 THEN 'strong wind gusts' WHEN wind >= 50 THEN 'high wind' END, CASE WHEN rain >= 15 THEN 'heavy precipitation' END, CASE WHEN snow >= 5 THEN 'snowfall' END] END, lambda x: x IS NOT NULL) AS drivers
  FROM (SELECT b.*, CASE WHEN sea >= 0.25 AND wave IS NOT NULL THEN 'historical offshore wave exposure (' || printf('%.2f', wave) || 'm wave estimate)' END AS seatext,
    f.wind_gusts_10m_max AS gust, f.wind_speed_10m_max AS wind, f.precipitation_sum AS rain, f.snowfall_sum AS snow
    FROM forecast_rows b LEFT JOIN forecast f ON f.city = b.city AND f.date = b.date AND b.source = 'short_horizon'))""",
)
def f2_all(spark, sf):
    return daily_table(spark, sf)


@query(
    "f6_window_summary",
    f"@forecast_rows|SELECT city, min(date) AS window_start, max(date) AS window_end, {big('count(*) FILTER (adjusted >= 0.1)')} AS risk_days_predicted, "
    # the distribution of the number of risk days: none, one, ... five or more
    "round(list_reduce(list([round(adjusted, 4), 0.0, 0.0, 0.0, 0.0, 0.0]::DOUBLE[] ORDER BY date), lambda s, x: "
    "[s[1] * (1 - x[1]), s[2] * (1 - x[1]) + s[1] * x[1], s[3] * (1 - x[1]) + s[2] * x[1], s[4] * (1 - x[1]) + s[3] * x[1], s[5] * (1 - x[1]) + s[4] * x[1], s[6] + s[5] * x[1]], "
    "[1.0, 0.0, 0.0, 0.0, 0.0, 0.0]::DOUBLE[])[6], 4) AS high_risk_window_probability, "
    "count(*) FILTER (source = 'short_horizon') AS n_short_horizon_days, count(*) FILTER (source = 'climatology') AS n_climatology_days FROM forecast_rows GROUP BY city",
)
def f6(spark, sf):
    return fc.summarise_window(daily_table(spark, sf))


# the distribution of the number of hits, one order at a time
DIST = """WITH RECURSIVE d AS (SELECT city, row_number() OVER (PARTITION BY city, month ORDER BY date) AS i, month, probability AS p FROM probs),
walk AS (SELECT DISTINCT city, month, 0 AS i, [1.0::DOUBLE, 0.0, 0.0, 0.0, 0.0, 0.0] AS s FROM d
  UNION ALL SELECT w.city, w.month, w.i + 1, [s[1] * (1 - p), s[2] * (1 - p) + s[1] * p, s[3] * (1 - p) + s[2] * p, s[4] * (1 - p) + s[3] * p, s[5] * (1 - p) + s[4] * p, s[6] + s[5] * p]
  FROM walk w JOIN d ON d.city = w.city AND d.month = w.month AND d.i = w.i + 1)
"""
block(
    "probs", "vis",
    "SELECT city, strftime(date, '%Y-%m') AS month, date, floor(visibility_min / 50) / 100 AS probability, CASE WHEN visibility_mean > 5000 THEN 'short_horizon' ELSE 'climatology' END AS source FROM vis",
)


@query(
    "f7_monthly_summary",
    "WITH RECURSIVE " + "{probs_blocks}" + DIST.replace("WITH RECURSIVE ", "")
    + ", f AS (SELECT city, month, arg_max(s[6], i) AS p FROM walk GROUP BY city, month) "
    "SELECT city, month AS target_month, count(*) FILTER (probability >= 0.25) AS risk_days_predicted, round(any_value(f.p), 4) AS high_risk_month_probability, "
    "count(*) FILTER (source = 'short_horizon') AS n_short_horizon_days, count(*) FILTER (source = 'climatology') AS n_climatology_days FROM probs JOIN f USING (city, month) GROUP BY city, month",
)
def f7(spark, sf):
    p = F.floor(F.col("visibility_min") / 50) / 100
    source = F.when(F.col("visibility_mean") > 5000, "short_horizon").otherwise("climatology")
    rows = views.visibility(spark, sf).select("city", "date", p.alias("probability"), (p >= 0.25).cast("int").alias("prediction"), source.alias("source"))
    return fc.summarise_months(rows)


def _with_recursive() -> None:
    from catalog.registry import BLOCKS, ORACLES

    needed = ["custplace", "day_orders", "vis", "probs"]
    text = "".join(f"{n} AS ({BLOCKS[n][1]}),\n" for n in needed)
    ORACLES["f7_monthly_summary"] = ORACLES["f7_monthly_summary"].replace("{probs_blocks}", text)


_with_recursive()


@query("f9_visible_rows", "@vis|SELECT city, date, visibility_mean FROM vis WHERE date BETWEEN DATE '2000-03-01' AND DATE '2000-03-31' ORDER BY city, date")
def f9(spark, sf):
    rows = views.visibility(spark, sf).select("city", "date", "visibility_mean")
    return fc.visible_rows(rows, dt.date(2000, 3, 1), dt.date(2000, 3, 31))
