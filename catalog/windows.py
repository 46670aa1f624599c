"""Window functions and time series."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views
from catalog.layers import NOISY, anomaly, lag, mode_block, roll
from catalog.predicates import GAP_SQL
from catalog.registry import big, block, query, r
from daypanel.constants import CONTEXT_COLUMNS, OUTLIER_COLUMNS
from daypanel.functions.columns import with_null_columns
from daypanel.operators import clean, quality, timeseries
from daypanel.operators import features as feat

THREE = ["temperature_2m_mean", "precipitation_sum", "wind_speed_10m_max"]
KEYS = ["city", "date"]


@query(
    "w1_rolling",
    "@weather|SELECT city, date, " + ", ".join(f"{roll('avg', c, n)} AS {c}_{n}d_mean, {roll('max', c, n)} AS {c}_{n}d_max" for c in THREE for n in (7, 30)) + " FROM weather",
)
def w1(spark, sf):
    out = feat.add_rolling_features(views.weather(spark, sf).select(*KEYS, *THREE))
    return out.drop(*THREE)


@query(
    "w1_rolling_in_blocks",
    f"@weather|SELECT city, date, wind_speed_10m_max, {roll('avg', 'wind_speed_10m_max', 30)} AS mean_30, {roll('max', 'wind_speed_10m_max', 7)} AS max_7 FROM weather",
)
def w1_blocks(spark, sf):
    rows = views.weather(spark, sf).select(*KEYS, "wind_speed_10m_max")
    wanted = {"mean_30": (F.avg("wind_speed_10m_max"), -29, 0), "max_7": (F.max("wind_speed_10m_max"), -6, 0)}
    return feat.over_blocks(rows, wanted, "city", "date", lookback=29, block=365)


@query(
    "w2_w4_preset_windows",
    f"@weather|SELECT city, date, {roll('avg', 'wind_speed_10m_max', 7)} AS wind_speed_7d_avg, {roll('max', 'wind_speed_10m_max', 7)} AS wind_speed_7d_max, "
    f"{roll('avg', 'precipitation_sum', 7)} AS precip_7d_avg, {roll('sum', 'precipitation_sum', 7)} AS precip_7d_sum, {roll('avg', 'temperature_2m_mean', 7)} AS temp_7d_avg, "
    f"{lag('wind_speed_10m_max')} AS wind_speed_lag1, {lag('precipitation_sum')} AS precip_lag1, {lag('temperature_2m_mean')} AS temp_lag1 FROM weather",
)
def w2(spark, sf):
    return feat.preset_features(views.weather(spark, sf).select(*KEYS, *THREE)).drop(*THREE)


@query("w3_lags", "@weather|SELECT city, date, " + ", ".join(f"{lag(c, n)} AS {c}_lag{n}" for c in THREE for n in (1, 2)) + " FROM weather")
def w3(spark, sf):
    return feat.add_lag_features(views.weather(spark, sf).select(*KEYS, *THREE)).drop(*THREE)


def _flag(t: str) -> str:
    return f"CAST(coalesce({t}, false) AS INTEGER)"


@query(
    "w5_w7_short_term",
    f"@joined|SELECT city, date, coalesce(wind_speed_10m_max - {lag('wind_speed_10m_max')}, 0) AS wind_change_1d, coalesce(precipitation_sum - {lag('precipitation_sum')}, 0) AS precip_change_1d, "
    f"{roll('max', 'wind_speed_10m_max', 3)} AS wind_3d_max, {roll('sum', 'precipitation_sum', 3)} AS precip_3d_sum, {_flag(roll('min', 'visibility_min', 3) + ' < 3000')} AS low_visibility_recent, "
    f"{_flag(roll('max', 'wind_speed_10m_max', 3) + ' >= 40')} AS strong_wind_recent, "
    f"{_flag(roll('max', 'wind_speed_10m_max', 3) + ' >= 40 AND ' + roll('sum', 'precipitation_sum', 3) + ' >= 5')} AS wind_precip_combo FROM joined",
)
def w5(spark, sf):
    used = ["wind_speed_10m_max", "precipitation_sum", "visibility_min"]
    return feat.add_short_term_features(views.joined(spark, sf).select(*KEYS, *used)).drop(*used)


@query("w8_range_mean", f"@weather|SELECT city, date, temperature_2m_max - temperature_2m_min AS temp_range_c, {r(roll('avg', '(temperature_2m_max - temperature_2m_min)', 7), 2)} AS temp_range_7d FROM weather")
def w8(spark, sf):
    used = ["temperature_2m_max", "temperature_2m_min"]
    return feat.add_temperature_range(views.weather(spark, sf).select(*KEYS, *used)).drop(*used)


@query("w9_anomaly", "@weather|SELECT city, date, " + ", ".join(anomaly(c) for c in THREE) + " FROM weather")
def w9(spark, sf):
    return feat.add_anomaly_scores(views.weather(spark, sf).select(*KEYS, *THREE)).drop(*THREE)


PAST = "OVER (PARTITION BY city, dayofyear(date) ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query(
    "w9_anomaly_past_only",
    "@weather|SELECT city, date, " + ", ".join(
        f"coalesce({r(f'({c} - avg({c}) {PAST}) / nullif(stddev_samp({c}) {PAST}, 0)', 3)}, 0.0::DOUBLE) AS {c}_anom" for c in THREE
    ) + " FROM weather",
)
def w9_past(spark, sf):
    return feat.add_anomaly_scores(views.weather(spark, sf).select(*KEYS, *THREE), past_only=True).drop(*THREE)


FILL = "precipitation_sum"
FORWARD = "last_value({c} IGNORE NULLS) OVER (PARTITION BY city ORDER BY date ROWS UNBOUNDED PRECEDING)"
BACKWARD = "last_value({c} IGNORE NULLS) OVER (PARTITION BY city ORDER BY date DESC ROWS UNBOUNDED PRECEDING)"
FILL_SQL = {
    "ffill": "coalesce(" + FORWARD.format(c=FILL) + ", " + BACKWARD.format(c=FILL) + ")",
    "bfill": BACKWARD.format(c=FILL),
    "mean": f"coalesce({FILL}, avg({FILL}) OVER (PARTITION BY city))",
    "median": f"coalesce({FILL}, median({FILL}) OVER (PARTITION BY city))",
    "zero": f"coalesce({FILL}, 0)",
    "keep": FILL,
    "no_such_strategy": FILL,
}


def _register_fill(strategy: str, sql: str) -> None:
    @query(f"w10_w13_fill_{strategy}", f"@weather|SELECT city, date, {sql} AS {FILL} FROM weather")
    def fill(spark, sf):
        return clean.handle_missing_values(views.weather(spark, sf).select(*KEYS, FILL), {FILL: strategy})


for _strategy, _sql in FILL_SQL.items():
    _register_fill(_strategy, _sql)
block("mode_fill", "weather", mode_block("weather", FILL))


@query("w12_fill_mode", f"@weather,mode_fill|SELECT city, date, coalesce({FILL}, m) AS {FILL} FROM weather LEFT JOIN mode_fill USING (city)")
def w12(spark, sf):
    return clean.handle_missing_values(views.weather(spark, sf).select(*KEYS, FILL), {FILL: "mode"})


@query("w13_dispatch_mixed", "@filled|SELECT city, date, " + ", ".join(["relative_humidity_2m_mean", "weather_code", "snowfall_sum", "visibility_mean"]) + " FROM filled")
def w13(spark, sf):
    return clean.handle_missing_values(views.joined(spark, sf)).select(*KEYS, "relative_humidity_2m_mean", "weather_code", "snowfall_sum", "visibility_mean")


def iqr_sql(c: str, source: str, k: float = 1.5) -> str:
    q1, q3 = (f"quantile_cont({c}, {p}) OVER (PARTITION BY city)" for p in (0.25, 0.75))
    return f"coalesce(({q3} - {q1}) <> 0 AND ({c} < {q1} - {k} * ({q3} - {q1}) OR {c} > {q3} + {k} * ({q3} - {q1})), false) AS {c}_is_outlier"


@query("w14_outliers_iqr", "@weather|SELECT city, date, " + ", ".join(iqr_sql(c, "weather") for c in OUTLIER_COLUMNS) + " FROM weather")
def w14(spark, sf):
    return clean.flag_outliers(views.weather(spark, sf).select(*KEYS, *OUTLIER_COLUMNS)).drop(*OUTLIER_COLUMNS)


@query("w14_outliers_iqr_large_groups", f"@hourly|SELECT city, datetime, visibility, {iqr_sql('visibility', 'hourly')} FROM hourly")
def w14_large(spark, sf):
    return clean.flag_outliers(views.hourly(spark, sf), ["visibility"], large_groups=True)


def z_sql(c: str, k: float) -> str:
    return f"coalesce(abs(({c} - avg({c}) OVER (PARTITION BY city)) / nullif(stddev_samp({c}) OVER (PARTITION BY city), 0)) > {k}, false) AS {c}_is_outlier"


@query("w15_outliers_zscore", "@weather|SELECT city, date, " + ", ".join(z_sql(c, 1.5) for c in OUTLIER_COLUMNS) + " FROM weather")
def w15(spark, sf):
    return clean.flag_outliers(views.weather(spark, sf).select(*KEYS, *OUTLIER_COLUMNS), method="zscore").drop(*OUTLIER_COLUMNS)


@query("w15_outliers_zscore_large_groups", f"@hourly|SELECT city, datetime, visibility, {z_sql('visibility', 2.0)} FROM hourly")
def w15_large(spark, sf):
    return clean.flag_outliers(views.hourly(spark, sf), ["visibility"], "zscore", 2.0, large_groups=True)


@query("w16_dedupe_first", "@lines|SELECT city, date, o, n, p FROM (SELECT *, row_number() OVER (PARTITION BY city, date ORDER BY o, n, p, f, s, q) AS i FROM lines) WHERE i = 1")
def w16(spark, sf):
    rows = views.lines(spark, sf).select(*KEYS, "o", "n", "p", "f", "s", "q")
    order = [F.col(c) for c in ("o", "n", "p", "f", "s", "q")]
    return clean.dedupe(rows, KEYS, order).select(*KEYS, "o", "n", "p")


@query("w17_gaps", "@weather|" + GAP_SQL.format(t="weather") + " WHERE gap_days > 1")
def w17(spark, sf):
    return quality.date_gaps(views.weather(spark, sf), 1)


@query(
    "w18_gap_summary",
    "@vis|WITH d AS (SELECT city, date FROM vis UNION SELECT 'NO GAP', DATE '2000-01-01'), g AS (" + GAP_SQL.format(t="d") + " WHERE gap_days > 3) "
    "SELECT city, count(*) AS gap_count, max(gap_days) AS max_gap FROM g GROUP BY city UNION ALL SELECT DISTINCT city, 0, 0 FROM d WHERE city NOT IN (SELECT city FROM g)",
)
def w18(spark, sf):
    import datetime as dt

    rows = views.visibility(spark, sf).select(*KEYS)
    single = rows.agg(F.lit("NO GAP").alias("city"), F.any_value(F.lit(dt.date(2000, 1, 1))).alias("date"))
    return quality.gap_summary(rows.unionByName(single), 3)


@query(
    "w19_constant_runs",
    "@joined|SELECT city, max(k) AS max_constant_run FROM (SELECT city, run, count(*) AS k FROM (SELECT city, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY city ORDER BY date ROWS UNBOUNDED PRECEDING) AS run "
    f"FROM (SELECT city, date, coalesce(weather_code = {lag('weather_code')}, false) AS same FROM joined)) GROUP BY city, run) GROUP BY city HAVING sum(k) >= 7",
)
def w19(spark, sf):
    return timeseries.constant_runs(views.joined(spark, sf), "weather_code")


@query("w20_next_day_target", "@daily|SELECT * FROM (SELECT city, date, lead(is_risk_day) OVER (PARTITION BY city ORDER BY date) AS target_risk_next_day FROM daily) WHERE target_risk_next_day IS NOT NULL")
def w20(spark, sf):
    return feat.next_day_target(views.daily(spark, sf)).select(*KEYS, "target_risk_next_day")


@query(
    "w21_rolling_min_rows",
    "@weather|SELECT city, date, " + ", ".join(
        f"CASE WHEN {roll('count', 'precipitation_sum', n)} >= {m} THEN {roll('avg', 'precipitation_sum', n)} END AS mean_{n}" for n, m in ((30, 10), (14, 14), (7, 1))
    ) + " FROM weather",
)
def w21(spark, sf):
    out = views.weather(spark, sf).select(*KEYS, "precipitation_sum")
    for n, m in ((30, 10), (14, 14), (7, 1)):
        out = feat.rolling_mean(out, "precipitation_sum", n, m, f"mean_{n}")
    return out.drop("precipitation_sum")


@query(
    "w22_lag1_autocorrelation",
    f"@weather|SELECT city, round(corr(wind_speed_10m_max, p), 9) AS autocorr_lag1 FROM (SELECT city, wind_speed_10m_max, {lag('wind_speed_10m_max')} AS p FROM weather) GROUP BY city",
)
def w22(spark, sf):
    return timeseries.lag1_autocorrelation(views.weather(spark, sf), "wind_speed_10m_max").withColumn("autocorr_lag1", F.round("autocorr_lag1", 9))


@query(
    "w23_autocorrelation",
    "@weather|WITH x AS (SELECT city, row_number() OVER (PARTITION BY city ORDER BY date) AS t, wind_speed_10m_max - avg(wind_speed_10m_max) OVER (PARTITION BY city) AS v FROM weather), "
    "s AS (SELECT city, count(*) AS n, sum(v * v) AS ss FROM x GROUP BY city) "
    "SELECT city, CAST(k AS INTEGER) AS lag, round(sum(a.v * b.v) / any_value(ss), 9) AS acf, round(any_value(1.96::DOUBLE / sqrt(n)), 9) AS band "
    "FROM x a JOIN (SELECT unnest(generate_series(0, 30)) AS k) ON true JOIN x b USING (city) JOIN s USING (city) WHERE b.t = a.t + k GROUP BY city, k",
)
def w23(spark, sf):
    out = timeseries.autocorrelation(views.weather(spark, sf), "wind_speed_10m_max")
    return out.withColumns({"acf": F.round("acf", 9), "band": F.round("band", 9)})


block(
    "vis_days", "vis",
    "SELECT city, date, visibility_mean FROM (SELECT city, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM vis GROUP BY city) LEFT JOIN vis USING (city, date)",
)


@query(
    "w24_interpolate",
    """@vis_days|WITH t AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY date) AS t FROM vis_days),
e AS (SELECT *, last_value(CASE WHEN visibility_mean IS NOT NULL THEN t END IGNORE NULLS) OVER a AS lt, last_value(visibility_mean IGNORE NULLS) OVER a AS lv,
  last_value(CASE WHEN visibility_mean IS NOT NULL THEN t END IGNORE NULLS) OVER b AS rt, last_value(visibility_mean IGNORE NULLS) OVER b AS rv FROM t
  WINDOW a AS (PARTITION BY city ORDER BY date ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY city ORDER BY date DESC ROWS UNBOUNDED PRECEDING))
SELECT city, date, round(coalesce(visibility_mean, CASE WHEN t - lt <= 3 THEN coalesce(lv + (rv - lv) / CAST(rt - lt AS DOUBLE) * (t - lt), lv) END), 9) AS visibility_mean FROM e""",
)
def w24(spark, sf):
    out = timeseries.interpolate(views.visibility(spark, sf), "visibility_mean")
    return out.withColumn("visibility_mean", F.round("visibility_mean", 9))


DECOMPOSED = """WITH b AS (SELECT city, date, temperature_2m_mean AS observed, row_number() OVER (PARTITION BY city ORDER BY date) - 1 AS t FROM weather),
t AS (SELECT *, CASE WHEN count(observed) OVER w = 365 THEN sum(observed) OVER w / 365 END AS trend FROM b WINDOW w AS (PARTITION BY city ORDER BY date ROWS BETWEEN 182 PRECEDING AND 182 FOLLOWING)),
m AS (SELECT city, t % 365 AS pos, avg(observed - trend) AS m FROM t GROUP BY city, t % 365),
s AS (SELECT city, pos, m - avg(m) OVER (PARTITION BY city) AS seasonal FROM m),
parts AS (SELECT t.city, date, observed, trend, seasonal, observed - trend - seasonal AS resid FROM t JOIN s ON t.city = s.city AND t.t % 365 = pos)
"""


@query("w25_decompose", "@weather|" + DECOMPOSED + "SELECT city, date, observed, round(trend, 9) AS trend, round(seasonal, 9) AS seasonal, round(resid, 9) AS resid FROM parts")
def w25(spark, sf):
    out = timeseries.decompose(views.weather(spark, sf), "temperature_2m_mean")
    return out.withColumns({c: F.round(c, 9) for c in ("trend", "seasonal", "resid")})


@query(
    "w25_decomposition_summary",
    "@weather|" + DECOMPOSED + "SELECT city, round(arg_max(trend, date) FILTER (trend IS NOT NULL) - arg_min(trend, date) FILTER (trend IS NOT NULL), 9) AS trend_change, "
    "round(max(seasonal) - min(seasonal), 9) AS seasonal_amplitude, round(stddev_samp(resid), 7) AS resid_std FROM parts GROUP BY city",
)
def w25_summary(spark, sf):
    parts = timeseries.decompose(views.weather(spark, sf), "temperature_2m_mean")
    out = timeseries.decomposition_summary(parts)
    return out.select("city", F.round("trend_change", 9).alias("trend_change"), F.round("seasonal_amplitude", 9).alias("seasonal_amplitude"), F.round("resid_std", 7).alias("resid_std"))
