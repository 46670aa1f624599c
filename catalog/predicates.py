"""Projections, predicates, joins and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog import views
from catalog.layers import AS_OF, CALENDAR_SQL, RISK_SQL, SECTOR_SQL, flag, season_case, shown, wave_sql
from catalog.registry import big, query, r
from daypanel.constants import (
    DEFAULT_FETCH_KM, FORECAST_MEASURES, MODERATE_CODES, PLAUSIBLE_BOUNDS, PRESET_RULES, RISK_RULES, SECTORS, WEATHER_CODES, Rule,
)
from daypanel.functions import calendar, columns, hazard, physics, rules
from daypanel.operators import clean, models, quality, rollup
from daypanel.operators import features as feat
from daypanel.operators import forecast as fc

# ---- P1-P4 rules --------------------------------------------------------------------------

ANY_SQL = "greatest(" + ", ".join(
    flag(f"{x.column} {'<' if x.below else '>'} {x.threshold}") for x in RISK_RULES if x.column != "wave_height"
) + ")"


@query("p1_risk_day", f"@joined|SELECT city, date, {ANY_SQL} AS is_risk_day FROM joined")
def p1(spark, sf):
    return rules.label_risk_days(views.joined(spark, sf)).select("city", "date", "is_risk_day")


ANY_ZERO_SQL = "greatest(" + ", ".join(
    flag(f"coalesce({x.column}, 0) {'<' if x.below else '>'} {x.threshold}") for x in RISK_RULES if x.column != "wave_height"
) + ")"


@query("p1_risk_day_null_is_risk", f"@joined|SELECT city, date, {ANY_ZERO_SQL} AS is_risk_day FROM joined")
def p1_null(spark, sf):
    return rules.label_risk_days(views.joined(spark, sf), null_is_risk=True).select("city", "date", "is_risk_day")


@query(
    "p2_risk_breakdown",
    "@joined|SELECT city, date, "
    + ", ".join(
        f"0 AS {x.column}_breach" if x.column == "wave_height"
        else flag(f"{x.column} {'<' if x.below else '>'} {x.threshold}") + f" AS {x.column}_breach"
        for x in RISK_RULES
    )
    + f", {ANY_SQL} AS any_risk FROM joined",
)
def p2(spark, sf):
    return rules.risk_breakdown(views.joined(spark, sf), ["city", "date"])


FLAGS = list(RISK_SQL)


@query("p3_named_flags", "@daily|SELECT city, date, " + ", ".join(FLAGS) + " FROM daily")
def p3(spark, sf):
    return views.daily(spark, sf).select("city", "date", *FLAGS)


@query(
    "p4_preset_flags",
    "@preset_daily|SELECT city, date, risk_wind, risk_gust, risk_precip, risk_snow, risk_visibility, is_risk_day FROM preset_daily",
)
def p4(spark, sf):
    staged = views.preset(spark, sf)[0]
    flagged = rules.label_risk_days(rules.add_rule_flags(staged, PRESET_RULES), PRESET_RULES)
    return flagged.select("city", "date", *[x.flag for x in PRESET_RULES], "is_risk_day")


# ---- P5-P11 cleaning projections ----------------------------------------------------------


@query("p5_known_flag", "@joined|SELECT city, date, visibility_is_known FROM joined")
def p5(spark, sf):
    return clean.add_known_flag(views.joined(spark, sf)).select("city", "date", "visibility_is_known")


def cap_sql(c: str) -> str:
    cases = " ".join(f"WHEN city = '{n}' AND {c} > {v} THEN {v}" for n, v in views.CAPS[c].items())
    return f"CAST(CASE {cases} ELSE {c} END AS DOUBLE) AS {c}"


@query("p6_winsorize", f"@weather|SELECT city, date, {', '.join(cap_sql(c) for c in views.CAPS)} FROM weather")
def p6(spark, sf):
    out = clean.winsorize(views.weather(spark, sf), views.caps(spark))
    return out.select("city", "date", *views.CAPS)


@query(
    "p7_capped_counts",
    "@weather|SELECT city, "
    + ", ".join(
        big("sum(CAST(coalesce(" + " OR ".join(f"(city = '{n}' AND {c} > {v})" for n, v in m.items()) + ", false) AS INTEGER))") + f" AS {c}_capped"
        for c, m in views.CAPS.items()
    )
    + " FROM weather GROUP BY city",
)
def p7(spark, sf):
    return clean.capped_counts(views.weather(spark, sf), views.caps(spark))


@query(
    "p8_round_and_cast",
    "@weather|SELECT city, date, round(wind_direction_10m_dominant, 1) AS wind_direction_10m_dominant, "
    "CAST(weather_code AS INTEGER) AS weather_code, round(surface_pressure_mean, 2) AS surface_pressure_mean FROM weather",
)
def p8(spark, sf):
    rows = views.weather(spark, sf).select("city", "date", "wind_direction_10m_dominant", "weather_code", "surface_pressure_mean")
    return clean.round_staging(rows, ["city", "date"])


@query(
    "p9_fog_proxy",
    "@joined|SELECT city, date, CASE WHEN visibility_mean IS NULL THEN "
    "CAST(coalesce(relative_humidity_2m_mean >= 90 AND temperature_2m_mean - dew_point_2m_mean <= 2, false) AS INTEGER) END AS fog_proxy FROM joined",
)
def p9(spark, sf):
    proxy = physics.fog_proxy("relative_humidity_2m_mean", "temperature_2m_mean", "dew_point_2m_mean", "visibility_mean")
    return views.joined(spark, sf).select("city", "date", proxy.alias("fog_proxy"))


@query(
    "p10_drop_null_keys",
    "@weather,vis|SELECT v.city, w.date, visibility_mean FROM weather w FULL JOIN vis v USING (city, date) WHERE v.city IS NOT NULL AND w.date IS NOT NULL",
)
def p10(spark, sf):
    w = views.weather(spark, sf).select(F.col("city").alias("wc"), F.col("date"))
    v = views.visibility(spark, sf).select("city", F.col("date").alias("vd"), "visibility_mean")
    both = w.join(v, (F.col("wc") == F.col("city")) & (F.col("date") == F.col("vd")), "full")
    return clean.drop_null_keys(both.select("city", "date", "visibility_mean"), ["city", "date"])


@query("p11_drop_rows", "@joined|SELECT city, date, visibility_mean FROM joined WHERE visibility_mean IS NOT NULL AND weather_code IS NOT NULL")
def p11(spark, sf):
    out = clean.handle_missing_values(views.joined(spark, sf), {"visibility_mean": "drop", "weather_code": "drop"})
    return out.select("city", "date", "visibility_mean")


@query(
    "p12_date_range",
    "@weather|SELECT city, date, wind_speed_10m_max FROM weather WHERE date >= DATE '2000-01-01' AND date < DATE '2001-01-01'",
)
def p12(spark, sf):
    d = F.col("date")
    rows = views.weather(spark, sf).where((d >= dt.date(2000, 1, 1)) & (d < dt.date(2001, 1, 1)))
    return rows.select("city", "date", "wind_speed_10m_max")


@query("p13_allow_list", "@weather,vis|SELECT city, date, wind_speed_10m_max FROM weather WHERE date IN (SELECT date FROM vis WHERE visibility_min < 500)")
def p13(spark, sf):
    days = views.visibility(spark, sf).where(F.col("visibility_min") < 500).select("date").distinct()
    return views.weather(spark, sf).join(days, "date", "left_semi").select("city", "date", "wind_speed_10m_max")


@query(
    "p14_align_union",
    "@weather,forecast|SELECT city, date, wind_speed_10m_max, surface_pressure_mean FROM weather UNION ALL "
    "SELECT city, date, wind_speed_10m_max, CAST(NULL AS DOUBLE) AS surface_pressure_mean FROM forecast",
)
def p14(spark, sf):
    both = views.weather(spark, sf).unionByName(views.forecast(spark, sf), allowMissingColumns=True)
    return both.select("city", "date", "wind_speed_10m_max", "surface_pressure_mean")


@query("p15_add_null_columns", "@forecast|SELECT city, date, snowfall_sum, CAST(NULL AS DOUBLE) AS visibility_mean FROM forecast")
def p15(spark, sf):
    full = columns.with_null_columns(views.forecast(spark, sf), FORECAST_MEASURES)
    return full.select("city", "date", "snowfall_sum", "visibility_mean")


@query("p16_leakage_filter", "@daily|SELECT city, temperature_2m_mean, wave_height_lag1, wave_height_lag2, wave_height_7d_max, wave_height_30d_max, wave_height_anom, "
       "round(wave_height_7d_mean, 6) AS wave_height_7d_mean, round(wave_height_30d_mean, 6) AS wave_height_30d_mean FROM daily")
def p16(spark, sf):
    daily = views.daily(spark, sf)
    chosen = models.feature_columns(daily.columns, ["city", "temperature_2m_mean", "wind_speed_10m_max", "is_risk_day", "not_there"])
    return shown(daily.select(*chosen))


TESTS_SQL = {
    "precipitation_sum negative": "precipitation_sum < 0",
    "relative_humidity_2m_mean > 100": "relative_humidity_2m_mean > 100",
    "temperature_2m_max < -80": "temperature_2m_max < -80",
    "temperature_2m_max > 60": "temperature_2m_max > 60",
    "wind_speed_10m_max > 300": "wind_speed_10m_max > 300",
}


@query("p17_non_physical", "@weather|" + " UNION ALL ".join(f"SELECT '{n}' AS check_name, count(*) FILTER ({t}) AS violations FROM weather" for n, t in TESTS_SQL.items()))
def p17(spark, sf):
    weather = views.weather(spark, sf)
    return quality.predicate_counts(weather, quality.non_physical(weather))


@query(
    "p18_plausible_ranges",
    "@weather|" + " UNION ALL ".join(f"SELECT '{c}' AS check_name, count(*) FILTER ({c} < {a} OR {c} > {b}) AS violations FROM weather" for c, (a, b) in PLAUSIBLE_BOUNDS.items()),
)
def p18(spark, sf):
    tests = {c: (F.col(c) < a) | (F.col(c) > b) for c, (a, b) in PLAUSIBLE_BOUNDS.items()}
    return quality.predicate_counts(views.weather(spark, sf), tests)


CODE_CASE = "CASE " + " ".join(f"WHEN weather_code = {k} THEN '{v}'" for k, v in WEATHER_CODES.items()) + " ELSE 'Unknown' END"


@query(
    "p19_weather_codes",
    f"@weather|SELECT CAST(weather_code AS INTEGER) AS weather_code, {CODE_CASE} AS description, "
    f"CASE WHEN weather_code >= 65 THEN 'HIGH' WHEN weather_code IN ({', '.join(map(str, MODERATE_CODES))}) THEN 'MOD' ELSE '' END AS risk, count(*) AS days "
    "FROM weather WHERE weather_code IS NOT NULL GROUP BY ALL",
)
def p19(spark, sf):
    counted = (
        views.weather(spark, sf).where(F.col("weather_code").isNotNull())
        .groupBy(F.col("weather_code").cast("int").alias("weather_code")).agg(F.count(F.lit(1)).alias("days"))
    )
    c = F.col("weather_code")
    return counted.select("weather_code", rules.code_text(c).alias("description"), rules.code_risk(c).alias("risk"), "days")


BAND_SQL = lambda low, mod, high, very, severe: (
    f"CASE WHEN probability < 0.10::DOUBLE THEN '{low}' WHEN probability < 0.25 THEN '{mod}' WHEN probability < 0.5 THEN '{high}' "
    f"WHEN probability < 0.75 THEN '{very}' ELSE '{severe}' END"
)


@query(
    "p20_risk_bands",
    f"@scored|SELECT city, {BAND_SQL('Low', 'Moderate', 'High', 'Very High', 'Severe')} AS band, "
    f"{BAND_SQL('Proceed normally', 'Monitor conditions', 'Plan with caution', 'Manual review advised', 'Avoid/postpone if possible')} AS action, "
    "count(*) AS n FROM scored GROUP BY ALL",
)
def p20(spark, sf):
    p = F.col("probability")
    return views.scored(spark, sf).groupBy("city", rules.risk_band(p).alias("band"), rules.risk_action(p).alias("action")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p21_source_labels",
    "SELECT source, CASE WHEN lower(coalesce(source,'')) LIKE '%climatology%' THEN 'climatology' WHEN lower(coalesce(source,'')) LIKE '%short%' OR lower(coalesce(source,'')) LIKE '%forecast%' "
    "THEN 'ML forecast' WHEN coalesce(source,'') <> '' THEN source ELSE 'model' END AS label, "
    "CASE WHEN lower(coalesce(source,'')) LIKE '%marine%' THEN 'marine forecast' WHEN lower(coalesce(source,'')) LIKE '%climatology%' THEN 'wave climatology' "
    "WHEN coalesce(source,'') <> '' THEN source ELSE 'not available' END AS sea_label, count(*) AS n FROM documents GROUP BY ALL",
)
def p21(spark, sf):
    s = F.col("source")
    return (
        views.table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        .select("source", rules.source_label(s).alias("label"), rules.sea_source_label(s).alias("sea_label"), "n")
    )


DISPLAY_SQL = "replace(p_name, '_', ' ')"
for _pattern, _word in rules.DISPLAY_WORDS:
    DISPLAY_SQL = f"regexp_replace({DISPLAY_SQL}, '{_pattern}', '{_word}', 'gi')"


@query(
    "p22_condition_text",
    f"SELECT p_partkey, CASE WHEN trim(coalesce(p_name, '')) = '' THEN 'No major risk condition' ELSE trim(regexp_replace({DISPLAY_SQL}, '\\s+', ' ', 'g')) END AS condition FROM part",
)
def p22(spark, sf):
    return views.table(spark, sf, "part").select("p_partkey", rules.condition_text(F.col("p_name")).alias("condition"))


@query(
    "p23_split_by_year",
    f"@daily|SELECT city, CASE WHEN year < 2001 THEN 'train' ELSE 'test' END AS part, count(*) AS n, avg(CAST(is_risk_day AS DOUBLE)) AS positive_rate FROM daily WHERE year <= 2001 GROUP BY ALL",
)
def p23(spark, sf):
    train, test = models.split_by_year(views.daily(spark, sf), 2001)
    return models.split_sizes(train, test, "is_risk_day")


@query(
    "p23_split_by_date",
    "@daily|WITH days AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM daily)), "
    "cut AS (SELECT date AS c FROM days WHERE i = greatest(1, least(CAST(floor(n * 0.8) AS BIGINT), n - 1))) "
    "SELECT city, CASE WHEN date < (SELECT c FROM cut) THEN 'train' ELSE 'test' END AS part, count(*) AS n, avg(CAST(is_risk_day AS DOUBLE)) AS positive_rate FROM daily GROUP BY ALL",
)
def p23_date(spark, sf):
    train, test = models.split_by_date(views.daily(spark, sf))
    return models.split_sizes(train, test, "is_risk_day")


@query("p23_split_stratified")
def p23_random(spark, sf):
    train, test = models.split_stratified(views.scored(spark, sf).withColumn("k", F.xxhash64("probability", "date")), "label", keys=["k"])
    return models.split_sizes(train, test, "label")


@query(
    "p23_split_stratified_properties",
    "@scored|SELECT city, CAST(label AS INTEGER) AS label, count(*) AS n, true AS complete, true AS share_fits FROM scored GROUP BY ALL",
)
def p23_properties(spark, sf):
    """Both parts together are all rows, and the test part of a large group holds about its share (four standard deviations)."""
    rows = views.scored(spark, sf).withColumn("k", F.xxhash64("probability", "date"))
    train, test = models.split_stratified(rows, "label", keys=["k"])
    parts = train.select("city", "label", F.lit(0).alias("t")).unionByName(test.select("city", "label", F.lit(1).alias("t")))
    sizes = parts.groupBy("city", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("k"))
    whole = rows.groupBy("city", "label").agg(F.count(F.lit(1)).alias("_all"))
    n = F.col("n").cast("double")
    fits = F.abs(F.col("k") - 0.2 * n) <= 4 * F.sqrt(0.16 * n) + 1
    return sizes.join(whole, ["city", "label"]).select("city", F.col("label").cast("int").alias("label"), "n", (F.col("n") == F.col("_all")).alias("complete"), fits.alias("share_fits"))


@query(
    "p24_first_number",
    "SELECT page_id, coalesce(TRY_CAST(url AS DOUBLE), TRY_CAST(regexp_extract(url, '[0-9]+') AS DOUBLE), 0.0::DOUBLE) AS number FROM pages",
)
def p24(spark, sf):
    pages = views.table(spark, sf, "pages").withColumn("digits", F.regexp_extract("url", "[0-9]+", 0))
    return pages.select("page_id", columns.first_number(pages, ["url", "digits", "absent"]).alias("number"))


# ---- Joins --------------------------------------------------------------------------------


@query("j1_left_join", "@joined|SELECT city, date, wind_speed_10m_max, visibility_mean, visibility_min FROM joined")
def j1(spark, sf):
    return views.joined(spark, sf).select("city", "date", "wind_speed_10m_max", "visibility_mean", "visibility_min")


@query(
    "j3_overlap",
    "@weather,forecast|SELECT city, count(*) AS days, avg(abs(f.wind_speed_10m_max - h.wind_speed_10m_max)) AS wind_diff, "
    "avg(abs(f.temperature_2m_max - h.temperature_2m_max)) AS temp_diff, "
    "avg(abs(f.wind_speed_10m_max - h.wind_speed_10m_max)) < 10 AND avg(abs(f.temperature_2m_max - h.temperature_2m_max)) < 5 AS agrees "
    "FROM weather h JOIN forecast f USING (city, date) GROUP BY city",
)
def j3(spark, sf):
    f = views.forecast(spark, sf).select("city", "date", F.col("wind_speed_10m_max").alias("fw"), F.col("temperature_2m_max").alias("ft"))
    both = views.weather(spark, sf).join(f, ["city", "date"])
    wind = F.avg(F.abs(F.col("fw") - F.col("wind_speed_10m_max")))
    temp = F.avg(F.abs(F.col("ft") - F.col("temperature_2m_max")))
    return both.groupBy("city").agg(
        F.count(F.lit(1)).alias("days"), wind.alias("wind_diff"), temp.alias("temp_diff"), ((wind < 10) & (temp < 5)).alias("agrees")
    )


@query(
    "j4_before_after",
    "@weather,staging|SELECT city, max(w.precipitation_sum) AS raw_precip_max, max(s.precipitation_sum) AS staging_precip_max, "
    "max(w.snowfall_sum) AS raw_snow_max, max(s.snowfall_sum) AS staging_snow_max FROM weather w JOIN staging s USING (city, date) GROUP BY city",
)
def j4(spark, sf):
    raw = views.weather(spark, sf).select("city", "date", F.col("precipitation_sum").alias("rp"), F.col("snowfall_sum").alias("rs"))
    staged = views.staging(spark, sf).select("city", "date", "precipitation_sum", "snowfall_sum")
    return raw.join(staged, ["city", "date"]).groupBy("city").agg(
        F.max("rp").alias("raw_precip_max"), F.max("precipitation_sum").alias("staging_precip_max"),
        F.max("rs").alias("raw_snow_max"), F.max("snowfall_sum").alias("staging_snow_max"),
    )


GAP_SQL = "SELECT city, date, next_date, gap_days FROM (SELECT city, date, lead(date) OVER (PARTITION BY city ORDER BY date) AS next_date, CAST(date_diff('day', date, lead(date) OVER (PARTITION BY city ORDER BY date)) AS INTEGER) AS gap_days FROM {t})"


@query(
    "j5_anti_join",
    "@weather|SELECT DISTINCT city FROM weather WHERE city NOT IN (SELECT city FROM (" + GAP_SQL.format(t="weather") + ") WHERE gap_days > 2)",
)
def j5(spark, sf):
    weather = views.weather(spark, sf)
    return weather.select("city").distinct().join(quality.date_gaps(weather, 2), "city", "left_anti")


@query(
    "j9_scaffold",
    "@weather|SELECT city, CAST(d AS DATE) AS date FROM (SELECT DISTINCT city FROM weather), generate_series(DATE '2001-09-01', DATE '2001-10-01', INTERVAL 1 DAY) AS g(d)",
)
def j9(spark, sf):
    return fc.scaffold(views.weather(spark, sf), dt.date(2001, 9, 1))


@query(
    "j10_fetch_lookup",
    f"@weather,fetch_km|SELECT city, date, coalesce(CAST(km AS DOUBLE), 200.0::DOUBLE) AS km FROM weather LEFT JOIN fetch_km ON city = fcity AND {SECTOR_SQL} = fsector",
)
def j10(spark, sf):
    index = physics.sector_index(F.col("wind_direction_10m_dominant")) + 1
    rows = views.weather(spark, sf).join(views.fetch(spark), "city", "left")
    return rows.select("city", "date", F.coalesce(F.try_element_at("fetch_km", index), F.lit(DEFAULT_FETCH_KM)).alias("km"))


@query(
    "j11_missing_dates",
    "@weather|SELECT city, CAST(d AS DATE) AS date FROM (SELECT city, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS d FROM weather GROUP BY city) "
    "WHERE (city, CAST(d AS DATE)) NOT IN (SELECT (city, date) FROM weather)",
)
def j11(spark, sf):
    return clean.missing_dates(views.weather(spark, sf))


# ---- Scalar functions ---------------------------------------------------------------------


@query("x1_x3_calendar", f"@weather|SELECT city, date, {CALENDAR_SQL} FROM weather")
def x1(spark, sf):
    return shown(calendar.add_seasonal_features(views.weather(spark, sf).select("city", "date")))


@query("x2_season", f"@weather|SELECT city, {season_case('month(date)')} AS season, count(*) AS n FROM weather GROUP BY ALL")
def x2(spark, sf):
    return views.weather(spark, sf).groupBy("city", calendar.season(F.month("date")).alias("season")).agg(F.count(F.lit(1)).alias("n"))


@query("x4_daily_range", "@weather|SELECT city, date, temperature_2m_max - temperature_2m_min AS temp_range_c FROM weather")
def x4(spark, sf):
    return views.weather(spark, sf).select("city", "date", physics.daily_range("temperature_2m_max", "temperature_2m_min").alias("temp_range_c"))


@query("x5_degree_days", "@weather|SELECT city, date, greatest(18.0::DOUBLE - temperature_2m_mean, 0) AS hdd, greatest(temperature_2m_mean - 18.0::DOUBLE, 0) AS cdd FROM weather")
def x5(spark, sf):
    return physics.add_degree_days(views.weather(spark, sf)).select("city", "date", "hdd", "cdd")


@query(
    "x6_sector",
    f"@weather|SELECT city, list_extract([{', '.join(repr(s) for s in SECTORS)}], {SECTOR_SQL} + 1) AS sector, count(*) AS n FROM weather GROUP BY ALL",
)
def x6(spark, sf):
    return views.weather(spark, sf).groupBy("city", physics.sector(F.col("wind_direction_10m_dominant")).alias("sector")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "x7_wave_height",
    f"@weather,fetch_km|SELECT city, date, {r(wave_sql('wind_speed_10m_max', 'coalesce(CAST(km AS DOUBLE), 200.0::DOUBLE)'), 2)} AS wave_height "
    f"FROM weather LEFT JOIN fetch_km ON city = fcity AND {SECTOR_SQL} = fsector",
)
def x7(spark, sf):
    return physics.add_wave_height(views.weather(spark, sf), views.fetch(spark)).select("city", "date", "wave_height")


def score_sql(v: str, t: float, cap: float) -> str:
    return f"CASE WHEN {v} IS NULL THEN 0.0::DOUBLE ELSE {cap}::DOUBLE / (exp((greatest({v}, 0) / {t}::DOUBLE - 1.0) * -6.0) + 1.0) END"


@query("x8_threshold_score", f"@marine|SELECT event_id, round({score_sql('wave_height_max', 2.5, 0.85)}, 9) AS score FROM marine")
def x8(spark, sf):
    return views.marine(spark, sf).select("event_id", F.round(hazard.threshold_score(F.col("wave_height_max"), 2.5), 9).alias("score"))


# wave 0.0 counts as unknown only when a later alternative exists; here there is none after it
SEA_SQL = f"""SELECT event_id, city, date,
  CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE {r("least(greatest(s1, s2, s3) + bonus, 0.90)", 4)} END AS offshore_sea_probability,
  CASE WHEN n = 0 THEN 'offshore sea-state data unavailable' WHEN s1 >= s2 AND s1 >= s3 THEN 'offshore wave height'
       WHEN s2 >= s3 THEN 'wind-wave height' ELSE 'swell height' END AS offshore_driver,
  CASE WHEN n > 0 THEN {r("CASE WHEN s1 >= s2 AND s1 >= s3 THEN wave WHEN s2 >= s3 THEN wind_wave ELSE swell END", 2)} END AS offshore_driver_value,
  {r("wave", 2)} AS offshore_wave_height_m,
  CASE WHEN n = 0 THEN 'not_available' ELSE 'marine_forecast' END AS offshore_source
FROM (SELECT *, CASE WHEN wave IS NULL THEN -1.0 ELSE {score_sql('wave', 2.5, 0.85)} END AS s1,
  CASE WHEN wind_wave IS NULL THEN -1.0 ELSE {score_sql('wind_wave', 2.0, 0.75)} END AS s2,
  CASE WHEN swell IS NULL THEN -1.0 ELSE {score_sql('swell', 1.5, 0.65)} END AS s3,
  (wave IS NOT NULL)::INT + (wind_wave IS NOT NULL)::INT + (swell IS NOT NULL)::INT AS n,
  CASE WHEN coalesce(wave_period_max >= 6 AND wave >= 1, false) THEN 0.08::DOUBLE ELSE 0.0 END AS bonus
 FROM (SELECT *, nullif(wave_height_max, 0) AS wave, wind_wave_height_max AS wind_wave, swell_wave_height_max AS swell FROM marine))"""


@query("x9_sea_risk", "@marine|" + SEA_SQL)
def x9(spark, sf):
    out = hazard.add_sea_risk(views.marine(spark, sf))
    return out.select(
        "event_id", "city", "date", "offshore_sea_probability", "offshore_driver", "offshore_driver_value", "offshore_wave_height_m", "offshore_source"
    )


COMBINED_SQL = "least(1.0 - (1.0 - probability) * (1.0 - 0.45::DOUBLE * sea), 0.95)"


@query(
    "x10_combined_probability",
    f"@scored|SELECT city, date, label, probability, round({COMBINED_SQL}, 12) AS combined FROM (SELECT *, CAST(label AS DOUBLE) * 0.5 AS sea FROM scored)",
)
def x10(spark, sf):
    combined = hazard.combined_probability(F.col("probability"), F.col("label") * 0.5)
    return views.scored(spark, sf).select("city", "date", "label", "probability", F.round(combined, 12).alias("combined"))


@query("x11_calibrator", "@scored|SELECT city, date, probability, probability AS same, round(least(probability * probability, 0.95), 9) AS squared FROM scored")
def x11(spark, sf):
    p = F.col("probability")
    mapped = hazard.calibrated_probability(p, lambda c: c * c)
    return views.scored(spark, sf).select("city", "date", "probability", hazard.calibrated_probability(p).alias("same"), F.round(mapped, 9).alias("squared"))


REASON_SQL = """SELECT event_id, CASE WHEN len(drivers) > 0 THEN array_to_string(list_slice(drivers, 1, 3), ', ')
  WHEN adjusted >= 0.1::DOUBLE AND base >= 0.1::DOUBLE THEN 'model signal from recent weather trends'
  WHEN adjusted >= 0.1::DOUBLE AND sea > 0 THEN 'offshore sea-state adjustment raised the risk' ELSE 'no major maritime risk driver' END AS risk_reason
FROM (SELECT *, least(1.0 - (1.0 - base) * (1.0 - 0.45::DOUBLE * sea), 0.95) AS adjusted,
  list_filter(CASE WHEN src = 'climatology' THEN [seatext, CASE WHEN seatext IS NULL THEN 'historical city/date risk pattern' END]
    ELSE [seatext, CASE WHEN gust >= 75 THEN 'strong wind gusts' WHEN wind >= 50 THEN 'high wind' END,
      CASE WHEN rain >= 15 THEN 'heavy precipitation' END, CASE WHEN snow >= 5 THEN 'snowfall' END] END, lambda x: x IS NOT NULL) AS drivers
FROM (SELECT event_id, offshore_sea_probability AS sea, CASE WHEN offshore_sea_probability >= 0.25 THEN
    offshore_driver || CASE WHEN offshore_wave_height_m IS NULL THEN '' ELSE ' (' || printf('%.2f', offshore_wave_height_m) || 'm wave estimate)' END END AS seatext,
    value / 1000.0::DOUBLE AS base, CASE WHEN event_type IN ('click', 'view') THEN 'climatology' ELSE 'short_horizon' END AS src,
    value AS gust, user_id AS wind, value / 4 AS rain, k / 16 AS snow
  FROM sea JOIN (SELECT event_id, value, user_id, event_type, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) USING (event_id)))"""
from catalog.registry import block  # noqa: E402

block("sea", "marine", SEA_SQL)


@query("x12_risk_reason", "@sea|" + REASON_SQL)
def x12(spark, sf):
    events = views.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").try_cast("double")
    rows = hazard.add_sea_risk(views.marine(spark, sf)).select("event_id", "offshore_sea_probability", "offshore_driver", "offshore_wave_height_m")
    both = rows.join(
        events.select(
            "event_id", (F.col("value") / 1000.0).alias("base"),
            F.when(F.col("event_type").isin("click", "view"), "climatology").otherwise("short_horizon").alias("source"),
            F.col("value").alias("wind_gusts_10m_max"), F.col("user_id").alias("wind_speed_10m_max"),
            (F.col("value") / 4).alias("precipitation_sum"), (k / 16).alias("snowfall_sum"),
        ),
        "event_id",
    )
    adjusted = hazard.combined_probability(F.col("base"), F.col("offshore_sea_probability"))
    return both.select("event_id", hazard.risk_reason(both, F.col("base"), adjusted, F.lit(0.1)).alias("risk_reason"))


@query(
    "x13_rolling_dates",
    "@weather|SELECT city, CAST(unnest(generate_series(m, m + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT city, max(date) AS m FROM weather GROUP BY city)",
)
def x13(spark, sf):
    latest = views.weather(spark, sf).groupBy("city").agg(F.max("date").alias("m"))
    return latest.select("city", calendar.rolling_dates(F.col("m")).alias("date"))


@query(
    "x14_month_dates",
    "@weather|SELECT city, CAST(unnest(generate_series(date_trunc('month', m), last_day(m)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT city, min(date) AS m FROM weather GROUP BY city)",
)
def x14(spark, sf):
    first = views.weather(spark, sf).groupBy("city").agg(F.min("date").alias("m"))
    return first.select("city", calendar.month_dates(F.col("m")).alias("date"))


@query(
    "x15_next_month",
    "@weather|SELECT city, strftime(date_trunc('month', max(date)) + INTERVAL 1 MONTH, '%Y-%m') AS target_month FROM weather GROUP BY city",
)
def x15(spark, sf):
    return views.weather(spark, sf).groupBy("city").agg(calendar.next_month(F.max(calendar.month_start(F.col("date")))).alias("target_month"))


@query(
    "x17_valid_range",
    "SELECT o_orderpriority, coalesce(TRY_CAST(a AS DATE) < TRY_CAST(b AS DATE) AND TRY_CAST(b AS DATE) <= DATE '2000-01-01', false) AS valid, count(*) AS n "
    "FROM (SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS a, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d') END AS b FROM orders) GROUP BY ALL",
)
def x17(spark, sf):
    text = lambda c: F.date_format(c, "yyyy-MM-dd")
    orders = views.table(spark, sf, "orders").select(
        "o_orderpriority", text("o_orderdate").alias("a"),
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise(text(F.date_add("o_orderdate", 7))).alias("b"),
    )
    valid = calendar.valid_range(F.col("a"), F.col("b"), F.lit(dt.date(2000, 1, 1)))
    return orders.groupBy("o_orderpriority", valid.alias("valid")).agg(F.count(F.lit(1)).alias("n"))


@query("x18_log1p", "@weather|SELECT city, date, round(ln(1 + precipitation_sum), 9) AS precip_log1p FROM weather")
def x18(spark, sf):
    return views.weather(spark, sf).select("city", "date", F.round(F.log1p("precipitation_sum"), 9).alias("precip_log1p"))


@query("x19_numeric_coercion", "SELECT conv_id, turn, TRY_CAST(regexp_extract(text, '[0-9.]+') AS DOUBLE) AS number FROM conversations")
def x19(spark, sf):
    number = columns.to_number(F.regexp_extract("text", "[0-9.]+", 0))
    return views.table(spark, sf, "conversations").select("conv_id", "turn", number.alias("number"))


@query("x20_normal_name", "SELECT o_orderkey, replace(replace(lower(o_orderpriority), ' ', ''), '-', '_') AS name FROM orders")
def x20(spark, sf):
    return views.table(spark, sf, "orders").select("o_orderkey", columns.normal_name(F.col("o_orderpriority")).alias("name"))


@query("x21_date_text", "@weather|SELECT city, date, strftime(date, '%Y-%m-%d') AS day_text, strftime(date, '%b') AS month_name FROM weather")
def x21(spark, sf):
    return views.weather(spark, sf).select("city", "date", F.date_format("date", "yyyy-MM-dd").alias("day_text"), F.date_format("date", "MMM").alias("month_name"))
