"""Quality gates and audits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog import views
from catalog.layers import AS_OF, MEASURES, NULLS_SUM
from catalog.predicates import GAP_SQL
from catalog.registry import big, block, query, r
from daypanel.constants import REQUIRED_FEATURES, VALUE_BOUNDS, VISIBILITY_MEASURES, WEATHER_MEASURES
from daypanel.operators import clean, quality, rollup

KEYS = ["city", "date"]
GATE = ["check_name", "status", "severity", "stage"]


def gate_sql(name: str, severity: str, stage: str, status: str, extra: str = "", source: str = "") -> str:
    return f"SELECT '{name}' AS check_name, {status} AS status, '{severity}' AS severity, '{stage}' AS stage{extra} {source}"


def details(df, **wanted):
    return df.select(*GATE, *[F.col("details")[k].cast(t).alias(k) for k, t in wanted.items()])


@query("q1_row_count", "@weather|" + gate_sql("row_count", "ABORT", "raw", "CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END", ", count(*) AS rows", "FROM weather"))
def q1(spark, sf):
    return details(quality.check_row_count(views.weather(spark, sf)), rows="bigint")


NULLS = {c: f"count(*) FILTER ({c} IS NULL)" for c in MEASURES}
OFFENDERS = ", ".join(f"CASE WHEN {e} > count(*) * 0.05 THEN '{c}' END" for c, e in NULLS.items())


@query(
    "q2_null_ratio",
    "@joined|" + gate_sql(
        "null_ratio", "WARN", "staging", f"CASE WHEN len(list_filter([{OFFENDERS}], lambda x: x IS NOT NULL)) = 0 THEN 'PASS' ELSE 'WARN' END",
        f", count(*) AS rows_checked, array_to_string(list_filter([{OFFENDERS}], lambda x: x IS NOT NULL), ', ') AS offenders", "FROM joined"),
)
def q2(spark, sf):
    out = quality.check_null_ratio(views.joined(spark, sf).select(*KEYS, *MEASURES))
    rows = details(out, rows_checked="bigint", offenders="string")
    return rows.withColumn("offenders", F.regexp_replace("offenders", "=[0-9.]+", ""))


block("gaps3", "weather", GAP_SQL.format(t="weather") + " WHERE gap_days > 3")


@query(
    "q3_date_continuity",
    "@gaps3|" + gate_sql(
        "date_continuity", "WARN", "staging", "CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'WARN' END",
        ", count(*) AS gaps_found, coalesce(max(gap_days), 0) AS worst_gap_days, count(DISTINCT city) AS entities_with_gaps", "FROM gaps3"),
)
def q3(spark, sf):
    return details(quality.check_date_continuity(views.weather(spark, sf)), gaps_found="bigint", worst_gap_days="int", entities_with_gaps="bigint")


TIGHT = {"temperature_2m_max": (-5, 35), "temperature_2m_min": (-9, 30), "wind_speed_10m_max": (6, 54), "relative_humidity_2m_mean": (41, 99), "precipitation_sum": (0, 14)}
RANGE_SQL = " UNION ALL ".join(
    f"SELECT city, date, '{c}' AS column_name, {c} AS value, CASE WHEN {c} < {a} THEN 'below_{a}' ELSE 'above_{b}' END AS reason FROM weather WHERE {c} < {a} OR {c} > {b}" for c, (a, b) in TIGHT.items()
)


@query("q4_value_ranges", "@weather|" + gate_sql(
    "value_ranges", "FLAG", "staging", "CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FLAG' END", ", count(*) AS flagged_total", f"FROM ({RANGE_SQL})"))
def q4(spark, sf):
    return details(quality.check_value_ranges(views.weather(spark, sf), TIGHT), flagged_total="bigint")


@query("q5_flag_rows", "@weather|" + RANGE_SQL)
def q5(spark, sf):
    return quality.out_of_range(views.weather(spark, sf), TIGHT)


@query("a31_flag_summary", f"@weather|SELECT column_name, reason, count(*) AS n FROM ({RANGE_SQL}) GROUP BY ALL")
def a31(spark, sf):
    from daypanel.sources.ledgers import flag_summary

    return flag_summary(quality.out_of_range(views.weather(spark, sf), TIGHT))


@query(
    "q6_feature_completeness",
    "@daily|" + gate_sql(
        "feature_completeness", "WARN", "analytics",
        "CASE WHEN " + " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in REQUIRED_FEATURES) + " = 0 THEN 'PASS' ELSE 'WARN' END",
        f", {len(REQUIRED_FEATURES)} AS required", "FROM daily"),
)
def q6(spark, sf):
    return details(quality.check_feature_completeness(views.daily(spark, sf)), required="int")


def fresh_sql(name: str, days: int) -> str:
    age = "CAST(date_diff('day', max(date), DATE '2001-11-10') AS INTEGER)"
    return "@weather|" + gate_sql(name, "WARN", "raw", f"CASE WHEN {age} <= {days} THEN 'PASS' ELSE 'WARN' END", f", {age} AS days_behind", "FROM weather")


@query("q7_freshness", fresh_sql("freshness", 2))
def q7(spark, sf):
    return details(quality.check_freshness(views.weather(spark, sf), AS_OF), days_behind="int")


@query("q7_freshness_monthly", fresh_sql("freshness_monthly", 35))
def q7_monthly(spark, sf):
    return details(quality.check_freshness_monthly(views.weather(spark, sf), AS_OF), days_behind="int")


block(
    "predicted", "vis",
    "SELECT city, date, visibility_mean / 9000 AS probability, CASE WHEN visibility_min < 100 THEN 'guess' WHEN visibility_min < 3000 THEN 'short_horizon' ELSE 'climatology' END AS source FROM vis",
)


def predicted(spark, sf):
    m = F.col("visibility_min")
    source = F.when(m < 100, "guess").when(m < 3000, "short_horizon").otherwise("climatology")
    return views.visibility(spark, sf).select(*KEYS, (F.col("visibility_mean") / 9000).alias("probability"), source.alias("source"))


@query(
    "q8_prediction_coverage",
    "@predicted|SELECT r_name AS city, d.expected_days, coalesce(rows, 0) AS rows, coalesce(unique_dates, 0) AS unique_dates, d.expected_days - coalesce(unique_dates, 0) AS missing_dates, "
    "coalesce(rows, 0) - coalesce(unique_dates, 0) AS duplicate_date_rows FROM region LEFT JOIN (SELECT city, count(*) AS rows, count(DISTINCT date) AS unique_dates FROM predicted GROUP BY city) ON city = r_name, "
    "(SELECT date_diff('day', min(date), max(date)) + 1 AS expected_days FROM predicted) d",
)
def q8(spark, sf):
    entities = views.table(spark, sf, "region").select(F.col("r_name").alias("city"))
    return quality.prediction_coverage(predicted(spark, sf), entities)


@query(
    "q8_predictions_gate",
    "@predicted|" + gate_sql(
        "predictions_completeness", "WARN", "predict", "'WARN'",
        ", count(*) AS rows, count(*) FILTER (source = 'guess') AS bad_sources, count(*) FILTER (probability > 1) AS bad_probabilities", "FROM predicted"),
)
def q8_gate(spark, sf):
    entities = views.table(spark, sf, "region").select(F.col("r_name").alias("city"))
    return details(quality.check_predictions(predicted(spark, sf), entities), rows="bigint", bad_sources="bigint", bad_probabilities="bigint")


@query(
    "q9_staging_gate",
    "@joined,gaps3|" + gate_sql("null_ratio", "WARN", "staging", "'WARN'") + " UNION ALL " + gate_sql("date_continuity", "WARN", "staging", "CASE WHEN (SELECT count(*) FROM gaps3) = 0 THEN 'PASS' ELSE 'WARN' END")
    + " UNION ALL " + gate_sql("value_ranges", "FLAG", "staging", "CASE WHEN (SELECT " + " + ".join(f"count(*) FILTER ({c} < {a} OR {c} > {b})" for c, (a, b) in VALUE_BOUNDS.items()) + " FROM joined) = 0 THEN 'PASS' ELSE 'FLAG' END"),
)
def q9(spark, sf):
    return quality.run_checks("staging", views.joined(spark, sf)).select(*GATE)


@query("q16_warnings_count", "@gaps3|SELECT CAST(1 + CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS BIGINT) AS warnings_count FROM gaps3")
def q16(spark, sf):
    return quality.warnings_count(quality.run_checks("staging", views.joined(spark, sf)))


@query(
    "q10_aborting_checks",
    "@weather|SELECT count(*) FILTER (n = 0) AS aborting FROM (SELECT count(*) AS n FROM weather)",
)
def q10(spark, sf):
    rows = quality.run_checks("raw", views.weather(spark, sf), as_of=AS_OF)
    return rows.agg(quality.count_where((F.col("severity") == quality.ABORT) & (F.col("status") != "PASS")).alias("aborting"))


def check_sql(name: str, value: str, passed: str, source: str) -> str:
    return f"SELECT {name} AS \"check\", CASE WHEN {passed} THEN 'PASS' ELSE 'FAIL' END AS status, CAST(v AS VARCHAR) AS detail FROM (SELECT {value} FROM {source})"


VALIDATION_SQL = " UNION ALL ".join(
    [check_sql(f"'rows in {n}'", "count(*) AS v", "v > 0", s) for n, s in (("raw", "weather"), ("staging", "preset_staging"), ("daily", "preset_daily"), ("monthly", "preset_monthly"))]
    + [
        check_sql("'entity count'", "count(DISTINCT city) AS v", "v = 5", "weather"),
        check_sql("'rows of ' || city", "city, count(*) AS v", "v >= 1800", "preset_staging GROUP BY city"),
        check_sql("'range start'", "min(date) AS v", "v <= DATE '1995-01-05'", "preset_staging"),
        check_sql("'range end'", "max(date) AS v", "v >= DATE '2001-12-31'", "preset_staging"),
        check_sql("'duplicates'", "count(*) FILTER (n > 1) AS v", "v = 0", "(SELECT count(*) AS n FROM preset_staging GROUP BY city, date)"),
        check_sql("'date gaps'", "count(*) AS v", "v = 0", "(" + GAP_SQL.format(t="preset_staging") + " WHERE gap_days > 1)"),
        check_sql("'both labels'", "count(DISTINCT high_risk_month) AS v", "v = 2", "preset_monthly"),
        check_sql("'risk days'", "sum(is_risk_day) AS v", "v > 0", "preset_daily"),
    ]
)


@query("q11_validate_layers", "@weather,preset_staging,preset_daily,preset_monthly|" + VALIDATION_SQL)
def q11(spark, sf):
    staging, daily, monthly = views.preset(spark, sf)
    return quality.validate_layers(views.weather(spark, sf), staging, daily, monthly, 5, "1995-01-05", "2001-12-31")


@query(
    "q12_continuity",
    "@vis|SELECT city, min(date) AS first_date, max(date) AS last_date, date_diff('day', min(date), max(date)) + 1 AS expected_days, count(*) AS actual_days, "
    "date_diff('day', min(date), max(date)) + 1 - count(*) AS missing_days, CASE WHEN date_diff('day', min(date), max(date)) + 1 > count(*) THEN 'GAPS' ELSE 'OK' END AS status FROM vis GROUP BY city",
)
def q12(spark, sf):
    return clean.continuity(views.visibility(spark, sf))


UNEXPECTED = " + ".join(
    (f"CASE WHEN count(*) FILTER ({c} IS NULL) <= count(*) FILTER (date < DATE '1998-01-01') THEN 0 ELSE count(*) FILTER ({c} IS NULL) END" if c in VISIBILITY_MEASURES else f"count(*) FILTER ({c} IS NULL)")
    for c in MEASURES
)


@query(
    "q13_audit",
    f"@joined|SELECT city, count(*) AS rows, 2557 AS expected_rows, {r('count(*) * 100.0::DOUBLE / 2557', 2)} AS coverage_pct, min(date) AS actual_start, max(date) AS actual_end, "
    f"date_diff('day', min(date), max(date)) + 1 - count(DISTINCT date) AS gap_days, {big(f'sum({NULLS_SUM(MEASURES)})')} AS total_nulls, {big(UNEXPECTED)} AS unexpected_nulls, "
    "count(*) - count(DISTINCT date) AS duplicate_dates, count(*) FILTER (temperature_2m_max > 60 OR temperature_2m_max < -80) AS extreme_temperatures, count(*) FILTER (wind_speed_10m_max > 250) AS extreme_winds "
    "FROM joined GROUP BY city",
)
def q13(spark, sf):
    rows = views.joined(spark, sf)
    out = quality.audit(rows, dt.date(1995, 1, 1), dt.date(2001, 12, 31), cutoff="1998-01-01")
    return out.drop("warnings", "status").withColumn("expected_rows", F.col("expected_rows").cast("int"))


@query("q13_first_missing_dates",
       "@vis_days|SELECT city, date AS missing_date, CAST(row_number() OVER (PARTITION BY city ORDER BY date) AS INTEGER) AS rank FROM vis_days WHERE visibility_mean IS NULL QUALIFY rank <= 5")
def q13_missing(spark, sf):
    return quality.first_missing_dates(views.visibility(spark, sf))


@query("q14_audit_summary", "@joined|SELECT city, CASE WHEN count(*) * 100.0 / 2557 < 95 THEN 'coverage below 95%; ' ELSE '' END || (date_diff('day', min(date), max(date)) + 1 - count(*)) || ' missing day(s); ' || " + f"({big(UNEXPECTED)})" + " || ' unexpected null(s)' AS warnings, 'WARN' AS status FROM joined GROUP BY city")
def q14(spark, sf):
    out = quality.audit(views.joined(spark, sf), dt.date(1995, 1, 1), dt.date(2001, 12, 31), cutoff="1998-01-01")
    return out.select("city", "warnings", "status")


@query(
    "q17_jumps",
    "@weather|SELECT city, date, wind_speed_10m_max, jump FROM (SELECT city, date, wind_speed_10m_max, wind_speed_10m_max - lag(wind_speed_10m_max) OVER (PARTITION BY city ORDER BY date) AS jump, "
    "stddev_samp(wind_speed_10m_max) OVER (PARTITION BY city) AS sd FROM weather) WHERE abs(jump) > sd * 2",
)
def q17(spark, sf):
    return quality.jumps(views.weather(spark, sf), "wind_speed_10m_max", 2.0)
