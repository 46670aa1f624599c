"""Aggregations, top-k, set operations and reshapes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog import views
from catalog.layers import NULLS_SUM, MEASURES, RISK_SQL, flag
from catalog.predicates import ANY_ZERO_SQL, DISPLAY_SQL  # noqa: F401
from catalog.registry import big, block, query, r
from daypanel.constants import OUTLIER_COLUMNS, RISK_RULES, WEATHER_MEASURES, Rule
from daypanel.functions import calendar
from daypanel.functions.columns import count_where
from daypanel.operators import forecast as fc
from daypanel.operators import rollup, stats
from daypanel.sources import files



def n_rows():
    return F.count(F.lit(1))


def pct(part: str, total: str = "count(*)", digits: int = 1) -> str:
    return r(f"{part} * 100.0::DOUBLE / {total}", digits)


# ---- A1 hours to days ---------------------------------------------------------------------


@query(
    "a1_hours_to_days",
    f"@hourly|SELECT city, CAST(datetime AS DATE) AS date, {r('avg(visibility)', 1)} AS visibility_mean, min(visibility) AS visibility_min, "
    f"{big('count(*) FILTER (visibility < 1000)')} AS visibility_hours_below_1km FROM hourly GROUP BY ALL",
)
def a1(spark, sf):
    return rollup.hours_to_days(views.hourly(spark, sf))


@query(
    "a1_hours_to_days_unrounded",
    f"@hourly|SELECT city, CAST(datetime AS DATE) AS date, avg(visibility) AS visibility_mean, min(visibility) AS visibility_min, "
    f"{big('count(*) FILTER (visibility < 1000)')} AS visibility_hours_below_1km FROM hourly WHERE visibility IS NOT NULL GROUP BY ALL",
)
def a1_sql(spark, sf):
    return rollup.hours_to_days(views.hourly(spark, sf), decimals=None, drop_nulls=True)


A4_COLUMNS = ["wind_speed_10m_max", "temperature_2m_mean", "visibility_mean"]


@query(
    "a4_monthly_features",
    f"@joined|SELECT city, last_day(date) AS month_end, "
    + ", ".join(f"avg({c}) AS {c}_mean, max({c}) AS {c}_max, min({c}) AS {c}_min, round(stddev_samp({c}), 5) AS {c}_std" for c in A4_COLUMNS)
    + f", {big('sum(k)')} AS risk_days, count(*) AS total_days, {pct('sum(k)', digits=2)} AS risk_day_pct, CAST(sum(k) >= 5 AS INTEGER) AS high_risk_month "
    f"FROM (SELECT *, {ANY_ZERO_SQL} AS k FROM joined) GROUP BY city, last_day(date)",
)
def a4(spark, sf):
    out = rollup.monthly_features(views.joined(spark, sf), A4_COLUMNS)
    return out.withColumns({f"{c}_std": F.round(f"{c}_std", 5) for c in A4_COLUMNS})


@query(
    "a4_monthly_features_all_months",
    f"@day_orders|WITH d AS (SELECT city, date, CAST(max(p) AS DOUBLE) AS wind_speed_10m_max FROM day_orders GROUP BY city, date), "
    "m AS (SELECT city, last_day(date) AS month_end, max(wind_speed_10m_max) AS wind_speed_10m_max_max, count(*) AS total_days FROM d GROUP BY city, last_day(date)), "
    "s AS (SELECT city, last_day(CAST(unnest(generate_series(date_trunc('month', min(date)), max(date)::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE)) AS month_end FROM d GROUP BY city) "
    "SELECT city, month_end, wind_speed_10m_max_max, coalesce(total_days, 0) AS total_days FROM s LEFT JOIN m USING (city, month_end)",
)
def a4_all(spark, sf):
    days = views.orders(spark, sf).groupBy("city", "date").agg(F.max("p").cast("double").alias("wind_speed_10m_max"))
    out = rollup.monthly_features(days, ["wind_speed_10m_max"], fill_months=True)
    return out.select("city", "month_end", "wind_speed_10m_max_max", "total_days")


@query(
    "a5_monthly_labels",
    f"@joined|SELECT city, last_day(date) AS month_end, {big('sum(k)')} AS risk_days, count(*) AS total_days, CAST(sum(k) AS DOUBLE) / count(*) * 100 AS risk_day_pct, "
    "avg(wind_speed_10m_max) AS wind_max_mean, max(wind_speed_10m_max) AS wind_max_max, coalesce(sum(precipitation_sum), 0) AS precip_sum, "
    f"CAST(sum(k) >= 5 AS INTEGER) AS high_risk_month FROM (SELECT *, {ANY_ZERO_SQL} AS k FROM joined) GROUP BY city, last_day(date)",
)
def a5(spark, sf):
    return rollup.monthly_labels(views.joined(spark, sf))


@query(
    "a6_load_summary",
    f"@weather|SELECT city, count(*) AS rows, min(date) AS first_date, max(date) AS last_date, {big(f'sum({NULLS_SUM(WEATHER_MEASURES)})')} AS nulls_total, "
    "max(wind_speed_10m_max) AS wind_speed_10m_max_peak FROM weather GROUP BY city",
)
def a6(spark, sf):
    return rollup.load_summary(views.weather(spark, sf))


@query("a7_latest_dates", "@vis|SELECT r_name AS city, max(date) AS max_date FROM region LEFT JOIN vis v ON city = r_name GROUP BY r_name")
def a7(spark, sf):
    entities = views.table(spark, sf, "region").select(F.col("r_name").alias("city"))
    return rollup.latest_dates(entities, views.visibility(spark, sf))


@query("a8_avg_temperature_by_year", f"@daily|SELECT city, year, {r('avg(temperature_2m_max)', 1)} AS avg_max_temp FROM daily GROUP BY city, year")
def a8(spark, sf):
    return views.daily(spark, sf).groupBy("city", "year").agg(rollup.stable_round(F.avg("temperature_2m_max"), 1).alias("avg_max_temp"))


@query(
    "a9_variance",
    f"@staging|SELECT city, {r('var_samp(precipitation_sum)', 2)} AS precip_variance, {r('stddev_samp(precipitation_sum)', 2)} AS precip_std, "
    f"{r('avg(precipitation_sum)', 2)} AS precip_mean, max(precipitation_sum) AS precip_max FROM staging GROUP BY city ORDER BY 2 DESC",
)
def a9(spark, sf):
    c, rd = "precipitation_sum", rollup.stable_round
    return views.staging(spark, sf).groupBy("city").agg(
        rd(F.var_samp(c), 2).alias("precip_variance"), rd(F.stddev_samp(c), 2).alias("precip_std"),
        rd(F.avg(c), 2).alias("precip_mean"), F.max(c).alias("precip_max"),
    ).orderBy(F.col("precip_variance").desc())


@query(
    "a10_dry_days",
    f"@daily|SELECT city, year, count(*) FILTER (precipitation_sum = 0) AS dry_days, count(*) AS total_days, {pct('count(*) FILTER (precipitation_sum = 0)')} AS dry_pct FROM daily GROUP BY city, year",
)
def a10(spark, sf):
    dry = count_where(F.col("precipitation_sum") == 0)
    return views.daily(spark, sf).groupBy("city", "year").agg(
        dry.alias("dry_days"), n_rows().alias("total_days"), rollup.stable_round(dry * 100.0 / n_rows(), 1).alias("dry_pct")
    )


@query(
    "a11_risk_by_season",
    f"@daily|SELECT city, season, count(*) AS total_days, {big('sum(is_risk_day)')} AS risk_days, {pct('sum(is_risk_day)')} AS risk_pct FROM daily GROUP BY city, season",
)
def a11(spark, sf):
    risk = F.sum("is_risk_day")
    out = views.daily(spark, sf).groupBy("city", "season").agg(
        n_rows().alias("total_days"), risk.alias("risk_days"), rollup.stable_round(risk * 100.0 / n_rows(), 1).alias("risk_pct")
    )
    return out.orderBy("city", calendar.season_order(F.col("season")))


TRIGGERS = {n: n.replace("risk_", "") + "_days" for n in RISK_SQL}


@query(
    "a12_trigger_totals",
    f"@daily|SELECT {', '.join(f'{big(f'sum({n})')} AS {o}' for n, o in TRIGGERS.items())}, {big('sum(is_risk_day)')} AS any_risk_days, count(*) AS total_days FROM daily",
)
def a12(spark, sf):
    return views.daily(spark, sf).agg(*[F.sum(n).alias(o) for n, o in TRIGGERS.items()], F.sum("is_risk_day").alias("any_risk_days"), n_rows().alias("total_days"))


MONTH_TRIGGERS = ["wind_risk_days", "gust_risk_days", "precip_risk_days", "snow_risk_days", "wave_risk_days", "visibility_risk_days", "severe_fog_days", "risk_days"]


@query("a13_trigger_mix", f"@monthly|SELECT city, {', '.join(f'{big(f'sum({c})')} AS {c}' for c in MONTH_TRIGGERS)} FROM monthly GROUP BY city")
def a13(spark, sf):
    return views.monthly(spark, sf).groupBy("city").agg(*[F.sum(c).alias(c) for c in MONTH_TRIGGERS])


@query("a14_risk_by_calendar_month", f"@monthly|SELECT city, month, {r('avg(risk_day_pct)', 1)} AS avg_risk_pct FROM monthly GROUP BY city, month")
def a14(spark, sf):
    return views.monthly(spark, sf).groupBy("city", "month").agg(rollup.stable_round(F.avg("risk_day_pct"), 1).alias("avg_risk_pct"))


@query(
    "a15_high_risk_months",
    f"@monthly|SELECT city, year, {big('sum(high_risk_month)')} AS high_risk_months, {big('12 - sum(high_risk_month)')} AS normal_months FROM monthly GROUP BY city, year",
)
def a15(spark, sf):
    high = F.sum("high_risk_month")
    return views.monthly(spark, sf).groupBy("city", "year").agg(high.alias("high_risk_months"), (12 - high).alias("normal_months"))


@query("a16_label_distribution", f"@monthly|SELECT high_risk_month, count(*) AS months, {pct('count(*)', '(SELECT count(*) FROM monthly)')} AS pct FROM monthly GROUP BY high_risk_month")
def a16(spark, sf):
    return rollup.shares(views.monthly(spark, sf), "high_risk_month", "months")


@query(
    "a17_label_share_by_entity",
    f"@monthly|SELECT city, {big('sum(high_risk_month)')} AS high_risk, {big('count(*) - sum(high_risk_month)')} AS normal, {pct('sum(high_risk_month)')} AS high_risk_pct FROM monthly GROUP BY city",
)
def a17(spark, sf):
    high = F.sum("high_risk_month")
    return views.monthly(spark, sf).groupBy("city").agg(
        high.alias("high_risk"), (n_rows() - high).alias("normal"), rollup.stable_round(high * 100.0 / n_rows(), 1).alias("high_risk_pct")
    )


@query("a18_yearly_totals", f"@daily|SELECT year, count(*) AS days, {big('sum(is_risk_day)')} AS risk_days, {big('sum(visibility_is_known)')} AS known_days FROM daily GROUP BY year")
def a18(spark, sf):
    return views.daily(spark, sf).groupBy("year").agg(n_rows().alias("days"), F.sum("is_risk_day").alias("risk_days"), F.sum("visibility_is_known").alias("known_days"))


@query("a19_outlier_counts", f"@staging|SELECT city, {', '.join(f'count(*) FILTER ({c}_is_outlier) AS {c}' for c in OUTLIER_COLUMNS)} FROM staging GROUP BY city")
def a19(spark, sf):
    return views.staging(spark, sf).groupBy("city").agg(*[count_where(F.col(f"{c}_is_outlier")).alias(c) for c in OUTLIER_COLUMNS])


@query(
    "a20_null_audit",
    "@joined|" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls, {pct(f'count(*) FILTER ({c} IS NULL)', digits=2)} AS null_pct FROM joined" for c in MEASURES),
)
def a20(spark, sf):
    return rollup.null_audit(views.joined(spark, sf), MEASURES)


@query(
    "a20_null_audit_by_entity",
    "@joined|" + " UNION ALL ".join(f"SELECT city, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls, {pct(f'count(*) FILTER ({c} IS NULL)', digits=2)} AS null_pct FROM joined GROUP BY city" for c in MEASURES),
)
def a20_by(spark, sf):
    return rollup.null_audit(views.joined(spark, sf), MEASURES, ["city"])


CORE = ["temperature_2m_max", "wind_speed_10m_max", "precipitation_sum", "relative_humidity_2m_mean", "visibility_mean"]
MOMENTS_SQL = (
    "count(value) AS count, avg(value) AS mean, round(stddev_samp(value), 5) AS std, min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q25, "
    "round(median(value), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max, "
    "round((avg(value*value*value) - 3*avg(value)*avg(value*value) + 2*pow(avg(value),3)) / pow(var_pop(value), 1.5), 4) AS skew, round(kurtosis_pop(value), 4) AS kurt"
)
LONG_SQL = lambda source: " UNION ALL ".join(f"SELECT city, date, '{c}' AS variable, {c} AS value FROM {source}" for c in CORE)
block("long_joined", "joined", LONG_SQL("joined"))
DESCRIBED_SQL = f"SELECT city, variable, {MOMENTS_SQL} FROM long_joined WHERE value IS NOT NULL GROUP BY city, variable"


def described(spark, sf):
    return rollup.describe_with_shape(views.joined(spark, sf), CORE)


@query("a21_describe_with_shape", "@long_joined|" + DESCRIBED_SQL)
def a21(spark, sf):
    rounded = {"std": 5, "q25": 6, "median": 6, "q75": 6, "skew": 4, "kurt": 4}
    return described(spark, sf).withColumns({c: F.round(c, d) for c, d in rounded.items()})


@query("a22_shape_summary", "@long_joined|SELECT variable, round(avg(skew), 2) AS skew, round(avg(kurt), 2) AS kurt FROM (" + DESCRIBED_SQL + ") GROUP BY variable")
def a22(spark, sf):
    out = rollup.shape_summary(described(spark, sf).withColumns({"skew": F.round("skew", 4), "kurt": F.round("kurt", 4)}))
    return out.withColumns({"skew": F.round("skew", 2), "kurt": F.round("kurt", 2)})


@query(
    "a23_yearly_trends",
    f"@daily|SELECT city, year, avg(temperature_2m_mean) AS mean_temp, sum(precipitation_sum) AS total_precip, max(wind_speed_10m_max) AS max_wind, avg(wind_speed_10m_max) AS mean_wind, {big('sum(is_risk_day)')} AS risk_days FROM daily GROUP BY city, year",
)
def a23(spark, sf):
    return views.daily(spark, sf).groupBy("city", "year").agg(
        F.avg("temperature_2m_mean").alias("mean_temp"), F.sum("precipitation_sum").alias("total_precip"),
        F.max("wind_speed_10m_max").alias("max_wind"), F.avg("wind_speed_10m_max").alias("mean_wind"), F.sum("is_risk_day").alias("risk_days"),
    )


PROFILE = {"temp": "temperature_2m_mean", "wind": "wind_speed_10m_max", "precip": "precipitation_sum"}


def profile(spark, sf):
    aggs = [e for n, c in PROFILE.items() for e in (F.avg(c).alias(f"{n}_mean"), F.round(F.stddev_samp(c), 6).alias(f"{n}_std"))]
    return views.daily(spark, sf).groupBy("city", "month").agg(*aggs)


@query("a24_monthly_profile", "@daily|SELECT city, month, " + ", ".join(f"avg({c}) AS {n}_mean, round(stddev_samp({c}), 6) AS {n}_std" for n, c in PROFILE.items()) + " FROM daily GROUP BY city, month")
def a24(spark, sf):
    return profile(spark, sf)


@query("a25_most_variable_month", "@daily|SELECT city, month, s AS temp_std FROM (SELECT city, month, round(stddev_samp(temperature_2m_mean), 6) AS s, row_number() OVER (PARTITION BY city ORDER BY round(stddev_samp(temperature_2m_mean), 6) DESC, month) AS i FROM daily GROUP BY city, month) WHERE i = 1")
def a25(spark, sf):
    best = F.max(F.struct("temp_std", (-F.col("month")).alias("m"))).alias("b")
    return profile(spark, sf).groupBy("city").agg(best).select("city", (-F.col("b.m")).alias("month"), "b.temp_std")


@query("a26_dry_share", "@daily|SELECT city, avg(CAST(precipitation_sum < 0.1 AS DOUBLE)) AS dry_share FROM daily GROUP BY city")
def a26(spark, sf):
    return views.daily(spark, sf).groupBy("city").agg(F.avg((F.col("precipitation_sum") < 0.1).cast("double")).alias("dry_share"))


@query("a27_annual_risk_days", f"@daily|SELECT city, year, {big('sum(is_risk_day)')} AS risk_days FROM daily GROUP BY city, year")
def a27(spark, sf):
    return views.daily(spark, sf).groupBy("city", "year").agg(F.sum("is_risk_day").alias("risk_days"))


@query("a28_code_frequency", "@weather|SELECT CAST(weather_code AS INTEGER) AS weather_code, count(*) AS days FROM weather WHERE weather_code IS NOT NULL GROUP BY ALL")
def a28(spark, sf):
    w = views.weather(spark, sf).where(F.col("weather_code").isNotNull())
    return w.groupBy(F.col("weather_code").cast("int").alias("weather_code")).agg(n_rows().alias("days"))


@query("a29_weekly_mean", "@weather|SELECT city, CAST(date + (7 - isodow(date))::INTEGER AS DATE) AS week_end, avg(wind_speed_10m_max) AS wind_mean FROM weather GROUP BY ALL")
def a29(spark, sf):
    return rollup.weekly_mean(views.weather(spark, sf), "wind_speed_10m_max", "wind_mean")


@query("a29_monthly_mean", "@weather|SELECT city, last_day(date) AS month_end, avg(wind_speed_10m_max) AS wind_mean FROM weather GROUP BY ALL")
def a29_month(spark, sf):
    return rollup.monthly_mean(views.weather(spark, sf), "wind_speed_10m_max", "wind_mean")


@query(
    "a30_month_coverage",
    f"@vis|SELECT city, CAST(date_trunc('month', date) AS DATE) AS month_start, count(*) AS days, {r('least(count(*) * 100.0::DOUBLE / day(last_day(any_value(date))), 100)', 1)} AS coverage_pct FROM vis GROUP BY ALL",
)
def a30(spark, sf):
    return rollup.month_coverage(views.visibility(spark, sf))


@query("a32_distinct_counts", "@daily|SELECT count(DISTINCT city) AS cities, count(DISTINCT year) AS years, count(DISTINCT is_risk_day) AS labels FROM daily")
def a32(spark, sf):
    return views.daily(spark, sf).agg(F.count_distinct("city").alias("cities"), F.count_distinct("year").alias("years"), F.count_distinct("is_risk_day").alias("labels"))


@query(
    "a33_histogram",
    """@lines|WITH b AS (SELECT city, min(p) AS lo, max(p) AS hi, count(*) AS k FROM lines GROUP BY city)
SELECT city, bin, count(*) AS n, round(any_value(lo + (hi - lo) / 60.0::DOUBLE * bin), 4) AS bin_start, round(count(*) / any_value(k * ((hi - lo) / 60.0::DOUBLE)), 12) AS density
FROM (SELECT *, CAST(least(floor((p - lo) * 60 / CAST(hi - lo AS DOUBLE)), 59) AS INTEGER) AS bin FROM lines JOIN b USING (city)) GROUP BY city, bin""",
)
def a33(spark, sf):
    h = rollup.histogram(views.lines(spark, sf).select("city", "p"), "p")
    return h.withColumns({"bin_start": F.round("bin_start", 4), "density": F.round("density", 12)})


BOX_SQL = """WITH q AS (SELECT {g}, quantile_cont({v}, 0.25) AS q25, quantile_cont({v}, 0.5) AS median, quantile_cont({v}, 0.75) AS q75 FROM {s} WHERE {v} IS NOT NULL GROUP BY {g})
SELECT {g}, count(*) AS n, any_value(q25) AS q25, any_value(median) AS median, any_value(q75) AS q75,
  min({v}) FILTER ({v} BETWEEN q25 - 1.5::DOUBLE * (q75 - q25) AND q75 + 1.5::DOUBLE * (q75 - q25)) AS whisker_low,
  max({v}) FILTER ({v} BETWEEN q25 - 1.5::DOUBLE * (q75 - q25) AND q75 + 1.5::DOUBLE * (q75 - q25)) AS whisker_high,
  count(*) FILTER ({v} NOT BETWEEN q25 - 1.5::DOUBLE * (q75 - q25) AND q75 + 1.5::DOUBLE * (q75 - q25)) AS n_outliers
FROM {s} JOIN q USING ({g}) WHERE {v} IS NOT NULL GROUP BY {g}"""


@query("a34_box_by_season", "@daily|" + BOX_SQL.format(g="city, season", v="temperature_2m_max", s="daily"))
def a34(spark, sf):
    return rollup.box_table(views.daily(spark, sf), "temperature_2m_max", ["city", "season"], large_groups=False)


@query("a34_box_large_groups", "@hourly|" + BOX_SQL.format(g="city", v="visibility", s="hourly"))
def a34_large(spark, sf):
    return rollup.box_table(views.hourly(spark, sf), "visibility", ["city"])


PROBS = list(rollup.NORMAL_QUANTILES)


@query(
    "a35_normal_quantiles",
    "@hourly|" + " UNION ALL ".join(f"SELECT city, {p}::DOUBLE AS probability, {rollup.NORMAL_QUANTILES[p]!r}::DOUBLE AS normal_quantile, round(quantile_cont(visibility, {p}), 6) AS observed FROM hourly GROUP BY city" for p in PROBS),
)
def a35(spark, sf):
    return rollup.normal_quantile_table(views.hourly(spark, sf), "visibility", ["city"]).withColumn("observed", F.round("observed", 6))


@query(
    "a36_card_statistics",
    "@scored|SELECT city, count(*) FILTER (probability >= 0.25) AS high_days, count(*) FILTER (probability >= 0.5) AS very_high_days, round(avg(probability), 10) AS mean_probability FROM scored GROUP BY city",
)
def a36(spark, sf):
    return fc.card_statistics(views.scored(spark, sf)).withColumn("mean_probability", F.round("mean_probability", 10))


@query("a38_rows_before", "@weather|SELECT count(*) FILTER (date < DATE '1999-01-01') AS n_before FROM weather")
def a38(spark, sf):
    return rollup.rows_before(views.weather(spark, sf), "1999-01-01")


@query("a39_target_distribution", "@daily|WITH t AS (SELECT lead(is_risk_day) OVER (PARTITION BY city ORDER BY date) AS target FROM daily) SELECT target, count(*) AS n, "
       + pct("count(*)", "(SELECT count(*) FROM t WHERE target IS NOT NULL)") + " AS pct FROM t WHERE target IS NOT NULL GROUP BY target")
def a39(spark, sf):
    from daypanel.operators.features import next_day_target

    return rollup.shares(next_day_target(views.daily(spark, sf), output="target").select("target"), "target")


RULE_SETS = {
    "wind_only": [Rule("wind_speed_10m_max", 50.0)],
    "three": [Rule("wind_speed_10m_max", 50.0), Rule("precipitation_sum", 15.0), Rule("snowfall_sum", 5.0)],
    "all": list(RISK_RULES),
}


@query(
    "a40_rule_set_counts",
    f"@weather|SELECT city, last_day(date) AS month_end, {big('sum(' + flag('wind_speed_10m_max > 50') + ')')} AS wind_only_days, "
    f"{big('sum(' + flag('wind_speed_10m_max > 50 OR precipitation_sum > 15 OR snowfall_sum > 5') + ')')} AS three_days, "
    f"{big('sum(' + flag('wind_speed_10m_max > 50 OR wind_gusts_10m_max > 75 OR precipitation_sum > 15 OR snowfall_sum > 5') + ')')} AS all_days FROM weather GROUP BY ALL",
)
def a40(spark, sf):
    return rollup.rule_set_counts(views.weather(spark, sf), RULE_SETS, ["city", F.last_day("date").alias("month_end")])


@query(
    "a40_rule_set_counts_by_year",
    f"@weather|SELECT city, CAST(year(date) AS INTEGER) AS year, {big('sum(' + flag('wind_speed_10m_max > 50') + ')')} AS wind_only_days, "
    f"{big('sum(' + flag('wind_speed_10m_max > 50 OR precipitation_sum > 15 OR snowfall_sum > 5') + ')')} AS three_days FROM weather GROUP BY ALL",
)
def a40_year(spark, sf):
    sets = {n: RULE_SETS[n] for n in ("wind_only", "three")}
    return rollup.rule_set_counts(views.weather(spark, sf), sets, ["city", F.year("date").alias("year")])


# ---- K top-k ------------------------------------------------------------------------------


def _top_sql(c: str, direction: str) -> str:
    return f"@weather|SELECT city, date, {c}, CAST(row_number() OVER (ORDER BY {c} {direction}, city, date) AS INTEGER) AS rank FROM weather WHERE {c} IS NOT NULL QUALIFY rank <= 10"


def _register_top(name: str, column: str, ascending: bool) -> None:
    @query(name, _top_sql(column, "ASC" if ascending else "DESC"))
    def top(spark, sf):
        return rollup.top_days(views.weather(spark, sf), column, ascending=ascending)


for _name, _column, _ascending in (
    ("k1_hottest", "temperature_2m_max", False), ("k1_coldest", "temperature_2m_min", True),
    ("k1_windiest", "wind_speed_10m_max", False), ("k1_wettest", "precipitation_sum", False),
):
    _register_top(_name, _column, _ascending)


@query(
    "k2_peak_and_trough",
    "@weather|SELECT city, arg_max(date, (temperature_2m_max, -epoch(date))) AS peak_day, max(temperature_2m_max) AS peak, arg_min(date, (temperature_2m_max, epoch(date))) AS trough_day, min(temperature_2m_max) AS trough FROM weather GROUP BY city",
)
def k2(spark, sf):
    c, d = F.col("temperature_2m_max"), F.unix_date("date")
    return views.weather(spark, sf).groupBy("city").agg(
        F.max_by("date", F.struct(c, -d)).alias("peak_day"), F.max(c).alias("peak"), F.min_by("date", F.struct(c, d)).alias("trough_day"), F.min(c).alias("trough")
    )


@query(
    "k3_top_null_columns",
    "@joined|SELECT column_name, nulls FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM joined" for c in MEASURES) + ") ORDER BY nulls DESC, column_name LIMIT 5",
)
def k3(spark, sf):
    audit = rollup.null_audit(views.joined(spark, sf), MEASURES).select("column_name", "nulls")
    return audit.orderBy(F.col("nulls").desc(), "column_name").limit(5)


@query("k4_winner_sort", "@monthly|SELECT city, year, month, risk_day_pct, wind_mean FROM monthly ORDER BY risk_day_pct DESC, wind_mean ASC, precip_total DESC, temp_max DESC, city, year, month LIMIT 1")
def k4(spark, sf):
    order = [F.col("risk_day_pct").desc(), F.col("wind_mean").asc(), F.col("precip_total").desc(), F.col("temp_max").desc(), F.col("city"), F.col("year"), F.col("month")]
    return views.monthly(spark, sf).orderBy(*order).limit(1).select("city", "year", "month", "risk_day_pct", "wind_mean")


@query("k6_first_risk_days", "@daily|SELECT city, date, wind_speed_10m_max, season FROM daily WHERE is_risk_day = 1 ORDER BY date, city LIMIT 10")
def k6(spark, sf):
    rows = views.daily(spark, sf).where(F.col("is_risk_day") == 1)
    return rows.orderBy("date", "city").limit(10).select("city", "date", "wind_speed_10m_max", "season")


# ---- R set operations and reshape ---------------------------------------------------------


@query("r1_union_all", "@weather,vis|SELECT city, date FROM weather UNION ALL SELECT city, date FROM vis")
def r1(spark, sf):
    return views.weather(spark, sf).select("city", "date").unionByName(views.visibility(spark, sf).select("city", "date"))


@query(
    "r2_concatenate",
    "@weather,vis|SELECT city, date, wind_speed_10m_max, CAST(NULL AS DOUBLE) AS visibility_mean FROM weather UNION ALL SELECT city, date, NULL, visibility_mean FROM vis",
)
def r2(spark, sf):
    a = views.weather(spark, sf).select("city", "date", "wind_speed_10m_max")
    return files.combine([a, views.visibility(spark, sf).select("city", "date", "visibility_mean")])


@query("r3_distinct", "@day_orders|SELECT DISTINCT city, date FROM day_orders")
def r3(spark, sf):
    return views.orders(spark, sf).select("city", "date").distinct()


@query("r4_difference", "@weather,vis|SELECT city, date FROM weather EXCEPT SELECT city, date FROM vis")
def r4(spark, sf):
    return views.weather(spark, sf).select("city", "date").distinct().join(views.visibility(spark, sf), ["city", "date"], "left_anti")


def _pivot_sql(keys: str, value: str, source: str) -> str:
    cols = ", ".join(f"avg({value}) FILTER (city = '{c}') AS \"{c}\"" for c in views.REGIONS)
    return f"SELECT {keys}, {cols} FROM {source} GROUP BY {keys}"


@query("r5_year_by_entity", "@daily|" + _pivot_sql("year", "temperature_2m_max", "daily"))
def r5(spark, sf):
    return rollup.to_wide(views.daily(spark, sf), ["year"], "city", views.REGIONS, "temperature_2m_max")


@query("r5_date_by_entity", "@weather|" + _pivot_sql("date", "temperature_2m_max", "weather"))
def r5_date(spark, sf):
    return rollup.to_wide(views.weather(spark, sf), ["date"], "city", views.REGIONS, "temperature_2m_max")


@query(
    "r5_entity_by_month",
    "@monthly|SELECT city, year, " + ", ".join(f'{big(f"sum(risk_days) FILTER (month = {m})")} AS "{m}"' for m in range(1, 13)) + " FROM monthly GROUP BY city, year",
)
def r5_month(spark, sf):
    return rollup.to_wide(views.monthly(spark, sf), ["city", "year"], "month", list(range(1, 13)), "risk_days", F.sum)


@query("r6_wide_to_long", "@long_joined|SELECT * FROM long_joined")
def r6(spark, sf):
    return rollup.to_long(views.joined(spark, sf), ["city", "date"], CORE)


@query("r7_year_overlay", "@weather|SELECT city, CAST(year(date) AS INTEGER) AS year, CAST(dayofyear(date) AS INTEGER) AS day_of_year, temperature_2m_max FROM weather")
def r7(spark, sf):
    return views.weather(spark, sf).select("city", F.year("date").alias("year"), F.dayofyear("date").alias("day_of_year"), "temperature_2m_max")


CATEGORY_CASE = (
    "CASE WHEN column_name LIKE '%\\_is\\_outlier' ESCAPE '\\' THEN 'Outlier flags' "
    "WHEN column_name LIKE 'risk\\_%' ESCAPE '\\' OR column_name = 'is_risk_day' THEN 'Risk flags' "
    "WHEN contains(column_name, '_lag') THEN 'Lag' WHEN contains(column_name, '_anom') THEN 'Anomaly' "
    "WHEN contains(column_name, '_7d_') OR contains(column_name, '_30d_') THEN 'Rolling' "
    "WHEN column_name IN ('year','month','quarter','day_of_year','week_of_year','day_of_week','season','month_sin','month_cos','doy_sin','doy_cos') THEN 'Calendar' "
    "WHEN column_name IN ('temp_range_c','temp_range_7d','hdd','cdd','wave_height') THEN 'Derived' WHEN column_name IN ('city','date') THEN 'Other' ELSE 'Base' END"
)
PICKED = ["date", "weather_code", "season", "hdd", "wind_speed_10m_max_lag1", "precipitation_sum_lag2", "wave_height_7d_max", "wave_height_anom",
          "risk_wind", "is_risk_day", "precipitation_sum_is_outlier", "visibility_mean"]


@query(
    "r8_column_categories",
    f"@daily|SELECT {CATEGORY_CASE} AS category, column_name, nulls FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM daily" for c in PICKED) + ")",
)
def r8(spark, sf):
    audit = rollup.null_audit(views.daily(spark, sf), PICKED).select("column_name", "nulls")
    return rollup.column_categories(PICKED, spark).join(audit, "column_name").select("category", "column_name", "nulls")
