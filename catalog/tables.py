"""Sources and sinks that can be asked of the given tables.

Files and ledgers are written from the views to the scratch folder first; layer tables are covered by the tests.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog import views
from catalog.gates import RANGE_SQL, TIGHT
from catalog.registry import big, query
from daypanel.constants import WEATHER_MEASURES
from daypanel.operators import clean
from daypanel.session import scratch_path
from daypanel.sources import files, ledgers, payload, tables
from daypanel.sources.schemas import QUALITY_FLAGS, WEATHER_DAILY

S1_COLUMNS = ["temperature_2m_max", "wind_speed_10m_max", "precipitation_sum"]


def _payloads(spark, sf):
    """One JSON text per entity and year, as the service would send it."""
    rows = views.weather(spark, sf).withColumn("year", F.year("date"))
    packed = payload.to_payloads(rows, "daily", "date", S1_COLUMNS, by=["year"])
    return packed.select(F.to_json(F.struct("city", "daily")).alias("text"))


@query("s1_daily_payload", f"@weather|SELECT city, date, {', '.join(S1_COLUMNS)} FROM weather")
def s1(spark, sf):
    schema = payload.payload_schema("daily", S1_COLUMNS)
    parsed = _payloads(spark, sf).select(F.from_json("text", schema).alias("p")).select("p.*")
    return payload.daily_rows(parsed, S1_COLUMNS)


@query("s2_hourly_payload", "@hourly|SELECT city, date_trunc('second', datetime) AS datetime, visibility FROM hourly")
def s2(spark, sf):
    hours = views.hourly(spark, sf).select("city", F.to_timestamp_ntz(F.date_format("datetime", "yyyy-MM-dd HH:mm:ss")).alias("datetime"), "visibility")
    day = hours.withColumn("day", F.to_date("datetime"))
    packed = payload.to_payloads(day, "hourly", "datetime", ["visibility"], by=["day"])
    return payload.hourly_rows(packed)


@query("s3_marine_payload", "@marine|SELECT city, date, CAST(NULL AS DOUBLE) AS wave_direction_dominant, max(wave_height_max) AS wave_height_max, max(wave_period_max) AS wave_period_max, "
       "max(wind_wave_height_max) AS wind_wave_height_max, max(swell_wave_height_max) AS swell_wave_height_max, CAST(NULL AS DOUBLE) AS swell_wave_period_max FROM marine GROUP BY city, date")
def s3(spark, sf):
    days = views.marine(spark, sf).groupBy("city", "date").agg(
        *[F.max(c).alias(c) for c in ("wave_height_max", "wave_period_max", "wind_wave_height_max", "swell_wave_height_max")]
    ).withColumns({c: F.lit(None).cast("double") for c in ("wave_direction_dominant", "swell_wave_period_max")})
    month = days.withColumn("month", F.month("date"))
    return payload.marine_rows(payload.to_payloads(month, "daily", "date", payload.MARINE_MEASURES, by=["month"]))


@query("s6_split_visibility", "@joined|SELECT city, date, visibility_mean, visibility_min, CAST(visibility_hours_below_1km AS DOUBLE) AS visibility_hours_below_1km FROM joined WHERE visibility_mean IS NOT NULL")
def s6(spark, sf):
    return files.split_visibility(views.joined(spark, sf))


@query("s7_visibility_forms", f"@hourly|SELECT city, CAST(datetime AS DATE) AS date, avg(visibility) AS visibility_mean, min(visibility) AS visibility_min, CAST(count(*) FILTER (visibility < 1000) AS DOUBLE) AS visibility_hours_below_1km FROM hourly GROUP BY ALL")
def s7(spark, sf):
    return files.visibility_from(views.hourly(spark, sf))


@query("s13_upsert", "@weather,forecast|SELECT city, date, coalesce(f.wind_speed_10m_max, w.wind_speed_10m_max) AS wind_speed_10m_max FROM weather w FULL JOIN forecast f USING (city, date)")
def s13(spark, sf):
    pick = lambda df: df.select("city", "date", "wind_speed_10m_max")
    return clean.upsert(pick(views.weather(spark, sf)), pick(views.forecast(spark, sf)), ["city", "date"])


@query(
    "s13_upsert_partial",
    "@weather,forecast|SELECT city, date, coalesce(f.precipitation_sum, w.precipitation_sum) AS precipitation_sum, w.surface_pressure_mean FROM weather w FULL JOIN forecast f USING (city, date)",
)
def s13_partial(spark, sf):
    old = views.weather(spark, sf).select("city", "date", "precipitation_sum", "surface_pressure_mean")
    return clean.upsert(old, views.forecast(spark, sf).select("city", "date", "precipitation_sum"), ["city", "date"], partial=True)


@query("s15_combined", "@weather,forecast|SELECT city, date, weather_code, rain_sum FROM weather UNION ALL SELECT city, date, weather_code, NULL FROM forecast")
def s15(spark, sf):
    return files.combine([views.weather(spark, sf), views.forecast(spark, sf)]).select("city", "date", "weather_code", "rain_sum")


@query("s16_prediction_metadata", "@vis|SELECT min(date) AS window_start, max(date) AS window_end, count(DISTINCT date) AS days, 'latest/daily' AS daily_path, 'latest/monthly' AS monthly_path FROM vis")
def s16(spark, sf):
    import datetime as dt

    return ledgers.prediction_metadata(views.visibility(spark, sf), dt.datetime(2001, 11, 10)).drop("generated_at")


@query(
    "s17_pending_fetches",
    "@weather,vis|SELECT DISTINCT city, 'archive' AS source, strftime(date_trunc('month', date), '%Y-%m-%d') AS start_date, strftime(last_day(date), '%Y-%m-%d') AS end_date FROM weather "
    "WHERE (city, date_trunc('month', date)) NOT IN (SELECT (city, date_trunc('month', date)) FROM vis)",
)
def s17(spark, sf):
    def months(df):
        text = lambda c: F.date_format(c, "yyyy-MM-dd")
        return df.select("city", F.lit("archive").alias("source"), text(F.trunc("date", "month")).alias("start_date"), text(F.last_day("date")).alias("end_date")).distinct()

    return ledgers.pending(months(views.weather(spark, sf)), months(views.visibility(spark, sf)))


@query(
    "s20_sql_over_views",
    "@weather|SELECT city, year(date) AS year, count(*) AS days FROM weather WHERE wind_speed_10m_max > 50 GROUP BY ALL",
)
def s20(spark, sf):
    return tables.run_query(
        spark, "SELECT city, CAST(year(date) AS bigint) AS year, count(*) AS days FROM weather_view WHERE wind_speed_10m_max > 50 GROUP BY city, year(date)",
        weather_view=views.weather(spark, sf),
    )


@query(
    "s21_inventory",
    "@weather,vis|SELECT 'weather' AS table_name, 17 AS columns, count(*) AS rows FROM weather UNION ALL SELECT 'visibility', 5, count(*) FROM vis",
)
def s21(spark, sf):
    return tables.inventory({"weather": views.weather(spark, sf), "visibility": views.visibility(spark, sf)})


@query("s24_file_report", "SELECT 'lineitem.parquet' AS file_name, count(*) AS rows FROM lineitem UNION ALL SELECT 'orders.parquet', count(*) FROM orders")
def s24(spark, sf):
    report = files.file_report(spark, [f"{sf}/lineitem.parquet", f"{sf}/orders.parquet"], "parquet")
    return report.select("file_name", "rows")


@query(
    "s4_csv_layouts",
    "@weather|SELECT city, date, temperature_2m_max, wind_speed_10m_max, CASE WHEN year(date) % 2 = 0 THEN precipitation_sum END AS precipitation_sum FROM weather",
)
def s4(spark, sf):
    """Days written as CSV in two layouts, which differ in columns and their order, and read back by header."""
    rows, path = views.weather(spark, sf), scratch_path(spark)
    even = F.pmod(F.year("date"), F.lit(2)) == 0
    rows.where(even).select("city", "date", "temperature_2m_max", "wind_speed_10m_max", "precipitation_sum").write.option("header", True).csv(path)
    rows.where(~even).select("wind_speed_10m_max", "date", F.lit("x, y").alias("unlisted"), "city", "temperature_2m_max").write.option("header", True).mode("append").csv(path)
    read = files.conform(files.read_csv(spark, path, "*.csv"), WEATHER_DAILY)
    return read.select("city", "date", "temperature_2m_max", "wind_speed_10m_max", "precipitation_sum")


@query(
    "s18_run_ledger",
    "@weather|SELECT strftime(date, '%Y-%m') AS run_id, CASE WHEN max(wind_speed_10m_max) > 50 THEN 'success' ELSE 'failed' END AS status, count(*) AS rows_ingested, "
    "CASE WHEN max(wind_speed_10m_max) > 50 THEN 0 ELSE 2000 END AS error_chars, CAST(0 AS BIGINT) AS warnings_count FROM weather GROUP BY 1",
)
def s18(spark, sf):
    """One run per month, recorded as failed first; runs of windy months are repeated with success, which replaces the record."""
    months = views.weather(spark, sf).groupBy(F.date_format("date", "yyyy-MM").alias("run_id")).agg(
        F.count("*").alias("rows_ingested"), F.max("wind_speed_10m_max").alias("wind"), F.min("date").cast("timestamp").alias("start_time")
    )
    path = scratch_path(spark)
    failed = months.withColumns({"status": F.lit("failed"), "end_time": F.col("start_time"), "errors": F.repeat(F.col("run_id"), F.lit(400))})
    done = months.where("wind > 50").withColumns({"status": F.lit("success"), "end_time": F.expr("start_time + interval 1 hour")})
    for rows in (failed, done):
        ledgers.record_run(ledgers.run_rows(rows), path)
    return ledgers.runs(spark, path).select("run_id", "status", "rows_ingested", F.length("errors").alias("error_chars"), "warnings_count")


@query("s19_flag_sink", f"@weather|SELECT city, date, column_name, value, reason, TIMESTAMP '2024-01-01 00:00:00' AS flagged_at FROM ({RANGE_SQL}) UNION ALL SELECT city, date, column_name, value, reason, TIMESTAMP '2024-01-02 00:00:00' FROM ({RANGE_SQL})")
def s19(spark, sf):
    """Two appends to the flag table, read back."""
    path = scratch_path(spark)
    for day in (1, 2):
        ledgers.record_flags(views.weather(spark, sf), path, dt.datetime(2024, 1, day), TIGHT)
    return ledgers.read_ledger(spark, path, QUALITY_FLAGS).withColumn("flagged_at", F.col("flagged_at").cast("timestamp_ntz"))


@query(
    "s22_schema_listing",
    "SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS data_type FROM (DESCRIBE lineitem)",
)
def s22(spark, sf):
    return tables.schema_listing(spark.read.parquet(f"{sf}/lineitem.parquet"))


@query(
    "s23_schema_difference",
    "SELECT column_name, 'left' AS only_in FROM (DESCRIBE documents) WHERE column_name NOT IN (SELECT column_name FROM (DESCRIBE pages)) "
    "UNION ALL SELECT column_name, 'right' FROM (DESCRIBE pages) WHERE column_name NOT IN (SELECT column_name FROM (DESCRIBE documents))",
)
def s23(spark, sf):
    left, right = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "pages"))
    return tables.schema_difference(left, right)
