"""Typed layers: column lists of the raw tables and of the ledgers."""

from __future__ import annotations

from pyspark.sql import types as T

from daypanel.constants import FORECAST_MEASURES, MARINE_MEASURES, VISIBILITY_MEASURES, WEATHER_MEASURES


def _daily(measures: list[str], *extra: T.StructField) -> T.StructType:
    keys = [T.StructField("city", T.StringType()), T.StructField("date", T.DateType())]
    return T.StructType(keys + [T.StructField(m, T.DoubleType()) for m in measures] + list(extra))


WEATHER_DAILY = _daily(WEATHER_MEASURES)
VISIBILITY_DAILY = _daily(VISIBILITY_MEASURES)
FORECAST = _daily(FORECAST_MEASURES, T.StructField("loaded_at", T.TimestampType()))
MARINE_DAILY = _daily(MARINE_MEASURES)
HOURLY = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("datetime", T.TimestampNTZType()),
        T.StructField("visibility", T.DoubleType()),
    ]
)
QUALITY_FLAGS = T.StructType(
    [
        T.StructField("flagged_at", T.TimestampType()),
        T.StructField("city", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("reason", T.StringType()),
    ]
)
FETCH_LOG = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("file_path", T.StringType()),
    ]
)
RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_ingested", T.LongType()),
        T.StructField("rows_cleaned", T.LongType()),
        T.StructField("rows_analytics", T.LongType()),
        T.StructField("predictions_for", T.StringType()),
        T.StructField("errors", T.StringType()),
        T.StructField("warnings_count", T.LongType()),
    ]
)
RAW_TABLES = {
    "weather_daily": WEATHER_DAILY,
    "visibility_daily": VISIBILITY_DAILY,
    "forecast": FORECAST,
}
