"""Static dimensions: places with nested offshore coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daypanel.constants import PLACES


def places(spark: SparkSession) -> DataFrame:
    rows = [(n, lat, lon, country, tz, (olat, olon)) for n, lat, lon, country, tz, olat, olon in PLACES]
    schema = (
        "city string, lat double, lon double, country string, timezone string, "
        "offshore struct<lat:double,lon:double>"
    )
    return spark.createDataFrame(rows, schema)
