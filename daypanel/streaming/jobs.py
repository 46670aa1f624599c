"""Streaming forms of three daily jobs. The batch operators are the reference for their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daypanel.functions.columns import count_where, stable_round
from daypanel.operators.clean import dedupe
from daypanel.operators.quality import out_of_range
from daypanel.sources.tables import upsert_path


def hours_to_days_stream(
    hourly: DataFrame, value: str = "visibility", threshold: float = 1000.0, entity: str = "city",
    timestamp: str = "datetime", tolerance: str = "3 days",
) -> DataFrame:
    """Tumbling one-day window; hours up to ``tolerance`` late still count.

    Watermarks need an instant: local wall-clock times are read as such in the session time
    zone, which is UTC here, so that windows start at local midnight.
    """
    day = F.window(timestamp, "1 day")
    return (
        hourly.withColumn(timestamp, F.col(timestamp).cast("timestamp"))
        .withWatermark(timestamp, tolerance)
        .groupBy(entity, day.alias("_day"))
        .agg(
            stable_round(F.avg(value), 1).alias("visibility_mean"),
            stable_round(F.min(value), 1).alias("visibility_min"),
            count_where(F.col(value) < threshold).alias("visibility_hours_below_1km"),
        )
        .select(entity, F.to_date("_day.start").alias("date"), "visibility_mean", "visibility_min", "visibility_hours_below_1km")
    )


def out_of_range_stream(rows: DataFrame) -> DataFrame:
    """Stateless filter of values outside their bounds."""
    return out_of_range(rows)


def upsert_stream(rows: DataFrame, path: str, checkpoint: str, keys: list[str]) -> StreamingQuery:
    """Merges every micro-batch into the layer; the batch number is the version, so a replay rewrites it."""

    def merge(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        rest = [F.col(c) for c in batch.columns if c not in keys]
        upsert_path(spark, path, dedupe(batch, keys, rest, keep="last"), keys, number)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
