"""Fetch ledger, run ledger and quality-flag sink as append-only Parquet folders.

A record is appended and never rewritten; readers take the latest record of a key, which is
the upsert. An append that is repeated after a failure therefore does no harm.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.constants import VALUE_BOUNDS
from daypanel.operators.clean import latest_by_key
from daypanel.operators.quality import out_of_range
from daypanel.sources.schemas import FETCH_LOG, QUALITY_FLAGS, RUNS

FETCH_KEYS = ["city", "source", "start_date", "end_date"]


def read_ledger(spark: SparkSession, path: str, schema) -> DataFrame:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def record_fetches(records: DataFrame, path: str) -> None:
    records.select(*FETCH_LOG.fieldNames()).write.mode("append").parquet(path)


def fetch_log(spark: SparkSession, path: str) -> DataFrame:
    """Latest record of each fetch, newest first."""
    latest = latest_by_key(
        read_ledger(spark, path, FETCH_LOG).withColumn("_at", F.col("fetched_at")), FETCH_KEYS, "_at"
    )
    return latest.orderBy(F.col("fetched_at").desc(), *FETCH_KEYS)


def pending(requested: DataFrame, ledger: DataFrame) -> DataFrame:
    """Requests that the ledger does not hold yet."""
    return requested.join(ledger.select(*FETCH_KEYS), FETCH_KEYS, "left_anti")


RUN_DEFAULTS = {"rows_ingested": 0, "rows_cleaned": 0, "rows_analytics": 0, "predictions_for": "", "errors": "", "warnings_count": 0}


def run_rows(df: DataFrame) -> DataFrame:
    """Ledger rows from a frame of run values: absent columns by default or null, error text cut to its first 2,000 characters."""
    value = lambda name: F.col(name) if name in df.columns else F.lit(RUN_DEFAULTS.get(name))
    typed = df.select(*(value(f.name).cast(f.dataType).alias(f.name) for f in RUNS.fields))
    return typed.withColumn("errors", F.substring("errors", 1, 2000))


def run_row(spark: SparkSession, **values) -> DataFrame:
    """One ledger row."""
    filled = {**RUN_DEFAULTS, **values}
    return run_rows(spark.createDataFrame([tuple(filled.get(n) for n in RUNS.fieldNames())], RUNS))


def record_run(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)


def runs(spark: SparkSession, path: str) -> DataFrame:
    table = read_ledger(spark, path, RUNS).withColumn("_at", F.col("end_time"))
    return latest_by_key(table, ["run_id"], "_at")


def latest_runs(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    return runs(spark, path).orderBy(F.col("start_time").desc(), "run_id").limit(n)


def flag_rows(df: DataFrame, flagged_at: dt.datetime, bounds: dict[str, tuple[float, float]] = VALUE_BOUNDS) -> DataFrame:
    """Out-of-range values in the shape of the flag table."""
    return out_of_range(df, bounds).withColumn("flagged_at", F.lit(flagged_at)).select(*QUALITY_FLAGS.fieldNames())


def record_flags(df: DataFrame, path: str, flagged_at: dt.datetime, bounds: dict[str, tuple[float, float]] = VALUE_BOUNDS) -> None:
    flag_rows(df, flagged_at, bounds).write.mode("append").parquet(path)


def flag_summary(flags: DataFrame, n: int | None = None) -> DataFrame:
    """Rows per (column, reason), most frequent first; all of them unless ``n`` is given."""
    counted = flags.groupBy("column_name", "reason").agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.orderBy(F.col("n").desc(), "column_name", "reason")
    return ordered if n is None else ordered.limit(n)


def save_predictions(daily: DataFrame, summary: DataFrame, directory: str, generated_at: dt.datetime) -> dict[str, str]:
    """Daily rows, summary and one-row metadata under ``<directory>/latest``."""
    paths = {k: f"{directory}/latest/{k}" for k in ("daily", "monthly", "metadata")}
    daily.write.mode("overwrite").option("header", True).csv(paths["daily"])
    summary.write.mode("overwrite").option("header", True).csv(paths["monthly"])
    prediction_metadata(daily, generated_at).coalesce(1).write.mode("overwrite").json(paths["metadata"])
    return paths


def prediction_metadata(daily: DataFrame, generated_at: dt.datetime) -> DataFrame:
    return daily.agg(
        F.min("date").alias("window_start"), F.max("date").alias("window_end"), F.count_distinct("date").alias("days")
    ).withColumns(
        {
            "daily_path": F.lit("latest/daily"),
            "monthly_path": F.lit("latest/monthly"),
            "generated_at": F.lit(generated_at),
        }
    )
