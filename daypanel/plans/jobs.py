"""The gated job: load, gate, clean, gate, features, gate, train, predict, gate, ledger."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.constants import HISTORY_START
from daypanel.operators import models, quality
from daypanel.operators.clean import caps_table
from daypanel.operators.forecast import daily_forecast, day_of_year_state, forecast_features, offshore_rows, summarise_window
from daypanel.operators.rollup import latest_dates, monthly_summary
from daypanel.plans.increments import changed_features
from daypanel.plans.layers import analytics_daily, clean_to_staging, preset_layers
from daypanel.session import scratch_table
from daypanel.sources import files, ledgers, versions
from daypanel.functions.physics import fetch_table

KEYS = ["city", "date"]


def fetch_window(latest: DataFrame, mode: str, as_of: dt.date, since: str | None = None, overlap_days: int = 3, start: str = HISTORY_START) -> DataFrame:
    """One row: first and last day to fetch. Incremental reaches ``overlap_days`` before the oldest maximum."""
    default = F.lit(start).cast("date")
    if mode == "full":
        first: Column = default
    elif since:
        first = F.lit(since).cast("date")
    else:
        first = F.coalesce(F.date_sub("oldest", overlap_days), default)
    oldest = latest.agg(F.min("max_date").alias("oldest"))
    return oldest.select(first.alias("fetch_start"), F.lit(as_of - dt.timedelta(days=1)).alias("fetch_end"))


def is_current(latest: DataFrame, as_of: dt.date) -> Column:
    """Whether every entity already has yesterday."""
    yesterday = F.lit(as_of - dt.timedelta(days=1))
    return latest.agg(F.coalesce(F.min(F.coalesce(F.col("max_date") >= yesterday, F.lit(False))), F.lit(False))).scalar()


def build_database(spark: SparkSession, directory: str, entities: int, start: str, end: str) -> dict[str, DataFrame]:
    """Files to the three layers of the SQL preset, with the validation rows."""
    weather = files.load_weather(spark, directory)
    visibility = files.load_visibility(spark, directory)
    staging, daily, monthly = preset_layers(weather, visibility)
    checks = quality.validate_layers(weather, staging, daily, monthly, entities, start, end)
    return {"weather": weather, "visibility": visibility, "staging": staging, "daily": daily, "monthly": monthly, "checks": checks}


@dataclass
class RunResult:
    status: str
    ledger: DataFrame
    checks: list[DataFrame] = field(default_factory=list)
    predictions: DataFrame | None = None
    summary: DataFrame | None = None


def run_job(
    spark: SparkSession, root: str, weather: DataFrame | None, visibility: DataFrame | None, as_of: dt.datetime,
    mode: str = "incremental", run_id: str | None = None, forecast: DataFrame | None = None,
    marine: DataFrame | None = None, caps: DataFrame | None = None, fetch: DataFrame | None = None,
    train: bool = True, predict: bool = True, features: list[str] | None = None,
    candidates=models.CANDIDATES, options: dict | None = None, strict_freshness: bool = False,
    lookback_days: int = 7,
) -> RunResult:
    """Runs the stages on the given new raw rows and appends a ledger row whatever happens.

    An incremental run starts from the layers of the last run that the ledger calls a success, so a refused or broken run
    is never a base. Raw rows, staging and daily features are stored by month: an increment writes the months that it changes, and
    features are recomputed only where a changed staging row reaches. Staging itself depends on statistics of the whole entity
    and is built as a whole. ``weather=None`` says that there is nothing new: an incremental run then checks that
    every entity has yesterday, takes the layers as they are and refreshes training and predictions. With ``train`` the candidates are trained whether or not there is a forecast; predictions are published
    after their gate.

    Each layer is written before its gate reads it, so a gate never recomputes the stage and
    later stages start from stored data.
    """
    started = dt.datetime.now()
    run_id = run_id or as_of.strftime("%Y%m%d_%H%M%S")
    day = as_of.date()
    caps = caps if caps is not None else caps_table(spark)
    fetch = fetch if fetch is not None else fetch_table(spark)
    gates: list[DataFrame] = []
    counts = {"rows_ingested": 0, "rows_cleaned": 0, "rows_analytics": 0}
    predictions = summary = None
    window, error, status = "", "", "SUCCESS"

    def store(df: DataFrame, layer: str) -> DataFrame:
        path = f"{root}/{layer}/run={run_id}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    def merge(df: DataFrame, layer: str, base: str | None) -> DataFrame:
        versions.merge_layer(df, f"{root}/{layer}", KEYS, run_id, base)
        return versions.read_layer(spark, f"{root}/{layer}", run_id)

    def reuse(layer: str, base: str | None) -> DataFrame:
        if not versions.has_version(spark, f"{root}/{layer}", base):
            raise RuntimeError(f"nothing new was given and there is no stored {layer}")
        return merge(versions.read_layer(spark, f"{root}/{layer}", base).limit(0), layer, base)

    def gate(stage: str, df: DataFrame, **extra) -> None:
        rows = quality.run_checks(stage, df, **extra).collect()
        result = spark.createDataFrame(rows, "check_name string, status string, severity string, stage string, details map<string,string>, message string")
        gates.append(result)
        if quality.any_aborting(result):
            raise RuntimeError(f"gate of stage {stage} stopped the run")

    try:
        base = last_success(spark, f"{root}/runs") if mode == "incremental" else None
        if weather is None:
            raw, staging, daily = reuse("raw_weather", base), reuse("staging", base), reuse("daily", base)
            reuse("raw_visibility", base)
            if not spark.range(1).select(is_current(latest_dates(raw.select("city").distinct(), raw), day)).first()[0]:
                raise RuntimeError("nothing new was given and the data is not current")
            gate("raw", raw, as_of=day, monthly=not strict_freshness)
        else:
            raw, vis = merge(weather, "raw_weather", base), merge(visibility, "raw_visibility", base)
            counts["rows_ingested"] = weather.count()
            gate("raw", raw, as_of=day, monthly=not strict_freshness)
            built = scratch_table(clean_to_staging(raw, vis, caps))
            known = versions.has_version(spark, f"{root}/staging", base) and versions.has_version(spark, f"{root}/daily", base)
            changed = scratch_table(versions.changed_rows(built, versions.read_layer(spark, f"{root}/staging", base), KEYS)) if known else built
            staging = merge(changed, "staging", base)
            counts["rows_cleaned"] = staging.count()
            gate("staging", staging)
            ledgers.flag_rows(staging, as_of).write.mode("append").parquet(f"{root}/quality_flags")
            if known:
                features_of = changed_features(staging, changed, versions.read_layer(spark, f"{root}/daily", base), fetch)
                daily = merge(scratch_table(features_of), "daily", base)
            else:
                daily = merge(scratch_table(analytics_daily(staging, fetch)), "daily", base)
        store(monthly_summary(daily), "monthly")
        counts["rows_analytics"] = daily.count()
        gate("analytics", daily)
        if train:
            past = day_of_year_state(daily)
            rates = store(past.rates(), "climatology")
            selection = models.train_and_select(daily, features, candidates, options=options)
            if predict:
                scored = None
                if forecast is not None:
                    future = forecast_features(staging, forecast, fetch, selection.features, lookback_days)
                    scored = models.score_with(selection.model, future, "model_probability")
                entities = past.entities()
                live = offshore_rows(marine) if marine is not None else None
                predictions = store(
                    daily_forecast(entities, day, scored, rates, past.global_rate(), live, past.sea_climate(), threshold=selection.threshold),
                    "predictions",
                )
                summary = summarise_window(predictions)
                gate("predict", predictions, entities=entities)
                ledgers.save_predictions(predictions, summary, f"{root}/published", as_of)
                window = f"{day}_{day + dt.timedelta(days=30)}"
    except Exception as problem:
        status, error = "FAILED", f"{type(problem).__name__}: {problem}"
    finished = dt.datetime.now()
    warnings = sum(quality.warnings_count(g).first()[0] for g in gates)
    row = ledgers.run_row(
        spark, run_id=run_id, mode=mode, start_time=started, end_time=finished,
        duration_sec=round((finished - started).total_seconds(), 1), status=status,
        predictions_for=window, errors=error, warnings_count=int(warnings), **counts,
    )
    ledgers.record_run(row, f"{root}/runs")
    return RunResult(status, row, gates, predictions, summary)


def last_success(spark: SparkSession, path: str) -> str | None:
    """The id of the latest successful run, or nothing before the first."""
    rows = ledgers.runs(spark, path).where("status = 'SUCCESS'").orderBy(F.col("end_time").desc(), F.col("run_id").desc())
    last = rows.select("run_id").first()
    return last["run_id"] if last else None
