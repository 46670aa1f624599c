"""The forecast table: features for future rows, probabilities, reasons and window summary."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.constants import DEFAULT_THRESHOLD, HIGH_RISK_DAYS, NO_SEA_DATA, OFFSHORE_WEIGHT, SEA_HISTORY
from daypanel.functions.calendar import rolling_dates
from daypanel.functions.columns import clip, stable_round, with_null_columns
from daypanel.functions.hazard import add_sea_risk, calibrated_probability, combined_probability, risk_reason, sea_risk
from daypanel.operators.features import engineer_all_features
from daypanel.operators.timeseries import climatology_lookup, smooth_rates
from daypanel.session import scratch_table


def forecast_features(
    staging: DataFrame, forecast: DataFrame, fetch: DataFrame, feature_columns: Sequence[str] = (),
    lookback_days: int = 7, entity: str = "city", date: str = "date",
) -> DataFrame:
    """The feature chain over recent history and forecast rows; only forecast dates are kept.

    History is cut to the lookback before it is joined with anything, so the date filter
    reaches the scan. Thirty-day features see only the lookback; use 30 or more for full ones.
    """
    first_day = forecast.agg(F.min(date)).scalar()
    recent = staging.where((F.col(date) >= F.date_sub(first_day, lookback_days)) & (F.col(date) < first_day))
    both = recent.unionByName(forecast, allowMissingColumns=True)
    engineered = engineer_all_features(both, fetch, entity, date)
    kept = engineered.join(forecast.select(date).distinct(), date, "left_semi").select(*engineered.columns)
    return with_null_columns(kept, feature_columns)


def offshore_rows(marine: DataFrame, entity: str = "city", date: str = "date") -> DataFrame:
    """Sea-state risk of each live marine row."""
    return add_sea_risk(marine).select(
        entity, date, "offshore_sea_probability", "offshore_driver", "offshore_wave_height_m", "offshore_source"
    )


def offshore_climatology(
    daily: DataFrame, entities: DataFrame | None = None, entity: str = "city", date: str = "date"
) -> DataFrame:
    """Mean sea-state risk and wave height by (entity, day of year)."""
    rows = daily.where(F.col("wave_height").isNotNull())
    if entities is not None:
        rows = rows.join(entities.select(entity), entity, "left_semi")
    rows = rows.select(entity, date, "wave_height")
    scored = rows.withColumn("_p", sea_risk(rows)["offshore_sea_probability"])
    return scored.groupBy(entity, F.dayofyear(date).alias("day_of_year")).agg(
        stable_round(F.avg("_p"), 4).alias("offshore_sea_probability"),
        stable_round(F.avg("wave_height"), 2).alias("offshore_wave_height_m"),
    )


@dataclass
class DayOfYearState:
    """What the forecast table needs of the past: a written row per (entity, day of year), from one aggregation over the daily layer."""

    days: DataFrame
    entity: str = "city"

    def entities(self) -> DataFrame:
        return self.days.select(self.entity).distinct()

    def rates(self, half_window: int = 7) -> DataFrame:
        raw = self.days.select(self.entity, "day_of_year", F.try_divide(F.col("label_sum"), F.col("label_n")).alias("_raw"))
        return smooth_rates(raw, half_window, self.entity)

    def global_rate(self) -> Column:
        return self.days.agg(F.try_divide(F.sum("label_sum"), F.sum("label_n"))).scalar()

    def sea_climate(self) -> DataFrame:
        return self.days.where("wave_n > 0").select(self.entity, "day_of_year", "offshore_sea_probability", "offshore_wave_height_m")


def day_of_year_state(daily: DataFrame, label: str = "is_risk_day", entity: str = "city", date: str = "date") -> DayOfYearState:
    """Reads the layer once. Its rates, overall rate, sea climate and entities equal those of the functions that read the layer itself."""
    rows = daily.select(entity, date, F.col(label).cast("double").alias("_label"), "wave_height")
    sea = sea_risk(rows.drop("_label"))["offshore_sea_probability"]
    known = F.col("wave_height").isNotNull()
    days = rows.withColumn("_sea", F.when(known, sea)).groupBy(entity, F.dayofyear(date).alias("day_of_year")).agg(
        F.sum("_label").alias("label_sum"), F.count("_label").alias("label_n"), F.count("wave_height").alias("wave_n"),
        stable_round(F.avg("_sea"), 4).alias("offshore_sea_probability"), stable_round(F.avg("wave_height"), 2).alias("offshore_wave_height_m"),
    )
    return DayOfYearState(scratch_table(days), entity)


def scaffold(entities: DataFrame, start: dt.date, days_ahead: int = 30, entity: str = "city") -> DataFrame:
    """Every entity with every day of the window; a generator, not a join."""
    return entities.select(entity).distinct().withColumn("date", rolling_dates(F.lit(start), days_ahead))


def add_offshore(
    days: DataFrame, live: DataFrame | None, climate: DataFrame | None, entity: str = "city", date: str = "date"
) -> DataFrame:
    """Live sea-state row, else the climatology of the day of year, else nothing known."""
    fields = ["offshore_sea_probability", "offshore_driver", "offshore_wave_height_m", "offshore_source"]
    out, choices = days, []
    if live is not None:
        packed = live.select(entity, date, F.struct(*fields).alias("_live"))
        out = out.join(packed, [entity, date], "left")
        choices.append(F.col("_live"))
    if climate is not None:
        packed = climate.select(
            entity, F.col("day_of_year").alias("_doy"),
            F.struct(
                F.col("offshore_sea_probability"), F.lit(SEA_HISTORY).alias("offshore_driver"),
                F.col("offshore_wave_height_m"), F.lit("wave_climatology").alias("offshore_source"),
            ).alias("_climate"),
        )
        out = out.withColumn("_doy", F.dayofyear(date)).join(packed, [entity, "_doy"], "left")
        choices.append(F.col("_climate"))
    nothing = F.struct(
        F.lit(0.0).alias("offshore_sea_probability"), F.lit(NO_SEA_DATA).alias("offshore_driver"),
        F.lit(None).cast("double").alias("offshore_wave_height_m"), F.lit("not_available").alias("offshore_source"),
    )
    return out.withColumn("_sea", F.coalesce(*choices, nothing)).select(*days.columns, "_sea.*")


REASON_COLUMNS = [
    "wind_speed_10m_max", "wind_gusts_10m_max", "precipitation_sum", "snowfall_sum", "visibility_mean", "visibility_min",
]


def daily_forecast(
    entities: DataFrame, start: dt.date, scored: DataFrame | None, rates: DataFrame, overall: Column,
    live: DataFrame | None, sea_climate: DataFrame | None, days_ahead: int = 30, horizon: int = 16,
    threshold: float = DEFAULT_THRESHOLD, weight: float = OFFSHORE_WEIGHT, calibrator=None,
    entity: str = "city",
) -> DataFrame:
    """The 14-column daily table as one lazy plan.

    ``scored`` holds model probabilities of the forecast rows (entity, date, model_probability
    and the measures that reasons name). Days without one fall back to climatology.
    """
    days = scaffold(entities, start, days_ahead, entity)
    if scored is None:
        joined = days.withColumn("model_probability", F.lit(None).cast("double"))
    else:
        shown = [c for c in REASON_COLUMNS if c in scored.columns]
        rows = scored.select(entity, "date", "model_probability", *shown)
        rows = rows.where(F.col("date").between(F.lit(start), F.date_add(F.lit(start), horizon)))
        joined = days.join(rows, [entity, "date"], "left")
    with_rate = climatology_lookup(joined, rates, overall, entity, output="_rate")
    use_model = F.col("model_probability").isNotNull()
    based = with_rate.withColumns(
        {
            "_base": clip(F.when(use_model, F.col("model_probability")).otherwise(F.col("_rate")), 0.0, 1.0),
            "source": F.when(use_model, "short_horizon").otherwise("climatology"),
        }
    )
    sea = add_offshore(based, live, sea_climate, entity)
    raw = combined_probability(F.col("_base"), F.coalesce("offshore_sea_probability", F.lit(0.0)), weight)
    combined = sea.withColumn("_raw", raw).withColumn("_adjusted", calibrated_probability(F.col("_raw"), calibrator))
    reason = risk_reason(combined, F.col("_base"), F.col("_adjusted"), F.lit(threshold))
    return combined.select(
        entity,
        "date",
        F.dayofmonth("date").alias("day_of_month"),
        F.round("_base", 4).alias("port_weather_probability"),
        F.round("offshore_sea_probability", 4).alias("offshore_sea_probability"),
        F.round("_raw", 4).alias("uncalibrated_maritime_probability"),
        F.round("_adjusted", 4).alias("probability"),
        F.lit(0 if calibrator is None else 1).alias("probability_calibrated"),
        (F.col("_adjusted") >= threshold).cast("int").alias("prediction"),
        "source",
        "offshore_source",
        "offshore_driver",
        "offshore_wave_height_m",
        reason.alias("risk_reason"),
    )


def at_least(probabilities: Column, k: int) -> Column:
    """Exact probability of at least k successes among independent days.

    Folds the list of day probabilities into the distribution of 0..k successes (k absorbing);
    the list has one entry per day of the window.
    """
    start = F.array(F.lit(1.0), *[F.lit(0.0) for _ in range(k)])

    def add_day(dist: Column, p: Column) -> Column:
        states = []
        for j in range(k + 1):
            stay = dist[j] if j == k else dist[j] * (1.0 - p)
            states.append(stay + dist[j - 1] * p if j else stay)
        return F.array(*states)

    return F.aggregate(probabilities, start, add_day)[k]


def summarise(
    daily: DataFrame, keys: Sequence[str | Column], min_days: int = HIGH_RISK_DAYS,
    output: str = "high_risk_window_probability", date: str = "date",
) -> list[Column] | DataFrame:
    """Window bounds, predicted days, probability of ``min_days`` or more, rows by source."""
    ordered = F.sort_array(F.collect_list(F.struct(date, "probability")))
    chances = F.transform(ordered, lambda x: x["probability"])
    return daily.groupBy(*keys).agg(
        F.min(date).alias("window_start"),
        F.max(date).alias("window_end"),
        F.sum("prediction").alias("risk_days_predicted"),
        F.round(at_least(chances, min_days), 4).alias(output),
        F.sum((F.col("source") == "short_horizon").cast("long")).alias("n_short_horizon_days"),
        F.sum((F.col("source") == "climatology").cast("long")).alias("n_climatology_days"),
    )


def summarise_window(daily: DataFrame, min_days: int = HIGH_RISK_DAYS, entity: str = "city") -> DataFrame:
    return summarise(daily, [entity], min_days)


def summarise_months(daily: DataFrame, min_days: int = HIGH_RISK_DAYS, entity: str = "city") -> DataFrame:
    month = F.date_format("date", "yyyy-MM").alias("target_month")
    out = summarise(daily, [entity, month], min_days, "high_risk_month_probability")
    return out.drop("window_start", "window_end")


def visible_rows(daily: DataFrame, start: dt.date, end: dt.date, entity: str = "city", date: str = "date") -> DataFrame:
    return daily.where(F.col(date).between(F.lit(start), F.lit(end))).orderBy(entity, date)


def card_statistics(daily: DataFrame, entity: str = "city") -> DataFrame:
    """Days at or above the two display levels and the mean probability."""
    p = F.col("probability")
    return daily.groupBy(entity).agg(
        F.sum((p >= 0.25).cast("long")).alias("high_days"),
        F.sum((p >= 0.50).cast("long")).alias("very_high_days"),
        F.avg(p).alias("mean_probability"),
    )
