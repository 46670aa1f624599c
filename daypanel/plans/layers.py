"""Layer builds: cleaning, analytics, the SQL preset and the visibility enrichment.

A layer is a chain of lazy transforms. After the key join, every step of the cleaning and of
the feature chain works on the layout by entity, so a layer costs one shuffle by entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.constants import OUTLIER_COLUMNS, PRESET_RULES, RISK_RULES, VISIBILITY_FROM, Rule
from daypanel.functions.calendar import season
from daypanel.functions.rules import add_rule_flags, label_risk_days
from daypanel.operators.clean import (
    add_known_flag, dedupe, drop_null_keys, flag_outliers, handle_missing_values, round_staging, winsorize,
)
from daypanel.operators.features import engineer_all_features, preset_features
from daypanel.operators.rollup import hours_to_days, monthly_summary, preset_monthly_summary

KEYS = ["city", "date"]


def join_visibility(weather: DataFrame, visibility: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Weather rows with their visibility, null where there is none. Keys are whole days."""
    as_day = lambda df: df.withColumn("date", F.to_date("date"))
    return as_day(weather).join(as_day(visibility), list(keys), "left")


def visibility_coverage(merged: DataFrame) -> DataFrame:
    known, total = F.count("visibility_mean"), F.count(F.lit(1))
    return merged.agg(
        known.alias("covered"), total.alias("rows"), F.round(known * 100.0 / F.nullif(total, F.lit(0)), 1).alias("covered_pct")
    )


def clean_to_staging(
    weather: DataFrame, visibility: DataFrame, caps: DataFrame,
    strategy: dict[str, str] | None = None, outliers: Sequence[str] = OUTLIER_COLUMNS,
) -> DataFrame:
    """Join, known flag, imputation, caps, outlier flags."""
    joined = join_visibility(weather, visibility)
    if "visibility_hours_below_1km" in joined.columns:
        joined = joined.withColumn("visibility_hours_below_1km", F.col("visibility_hours_below_1km").cast("int"))
    return (
        add_known_flag(joined)
        .transform(handle_missing_values, strategy)
        .transform(winsorize, caps)
        .transform(flag_outliers, outliers)
    )


def analytics_daily(staging: DataFrame, fetch: DataFrame, rules: Sequence[Rule] = RISK_RULES) -> DataFrame:
    """All features, the label of the full rule set and the seven named flags."""
    return (
        engineer_all_features(staging, fetch)
        .transform(label_risk_days, rules)
        .transform(add_rule_flags, rules)
    )


def analytics(staging: DataFrame, fetch: DataFrame) -> tuple[DataFrame, DataFrame]:
    daily = analytics_daily(staging, fetch)
    return daily, monthly_summary(daily)


def preset_staging(weather: DataFrame, visibility: DataFrame) -> DataFrame:
    """SQL preset: duplicates and null keys dropped, left join, rounding, casts."""
    order = [F.col(c) for c in weather.columns if c not in KEYS]
    vis_order = [F.col(c) for c in visibility.columns if c not in KEYS]
    clean_weather = dedupe(drop_null_keys(weather, KEYS), KEYS, order)
    clean_visibility = dedupe(drop_null_keys(visibility, KEYS), KEYS, vis_order)
    return round_staging(clean_weather.join(clean_visibility, KEYS, "left"), KEYS)


def preset_daily(staging: DataFrame) -> DataFrame:
    """SQL preset: calendar (Sunday is 0), five rules, seven-row windows, one lag."""
    day = F.col("date")
    dated = staging.withColumns(
        {
            "year": F.year(day), "month": F.month(day), "day_of_week": F.dayofweek(day) - 1,
            "day_of_year": F.dayofyear(day), "season": season(F.month(day)),
        }
    )
    flagged = label_risk_days(add_rule_flags(dated, PRESET_RULES), PRESET_RULES)
    return preset_features(flagged)


def preset_layers(weather: DataFrame, visibility: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    staging = preset_staging(weather, visibility)
    daily = preset_daily(staging)
    return staging, daily, preset_monthly_summary(daily)


def enrich_visibility(daily: DataFrame, hourly: DataFrame, start: str = VISIBILITY_FROM) -> DataFrame:
    """Hours of the daily range, from the first day that has visibility, aggregated and joined."""
    span = daily.agg(F.struct(F.min("date").alias("a"), F.max("date").alias("b"))).scalar()
    day = F.to_date("datetime")
    wanted = hourly.where((day >= F.lit(start).cast("date")) & (day >= span["a"]) & (day <= span["b"]))
    wanted = wanted.join(daily.select("city").distinct(), "city", "left_semi")
    return join_visibility(daily, hours_to_days(wanted))
