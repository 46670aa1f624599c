"""Scores of the secondary (sea-state) hazard and their combination with a base probability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.constants import NO_SEA_DATA, OFFSHORE_WEIGHT
from daypanel.functions.columns import clip

# Driver name, columns, threshold and cap of each candidate score, in tie order.
CANDIDATES = [
    ("offshore wave height", "wave", 2.5, 0.85),
    ("wind-wave height", "wind_wave", 2.0, 0.75),
    ("swell height", "swell", 1.5, 0.65),
]


def threshold_score(value: Column, threshold: float, cap: float = 0.85) -> Column:
    """Logistic score around a threshold, between 0 and ``cap``; unknown scores 0."""
    if threshold <= 0:
        return F.lit(0.0)
    ratio = F.greatest(value, F.lit(0.0)) / threshold
    score = cap / (F.exp((ratio - 1.0) * -6.0) + 1.0)
    return F.when(value.isNull(), F.lit(0.0)).otherwise(clip(score, 0.0, cap))


def _measure(df: DataFrame, *names: str) -> Column:
    """First known alternative; a zero counts as unknown for all but the last one."""
    parts = []
    for i, name in enumerate(names):
        if name not in df.columns:
            value = F.lit(None).cast("double")
        else:
            value = F.col(name).cast("double")
        parts.append(value if i == len(names) - 1 else F.nullif(value, F.lit(0.0)))
    return F.coalesce(*parts)


def sea_risk(df: DataFrame) -> Column:
    """Struct of probability, driver, driver value, wave height and source for each row."""
    measures = {
        "wave": _measure(df, "wave_height_max", "wave_height", "wave_height_estimated"),
        "wind_wave": _measure(df, "wind_wave_height_max"),
        "swell": _measure(df, "swell_wave_height_max"),
    }
    period = _measure(df, "wave_period_max", "swell_wave_period_max")
    options = [
        F.when(
            measures[key].isNotNull(),
            F.struct(
                threshold_score(measures[key], threshold, cap).alias("score"),
                F.lit(-rank).alias("tie"),
                F.lit(name).alias("name"),
                measures[key].alias("value"),
            ),
        )
        for rank, (name, key, threshold, cap) in enumerate(CANDIDATES)
    ]
    best = F.array_max(F.array(*options))
    bonus = F.coalesce((period >= 6.0) & (measures["wave"] >= 1.0), F.lit(False)).cast("double") * 0.08
    probability = F.round(clip(best["score"] + bonus, 0.0, 0.90), 4)
    known = best.isNotNull()
    return F.struct(
        F.when(known, probability).otherwise(F.lit(0.0)).alias("offshore_sea_probability"),
        F.when(known, best["name"]).otherwise(F.lit(NO_SEA_DATA)).alias("offshore_driver"),
        F.when(known, F.round(best["value"], 2)).alias("offshore_driver_value"),
        F.round(measures["wave"], 2).alias("offshore_wave_height_m"),
        F.when(known, F.lit("marine_forecast")).otherwise(F.lit("not_available")).alias("offshore_source"),
    )


def add_sea_risk(df: DataFrame) -> DataFrame:
    return df.withColumn("_sea", sea_risk(df)).select(*df.columns, "_sea.*")


def combined_probability(base: Column, sea: Column, weight: float = OFFSHORE_WEIGHT) -> Column:
    """Two independent failure modes, the second one weighted; at most 0.95."""
    effective = clip(clip(sea, 0.0, 1.0) * weight, 0.0, 1.0)
    return clip(1.0 - (1.0 - clip(base, 0.0, 1.0)) * (1.0 - effective), 0.0, 0.95)


def calibrated_probability(probability: Column, calibrator=None) -> Column:
    """Optional mapping of the combined score; identity without a calibrator."""
    p = clip(probability, 0.0, 1.0)
    return p if calibrator is None else clip(calibrator(p), 0.0, 0.95)


def risk_reason(
    df: DataFrame, base: Column, adjusted: Column, threshold: Column, source: str = "source"
) -> Column:
    """At most three drivers in a fixed order, or a sentence that says where the score comes from."""

    def weather(name: str) -> Column:
        return F.col(name).cast("double") if name in df.columns else F.lit(None).cast("double")

    sea = F.coalesce(F.col("offshore_sea_probability"), F.lit(0.0))
    driver = F.col("offshore_driver")
    height = F.col("offshore_wave_height_m")
    named = (sea >= 0.25) & (F.coalesce(driver, F.lit("")) != "") & (driver != NO_SEA_DATA)
    with_height = F.concat(driver, F.lit(" ("), F.format_string("%.2f", height), F.lit("m wave estimate)"))
    sea_part = F.when(named, F.when(height.isNotNull(), with_height).otherwise(driver))
    historic = F.lower(F.coalesce(F.col(source), F.lit(""))).contains("climatology")

    gusts, wind = weather("wind_gusts_10m_max"), weather("wind_speed_10m_max")
    vis_min, vis_mean = weather("visibility_min"), weather("visibility_mean")
    live_parts = [
        F.when(gusts >= 75, "strong wind gusts").when(wind >= 50, "high wind"),
        F.when(weather("precipitation_sum") >= 15, "heavy precipitation"),
        F.when(weather("snowfall_sum") >= 5, "snowfall"),
        F.when(vis_min <= 500, "very low visibility").when(vis_mean <= 1000, "low visibility"),
    ]
    climate_parts = [F.when(sea_part.isNull(), "historical city/date risk pattern")]
    drivers = F.when(historic, F.array_compact(F.array(sea_part, *climate_parts))).otherwise(
        F.array_compact(F.array(sea_part, *live_parts))
    )
    listed = F.concat_ws(", ", F.slice(F.array_distinct(drivers), 1, 3))
    return (
        F.when(F.size(drivers) > 0, listed)
        .when((adjusted >= threshold) & (base >= threshold), "model signal from recent weather trends")
        .when((adjusted >= threshold) & (sea > 0), "offshore sea-state adjustment raised the risk")
        .otherwise("no major maritime risk driver")
    )
