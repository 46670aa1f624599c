"""Degree days, daily ranges, compass sectors and wind-driven wave height."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.constants import DEFAULT_FETCH_KM, FETCH_KM, SECTORS
from daypanel.functions.columns import clip, small_table

GRAVITY = 9.81


def add_degree_days(df: DataFrame, base: float = 18.0, temperature: str = "temperature_2m_mean") -> DataFrame:
    """Heating and cooling degree days; an unknown temperature gives unknown degree days."""
    if temperature not in df.columns:
        return df
    t = F.col(temperature)
    floor_zero = lambda c: F.round(F.when(c < 0, F.lit(0.0)).otherwise(c), 2)
    return df.withColumns({"hdd": floor_zero(base - t), "cdd": floor_zero(t - base)})


def daily_range(high: str, low: str) -> Column:
    return F.round(F.col(high) - F.col(low), 2)


def sector_index(degrees: Column) -> Column:
    """0..7 for the compass sector of a bearing: 45 degrees each, centred on N, NE, ..."""
    bearing = F.pmod(F.coalesce(degrees, F.lit(0.0)) + 22.5, F.lit(360.0))
    return F.floor(bearing / 45).cast("int") % len(SECTORS)


def sector(degrees: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in SECTORS]), sector_index(degrees) + 1)


def fetch_table(spark: SparkSession, fetch_km: dict[str, list[float]] | None = None, entity: str = "city") -> DataFrame:
    """Open-water distances: one row per entity with the eight lengths in sector order.

    One row per entity lets the lookup join on the entity alone, which keeps the layout of a
    panel that is already partitioned by entity.
    """
    table = FETCH_KM if fetch_km is None else fetch_km
    rows = [(name, [float(km) for km in row]) for name, row in table.items()]
    return small_table(spark, rows, f"`{entity}` string, fetch_km array<double>")


def wave_height(speed_kmh: Column, fetch_km: Column) -> Column:
    """Fetch-limited significant wave height in metres, between 0 and 6."""
    u = speed_kmh / 3.6
    moving = F.when(u < 0.5, F.lit(0.5)).otherwise(u)
    u2 = moving * moving
    dimensionless = fetch_km * 1000.0 * GRAVITY / u2
    height = u2 * 0.283 / GRAVITY * F.tanh(F.pow(dimensionless, F.lit(0.42)) * 0.0125)
    return F.when(u < 0.5, F.lit(0.0)).otherwise(clip(height, 0.0, 6.0))


def add_wave_height(
    df: DataFrame,
    fetch: DataFrame,
    entity: str = "city",
    speed: str = "wind_speed_10m_max",
    direction: str = "wind_direction_10m_dominant",
    output: str = "wave_height",
) -> DataFrame:
    """Looks the fetch length of (entity, sector) up and derives the wave height.

    An unknown bearing counts as north; a place without a fetch row uses the default length.
    """
    bearing = F.col(direction).cast("double") if direction in df.columns else F.lit(None).cast("double")
    lengths = fetch.select(F.col(entity), F.col("fetch_km").alias("_fetch_km"))
    km = F.coalesce(F.try_element_at("_fetch_km", sector_index(bearing) + 1), F.lit(DEFAULT_FETCH_KM))
    height = F.round(wave_height(F.col(speed), km), 2)
    return df.join(lengths, entity, "left").select(*df.columns, height.alias(output))


def fog_proxy(humidity: str, temperature: str, dew_point: str, visibility: str) -> Column:
    """1 on moist, near-saturated days; null where a real visibility is known."""
    moist = (F.col(humidity) >= 90) & (F.col(temperature) - F.col(dew_point) <= 2)
    return F.when(F.col(visibility).isNull(), F.coalesce(moist, F.lit(False)).cast("int"))
