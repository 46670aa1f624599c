"""Thresholds, lookup tables and column lists the results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: daily measures and their layers -------------------------------------
WEATHER_MEASURES = [
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "apparent_temperature_mean",
    "wind_speed_10m_max",
    "wind_gusts_10m_max",
    "wind_direction_10m_dominant",
    "precipitation_sum",
    "rain_sum",
    "snowfall_sum",
    "weather_code",
    "relative_humidity_2m_mean",
    "dew_point_2m_mean",
    "surface_pressure_mean",
    "shortwave_radiation_sum",
]
VISIBILITY_MEASURES = ["visibility_mean", "visibility_min", "visibility_hours_below_1km"]
FORECAST_MEASURES = [
    "temperature_2m_max",
    "temperature_2m_min",
    "wind_speed_10m_max",
    "wind_gusts_10m_max",
    "precipitation_sum",
    "snowfall_sum",
    "weather_code",
    "relative_humidity_2m_mean",
    "visibility_mean",
]
MARINE_MEASURES = [
    "wave_height_max",
    "wave_direction_dominant",
    "wave_period_max",
    "wind_wave_height_max",
    "swell_wave_height_max",
    "swell_wave_period_max",
]
# Decimals kept when the SQL-preset staging table is built.
STAGING_DECIMALS = {"wind_direction_10m_dominant": 1, "visibility_mean": 1, "visibility_min": 1}
STAGING_INTEGERS = ["weather_code", "visibility_hours_below_1km"]

# First day on which the visibility source has data.
VISIBILITY_FROM = "2022-01-01"
HISTORY_START = "2015-01-01"
HISTORY_END = "2024-12-31"


# --- Fixed values: risk rules -----------------------------------------------------------
@dataclass(frozen=True)
class Rule:
    """A threshold on one column; ``below`` turns the strict ``>`` into a strict ``<``."""

    column: str
    threshold: float
    below: bool = False
    flag: str | None = None


RISK_RULES = (
    Rule("wind_speed_10m_max", 50.0, flag="risk_wind"),
    Rule("wind_gusts_10m_max", 75.0, flag="risk_gust"),
    Rule("precipitation_sum", 15.0, flag="risk_precip"),
    Rule("snowfall_sum", 5.0, flag="risk_snow"),
    Rule("wave_height", 2.5, flag="risk_wave"),
    Rule("visibility_mean", 1000.0, below=True, flag="risk_visibility"),
    Rule("visibility_min", 500.0, below=True, flag="risk_fog_min"),
    Rule("visibility_hours_below_1km", 4.0),
)
# The simpler SQL preset knows five of them and no wave height.
PRESET_RULES = tuple(r for r in RISK_RULES if r.column in {
    "wind_speed_10m_max", "wind_gusts_10m_max", "precipitation_sum", "snowfall_sum", "visibility_mean"})
HIGH_RISK_DAYS = 5

# --- Fixed values: cleaning -------------------------------------------------------------
FILL_STRATEGIES = {
    "temperature_2m_max": "ffill",
    "temperature_2m_min": "ffill",
    "temperature_2m_mean": "ffill",
    "apparent_temperature_mean": "ffill",
    "wind_speed_10m_max": "ffill",
    "wind_gusts_10m_max": "ffill",
    "wind_direction_10m_dominant": "keep",
    "precipitation_sum": "zero",
    "rain_sum": "zero",
    "snowfall_sum": "zero",
    "weather_code": "mode",
    "relative_humidity_2m_mean": "ffill",
    "dew_point_2m_mean": "ffill",
    "surface_pressure_mean": "ffill",
    "shortwave_radiation_sum": "ffill",
    "visibility_mean": "median",
    "visibility_min": "median",
    "visibility_hours_below_1km": "median",
}
OUTLIER_COLUMNS = [
    "temperature_2m_max",
    "temperature_2m_min",
    "wind_speed_10m_max",
    "wind_gusts_10m_max",
    "precipitation_sum",
    "surface_pressure_mean",
]
CAPS = {
    "precipitation_sum": {"Anzali": 60.0, "Baku": 30.0, "Aktau": 25.0, "Turkmenbashi": 25.0, "Makhachkala": 40.0},
    "snowfall_sum": {"Anzali": 10.0, "Baku": 15.0, "Aktau": 20.0, "Turkmenbashi": 10.0, "Makhachkala": 30.0},
}
VALUE_BOUNDS = {
    "temperature_2m_max": (-50, 60),
    "temperature_2m_min": (-60, 55),
    "wind_speed_10m_max": (0, 300),
    "relative_humidity_2m_mean": (0, 100),
    "precipitation_sum": (0, 500),
}
PLAUSIBLE_BOUNDS = {
    "temperature_2m_max": (-80, 60),
    "wind_speed_10m_max": (0, 200),
    "precipitation_sum": (0, 200),
    "relative_humidity_2m_mean": (0, 100),
    "surface_pressure_mean": (850, 1080),
}

# --- Fixed values: places and open-water distances ----------------------------------------
PLACES = [
    # city, lat, lon, country, timezone, offshore lat, offshore lon
    ("Baku", 40.41, 49.87, "Azerbaijan", "Asia/Baku", 40.30, 50.10),
    ("Aktau", 43.65, 51.17, "Kazakhstan", "Asia/Aqtau", 43.55, 51.05),
    ("Anzali", 37.47, 49.46, "Iran", "Asia/Tehran", 37.55, 49.55),
    ("Turkmenbashi", 40.02, 52.97, "Turkmenistan", "Asia/Ashgabat", 40.05, 53.10),
    ("Makhachkala", 42.98, 47.50, "Russia", "Europe/Moscow", 42.90, 47.60),
]
SECTORS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]
FETCH_KM = {
    # city: kilometres of open water in the order of SECTORS
    "Baku": [400, 350, 50, 30, 30, 80, 250, 400],
    "Aktau": [80, 50, 30, 200, 400, 500, 500, 200],
    "Anzali": [700, 700, 500, 50, 30, 30, 100, 300],
    "Turkmenbashi": [100, 50, 30, 30, 50, 200, 500, 500],
    "Makhachkala": [30, 100, 400, 500, 700, 200, 30, 30],
}
DEFAULT_FETCH_KM = 200.0

# --- Fixed values: weather codes ----------------------------------------------------------
WEATHER_CODES = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Depositing rime fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    71: "Slight snowfall",
    73: "Moderate snowfall",
    75: "Heavy snowfall",
    77: "Snow grains",
    80: "Slight showers",
    81: "Moderate showers",
    82: "Violent showers",
    85: "Slight snow showers",
    86: "Heavy snow showers",
    95: "Thunderstorm",
    96: "Thunderstorm + slight hail",
    99: "Thunderstorm + heavy hail",
}
MODERATE_CODES = [45, 48, 55, 63, 73, 80, 81, 95]
HIGH_CODE_FROM = 65

# --- Fixed values: feature defaults -------------------------------------------------------
CONTEXT_COLUMNS = ["temperature_2m_mean", "precipitation_sum", "wind_speed_10m_max", "wave_height"]
REQUIRED_FEATURES = [
    "temperature_2m_mean",
    "wind_speed_10m_max",
    "precipitation_sum",
    "wave_height",
    "visibility_mean",
    "visibility_is_known",
    "hdd",
    "cdd",
    "temp_range_c",
    "month_sin",
    "month_cos",
    "doy_sin",
    "doy_cos",
    "is_risk_day",
    "wind_change_1d",
    "precip_change_1d",
    "wind_3d_max",
    "precip_3d_sum",
    "strong_wind_recent",
    "wind_precip_combo",
    "low_visibility_recent",
]
# Columns that define the label of the same day, or the label itself.
LEAKING_COLUMNS = [
    "is_risk_day",
    "target_risk_next_day",
    "high_risk_month",
    "risk_days",
    "risk_day_pct",
    "wind_speed_10m_max",
    "wind_gusts_10m_max",
    "precipitation_sum",
    "rain_sum",
    "snowfall_sum",
    "visibility_mean",
    "visibility_min",
    "visibility_hours_below_1km",
    "wave_height",
    "risk_wind",
    "risk_gust",
    "risk_precip",
    "risk_snow",
    "risk_wave",
    "risk_visibility",
    "risk_fog_min",
    "risk_fog_proxy",
]
WAVE_HISTORY_COLUMNS = [
    "wave_height_lag1",
    "wave_height_lag2",
    "wave_height_7d_mean",
    "wave_height_7d_max",
    "wave_height_30d_mean",
    "wave_height_30d_max",
    "wave_height_anom",
]

# --- Fixed values: risk bands and forecast texts ----------------------------------------
RISK_BANDS = [
    # upper edge (exclusive), label, action
    (0.10, "Low", "Proceed normally"),
    (0.25, "Moderate", "Monitor conditions"),
    (0.50, "High", "Plan with caution"),
    (0.75, "Very High", "Manual review advised"),
    (None, "Severe", "Avoid/postpone if possible"),
]
OFFSHORE_WEIGHT = 0.45
NO_SEA_DATA = "offshore sea-state data unavailable"
SEA_HISTORY = "historical offshore wave exposure"
DEFAULT_THRESHOLD = 0.10
