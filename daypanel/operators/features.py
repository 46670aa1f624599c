"""Row-window and calendar features of a daily panel.

All windows of the chain share one partitioning by entity and one order by date, so the
whole chain costs a single shuffle and Catalyst evaluates same-ordered windows together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daypanel.constants import CONTEXT_COLUMNS
from daypanel.functions.calendar import add_seasonal_features
from daypanel.functions.columns import present
from daypanel.functions.physics import add_degree_days, add_wave_height, daily_range


#: Rows before its own that each operator of ``engineer_all_features`` reads, by its default windows and lags.
REACH = {"temperature_range": 7 - 1, "rolling": 30 - 1, "lag": 2, "short_term": 3 - 1}
#: Rows after a changed one whose features change with it.
CHAIN_REACH = max(REACH.values())


def along(entity: str, date: str) -> WindowSpec:
    return W.partitionBy(entity).orderBy(date)


def last_rows(n: int, entity: str, date: str) -> WindowSpec:
    return along(entity, date).rowsBetween(-(n - 1), W.currentRow)


def add_rolling_features(
    df: DataFrame,
    columns: Sequence[str] = CONTEXT_COLUMNS,
    windows: Sequence[int] = (7, 30),
    entity: str = "city",
    date: str = "date",
) -> DataFrame:
    """``<column>_<n>d_mean`` and ``_max`` over the last n rows, from the first row on."""
    new = {}
    for c in present(df, columns):
        for n in windows:
            rows = last_rows(n, entity, date)
            new[f"{c}_{n}d_mean"] = F.avg(c).over(rows)
            new[f"{c}_{n}d_max"] = F.max(c).over(rows)
    return df.withColumns(new)


def rolling_mean(
    df: DataFrame, column: str, n: int, min_rows: int, output: str, entity: str = "city", date: str = "date"
) -> DataFrame:
    """Mean of the last n rows once at least ``min_rows`` of them are known."""
    rows = last_rows(n, entity, date)
    return df.withColumn(output, F.when(F.count(column).over(rows) >= min_rows, F.avg(column).over(rows)))


def add_lag_features(
    df: DataFrame,
    columns: Sequence[str] = CONTEXT_COLUMNS,
    lags: Sequence[int] = (1, 2),
    entity: str = "city",
    date: str = "date",
) -> DataFrame:
    window = along(entity, date)
    return df.withColumns({f"{c}_lag{n}": F.lag(c, n).over(window) for c in present(df, columns) for n in lags})


def add_temperature_range(
    df: DataFrame,
    high: str = "temperature_2m_max",
    low: str = "temperature_2m_min",
    entity: str = "city",
    date: str = "date",
) -> DataFrame:
    if high not in df.columns or low not in df.columns:
        return df
    spread = daily_range(high, low)
    new = {"temp_range_c": spread}
    if entity in df.columns:
        new["temp_range_7d"] = F.round(F.avg(spread).over(last_rows(7, entity, date)), 2)
    return df.withColumns(new)


def add_anomaly_scores(
    df: DataFrame,
    columns: Sequence[str] = CONTEXT_COLUMNS,
    entity: str = "city",
    date: str = "date",
    past_only: bool = False,
) -> DataFrame:
    """Deviation from the mean of the same (entity, day of year) in sample standard deviations.

    ``past_only`` compares with earlier years alone and so does not look ahead.
    """
    same_day = W.partitionBy(entity, F.dayofyear(date))
    if past_only:
        same_day = same_day.orderBy(date).rowsBetween(W.unboundedPreceding, -1)
    new = {}
    for c in present(df, columns):
        sd = F.nullif(F.stddev_samp(c).over(same_day), F.lit(0.0))
        new[f"{c}_anom"] = F.coalesce(F.round((F.col(c) - F.avg(c).over(same_day)) / sd, 3), F.lit(0.0))
    return df.withColumns(new)


def add_short_term_features(
    df: DataFrame,
    wind: str = "wind_speed_10m_max",
    rain: str = "precipitation_sum",
    visibility: str = "visibility_min",
    entity: str = "city",
    date: str = "date",
) -> DataFrame:
    """One-day changes, three-row extremes and the signals made of them."""
    window, three = along(entity, date), last_rows(3, entity, date)
    has = set(df.columns)
    change = lambda c: F.coalesce(F.col(c) - F.lag(c, 1).over(window), F.lit(0.0))
    flag = lambda test: F.coalesce(test, F.lit(False)).cast("int")
    first = {}
    if wind in has:
        first["wind_change_1d"] = change(wind)
        first["wind_3d_max"] = F.max(wind).over(three)
    if rain in has:
        first["precip_change_1d"] = change(rain)
        first["precip_3d_sum"] = F.sum(rain).over(three)
    if visibility in has:
        first["low_visibility_recent"] = flag(F.min(visibility).over(three) < 3000)
    out = df.withColumns(first)
    second = {}
    if wind in has:
        second["strong_wind_recent"] = flag(F.col("wind_3d_max") >= 40)
    if wind in has and rain in has:
        second["wind_precip_combo"] = flag((F.col("wind_3d_max") >= 40) & (F.col("precip_3d_sum") >= 5))
    return out.withColumns(second)


def next_day_target(
    df: DataFrame, label: str = "is_risk_day", output: str = "target_risk_next_day",
    entity: str = "city", date: str = "date",
) -> DataFrame:
    """The label of the following row; the last row of an entity has none and is dropped."""
    shifted = F.lead(label, 1).over(along(entity, date)).cast("int")
    return df.withColumn(output, shifted).where(F.col(output).isNotNull())


def engineer_all_features(
    df: DataFrame, fetch: DataFrame, entity: str = "city", date: str = "date"
) -> DataFrame:
    """The full chain; wave height precedes the windows that read it. A new window or lag here belongs in ``REACH``."""
    out = add_seasonal_features(df, date)
    out = add_temperature_range(out, entity=entity, date=date)
    out = add_degree_days(out)
    out = add_wave_height(out, fetch, entity)
    out = add_rolling_features(out, entity=entity, date=date)
    out = add_anomaly_scores(out, entity=entity, date=date)
    out = add_lag_features(out, entity=entity, date=date)
    return add_short_term_features(out, entity=entity, date=date)


def preset_features(df: DataFrame, entity: str = "city", date: str = "date") -> DataFrame:
    """Rolling and lag columns of the SQL preset."""
    seven, window = last_rows(7, entity, date), along(entity, date)
    return df.withColumns(
        {
            "wind_speed_7d_avg": F.avg("wind_speed_10m_max").over(seven),
            "wind_speed_7d_max": F.max("wind_speed_10m_max").over(seven),
            "precip_7d_avg": F.avg("precipitation_sum").over(seven),
            "precip_7d_sum": F.sum("precipitation_sum").over(seven),
            "temp_7d_avg": F.avg("temperature_2m_mean").over(seven),
            "wind_speed_lag1": F.lag("wind_speed_10m_max", 1).over(window),
            "precip_lag1": F.lag("precipitation_sum", 1).over(window),
            "temp_lag1": F.lag("temperature_2m_mean", 1).over(window),
        }
    )


def row_blocks(
    df: DataFrame, entity: str, date: str, lookback: int, block: int = 4096, bucket_days: int = 512
) -> DataFrame:
    """Cuts long entities into blocks that windows can process in parallel.

    Rows are numbered by (count of earlier date buckets) + (row number inside the bucket), so
    no entity is sorted as a whole. Every block also receives the ``lookback`` rows before it,
    marked ``_home = false``. A row window of at most ``lookback + 1`` rows over
    (entity, ``_block``) then gives on home rows exactly what it gives over the entity.
    """
    if lookback > block:
        raise ValueError("lookback must not exceed the block length")
    bucketed = df.withColumn("_bucket", F.floor(F.unix_date(F.to_date(date)) / bucket_days))
    sizes = bucketed.groupBy(entity, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = W.partitionBy(entity).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(entity, "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    inside = W.partitionBy(entity, "_bucket").orderBy(date)
    numbered = bucketed.join(starts, [entity, "_bucket"]).withColumn(
        "_row", F.col("_start") + F.row_number().over(inside) - 1
    )
    home = F.floor(F.col("_row") / block)
    spill = F.col("_row") % block >= block - lookback
    copies = F.when(spill, F.array(home, home + 1)).otherwise(F.array(home))
    return (
        numbered.withColumn("_block", F.explode(copies))
        .withColumn("_home", F.col("_block") == home)
        .drop("_bucket", "_start")
    )


def over_blocks(
    df: DataFrame, columns: dict[str, tuple[Column, int, int]], entity: str, date: str, lookback: int, block: int = 4096
) -> DataFrame:
    """Evaluates row-window aggregates ``name -> (aggregate, first_row, last_row)`` blockwise."""
    blocks = row_blocks(df, entity, date, lookback, block)
    window = W.partitionBy(entity, "_block").orderBy("_row")
    new = {name: agg.over(window.rowsBetween(a, b)) for name, (agg, a, b) in columns.items()}
    return blocks.withColumns(new).where("_home").select(*df.columns, *columns)
