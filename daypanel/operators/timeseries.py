"""Runs, autocorrelation, interpolation, seasonal decomposition and climatology."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daypanel.functions.columns import correlation
from daypanel.operators.clean import scaffold_days


def constant_runs(df: DataFrame, column: str, min_run: int = 7, entity: str = "city", date: str = "date") -> DataFrame:
    """Longest run of equal consecutive values; entities with fewer rows than ``min_run`` are left out."""
    window = W.partitionBy(entity).orderBy(date)
    same = F.coalesce(F.col(column) == F.lag(column).over(window), F.lit(False))
    run = F.sum(F.when(same, 0).otherwise(1)).over(window.rowsBetween(W.unboundedPreceding, W.currentRow))
    lengths = (
        df.select(entity, run.alias("_run")).groupBy(entity, "_run").agg(F.count(F.lit(1)).alias("_len"))
    )
    return (
        lengths.groupBy(entity)
        .agg(F.max("_len").alias("max_constant_run"), F.sum("_len").alias("_rows"))
        .where(F.col("_rows") >= min_run)
        .drop("_rows")
    )


def lag1_autocorrelation(df: DataFrame, column: str, entity: str = "city", date: str = "date") -> DataFrame:
    previous = F.lag(column).over(W.partitionBy(entity).orderBy(date))
    return df.select(entity, F.col(column), previous.alias("_p")).groupBy(entity).agg(
        correlation(column, "_p").alias("autocorr_lag1")
    )


def autocorrelation(
    df: DataFrame, column: str, lags: int = 30, entity: str = "city", date: str = "date"
) -> DataFrame:
    """Autocorrelations 0..lags with a common mean and variance, and the 1.96/sqrt(n) band.

    The lagged products are summed straight from lag windows of one ordered pass, so no
    self-join and no row blow-up is needed.
    """
    known = df.where(F.col(column).isNotNull())
    window = W.partitionBy(entity).orderBy(date)
    centred = known.select(
        entity, date, (F.col(column) - F.avg(column).over(W.partitionBy(entity))).alias("_x")
    )
    products = centred.select(
        entity, *[(F.col("_x") * (F.lag("_x", k).over(window) if k else F.col("_x"))).alias(f"_p{k}") for k in range(lags + 1)]
    )
    sums = products.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(f"_p{k}"), F.lit(0.0)).alias(f"_p{k}") for k in range(lags + 1)]
    )
    rows = F.explode(
        F.array(*[F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"_p{k}"), F.col("_p0")).alias("acf")) for k in range(lags + 1)])
    )
    return sums.select(entity, "n", rows.alias("_r")).select(
        entity, "_r.lag", "_r.acf", (F.lit(1.96) / F.sqrt(F.col("n"))).alias("band")
    )


def interpolate(
    df: DataFrame, column: str, limit: int = 3, entity: str = "city", date: str = "date", scaffold: bool = True
) -> DataFrame:
    """Linear filling by position inside gaps, at most ``limit`` steps; trailing gaps repeat the last value."""
    rows = scaffold_days(df.select(entity, date, column), entity, date) if scaffold else df.select(entity, date, column)
    forward = W.partitionBy(entity).orderBy(date)
    past = forward.rowsBetween(W.unboundedPreceding, W.currentRow)
    backwards = W.partitionBy(entity).orderBy(F.col(date).desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = rows.withColumn("_t", F.row_number().over(forward))
    known_at = F.when(F.col(column).isNotNull(), F.struct(F.col("_t").alias("t"), F.col(column).alias("v")))
    edges = numbered.withColumn("_k", known_at).withColumns(
        {"_left": F.last("_k", True).over(past), "_right": F.last("_k", True).over(backwards)}
    )
    step = F.col("_t") - F.col("_left.t")
    slope = (F.col("_right.v") - F.col("_left.v")) / F.nullif(F.col("_right.t") - F.col("_left.t"), F.lit(0))
    between = F.col("_left.v") + slope * step
    filled = F.when(step <= limit, F.coalesce(between, F.col("_left.v")))
    return edges.select(entity, date, F.coalesce(F.col(column), filled).alias(column))


def decompose(
    df: DataFrame, column: str, period: int = 365, entity: str = "city", date: str = "date"
) -> DataFrame:
    """Additive decomposition by position: centred moving mean, seasonal means, residual.

    The trend needs a full window (for an even period its two end points weigh one half), so
    its ends are null. Seasonal means are centred on zero over one period.
    """
    window = W.partitionBy(entity).orderBy(date)
    half = period // 2
    frame = window.rowsBetween(-half, half)
    width = 2 * half + 1
    total = F.sum("observed").over(frame)
    if period % 2 == 0:
        ends = F.lag("observed", half).over(window) + F.lead("observed", half).over(window)
        total = total - ends * 0.5
    base = df.select(entity, date, F.col(column).cast("double").alias("observed")).withColumn(
        "_t", F.row_number().over(window) - 1
    )
    trended = base.withColumns(
        {
            "trend": F.when(F.count("observed").over(frame) == width, total / period),
            "_pos": F.col("_t") % period,
        }
    )
    means = (
        trended.groupBy(entity, "_pos")
        .agg(F.avg(F.col("observed") - F.col("trend")).alias("_m"))
        .withColumn("seasonal", F.col("_m") - F.avg("_m").over(W.partitionBy(entity)))
        .select(entity, "_pos", "seasonal")
    )
    return trended.join(means, [entity, "_pos"], "left").select(
        entity, date, "observed", "trend", "seasonal",
        (F.col("observed") - F.col("trend") - F.col("seasonal")).alias("resid"),
    )


def decomposition_summary(parts: DataFrame, entity: str = "city", date: str = "date") -> DataFrame:
    """Trend change between its ends, seasonal amplitude and residual spread."""
    when = F.when(F.col("trend").isNotNull(), F.col(date))
    return parts.groupBy(entity).agg(
        (F.max_by("trend", when) - F.min_by("trend", when)).alias("trend_change"),
        (F.max("seasonal") - F.min("seasonal")).alias("seasonal_amplitude"),
        F.stddev_samp("resid").alias("resid_std"),
    )


def climatology(
    df: DataFrame, label: str = "is_risk_day", half_window: int = 7, entity: str = "city", date: str = "date"
) -> DataFrame:
    """Rate of the label by (entity, day of year), holes carried forward, circularly smoothed.

    Smoothing reads a window over a ring that is extended at both ends, so each entity costs
    366 + 2 * half_window rows and no self-join.
    """
    rates = df.groupBy(entity, F.dayofyear(date).alias("day_of_year")).agg(F.avg(label).alias("_raw"))
    return smooth_rates(rates, half_window, entity)


def smooth_rates(rates: DataFrame, half_window: int = 7, entity: str = "city") -> DataFrame:
    """The climatology of given rates: ``entity``, ``day_of_year``, ``_raw``."""
    slots = rates.select(entity).distinct().select(
        entity, F.explode(F.sequence(F.lit(1), F.lit(366))).alias("day_of_year")
    )
    ring = W.partitionBy(entity).orderBy("day_of_year")
    held = slots.join(rates, [entity, "day_of_year"], "left").select(
        entity, "day_of_year",
        F.last("_raw", True).over(ring.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("_held"),
    )
    if half_window == 0:
        return held.withColumnRenamed("_held", "rate")
    d = F.col("day_of_year")
    copies = F.array_compact(
        F.array(d, F.when(d > 366 - half_window, d - 366), F.when(d <= half_window, d + 366))
    )
    extended = held.select(entity, F.explode(copies).alias("day_of_year"), "_held")
    frame = W.partitionBy(entity).orderBy("day_of_year").rowsBetween(-half_window, half_window)
    full = F.count("_held").over(frame) == 2 * half_window + 1
    return (
        extended.select(entity, "day_of_year", F.when(full, F.avg("_held").over(frame)).alias("rate"))
        .where(d.between(1, 366))
    )


def climatology_lookup(
    df: DataFrame, table: DataFrame, global_rate, entity: str = "city", date: str = "date", output: str = "climatology_rate"
) -> DataFrame:
    """Adds the rate of (entity, day of year), the global rate where there is none."""
    keyed = df.withColumn("_doy", F.dayofyear(date))
    lookup = table.select(F.col(entity), F.col("day_of_year").alias("_doy"), F.col("rate").alias("_rate"))
    return keyed.join(lookup, [entity, "_doy"], "left").select(
        *df.columns, F.coalesce("_rate", global_rate).alias(output)
    )


def global_rate(df: DataFrame, label: str = "is_risk_day"):
    """Overall mean of the label as a scalar subquery."""
    return df.agg(F.avg(label)).scalar()
