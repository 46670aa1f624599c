"""Roll-ups: hours to days, days to months and years, audits, histograms, box tables.

Everything here is a grouped aggregation with a map-side combine; no operator needs the rows
of a group together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daypanel.constants import HIGH_RISK_DAYS, RISK_RULES, Rule
from daypanel.functions.calendar import days_in_month, week_end
from daypanel.functions.columns import capped_coverage, count_where, join_groups, numeric_columns, present, small_table, stable_round
from daypanel.functions.rules import any_breach
from daypanel.operators.order_stats import exact_quantiles


def hours_to_days(
    hourly: DataFrame,
    value: str = "visibility",
    threshold: float = 1000.0,
    entity: str = "city",
    timestamp: str = "datetime",
    decimals: int | None = 1,
    drop_nulls: bool = False,
) -> DataFrame:
    """Daily mean, minimum and number of hours strictly below the threshold.

    The SQL preset drops null hours first and does not round.
    """
    rows = hourly.where(F.col(value).isNotNull()) if drop_nulls else hourly
    shown = (lambda c: c) if decimals is None else (lambda c: stable_round(c, decimals))
    return rows.groupBy(entity, F.to_date(timestamp).alias("date")).agg(
        shown(F.avg(value)).alias("visibility_mean"),
        shown(F.min(value)).alias("visibility_min"),
        count_where(F.col(value) < threshold).alias("visibility_hours_below_1km"),
    )


def _share(part: Column, total: Column, decimals: int) -> Column:
    return stable_round(part * 100.0 / total, decimals)


def _month_keys(entity: str, date: str) -> list[Column]:
    return [
        F.col(entity),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.trunc(date, "month").alias("month_start"),
    ]


def _core_measures(min_days: int) -> list[Column]:
    risk = F.sum("is_risk_day")
    return [
        F.count(F.lit(1)).alias("total_days"),
        risk.alias("risk_days"),
        _share(risk, F.count(F.lit(1)), 1).alias("risk_day_pct"),
        F.when(risk >= min_days, 1).otherwise(0).alias("high_risk_month"),
        F.sum("risk_wind").alias("wind_risk_days"),
        F.sum("risk_gust").alias("gust_risk_days"),
        F.sum("risk_precip").alias("precip_risk_days"),
        F.sum("risk_snow").alias("snow_risk_days"),
        F.sum("risk_visibility").alias("visibility_risk_days"),
        stable_round(F.avg("temperature_2m_mean"), 2).alias("temp_mean"),
        stable_round(F.max("temperature_2m_max"), 2).alias("temp_max"),
        stable_round(F.min("temperature_2m_min"), 2).alias("temp_min"),
        stable_round(F.stddev_samp("temperature_2m_mean"), 2).alias("temp_std"),
        stable_round(F.avg("wind_speed_10m_max"), 2).alias("wind_mean"),
        stable_round(F.max("wind_speed_10m_max"), 2).alias("wind_max"),
        stable_round(F.stddev_samp("wind_speed_10m_max"), 2).alias("wind_std"),
        stable_round(F.sum("precipitation_sum"), 2).alias("precip_total"),
        stable_round(F.avg("precipitation_sum"), 2).alias("precip_daily_avg"),
        stable_round(F.max("precipitation_sum"), 2).alias("precip_max"),
        stable_round(F.avg("visibility_mean"), 1).alias("vis_mean_avg"),
        stable_round(F.min("visibility_min"), 1).alias("vis_min_worst"),
    ]


def monthly_summary(
    daily: DataFrame, min_days: int = HIGH_RISK_DAYS, entity: str = "city", date: str = "date"
) -> DataFrame:
    """Main monthly table: counts, label, flag totals and measures with wave and degree days."""
    return daily.groupBy(*_month_keys(entity, date)).agg(
        *_core_measures(min_days),
        F.sum("risk_wave").alias("wave_risk_days"),
        F.sum("risk_fog_min").alias("severe_fog_days"),
        stable_round(F.sum("hdd"), 1).alias("hdd_total"),
        stable_round(F.sum("cdd"), 1).alias("cdd_total"),
        stable_round(F.avg("wave_height"), 2).alias("wave_mean"),
        stable_round(F.max("wave_height"), 2).alias("wave_max"),
    )


def preset_monthly_summary(
    daily: DataFrame, min_days: int = HIGH_RISK_DAYS, entity: str = "city", date: str = "date"
) -> DataFrame:
    """Monthly table of the SQL preset: gusts, dry days, snow, pressure, humidity, fog."""
    return daily.groupBy(*_month_keys(entity, date)).agg(
        *_core_measures(min_days),
        stable_round(F.avg("wind_gusts_10m_max"), 2).alias("gust_mean"),
        stable_round(F.max("wind_gusts_10m_max"), 2).alias("gust_max"),
        count_where(F.col("precipitation_sum") == 0).alias("dry_days"),
        stable_round(F.sum("snowfall_sum"), 2).alias("snow_total"),
        stable_round(F.max("snowfall_sum"), 2).alias("snow_max"),
        stable_round(F.avg("surface_pressure_mean"), 2).alias("pressure_mean"),
        stable_round(F.stddev_samp("surface_pressure_mean"), 2).alias("pressure_std"),
        stable_round(F.min("surface_pressure_mean"), 2).alias("pressure_min"),
        stable_round(F.avg("relative_humidity_2m_mean"), 2).alias("humidity_mean"),
        stable_round(F.max("relative_humidity_2m_mean"), 2).alias("humidity_max"),
        count_where(F.col("visibility_hours_below_1km") >= 4).alias("sustained_fog_days"),
    )


def monthly_features(
    daily: DataFrame,
    columns: Sequence[str] | None = None,
    rules: Sequence[Rule] = RISK_RULES,
    min_days: int = HIGH_RISK_DAYS,
    entity: str = "city",
    date: str = "date",
    fill_months: bool = False,
    null_is_risk: bool = True,
) -> DataFrame:
    """Mean, max, min and std of every numeric column per month-end, with the risk label.

    ``fill_months`` also lists months without rows inside the span of an entity.
    """
    columns = numeric_columns(daily) if columns is None else present(daily, columns)
    labelled = daily.withColumn("_risk", any_breach(daily, rules, null_is_risk))
    stats = {"mean": F.avg, "max": F.max, "min": F.min, "std": F.stddev_samp}
    out = labelled.groupBy(entity, F.last_day(date).alias("month_end")).agg(
        *[f(c).alias(f"{c}_{name}") for c in columns for name, f in stats.items()],
        F.sum("_risk").alias("risk_days"),
        F.count(F.lit(1)).alias("total_days"),
        _share(F.sum("_risk"), F.count(F.lit(1)), 2).alias("risk_day_pct"),
        (F.sum("_risk") >= min_days).cast("int").alias("high_risk_month"),
    )
    if not fill_months:
        return out
    spans = daily.groupBy(entity).agg(F.trunc(F.min(date), "month").alias("_a"), F.max(date).alias("_b"))
    months = spans.select(
        entity, F.explode(F.sequence("_a", "_b", F.expr("interval 1 month"))).alias("_m")
    ).select(entity, F.last_day("_m").alias("month_end"))
    filled = months.join(out, [entity, "month_end"], "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("risk_days", "total_days", "high_risk_month")}
    return filled.withColumns(zero)


def monthly_labels(
    daily: DataFrame,
    rules: Sequence[Rule] = RISK_RULES,
    min_days: int = HIGH_RISK_DAYS,
    entity: str = "city",
    date: str = "date",
    null_is_risk: bool = True,
) -> DataFrame:
    """The early label table: risk days, share, wind mean and max, precipitation total."""
    labelled = daily.withColumn("_risk", any_breach(daily, rules, null_is_risk))
    risk, total = F.sum("_risk"), F.count(F.lit(1))
    return labelled.groupBy(entity, F.last_day(date).alias("month_end")).agg(
        risk.alias("risk_days"),
        total.alias("total_days"),
        (risk / total * 100).alias("risk_day_pct"),
        F.avg("wind_speed_10m_max").alias("wind_max_mean"),
        F.max("wind_speed_10m_max").alias("wind_max_max"),
        F.coalesce(F.sum("precipitation_sum"), F.lit(0.0)).alias("precip_sum"),
        (risk >= min_days).cast("int").alias("high_risk_month"),
    )


def load_summary(df: DataFrame, entity: str = "city", date: str = "date", peak: str = "wind_speed_10m_max") -> DataFrame:
    """Rows, span, nulls over all numeric columns and the maximum of one column, per entity."""
    nulls = [F.col(c).isNull().cast("long") for c in numeric_columns(df)]
    return df.groupBy(entity).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.sum(sum(nulls[1:], nulls[0])).alias("nulls_total"),
        F.max(peak).alias(f"{peak}_peak"),
    )


def latest_dates(entities: DataFrame, df: DataFrame, entity: str = "city", date: str = "date") -> DataFrame:
    """Latest day of every wanted entity, null for those without rows."""
    return entities.select(entity).join(df.groupBy(entity).agg(F.max(date).alias("max_date")), entity, "left")


def null_audit(df: DataFrame, columns: Sequence[str] | None = None, group: Sequence[str] = ()) -> DataFrame:
    """Nulls and percentage per column in long form, from one pass over the data."""
    columns = [c for c in df.columns if c not in group] if columns is None else list(columns)
    counted = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("rows"),
        *[count_where(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(columns)],
    )
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("nulls")) for i, c in enumerate(columns)])
    )
    return counted.select(*group, "rows", pairs.alias("_p")).select(
        *group,
        "_p.column_name",
        "_p.nulls",
        stable_round(F.try_divide(F.col("_p.nulls") * 100.0, F.col("rows")), 2).alias("null_pct"),
    )


def shares(df: DataFrame, label: str, output: str = "n", decimals: int = 1) -> DataFrame:
    """Rows per label value with their percentage of all rows, from one scan: the total is summed over the counts, a row per label."""
    counted = df.groupBy(label).agg(F.count(F.lit(1)).alias(output))
    share = F.col(output) * 100.0 / F.sum(output).over(W.partitionBy())
    return counted.withColumn("pct", stable_round(share, decimals))


def describe_with_shape(df: DataFrame, variables: Sequence[str], entity: str = "city") -> DataFrame:
    """Count, moments, quartiles, skewness and excess kurtosis per (entity, variable)."""
    long = to_long(df, [entity], variables)
    known = long.where(F.col("value").isNotNull())
    return known.groupBy(entity, "variable").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.percentile("value", F.lit(0.25)).alias("q25"),
        F.percentile("value", F.lit(0.5)).alias("median"),
        F.percentile("value", F.lit(0.75)).alias("q75"),
        F.max("value").alias("max"),
        F.skewness("value").alias("skew"),
        F.kurtosis("value").alias("kurt"),
    )


def shape_summary(described: DataFrame) -> DataFrame:
    """Mean skewness and kurtosis of each variable, the most skewed first."""
    out = described.groupBy("variable").agg(F.avg("skew").alias("skew"), F.avg("kurt").alias("kurt"))
    return out.orderBy(F.abs("skew").desc(), "variable")


def to_long(df: DataFrame, keys: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """One row per key and variable."""
    variables = present(df, variables)
    values = [F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("value")) for v in variables]
    return df.select(*keys, F.explode(F.array(*values)).alias("_v")).select(*keys, "_v.*")


def to_wide(
    df: DataFrame, keys: Sequence[str], names: str, values: Sequence, value: str, aggregate=F.avg
) -> DataFrame:
    """Pivot with an explicit list of names, so no extra job is needed to find them."""
    return df.groupBy(*keys).pivot(names, list(values)).agg(aggregate(value))


def weekly_mean(df: DataFrame, column: str, output: str, entity: str = "city", date: str = "date") -> DataFrame:
    return df.groupBy(entity, week_end(F.col(date)).alias("week_end")).agg(F.avg(column).alias(output))


def monthly_mean(df: DataFrame, column: str, output: str, entity: str = "city", date: str = "date") -> DataFrame:
    return df.groupBy(entity, F.last_day(date).alias("month_end")).agg(F.avg(column).alias(output))


def month_coverage(df: DataFrame, entity: str = "city", date: str = "date", decimals: int = 1) -> DataFrame:
    """Share of the days of each month that are present, at most 100."""
    month = F.trunc(date, "month")
    per_month = df.groupBy(entity, month.alias("month_start")).agg(F.count(F.lit(1)).alias("days"))
    share = capped_coverage(F.col("days"), days_in_month(F.col("month_start")))
    return per_month.withColumn("coverage_pct", stable_round(share, decimals))


def histogram(df: DataFrame, column: str, bins: int = 60, group: Sequence[str] = ("city",)) -> DataFrame:
    """Counts and densities in equal-width bins between the minimum and maximum of each group."""
    group = list(group)
    known = df.where(F.col(column).isNotNull())
    spans = known.groupBy(*group).agg(
        F.min(column).alias("_lo"), F.max(column).alias("_hi"), F.count(F.lit(1)).alias("_n")
    )
    # equal values collapse before they meet the bounds
    counted = known.groupBy(*group, column).agg(F.count(F.lit(1)).alias("_c"))
    placed = join_groups(counted, spans, group, column)
    width = (F.col("_hi") - F.col("_lo")) / bins
    position = F.coalesce(F.try_divide((F.col(column) - F.col("_lo")) * bins, F.col("_hi") - F.col("_lo")), F.lit(0.0))
    index = F.least(F.floor(position), F.lit(bins - 1)).cast("int")
    return (
        placed.withColumn("bin", index)
        .groupBy(*group, "bin")
        .agg(
            F.sum("_c").alias("n"),
            F.max(F.col("_lo") + width * F.col("bin")).alias("bin_start"),
            F.try_divide(F.sum("_c"), F.max(F.col("_n") * width)).alias("density"),
        )
    )


def box_table(df: DataFrame, column: str, group: Sequence[str], large_groups: bool = True) -> DataFrame:
    """Quartiles, whisker ends and outlier count per group.

    The quartiles of groups without a size bound come from the distributed search.
    """
    group = list(group)
    if large_groups:
        quartiles = exact_quantiles(df, group, column, {"q25": 0.25, "median": 0.5, "q75": 0.75})
    else:
        quartiles = df.where(F.col(column).isNotNull()).groupBy(*group).agg(
            *[F.percentile(column, F.lit(p)).alias(n) for n, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))]
        )
    # equal values collapse before they meet the quartiles
    counted = df.where(F.col(column).isNotNull()).groupBy(*group, column).agg(F.count(F.lit(1)).alias("_c"))
    joined = join_groups(counted, quartiles, group, column)
    reach = (F.col("q75") - F.col("q25")) * 1.5
    inside = (F.col(column) >= F.col("q25") - reach) & (F.col(column) <= F.col("q75") + reach)
    return joined.groupBy(*group).agg(
        F.sum("_c").alias("n"),
        F.max("q25").alias("q25"),
        F.max("median").alias("median"),
        F.max("q75").alias("q75"),
        F.min(F.when(inside, F.col(column))).alias("whisker_low"),
        F.max(F.when(inside, F.col(column))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("_c"))).alias("n_outliers"),
    )


# Quantiles of the standard normal distribution at the listed probabilities.
NORMAL_QUANTILES = {
    0.01: -2.3263478740408408,
    0.05: -1.6448536269514729,
    0.10: -1.2815515655446004,
    0.25: -0.6744897501960817,
    0.50: 0.0,
    0.75: 0.6744897501960817,
    0.90: 1.2815515655446004,
    0.95: 1.6448536269514722,
    0.99: 2.3263478740408408,
}


def normal_quantile_table(df: DataFrame, column: str, group: Sequence[str]) -> DataFrame:
    """Observed quantiles beside those of the normal distribution."""
    group = list(group)
    names = {f"q{i}": p for i, p in enumerate(NORMAL_QUANTILES)}
    wide = exact_quantiles(df, group, column, names)
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(p).alias("probability"),
                    F.lit(NORMAL_QUANTILES[p]).alias("normal_quantile"),
                    F.col(n).alias("observed"),
                )
                for n, p in names.items()
            ]
        )
    )
    return wide.select(*group, rows.alias("_r")).select(*group, "_r.*")


def rows_before(df: DataFrame, cutoff, date: str = "date", output: str = "n_before") -> DataFrame:
    return df.agg(count_where(F.col(date) < F.lit(cutoff).cast("date")).alias(output))


def rule_set_counts(
    df: DataFrame, rule_sets: dict[str, Sequence[Rule]], keys: Sequence[Column | str], null_is_risk: bool = True
) -> DataFrame:
    """Risk days of several rule sets side by side."""
    return df.groupBy(*keys).agg(
        *[F.sum(any_breach(df, rules, null_is_risk)).alias(f"{name}_days") for name, rules in rule_sets.items()]
    )


def top_days(
    df: DataFrame, column: str, n: int = 10, ascending: bool = False, entity: str = "city", date: str = "date"
) -> DataFrame:
    """The n most extreme rows with their rank; equal values rank by entity and date."""
    order = [F.col(column).asc() if ascending else F.col(column).desc(), F.col(entity), F.col(date)]
    best = df.where(F.col(column).isNotNull()).select(entity, date, column).orderBy(*order).limit(n)
    return best.withColumn("rank", F.row_number().over(W.orderBy(*order)))


def column_categories(names: Sequence[str], spark) -> DataFrame:
    """Each column name with the category its pattern puts it in."""
    calendar = {"year", "month", "quarter", "day_of_year", "week_of_year", "day_of_week", "season",
                "month_sin", "month_cos", "doy_sin", "doy_cos"}
    derived = {"temp_range_c", "temp_range_7d", "hdd", "cdd", "wave_height"}
    table = small_table(spark, [(i, n) for i, n in enumerate(names)], "position int, column_name string")
    c = F.col("column_name")
    category = (
        F.when(c.endswith("_is_outlier"), "Outlier flags")
        .when(c.startswith("risk_") | (c == "is_risk_day"), "Risk flags")
        .when(c.contains("_lag"), "Lag")
        .when(c.contains("_anom"), "Anomaly")
        .when(c.contains("_7d_") | c.contains("_30d_"), "Rolling")
        .when(c.isin(calendar), "Calendar")
        .when(c.isin(derived), "Derived")
        .when(c.isin("city", "date"), "Other")
        .otherwise("Base")
    )
    return table.withColumn("category", category)
