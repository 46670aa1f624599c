"""Cleaning: known flags, imputation, caps, outlier flags, duplicates, continuity.

A panel has one row per (entity, date), so the rows of one entity are bounded by the number
of calendar days. Operators that look along the dates of an entity rely on that bound;
``dedupe`` establishes it with a map-side combined aggregation, never with a window over
the copies of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daypanel.constants import CAPS, FILL_STRATEGIES, OUTLIER_COLUMNS, STAGING_DECIMALS, STAGING_INTEGERS
from daypanel.functions.columns import count_where, join_groups, numeric_columns, present, small_table
from daypanel.operators.order_stats import exact_quantiles

DIRECTIONAL = {"ffill", "bfill"}
GROUP_STATISTICS = {
    "mean": lambda c: F.avg(c),
    "median": lambda c: F.median(c),
    "mode": lambda c: F.mode(c, True),
}


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def dedupe(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: str = "first"
) -> DataFrame:
    """One row per key, chosen by an explicit order.

    ``min_by``/``max_by`` are combined before the shuffle, so a key with very many copies
    costs one row per map task.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if keep == "first" else F.max_by
    chosen = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*keys, "_row.*").select(*df.columns)


def upsert(
    old: DataFrame, new: DataFrame, keys: Sequence[str], partial: bool = False
) -> DataFrame:
    """Rows of ``new`` replace those of ``old``; ``partial`` keeps old values where new is null."""
    both = old.withColumn("_load", F.lit(0)).unionByName(
        new.withColumn("_load", F.lit(1)), allowMissingColumns=True
    )
    return latest_by_key(both, keys, "_load", partial)


def latest_by_key(df: DataFrame, keys: Sequence[str], order: str, partial: bool = False) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c != order]
    if partial:
        picked = [
            F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in rest
        ]
        return df.groupBy(*keys).agg(*picked)
    return dedupe(df, keys, [F.col(order)], keep="last").drop(order)


def add_known_flag(df: DataFrame, column: str = "visibility_mean", output: str = "visibility_is_known") -> DataFrame:
    known = F.col(column).isNotNull().cast("int") if column in df.columns else F.lit(0)
    return df.withColumn(output, known)


def fill_expression(column: str, strategy: str, entity: str, date: str) -> Column:
    """The filled column as an expression over the rows of one entity."""
    value = F.col(column)
    along = W.partitionBy(entity).orderBy(date)
    if strategy == "zero":
        return F.coalesce(value, F.lit(0).cast("double"))
    if strategy == "ffill":
        # after the forward fill only leading nulls are left: they take the first known value
        before = F.last(column, True).over(along.rowsBetween(W.unboundedPreceding, W.currentRow))
        leading = F.first(column, True).over(along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        return F.coalesce(before, leading)
    if strategy == "bfill":
        backwards = W.partitionBy(entity).orderBy(F.col(date).desc())
        return F.last(column, True).over(backwards.rowsBetween(W.unboundedPreceding, W.currentRow))
    raise ValueError(strategy)


def handle_missing_values(
    df: DataFrame, strategy: dict[str, str] | None = None, entity: str = "city", date: str = "date"
) -> DataFrame:
    """Imputes each column by its strategy; unknown strategies and absent columns are skipped.

    With a directional fill in the map the frame is laid out by entity once and the group
    statistics are read off the same layout. Otherwise they are a combined aggregation that
    is joined back, and the wide rows are not shuffled by entity at all.
    """
    strategy = FILL_STRATEGIES if strategy is None else strategy
    wanted = {c: strategy[c] for c in present(df, strategy)}
    by_group = {c: s for c, s in wanted.items() if s in GROUP_STATISTICS}
    directional = {c: s for c, s in wanted.items() if s in DIRECTIONAL}
    filled = {c: fill_expression(c, s, entity, date) for c, s in wanted.items() if s == "zero" or c in directional}
    dropped = [c for c, s in wanted.items() if s == "drop"]
    for c in dropped:
        # the row set is decided on the values as read, before any fill
        df = df.withColumn(f"_drop_{c}", F.col(c).isNull())
    source = df
    if by_group and directional:
        whole = W.partitionBy(entity)
        for c, s in by_group.items():
            filled[c] = F.coalesce(F.col(c), GROUP_STATISTICS[s](F.col(c)).over(whole))
    elif by_group:
        stats = df.groupBy(entity).agg(
            *[GROUP_STATISTICS[s](F.col(c)).alias(f"_fill_{c}") for c, s in by_group.items()]
        )
        source = df.join(stats, entity, "left")
        filled.update({c: F.coalesce(F.col(c), F.col(f"_fill_{c}")) for c in by_group})
    out = source.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])
    for c in dropped:
        out = out.where(~F.col(f"_drop_{c}"))
    return out.drop(*[f"_drop_{c}" for c in dropped])


def caps_table(
    spark: SparkSession, caps: dict[str, dict[str, float]] | None = None, entity: str = "city"
) -> DataFrame:
    """Caps as one row per entity and one column ``<measure>_cap`` per capped measure."""
    caps = CAPS if caps is None else caps
    names = sorted({name for row in caps.values() for name in row})
    rows = [(n, *[float(caps[c][n]) if n in caps[c] else None for c in caps]) for n in names]
    schema = f"`{entity}` string, " + ", ".join(f"{c}_cap double" for c in caps)
    return small_table(spark, rows, schema)


def winsorize(df: DataFrame, caps: DataFrame, entity: str = "city") -> DataFrame:
    """Values above the cap of their entity become the cap; nulls and uncapped entities stay."""
    capped = [c[: -len("_cap")] for c in caps.columns if c.endswith("_cap")]
    capped = present(df, capped)
    joined = df.join(caps, entity, "left")
    return joined.select(
        *[
            F.when(F.col(c) > F.col(f"{c}_cap"), F.col(f"{c}_cap")).otherwise(F.col(c)).alias(c)
            if c in capped
            else F.col(c)
            for c in df.columns
        ]
    )


def capped_counts(df: DataFrame, caps: DataFrame, entity: str = "city") -> DataFrame:
    """How many values of each measure lie above the cap, per entity."""
    capped = present(df, [c[: -len("_cap")] for c in caps.columns if c.endswith("_cap")])
    return (
        df.join(caps, entity, "left")
        .groupBy(entity)
        .agg(*[count_where(F.col(c) > F.col(f"{c}_cap")).alias(f"{c}_capped") for c in capped])
    )


def flag_outliers(
    df: DataFrame,
    columns: Sequence[str] = OUTLIER_COLUMNS,
    method: str = "iqr",
    threshold: float = 1.5,
    entity: str = "city",
    large_groups: bool = False,
) -> DataFrame:
    """Adds ``<column>_is_outlier``; unknown values and groups without spread are never outliers.

    ``large_groups`` is for frames that are not daily panels: bounds then come from a
    distributed quantile search (``iqr``) or a combined aggregation (``zscore``) that is
    joined back, so no group is ever collected in one task.
    """
    columns = present(df, columns)
    if method not in ("iqr", "zscore"):
        raise ValueError(f"method must be 'iqr' or 'zscore', got {method!r}")
    if method == "iqr":
        bounds = {c: _iqr_bounds(c) for c in columns}
    else:
        bounds = {c: (F.avg(c), F.stddev_samp(c)) for c in columns}
    if large_groups:
        if method == "iqr":
            stats = None
            for c in columns:
                q = exact_quantiles(df, [entity], c, {f"_{c}_a": 0.25, f"_{c}_b": 0.75})
                stats = q if stats is None else stats.join(q, entity, "full")
        else:
            stats = df.groupBy(entity).agg(
                *[e.alias(f"_{c}_{i}") for c in columns for i, e in zip("ab", bounds[c])]
            )
        joined = join_groups(df, stats, [entity], how="left")
    else:
        whole = W.partitionBy(entity)
        joined = df.withColumns(
            {f"_{c}_{i}": e.over(whole) for c in columns for i, e in zip("ab", bounds[c])}
        )
    test = _iqr_test if method == "iqr" else _z_test
    flags = [
        test(F.col(c), F.col(f"_{c}_a"), F.col(f"_{c}_b"), threshold).alias(f"{c}_is_outlier") for c in columns
    ]
    return joined.select(*df.columns, *flags)


def _iqr_bounds(column: str) -> tuple[Column, Column]:
    return F.percentile(column, F.lit(0.25)), F.percentile(column, F.lit(0.75))


def _iqr_test(value: Column, q1: Column, q3: Column, k: float) -> Column:
    spread = q3 - q1
    outside = (spread != 0) & ((value < q1 - spread * k) | (value > q3 + spread * k))
    return F.coalesce(outside, F.lit(False))


def _z_test(value: Column, mean: Column, sd: Column, k: float) -> Column:
    z = F.abs((value - mean) / F.nullif(sd, F.lit(0.0)))
    return F.coalesce(z > k, F.lit(False))


def round_staging(df: DataFrame, keys: Sequence[str], decimals: dict[str, int] | None = None) -> DataFrame:
    """Rounds the measures for the SQL-preset staging table and casts the count-like ones."""
    decimals = STAGING_DECIMALS if decimals is None else decimals
    out = []
    for c in df.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in STAGING_INTEGERS:
            out.append(F.col(c).cast("int").alias(c))
        else:
            out.append(F.round(c, decimals.get(c, 2)).alias(c))
    return df.select(*out)


def continuity(df: DataFrame, entity: str = "city", date: str = "date") -> DataFrame:
    """Expected and actual days per entity, and how many days are missing.

    Counting needs no scaffold: the distinct days and the span decide it.
    """
    per_entity = (
        df.groupBy(entity, date)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy(entity)
        .agg(
            F.min(date).alias("first_date"),
            F.max(date).alias("last_date"),
            F.sum("_rows").alias("actual_days"),
            F.count(F.lit(1)).alias("_distinct"),
        )
    )
    expected = (F.datediff("last_date", "first_date") + 1).cast("long")
    return per_entity.select(
        entity,
        "first_date",
        "last_date",
        expected.alias("expected_days"),
        "actual_days",
        (expected - F.col("_distinct")).alias("missing_days"),
        F.when(expected > F.col("_distinct"), "GAPS").otherwise("OK").alias("status"),
    )


def missing_dates(df: DataFrame, entity: str = "city", date: str = "date") -> DataFrame:
    """One row per missing (entity, date) inside the span of each entity."""
    spans = df.groupBy(entity).agg(F.min(date).alias("_a"), F.max(date).alias("_b"))
    scaffold = spans.select(entity, F.explode(F.sequence("_a", "_b")).alias(date))
    return scaffold.join(df.select(entity, date), [entity, date], "left_anti")


def scaffold_days(df: DataFrame, entity: str = "city", date: str = "date") -> DataFrame:
    """The panel with a row for every day of each entity's span; new rows hold nulls."""
    spans = df.groupBy(entity).agg(F.min(date).alias("_a"), F.max(date).alias("_b"))
    days = spans.select(entity, F.explode(F.sequence("_a", "_b")).alias(date))
    return days.join(df, [entity, date], "left")


def cleaning_summary(
    before: DataFrame, after: DataFrame, raw: DataFrame, caps: DataFrame, entity: str = "city", date: str = "date"
) -> DataFrame:
    """One row: rows in and out, nulls filled and left, capped values, flags, missing days."""

    def nulls(frame: DataFrame) -> Column:
        parts = [F.col(c).isNull().cast("long") for c in numeric_columns(frame)]
        return F.coalesce(F.sum(sum(parts[1:], parts[0])), F.lit(0).cast("long"))

    flags = [c for c in after.columns if c.endswith("_is_outlier")]
    flag_sum = sum((F.col(c).cast("long") for c in flags), F.lit(0).cast("long"))
    counts = capped_counts(raw, caps, entity)
    capped = [F.col(c) for c in counts.columns if c != entity]
    total_capped = counts.agg(F.sum(sum(capped[1:], capped[0])).alias("n")).scalar()
    in_row = before.agg(F.struct(F.count(F.lit(1)).alias("rows"), nulls(before).alias("nulls"))).scalar()
    gaps = continuity(after, entity, date).agg(F.sum("missing_days")).scalar()
    out = after.agg(
        F.count(F.lit(1)).alias("rows_out"),
        nulls(after).alias("missing_remaining"),
        F.coalesce(F.sum(flag_sum), F.lit(0).cast("long")).alias("outlier_flags_set"),
    )
    return out.select(
        in_row["rows"].alias("rows_in"),
        "rows_out",
        (in_row["nulls"] - F.col("missing_remaining")).alias("missing_filled"),
        "missing_remaining",
        total_capped.alias("values_winsorized"),
        "outlier_flags_set",
        gaps.alias("date_gaps"),
    )
