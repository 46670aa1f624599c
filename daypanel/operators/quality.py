"""Quality gates and audits. Every check is a frame of rows, so results can be stored and joined.

Gate rows: check_name, status, severity, stage, details (map of text), message.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daypanel.constants import REQUIRED_FEATURES, VALUE_BOUNDS, VISIBILITY_FROM, VISIBILITY_MEASURES
from daypanel.functions.columns import count_where, numeric_columns, present, to_number
from daypanel.session import scratch_table

ABORT, WARN, FLAG = "ABORT", "WARN", "FLAG"
EMPTY_MAP = "map<string,string>"


def _verdict(name: str, severity: str, stage: str, status: Column, details: dict, message: Column) -> list[Column]:
    pairs = [x for k, v in details.items() for x in (F.lit(k), v.cast("string"))]
    packed = F.create_map(*pairs) if pairs else F.create_map().cast(EMPTY_MAP)
    return [
        F.lit(name).alias("check_name"), status.alias("status"), F.lit(severity).alias("severity"), F.lit(stage).alias("stage"),
        packed.alias("details"), message.alias("message"),
    ]


def _result(df: DataFrame, *verdict) -> DataFrame:
    return df.select(*_verdict(*verdict))


@dataclass
class Check:
    """What a check measures and how it judges.

    ``measures``: name to an aggregate over the rows of an entity and the aggregate that combines entities. ``rows``: the columns of each
    result row, over the combined measures. ``entity_rows``: the same over the measures of one entity. ``ordered``: the measures
    read ``_gap`` (days to the entity's next row) or ``_copy`` (the row is the second of its day).
    """

    measures: dict[str, tuple[Column, Callable]]
    rows: list[list[Column]] = field(default_factory=list)
    entity_rows: list[list[Column]] = field(default_factory=list)
    ordered: bool = False


def run_pass(df: DataFrame, checks: Sequence[Check], entity: str = "city", date: str = "date") -> DataFrame:
    """The result rows of all checks from one pass over the layer.

    The measures of all checks are one aggregation by entity, in the layout of the one window that ordered checks need, and a second one
    over entities; the verdicts are exploded from its row. Results by entity need the entities' measures twice, so
    these, a row per entity, are then written.
    """
    rows = df
    if any(c.ordered for c in checks):
        along = W.partitionBy(entity).orderBy(date)
        second = (F.lag(date, 1).over(along) == F.col(date)) & ~F.coalesce(F.lag(date, 2).over(along) == F.col(date), F.lit(False))
        rows = rows.withColumns({"_gap": F.datediff(F.lead(date, 1).over(along), date), "_copy": F.coalesce(second, F.lit(False))})
    measures = {n: m for c in checks for n, m in c.measures.items()}
    each = rows.groupBy(entity).agg(*[m.alias(n) for n, (m, _) in measures.items()])
    by_entity = [r for c in checks for r in c.entity_rows]
    if by_entity:
        each = scratch_table(each)
    explode = lambda found, results: found.select(F.explode(F.array(*[F.struct(*r) for r in results])).alias("_r")).select("_r.*")
    out = explode(each.agg(*[combine(n).alias(n) for n, (_, combine) in measures.items()]), [r for c in checks for r in c.rows])
    return out.unionByName(explode(each, by_entity)) if by_entity else out


def summed(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0).cast("long"))


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in [q.cast("string") if isinstance(q, Column) else q for q in parts]])


def check_row_count(df: DataFrame, table: str = "raw") -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("n"))
    ok = F.col("n") > 0
    return _result(
        n, "row_count", ABORT, "raw", F.when(ok, "PASS").otherwise("FAIL"),
        {"rows": F.col("n"), "table": F.lit(table)},
        F.when(ok, _text(f"{table}: ", F.col("n"), " rows")).otherwise(_text(f"{table} is empty")),
    )


def null_ratios(df: DataFrame, keys: Sequence[str] = ("city", "date")) -> DataFrame:
    """Column, rows and null percentage for every non-key column, in one pass."""
    from daypanel.operators.rollup import null_audit

    return null_audit(df.drop(*keys))


def null_ratio(df: DataFrame, max_ratio: float = 0.05, keys: Sequence[str] = ("city", "date")) -> Check:
    columns = [c for c in df.columns if c not in keys]
    n = F.col("null_rows")
    offender = [F.when(F.col(f"null_{c}") > n * max_ratio, _text(f"{c}=", F.round(F.col(f"null_{c}") * 100.0 / F.nullif(n, F.lit(0)), 2))) for c in columns]
    bad = F.array_compact(F.array(*offender)) if offender else F.array().cast("array<string>")
    empty, ok, listed = n == 0, F.size(bad) == 0, F.concat_ws(", ", bad)
    verdict = _verdict(
        "null_ratio", WARN, "staging", F.when(empty, "FAIL").when(ok, "PASS").otherwise("WARN"),
        {"threshold_pct": F.lit(max_ratio * 100), "rows_checked": n, "offenders": listed},
        F.when(empty, _text("table is empty")).when(ok, _text("all columns within the null threshold")).otherwise(_text(F.size(bad), " column(s) exceed it: ", listed)),
    )
    measures = {"null_rows": (F.count(F.lit(1)), summed)} | {f"null_{c}": (count_where(F.col(c).isNull()), summed) for c in columns}
    return Check(measures, [verdict])


def check_null_ratio(df: DataFrame, max_ratio: float = 0.05, keys: Sequence[str] = ("city", "date")) -> DataFrame:
    return run_pass(df, [null_ratio(df, max_ratio, keys)], keys[0])


def date_gaps(df: DataFrame, max_gap: int = 1, entity: str = "city", date: str = "date") -> DataFrame:
    """Pairs of consecutive days of an entity more than ``max_gap`` days apart."""
    following = F.lead(date).over(W.partitionBy(entity).orderBy(date))
    return (
        df.select(entity, date, following.alias("next_date"))
        .withColumn("gap_days", F.datediff("next_date", date))
        .where(F.col("gap_days") > max_gap)
    )


def gap_summary(df: DataFrame, max_gap: int = 1, entity: str = "city", date: str = "date") -> DataFrame:
    """Gap count and longest gap per entity, gap-free entities with zeros."""
    gaps = date_gaps(df, max_gap, entity, date)
    with_gaps = gaps.groupBy(entity).agg(F.count(F.lit(1)).alias("gap_count"), F.max("gap_days").alias("max_gap"))
    zero = F.lit(0)
    without = (
        df.select(entity).distinct().join(with_gaps, entity, "left_anti")
        .select(entity, zero.cast("long").alias("gap_count"), zero.alias("max_gap"))
    )
    return with_gaps.unionByName(without)


def date_continuity(max_gap: int = 3) -> Check:
    wide = F.col("_gap") > max_gap
    measures = {
        "gap_n": (count_where(wide), summed),
        "gap_worst": (F.coalesce(F.max(F.when(wide, F.col("_gap"))), F.lit(0)), lambda c: F.coalesce(F.max(c), F.lit(0))),
        "gap_entities": (F.coalesce(F.max(wide.cast("long")), F.lit(0).cast("long")), summed),
    }
    n, worst = F.col("gap_n"), F.col("gap_worst")
    verdict = _verdict(
        "date_continuity", WARN, "staging", F.when(n == 0, "PASS").otherwise("WARN"),
        {"max_gap_allowed": F.lit(max_gap), "gaps_found": n, "worst_gap_days": worst, "entities_with_gaps": F.col("gap_entities")},
        F.when(n == 0, _text(f"no gaps > {max_gap} days")).otherwise(_text(n, f" gaps > {max_gap} days (worst: ", worst, " days)")),
    )
    return Check(measures, [verdict], ordered=True)


def check_date_continuity(df: DataFrame, max_gap: int = 3, entity: str = "city", date: str = "date") -> DataFrame:
    return run_pass(df, [date_continuity(max_gap)], entity, date)


def out_of_range(
    df: DataFrame, bounds: dict[str, tuple[float, float]] = VALUE_BOUNDS, entity: str = "city", date: str = "date"
) -> DataFrame:
    """One row per value outside its bounds, with the bound in the reason. Also runs on streams."""
    checks = []
    for c in present(df, bounds):
        low, high = bounds[c]
        value = F.col(c).cast("double")
        reason = F.when(value < low, f"below_{low}").when(value > high, f"above_{high}")
        checks.append(
            F.when(
                reason.isNotNull(),
                F.struct(F.lit(c).alias("column_name"), value.alias("value"), reason.alias("reason")),
            )
        )
    return df.select(entity, date, F.explode(F.array_compact(F.array(*checks))).alias("_c")).select(
        entity, date, "_c.*"
    )


def value_ranges(df: DataFrame, bounds: dict[str, tuple[float, float]] = VALUE_BOUNDS) -> Check:
    columns = present(df, bounds)
    measures = {f"range_{c}": (count_where((F.col(c) < bounds[c][0]) | (F.col(c) > bounds[c][1])), summed) for c in columns}
    total = reduce(lambda a, b: a + b, [F.col(f"range_{c}") for c in columns], F.lit(0).cast("long"))
    listed = F.concat_ws(", ", *[F.when(F.col(f"range_{c}") > 0, _text(f"{c}=", F.col(f"range_{c}"))) for c in columns])
    verdict = _verdict(
        "value_ranges", FLAG, "staging", F.when(total == 0, "PASS").otherwise("FLAG"), {"flagged_total": total, "flagged_by_column": listed},
        F.when(total == 0, _text("all values within bounds")).otherwise(_text(total, " out-of-range values")),
    )
    return Check(measures or {"range_none": (F.lit(0).cast("long"), summed)}, [verdict])


def check_value_ranges(df: DataFrame, bounds: dict[str, tuple[float, float]] = VALUE_BOUNDS, entity: str = "city") -> DataFrame:
    return run_pass(df, [value_ranges(df, bounds)], entity)


def check_feature_completeness(df: DataFrame, required: Sequence[str] = REQUIRED_FEATURES) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        one = df.agg(F.count(F.lit(1)).alias("n"))
        return _result(
            one, "feature_completeness", WARN, "analytics", F.lit("FAIL"),
            {"missing_columns": F.lit(", ".join(missing))}, _text(f"{len(missing)} required columns missing"),
        )
    counted = df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in required])
    listed = F.concat_ws(", ", *[F.when(F.col(c) > 0, _text(f"{c}=", F.col(c))) for c in required])
    ok = listed == ""
    return _result(
        counted, "feature_completeness", WARN, "analytics", F.when(ok, "PASS").otherwise("WARN"),
        {"required": F.lit(len(required)), "null_offenders": listed},
        F.when(ok, _text("all required columns present and non-null")).otherwise(_text("nulls in ", listed)),
    )


def check_freshness(
    df: DataFrame, as_of: dt.date, max_days: int = 2, date: str = "date", name: str = "freshness"
) -> DataFrame:
    """Age of the latest day on a given day; never reads the clock itself."""
    latest = df.agg(F.max(date).alias("d"))
    age = F.datediff(F.lit(as_of), F.col("d"))
    empty, ok = F.col("d").isNull(), age <= max_days
    return _result(
        latest, name, WARN, "raw", F.when(empty, "FAIL").when(ok, "PASS").otherwise("WARN"),
        {"latest_date": F.col("d"), "days_behind": age, "max_days_allowed": F.lit(max_days)},
        F.when(empty, _text("no data")).otherwise(_text("data is ", age, f" days old, limit {max_days}")),
    )


def check_freshness_monthly(df: DataFrame, as_of: dt.date, date: str = "date") -> DataFrame:
    return check_freshness(df, as_of, 35, date, "freshness_monthly")


def prediction_coverage(
    predictions: DataFrame, entities: DataFrame, entity: str = "city", date: str = "date"
) -> DataFrame:
    """Expected, present, missing and duplicate days of every wanted entity in the window."""
    rows = predictions.withColumn(date, F.col(date).try_cast("date")).where(F.col(date).isNotNull())
    window = rows.agg(F.struct(F.min(date).alias("a"), F.max(date).alias("b"))).scalar()
    expected = (F.datediff(window["b"], window["a"]) + 1).cast("long")
    per_day = rows.groupBy(entity, date).agg(F.count(F.lit(1)).alias("_n"))
    per_entity = per_day.groupBy(entity).agg(
        F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("unique_dates")
    )
    zero = F.lit(0).cast("long")
    counted = entities.select(entity).join(per_entity, entity, "left").select(
        entity,
        expected.alias("expected_days"),
        F.coalesce("rows", zero).alias("rows"),
        F.coalesce("unique_dates", zero).alias("unique_dates"),
    )
    return counted.withColumns(
        {
            "missing_dates": F.col("expected_days") - F.col("unique_dates"),
            "duplicate_date_rows": F.col("rows") - F.col("unique_dates"),
        }
    )


VALID_SOURCES = ("short_horizon", "climatology")


def check_predictions(
    predictions: DataFrame, entities: DataFrame, entity: str = "city", date: str = "date",
    sources: Sequence[str] = VALID_SOURCES,
) -> DataFrame:
    """Window coverage, entity set, source values and probability range as one gate row."""
    needed = [entity, date, "probability", "source"]
    missing = [c for c in needed if c not in predictions.columns]
    if missing:
        one = predictions.agg(F.count(F.lit(1)).alias("n"))
        return _result(one, "predictions_completeness", WARN, "predict", F.lit("WARN"),
                       {"missing_columns": F.lit(", ".join(missing))}, _text("missing required columns"))
    p = to_number("probability")
    day = F.col(date).try_cast("date")
    rows = predictions.agg(
        F.count(F.lit(1)).alias("rows"),
        count_where(day.isNull()).alias("bad_dates"),
        count_where(~F.col("source").isin(list(sources))).alias("bad_sources"),
        count_where(p.isNull() | (p < 0) | (p > 1)).alias("bad_probabilities"),
    )
    coverage = prediction_coverage(predictions, entities, entity, date).agg(
        F.struct(
            count_where((F.col("missing_dates") > 0) | (F.col("duplicate_date_rows") > 0)).alias("bad"),
            F.sum("duplicate_date_rows").alias("duplicates"),
            count_where(F.col("rows") == 0).alias("absent"),
        )
    ).scalar()
    extra = (
        predictions.select(entity).where(F.col(entity).isNotNull()).distinct()
        .join(entities.select(entity), entity, "left_anti").agg(F.count(F.lit(1))).scalar()
    )
    out = rows.withColumns(
        {"bad_entities": coverage["bad"], "duplicates": coverage["duplicates"],
         "absent_entities": coverage["absent"], "unexpected_entities": extra}
    )
    problems = ["bad_dates", "bad_sources", "bad_probabilities", "bad_entities", "unexpected_entities"]
    ok = reduce(lambda a, b: a & b, [F.coalesce(F.col(c), F.lit(0)) == 0 for c in problems])
    empty = F.col("rows") == 0
    return _result(
        out, "predictions_completeness", WARN, "predict",
        F.when(empty, "FAIL").when(ok, "PASS").otherwise("WARN"),
        {c: F.col(c) for c in out.columns},
        F.when(empty, _text("no predictions")).when(ok, _text("predictions cover the window"))
        .otherwise(F.concat_ws("; ", *[F.when(F.col(c) > 0, _text(f"{c}=", F.col(c))) for c in problems])),
    )


def run_checks(stage: str, df: DataFrame, as_of: dt.date | None = None, monthly: bool = True, entities: DataFrame | None = None) -> DataFrame:
    """All gate rows of one stage; staging is read once for its three checks."""
    if stage == "raw":
        if as_of is None:
            raise ValueError("stage 'raw' needs as_of")
        fresh = check_freshness_monthly(df, as_of) if monthly else check_freshness(df, as_of)
        return check_row_count(df).unionByName(fresh)
    if stage == "staging":
        return run_pass(df, [null_ratio(df), date_continuity(), value_ranges(df)])
    if stage == "analytics":
        return check_feature_completeness(df)
    if stage == "predict":
        if entities is None:
            raise ValueError("stage 'predict' needs the expected entities")
        return check_predictions(df, entities)
    raise ValueError(f"unknown stage: {stage!r}")


def any_aborting(results: DataFrame) -> bool:
    """The one action of a gate: whether an ABORT check did not pass."""
    return not results.where((F.col("severity") == ABORT) & (F.col("status") != "PASS")).isEmpty()


def warnings_count(results: DataFrame) -> DataFrame:
    return results.agg(count_where(F.col("status").isin("WARN", "FAIL", "FLAG")).alias("warnings_count"))


def predicate_counts(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """Rows that satisfy each named predicate, in long form from one pass."""
    counted = df.agg(*[count_where(p).alias(f"p{i}") for i, p in enumerate(predicates.values())])
    rows = [F.struct(F.lit(n).alias("check_name"), F.col(f"p{i}").alias("violations")) for i, n in enumerate(predicates)]
    return counted.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def non_physical(df: DataFrame) -> dict[str, Column]:
    tests = {
        "precipitation_sum negative": ("precipitation_sum", lambda c: c < 0),
        "relative_humidity_2m_mean > 100": ("relative_humidity_2m_mean", lambda c: c > 100),
        "temperature_2m_max < -80": ("temperature_2m_max", lambda c: c < -80),
        "temperature_2m_max > 60": ("temperature_2m_max", lambda c: c > 60),
        "wind_speed_10m_max > 300": ("wind_speed_10m_max", lambda c: c > 300),
    }
    return {n: t(F.col(c)) for n, (c, t) in tests.items() if c in df.columns}


def audit(
    df: DataFrame, start: dt.date, end: dt.date, entity: str = "city", date: str = "date",
    cutoff: str = VISIBILITY_FROM, expected_null_columns: Sequence[str] = VISIBILITY_MEASURES,
) -> DataFrame:
    """Coverage, gaps, nulls, duplicates and extreme values of every entity, with warnings."""
    expected_days = (end - start).days + 1
    nums = numeric_columns(df)
    per_day = df.groupBy(entity, date).agg(
        F.count(F.lit(1)).alias("_rows"),
        count_where(F.col(date) < F.lit(cutoff).cast("date")).alias("_early"),
        *[count_where(F.col(c).isNull()).alias(f"_null_{c}") for c in nums],
        count_where((F.col("temperature_2m_max") > 60) | (F.col("temperature_2m_max") < -80)).alias("_hot")
        if "temperature_2m_max" in nums else F.lit(0).cast("long").alias("_hot"),
        count_where(F.col("wind_speed_10m_max") > 250).alias("_gale")
        if "wind_speed_10m_max" in nums else F.lit(0).cast("long").alias("_gale"),
    )
    per_entity = per_day.groupBy(entity).agg(
        F.sum("_rows").alias("rows"),
        F.min(date).alias("actual_start"),
        F.max(date).alias("actual_end"),
        F.count(F.lit(1)).alias("_distinct"),
        *[F.sum(c).alias(c) for c in per_day.columns if c.startswith("_") and c != "_rows"],
    )
    unexpected = [
        F.when(F.lit(c in expected_null_columns) & (F.col(f"_null_{c}") <= F.col("_early")), F.lit(0).cast("long"))
        .otherwise(F.col(f"_null_{c}"))
        for c in nums
    ]
    counted = per_entity.select(
        entity,
        "rows",
        F.lit(expected_days).cast("long").alias("expected_rows"),
        F.round(F.col("rows") * 100.0 / expected_days, 2).alias("coverage_pct"),
        "actual_start",
        "actual_end",
        (F.datediff("actual_end", "actual_start") + 1 - F.col("_distinct")).alias("gap_days"),
        reduce(lambda a, b: a + b, [F.col(f"_null_{c}") for c in nums], F.lit(0).cast("long")).alias("total_nulls"),
        reduce(lambda a, b: a + b, unexpected, F.lit(0).cast("long")).alias("unexpected_nulls"),
        (F.col("rows") - F.col("_distinct")).alias("duplicate_dates"),
        F.col("_hot").alias("extreme_temperatures"),
        F.col("_gale").alias("extreme_winds"),
    )
    texts = F.concat_ws(
        "; ",
        F.when(F.col("coverage_pct") < 95, "coverage below 95%"),
        F.when(F.col("gap_days") > 0, _text(F.col("gap_days"), " missing day(s)")),
        F.when(F.col("unexpected_nulls") > 0, _text(F.col("unexpected_nulls"), " unexpected null(s)")),
        F.when(F.col("duplicate_dates") > 0, _text(F.col("duplicate_dates"), " duplicate date rows")),
        F.when(F.col("extreme_temperatures") > 0, _text(F.col("extreme_temperatures"), " extreme temperatures")),
        F.when(F.col("extreme_winds") > 0, _text(F.col("extreme_winds"), " extreme winds")),
    )
    return counted.withColumns({"warnings": texts, "status": F.when(texts == "", "PASS").otherwise("WARN")})


def first_missing_dates(df: DataFrame, n: int = 5, entity: str = "city", date: str = "date") -> DataFrame:
    """The first n missing days per entity, each with its rank."""
    gaps = date_gaps(df.select(entity, date).distinct(), 1, entity, date)
    days = gaps.select(entity, F.explode(F.sequence(F.date_add(date, 1), F.date_sub("next_date", 1))).alias("missing_date"))
    rank = F.row_number().over(W.partitionBy(entity).orderBy("missing_date"))
    return days.withColumn("rank", rank).where(F.col("rank") <= n)


def validate_layers(
    raw: DataFrame, staging: DataFrame, daily: DataFrame, monthly: DataFrame, entities: int,
    start: str, end: str, min_rows: int = 1800, max_gap: int = 1, entity: str = "city", date: str = "date",
) -> DataFrame:
    """The validation battery: one row per check with status and detail, from one pass over each layer."""

    def row(name: str | Column, passed: Column, detail: Column) -> list[Column]:
        label = name if isinstance(name, Column) else F.lit(name)
        return [label.alias("check"), F.when(passed, "PASS").otherwise("FAIL").alias("status"), detail.cast("string").alias("detail")]

    n = F.col("n_rows")
    counted = {"n_rows": (F.count(F.lit(1)), summed)}
    rows_in = lambda layer: row(f"rows in {layer}", n > 0, n)
    first, last, copies, gaps = (F.col(c) for c in ("first_day", "last_day", "n_copies", "n_gaps"))
    # labels are 0 and 1
    labels = F.when(F.col("low_label").isNull(), 0).when(F.col("low_label") == F.col("high_label"), 1).otherwise(2).cast("long")
    of_raw = Check(counted | {"n_entities": (F.max(F.col(entity).isNotNull().cast("long")), summed)}, [rows_in("raw"), row("entity count", F.col("n_entities") == entities, F.col("n_entities"))])
    of_staging = Check(
        counted | {
            "first_day": (F.min(date), F.min), "last_day": (F.max(date), F.max), "n_copies": (count_where(F.col("_copy")), summed),
            "n_gaps": (count_where(F.col("_gap") > max_gap), summed),
        },
        [rows_in("staging"), row("range start", first <= F.lit(start).cast("date"), first), row("range end", last >= F.lit(end).cast("date"), last), row("duplicates", copies == 0, copies), row("date gaps", gaps == 0, gaps)],
        [row(_text("rows of ", F.col(entity)), n >= min_rows, n)], ordered=True,
    )
    of_daily = Check(counted | {"n_risk": (F.sum("is_risk_day"), F.sum)}, [rows_in("daily"), row("risk days", F.col("n_risk") > 0, F.col("n_risk"))])
    of_monthly = Check(counted | {"low_label": (F.min("high_risk_month"), F.min), "high_label": (F.max("high_risk_month"), F.max)}, [rows_in("monthly"), row("both labels", labels == 2, labels)])
    layers = [(raw, of_raw), (staging, of_staging), (daily, of_daily), (monthly, of_monthly)]
    return reduce(DataFrame.unionByName, [run_pass(df, [check], entity, date) for df, check in layers])


def jumps(df: DataFrame, column: str, sigmas: float = 5.0, entity: str = "city", date: str = "date") -> DataFrame:
    """Row-to-row changes larger than so many standard deviations of the column."""
    sd = F.stddev_samp(column).over(W.partitionBy(entity))
    change = F.col(column) - F.lag(column).over(W.partitionBy(entity).orderBy(date))
    return df.select(entity, date, F.col(column), change.alias("jump"), sd.alias("_sd")).where(
        F.abs("jump") > F.col("_sd") * sigmas
    ).drop("_sd")
