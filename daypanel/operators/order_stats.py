"""Exact order statistics that never sort a large group in one task.

Values are first counted, which collapses repeated values before the shuffle. The distinct values are dealt to ranges of
(group, value) whose bounds Spark samples from them, so ranges hold about as many each whatever the values' spread, and a large
group has many. Range totals are prefix-summed, and running sums are formed inside one range. Ranks, percentiles, AUC and ROC
points all follow from the sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daypanel.session import scratch_table


def value_counts(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Distinct values of each group with their number of rows ``n``."""
    return df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))


def value_ranges(cells: DataFrame, group: Sequence[str], value: str, parts: int | None = None) -> DataFrame:
    """The rows, one per (group, value), written in ranges of both, with the number of their range in ``_range``; ``parts`` fixes the number of ranges."""
    by = [*[F.col(g).asc_nulls_first() for g in group], F.col(value).asc()]
    dealt = cells.repartitionByRange(parts, *by) if parts else cells.repartitionByRange(*by)
    return scratch_table(dealt.withColumn("_range", F.spark_partition_id()))


def prefix_sums(cells: DataFrame, group: Sequence[str], value: str, measures: Sequence[str] = ("n",)) -> DataFrame:
    """Adds ``<measure>_before``, the sum over smaller values of the same group, and ``<measure>_total``, the group's sum.

    ``cells`` has one row per (group, value) and is computed once: its ranges are written, and their totals, one row per range and
    group that share a row, decide what each range starts from. Null groups are a group.
    """
    group = list(group)
    dealt = value_ranges(cells, group, value)
    whole = W.partitionBy(*group)
    earlier = whole.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    totals = dealt.groupBy(*group, "_range").agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    bases = totals.select(
        F.col("_range").alias("_of_range"),
        *[F.col(g).alias(f"_of_{g}") for g in group],
        *[F.coalesce(F.sum(f"_{m}").over(earlier), F.lit(0)).alias(f"_{m}_base") for m in measures],
        *[F.sum(f"_{m}").over(whole).alias(f"{m}_total") for m in measures],
    )
    same = F.col("_range") == F.col("_of_range")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    inside = W.partitionBy("_range", *group).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    return dealt.join(bases, same).select(
        *cells.columns,
        *[(F.col(f"_{m}_base") + F.coalesce(F.sum(m).over(inside), F.lit(0))).alias(f"{m}_before") for m in measures],
        *[f"{m}_total" for m in measures],
    )


def mid_ranks(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Distinct values with their count and average rank (ties share the mean of their ranks)."""
    sums = prefix_sums(value_counts(df, group, value), group, value)
    return sums.select(
        *group, value, "n", (F.col("n_before") + (F.col("n") + 1) / 2.0).alias("mid_rank")
    )


def exact_quantiles(
    df: DataFrame, group: Sequence[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Linearly interpolated quantiles per group, one column per entry of ``probs``."""
    group = list(group)
    sums = prefix_sums(value_counts(df, group, value), group, value)
    def at(index: Column) -> Column:
        hit = (F.col("n_before") <= index) & (index < F.col("n_before") + F.col("n"))
        return F.max(F.when(hit, F.col(value)))

    parts = []
    for name, p in probs.items():
        position = (F.col("n_total") - 1) * F.lit(float(p))
        parts += [
            at(F.floor(position)).alias(f"_{name}_lo"),
            at(F.ceil(position)).alias(f"_{name}_hi"),
            F.max(position - F.floor(position)).alias(f"_{name}_w"),
        ]
    picked = sums.groupBy(*group).agg(*parts)
    return picked.select(
        *group,
        *[
            (F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_w")).alias(n)
            for n in probs
        ],
    )
