"""Places of rows in a global order, from range partitions and their totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daypanel.session import scratch_table


def range_places(rows: DataFrame, order: Sequence[str | Column], group: Sequence[str] = ()) -> DataFrame:
    """Adds ``place`` (long, from 0 within the row's group in the given order) and ``group_rows`` (long).

    Rows are dealt to ranges of (group, order) and sorted there, so a group of any size is spread over as many tasks as
    it needs and no task sees a whole group. The ranges are written once; their counts per group, at most one row
    per range and one more per group, are prefix-summed and met again. ``order`` should tell rows apart:
    equal rows always land in one range. Null groups are a group and come first. No rows give no rows.
    """
    group = list(group)
    by = [F.col(g).asc_nulls_first() for g in group] + [F.col(o) if isinstance(o, str) else o for o in order]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_row", F.monotonically_increasing_id())
    dealt = scratch_table(dealt).withColumn("_range", F.shiftright("_row", 33))
    counts = dealt.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    whole = W.partitionBy(*group)
    before = whole.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(
        *[F.col(g).alias(f"_of_{g}") for g in group],
        F.col("_range").alias("_of_range"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("group_rows"),
    )
    same = F.col("_range") == F.col("_of_range")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    placed = dealt.join(counts, same)
    return placed.select(*rows.columns, (F.col("_row") + F.col("_shift")).alias("place"), "group_rows")
