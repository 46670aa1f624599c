"""Small column helpers: coercion, null policy, safe arithmetic, names."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from daypanel.session import scratch_table


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A driver-side table as a local relation: Spark knows its size and can broadcast it."""
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)
    columns = [pa.array([row[i] for row in rows], type=f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow))


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The columns of the list that the frame has; absent ones are skipped, not errors."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing is NULL everywhere: Spark sorts NaN above all numbers and averages it in."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def to_number(column: str | Column) -> Column:
    """Text to double; unreadable text and NaN become null."""
    value = (F.col(column) if isinstance(column, str) else column).try_cast("double")
    return F.when(~F.isnan(value), value)


def first_number(df: DataFrame, names: Sequence[str], default: float = 0.0) -> Column:
    """The first readable number among several alternative columns, else ``default``."""
    return F.coalesce(*[to_number(c) for c in present(df, names)], F.lit(default))


def clip(column: Column, lower: float, upper: float) -> Column:
    """Bounded value; null stays null (``greatest`` and ``least`` would drop the null)."""
    return F.when(column < lower, F.lit(float(lower))).when(column > upper, F.lit(float(upper))).otherwise(column)


def stable_round(column: Column, decimals: int) -> Column:
    """Rounding that does not depend on the order in which a sum was formed.

    The last bits of a distributed float sum vary; rounding a few digits finer first keeps a
    value that lies on a rounding edge on the same side in every run.
    """
    return F.round(F.round(column, decimals + 6), decimals)


def normal_name(column: Column) -> Column:
    """Lower case without blanks, hyphens as underscores."""
    return F.translate(F.replace(F.lower(column), F.lit(" "), F.lit("")), "-", "_")


def count_where(predicate: Column) -> Column:
    return F.coalesce(F.sum(predicate.cast("long")), F.lit(0).cast("long"))


def correlation(x: str, y: str, known: bool = False) -> Column:
    """Pearson correlation over the rows that know both columns; ``known`` promises that all do.

    NaN where one of them is constant, null with fewer than two rows. ``corr`` divides by the variances and raises
    there. A constant is told by its least and greatest value, for the variance of merged parts may be off zero by a rounding error.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = (F.col(c).cast("double") if known else F.when(both, F.col(c).cast("double")) for c in (x, y))
    n = F.count(a)
    constant = (F.min(a) == F.max(a)) | (F.min(b) == F.max(b))
    r = F.coalesce(F.try_divide(F.covar_pop(a, b), F.sqrt(F.var_pop(a) * F.var_pop(b))), F.lit(float("nan")))
    return F.when((n > 1) & constant, F.lit(float("nan"))).when(n > 1, r)


def with_null_columns(df: DataFrame, columns: Iterable[str], dtype: str = "double") -> DataFrame:
    """Adds the missing columns of the list as typed nulls."""
    have = set(df.columns)
    missing = {c: F.lit(None).cast(dtype) for c in columns if c not in have}
    return df.withColumns(missing) if missing else df


def capped_coverage(present_days: Column, expected_days: Column) -> Column:
    return F.least(present_days * 100.0 / expected_days, F.lit(100.0))


#: Groups whose statistics are sent to every task; a row of statistics is a few numbers.
BROADCAST_GROUPS = 100_000
#: Parts that the rows of a group are dealt to beyond that.
SALTS = 32


def join_groups(rows: DataFrame, stats: DataFrame, keys: Sequence[str], *salt: str, how: str = "inner") -> DataFrame:
    """Joins rows with one row of statistics per group, no group in one task.

    The statistics are written and counted. Up to ``BROADCAST_GROUPS`` of them go to every task, and the rows stay where they are.
    More are repeated for each salt, and the rows of a group are dealt out by a hash of the columns ``salt``
    (all, if none is named).
    """
    held = scratch_table(stats)
    if held.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(held), list(keys), how)
    part = F.pmod(F.xxhash64(*(salt or rows.columns)), F.lit(SALTS)).alias("_salt")
    spread = held.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.select("*", part).join(spread, [*keys, "_salt"], how).drop("_salt")
