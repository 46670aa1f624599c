"""JSON payloads of parallel arrays to rows.

A payload is ``{"daily": {"time": [...], "<measure>": [...]}}`` (or ``hourly``). Values may be
numbers or text; unreadable ones become null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypanel.constants import MARINE_MEASURES
from daypanel.functions.columns import to_number


def payload_schema(section: str, measures: Sequence[str], entity: str = "city") -> T.StructType:
    arrays = [T.StructField(n, T.ArrayType(T.StringType())) for n in ["time", *measures]]
    return T.StructType([T.StructField(entity, T.StringType()), T.StructField(section, T.StructType(arrays))])


def read_payloads(
    spark: SparkSession, paths: str | Sequence[str], section: str, measures: Sequence[str],
    entity: str = "city", multiline: bool = False,
) -> DataFrame:
    """Payload files, one JSON object per line (or per file), with a declared schema."""
    return spark.read.schema(payload_schema(section, measures, entity)).option("multiLine", multiline).json(paths)


def _checked(payloads: DataFrame, section: str, entity: str) -> DataFrame:
    body = F.col(section)
    ok = (
        F.when(body.isNull(), F.raise_error(F.concat(F.lit(f"payload without section {section}: "), F.coalesce(entity, F.lit("?")))))
        .when(body["time"].isNull(), F.raise_error(F.concat(F.lit("payload without time: "), F.coalesce(entity, F.lit("?")))))
        .otherwise(F.lit(True))
    )
    return payloads.where(ok)


def to_rows(
    payloads: DataFrame, section: str, measures: Sequence[str], time: Column, output: str, entity: str = "city"
) -> DataFrame:
    """One row per array position. ``time`` parses the text column ``_time``."""
    # an absent or short array leaves nulls; a null one would drop the whole payload
    nothing = F.array().cast("array<string>")
    arrays = [F.col(f"{section}.time").alias("_time")]
    arrays += [F.coalesce(F.col(f"{section}.{m}"), nothing).alias(m) for m in measures]
    split = _checked(payloads, section, entity).select(entity, *arrays)
    zipped = split.select(entity, F.inline(F.arrays_zip("_time", *measures)))
    return zipped.select(entity, time.alias(output), *[to_number(m).alias(m) for m in measures])


def daily_rows(payloads: DataFrame, measures: Sequence[str], entity: str = "city") -> DataFrame:
    return to_rows(payloads, "daily", measures, F.to_date("_time"), "date", entity)


def hourly_rows(payloads: DataFrame, measures: Sequence[str] = ("visibility",), entity: str = "city") -> DataFrame:
    return to_rows(payloads, "hourly", measures, F.to_timestamp_ntz("_time"), "datetime", entity)


def marine_rows(payloads: DataFrame, entity: str = "city") -> DataFrame:
    return to_rows(payloads, "daily", MARINE_MEASURES, F.to_date("_time"), "date", entity)


def to_payloads(rows: DataFrame, section: str, time: str, measures: Sequence[str], entity: str = "city", by: Sequence[str] = ()) -> DataFrame:
    """The inverse shape: one payload per entity (and further keys that bound its length)."""
    packed = F.sort_array(F.collect_list(F.struct(F.col(time).cast("string").alias("time"), *[F.col(m).cast("string").alias(m) for m in measures])))
    grouped = rows.groupBy(entity, *by).agg(packed.alias("_rows"))
    # a field of an array of structs is the array of that field
    body = F.struct(*[F.col("_rows").getField(n).alias(n) for n in ["time", *measures]])
    return grouped.select(entity, body.alias(section))
