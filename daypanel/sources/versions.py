"""Layers stored by month: a run writes the months that its rows touch, a manifest says which run holds each month.

    <path>/run=<id>/month=<yyyy-MM>/   rows of the months that the run wrote
    <path>/manifest=<id>/              one row per month of the layer as the run left it: month, run, schema

A layer is what the manifest of a run lists. It is written last, so a run that broke off is no version, and earlier
versions stay readable until their folders are removed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypanel.functions.columns import small_table
from daypanel.operators.clean import upsert

NO_DATE = "none"


def month_of(date: str = "date") -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_DATE))


def manifest(spark: SparkSession, path: str, run: str) -> dict[str, str]:
    """Month to the run that holds it; one entry per month of the layer."""
    return {r["month"]: r["run"] for r in spark.read.parquet(f"{path}/manifest={run}").select("month", "run").collect()}


def _schema(spark: SparkSession, path: str, run: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.parquet(f"{path}/manifest={run}").first()["schema"]))


def has_version(spark: SparkSession, path: str, run: str | None) -> bool:
    if run is None:
        return False
    try:
        spark.read.parquet(f"{path}/manifest={run}")
    except AnalysisException:
        return False
    return True


def read_layer(spark: SparkSession, path: str, run: str, months: Sequence[str] | None = None) -> DataFrame:
    """The layer as the run left it, or some of its months."""
    held, schema = manifest(spark, path, run), _schema(spark, path, run)
    wanted = sorted(m for m in held if m and (months is None or m in set(months)))
    folders = [f"{path}/run={held[m]}/month={m}" for m in wanted]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _united(old: T.StructType, new: T.StructType) -> T.StructType:
    have = {f.name for f in old.fields}
    return T.StructType([T.StructField(f.name, f.dataType) for f in [*old.fields, *(f for f in new.fields if f.name not in have)]])


def _write_manifest(spark: SparkSession, path: str, run: str, held: dict[str, str], schema: T.StructType) -> None:
    # a layer without rows still has a schema
    rows = [(m, r, schema.json()) for m, r in sorted(held.items())] or [("", run, schema.json())]
    small_table(spark, rows, "month string, run string, schema string").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest={run}")


def merge_layer(rows: DataFrame, path: str, keys: Sequence[str], run: str, base: str | None = None, partial: bool = False, date: str = "date") -> list[str]:
    """Upserts rows into the layer as ``base`` left it and returns the months that were written, in order.

    Only months that the rows touch are read, merged and written; the others stay where earlier runs put them. Without a base the rows
    are the layer. ``rows`` is read twice (its months, its rows): store it first if it is dear. What reaches the driver is a
    name per month.
    """
    spark = rows.sparkSession
    touched = sorted(r["month"] for r in rows.select(month_of(date).alias("month")).distinct().collect())
    known = has_version(spark, path, base)
    held = {m: r for m, r in manifest(spark, path, base).items() if m} if known else {}
    schema = _united(_schema(spark, path, base), rows.schema) if known else _united(T.StructType([]), rows.schema)
    if touched:
        old = [m for m in touched if m in held]
        merged = upsert(read_layer(spark, path, base, old), rows, list(keys), partial) if old else rows
        merged = merged.select(*[(F.col(f.name) if f.name in merged.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
        merged.withColumn("month", month_of(date)).repartition("month").write.mode("overwrite").partitionBy("month").parquet(f"{path}/run={run}")
    _write_manifest(spark, path, run, held | dict.fromkeys(touched, run), schema)
    return touched


def changed_rows(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` that ``old`` has not or has with other values."""
    shared = [c for c in new.columns if c in old.columns]
    sign = F.xxhash64(*shared).alias("_sign")
    before = old.select(*[F.col(k).alias(f"_of_{k}") for k in keys], sign.alias("_old_sign"))
    same = F.col("_sign") == F.col("_old_sign")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return new.select("*", sign).join(before, same, "left_anti").drop("_sign")
