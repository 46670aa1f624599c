"""Layer tables, upserts into them, listings and ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.functions.columns import small_table
from daypanel.operators.clean import upsert
from daypanel.sources.schemas import RAW_TABLES


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_raw_tables(spark: SparkSession, database: str, replace: bool = True) -> list[str]:
    """The typed raw tables; ``replace=False`` keeps those that exist."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = []
    for name, schema in RAW_TABLES.items():
        full = f"`{database}`.`{name}`"
        if replace:
            spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({_ddl(schema)}) USING parquet")
        names.append(full)
    return names


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> str:
    """Overwrites a layer table; partition columns let readers prune by them."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return table


def upsert_path(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], version: int, partial: bool = False) -> str:
    """Writes the merged layer as the next version of the path and returns that version.

    Parquet files cannot be replaced while they are read, so every version is a folder of its own.
    """
    target = f"{path}/v={version}"
    merged = new if version == 0 else upsert(spark.read.parquet(f"{path}/v={version - 1}"), new, keys, partial)
    merged.write.mode("overwrite").parquet(target)
    return target


def run_query(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """SQL over named frames, which become temporary views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Table name, number of columns and of rows."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), F.lit(len(df.columns)).alias("columns"), "rows"
        )
        out = row if out is None else out.unionByName(row)
    return out


def database_inventory(spark: SparkSession, database: str) -> DataFrame:
    names = [t.name for t in spark.catalog.listTables(database)]
    return inventory({f"{database}.{n}": spark.table(f"`{database}`.`{n}`") for n in sorted(names)})


def schema_listing(df: DataFrame) -> DataFrame:
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return small_table(df.sparkSession, rows, "position int, column_name string, data_type string")


def schema_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of only one of two frames, and the side they are on."""
    a, b = schema_listing(left), schema_listing(right)
    only_left = a.join(b, "column_name", "left_anti").select("column_name", F.lit("left").alias("only_in"))
    only_right = b.join(a, "column_name", "left_anti").select("column_name", F.lit("right").alias("only_in"))
    return only_left.unionByName(only_right)
