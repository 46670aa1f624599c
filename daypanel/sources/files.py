"""CSV and Parquet files: typed reads by pattern, visibility forms, combined files, checks."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypanel.constants import VISIBILITY_MEASURES
from daypanel.functions.columns import nan_to_null, small_table, to_number
from daypanel.operators.clean import latest_by_key, upsert
from daypanel.operators.rollup import hours_to_days
from daypanel.session import scratch_table
from daypanel.sources.schemas import FORECAST, VISIBILITY_DAILY, WEATHER_DAILY


#: Files whose headers are sent to every task; beyond it lines and headers are shuffled by file.
BROADCAST_FILES = 100_000


def header_names(header: str) -> list[str]:
    """Column names of a header line; empty names and repeats get their position, as Spark's own reader does it."""
    cells = next(csv.reader([header.removeprefix("\ufeff")]), [])
    folded = [c.casefold() for c in cells]
    return [f"_c{k}" if not c else f"{c}{k}" if folded.count(c.casefold()) > 1 else c for k, c in enumerate(cells)]


def read_csv(spark: SparkSession, path: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """Header CSV as text columns, each file read by its own header; types follow by ``conform``.

    The files are scanned once: their lines are written to the scratch folder with the file and place that each came from. The header
    of a file is its first line, found by an aggregation and joined back to the file's other lines, which are cut into
    cells and mapped to columns by position. Only the distinct headers reach the driver, never paths, so their number
    follows the layouts, not the files. Names that differ in case alone are one column. Blank lines are
    skipped, missing cells are null, and cells beyond the header are dropped. ``_file`` is the path of the file; a value may not hold a line break.
    """
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    lines = reader.text(path if isinstance(path, str) else list(path))
    lines = scratch_table(
        lines.select("value", F.col("_metadata.file_path").alias("_file"), (F.col("_metadata.file_block_start") == 0).alias("_top"), F.monotonically_increasing_id().alias("_n"))
        .where(F.trim("value") != "")
    )
    # lines of a block keep their order in _n; blocks of a file may lie anywhere
    first = scratch_table(lines.where("_top").groupBy("_file").agg(F.min(F.struct("_n", "value")).alias("first")).select("_file", "first._n", "first.value"))
    headers = sorted(r["value"] for r in first.select("value").distinct().collect())
    if not headers:
        raise FileNotFoundError(f"no files for {path} {pattern or ''}")
    layouts = [header_names(h) for h in headers]
    width = max(map(len, layouts))
    # column -> per layout the place of its cell, none where the layout lacks it
    places: dict[str, list[int | None]] = {}
    spelled: dict[str, str] = {}
    for k, names in enumerate(layouts):
        for place, name in enumerate(names):
            spelled.setdefault(name.casefold(), name)
            places.setdefault(name.casefold(), [None] * len(layouts))[k] = place
    numbered = small_table(spark, list(zip(headers, range(len(headers)))), "value string, _layout int")
    files = first.join(numbered, "value").select("_file", F.col("_n").alias("_first"), "_layout")
    if first.count() <= BROADCAST_FILES:
        files = F.broadcast(files)
    cells = F.from_csv("value", ", ".join(f"c{k} string" for k in range(width)))
    rows = lines.join(files, "_file").where("_n <> _first").select("_file", "_layout", cells.alias("cells"))
    rows = rows.select("_file", "_layout", F.array(*(F.col(f"cells.c{k}") for k in range(width))).alias("cells"))
    return rows.select(*(_cell(at).alias(spelled[name]) for name, at in places.items()), "_file")


def _cell(at: list[int | None]) -> Column:
    """The cell of a column: ``at`` has its place in each layout."""
    if len(set(at)) == 1:
        return F.get("cells", F.lit(at[0]))
    return F.get("cells", F.get(F.array(*(F.lit(k).cast("int") for k in at)), F.col("_layout")))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Known columns cast to their type, absent ones as typed nulls, unknown ones dropped."""
    out = []
    for f in schema.fields:
        if f.name not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.DoubleType):
            out.append(to_number(f.name).alias(f.name))
        else:
            out.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def prefer_single_files(df: DataFrame, combined_prefix: str = "all_cities_") -> DataFrame:
    """Drops rows of combined files when any per-entity file is there."""
    name = F.element_at(F.split("_file", "/"), -1)
    combined = name.startswith(combined_prefix)
    any_single = df.agg(F.max((~combined).cast("int"))).scalar()
    return df.where(~combined | (F.coalesce(any_single, F.lit(0)) == 0))


def load_weather(spark: SparkSession, directory: str, pattern: str = "*_historical_*.csv") -> DataFrame:
    """Weather files by pattern; of several files with a key the later name wins."""
    rows = prefer_single_files(read_csv(spark, directory, pattern))
    schema = T.StructType(WEATHER_DAILY.fields + [T.StructField("_file", T.StringType())])
    return latest_by_key(conform(rows, schema), ["city", "date"], "_file")


def split_visibility(rows: DataFrame, keys: Sequence[str] = ("city", "date")) -> DataFrame:
    """Visibility columns of weather files, rows with any known value."""
    typed = conform(rows, VISIBILITY_DAILY)
    return typed.where(F.coalesce(*[F.col(c) for c in VISIBILITY_MEASURES]).isNotNull())


def visibility_from(rows: DataFrame) -> DataFrame | None:
    """Daily files are taken as they are, hourly ones aggregated, others are not visibility files."""
    have = set(rows.columns)
    if {"city", "date", *VISIBILITY_MEASURES} <= have:
        return conform(rows, VISIBILITY_DAILY)
    if {"city", "datetime", "visibility"} <= have:
        hourly = rows.select("city", F.col("datetime").try_cast("timestamp_ntz").alias("datetime"), to_number("visibility").alias("visibility"))
        daily = hours_to_days(hourly, decimals=None, drop_nulls=True)
        return conform(daily, VISIBILITY_DAILY)
    return None


def load_visibility(
    spark: SparkSession, directory: str, weather_pattern: str = "*_historical_*.csv",
    pattern: str = "*_hourly_visibility_*.csv",
) -> DataFrame:
    """Visibility of the weather files, replaced by that of the visibility files."""
    base = split_visibility(prefer_single_files(read_csv(spark, directory, weather_pattern)))
    extra = visibility_from(read_csv(spark, directory, pattern))
    return base if extra is None else upsert(base, extra, ["city", "date"])


def load_forecast(spark: SparkSession, directory: str, pattern: str = "*_forecast_7day.csv") -> DataFrame:
    """Forecast snapshots; of repeated (city, date) rows the latest file stays."""
    rows = spark.read.option("header", True).option("pathGlobFilter", pattern).csv(directory)
    stamped = rows.withColumn("loaded_at", F.col("_metadata.file_modification_time"))
    return latest_by_key(conform(stamped, FORECAST), ["city", "date"], "loaded_at")


def save_raw(df: DataFrame, path: str, fmt: str = "csv") -> str:
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.option("header", True).csv(path)
    return path


def load_raw(spark: SparkSession, directory: str, name: str, date: str = "date") -> DataFrame:
    """Parquet of that name if there is one, else CSV; the date column as a date, NaN as null."""
    from pyspark.errors import AnalysisException

    base = f"{directory.rstrip('/')}/{name}"
    try:
        df = spark.read.parquet(f"{base}.parquet")
    except AnalysisException:
        try:
            df = spark.read.option("header", True).option("inferSchema", True).csv(f"{base}.csv")
        except AnalysisException as error:
            raise FileNotFoundError(f"no raw file for {name} in {directory}") from error
    return nan_to_null(df.withColumn(date, F.to_date(date)) if date in df.columns else df)


def combine(frames: Sequence[DataFrame]) -> DataFrame:
    """All frames by name; columns that one lacks are null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def file_report(spark: SparkSession, path: str | Sequence[str], fmt: str = "csv", pattern: str | None = None) -> DataFrame:
    """Rows and size of every file that can be read."""
    reader = spark.read.option("header", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    rows = reader.format(fmt).load(path)
    return rows.groupBy(
        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("size_bytes")
    ).agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(rows.columns)))
