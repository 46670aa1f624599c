"""The given tables in the shapes that the operators expect.

Measures are whole numbers held as doubles (prices in cents, rates in percent), so sums and
means do not depend on the order of summation and both engines agree to the last bit.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import block
from daypanel.functions.physics import fetch_table as long_fetch_table
from daypanel.operators import clean
from daypanel.plans import layers

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
CAPS = {
    "precipitation_sum": {"AFRICA": 14.0, "AMERICA": 12.0, "ASIA": 10.0, "EUROPE": 15.0},
    "snowfall_sum": {"AFRICA": 4.0, "AMERICA": 5.0, "MIDDLE EAST": 3.0},
}
FETCH = {
    "AFRICA": [400, 350, 50, 30, 30, 80, 250, 400],
    "AMERICA": [80, 50, 30, 200, 400, 500, 500, 200],
    "ASIA": [700, 700, 500, 50, 30, 30, 100, 300],
    "EUROPE": [100, 50, 30, 30, 50, 200, 500, 500],
}
START = "2001-09-01"


_PLANS: dict[tuple, object] = {}


def planned(build):
    """Keeps the lazy plan of a view per session and folder. No data is kept."""

    @functools.wraps(build)
    def lookup(spark: SparkSession, *where):
        key = (spark.sparkContext.applicationId, build.__name__, *where)
        if key not in _PLANS:
            _PLANS[key] = build(spark, *where)
        return _PLANS[key]

    return lookup


@planned
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def hundredths(column: str):
    """A two-decimal number as a whole number; ``round`` on a double would build a decimal per row."""
    return F.floor(F.col(column) * 100 + 0.5)


def _with_region(df: DataFrame, spark: SparkSession, sf: str, nation_key: str, key: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return (
        df.join(nation, F.col(nation_key) == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(key, F.col("r_name").alias("city"))
    )


@planned
def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with the region of their supplier.

    Dimension sides are left to Spark: it broadcasts them while their size allows and
    otherwise sort-merges, splitting a supplier that holds very many lines (AQE skew join).
    """
    place = _with_region(table(spark, sf, "supplier"), spark, sf, "s_nationkey", "s_suppkey")
    return (
        table(spark, sf, "lineitem")
        .join(place, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "city",
            F.to_date("l_shipdate").alias("date"),
            F.col("l_orderkey").alias("o"),
            F.col("l_linenumber").alias("n"),
            F.col("l_quantity").alias("q"),
            hundredths("l_discount").alias("d"),
            hundredths("l_tax").alias("t"),
            hundredths("l_extendedprice").alias("p"),
            F.col("l_returnflag").alias("f"),
            F.col("l_linestatus").alias("s"),
        )
    )


block(
    "place", "",
    "SELECT s_suppkey, r_name AS city FROM supplier JOIN nation ON s_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey",
)
block(
    "lines", "place",
    "SELECT city, CAST(l_shipdate AS DATE) AS date, l_orderkey AS o, l_linenumber AS n, l_quantity AS q, "
    "CAST(round(l_discount*100) AS BIGINT) AS d, CAST(round(l_tax*100) AS BIGINT) AS t, "
    "CAST(round(l_extendedprice*100) AS BIGINT) AS p, l_returnflag AS f, l_linestatus AS s "
    "FROM lineitem JOIN place ON l_suppkey = s_suppkey",
)


def _measures() -> list:
    """Day measures; h is the dearest and c the cheapest line of the day."""
    h, c = F.col("h"), F.col("c")
    mean_q = F.col("sum_q") / F.col("k")
    return [
        F.col("city"),
        F.col("date"),
        (F.col("max_q") - 10).alias("temperature_2m_max"),
        (F.col("min_q") - 10).alias("temperature_2m_min"),
        (F.floor(mean_q) - 10).cast("double").alias("temperature_2m_mean"),
        (F.floor((F.col("max_q") + F.col("min_q")) / 2) - 10).cast("double").alias("apparent_temperature_mean"),
        (h["d"] * 6).cast("double").alias("wind_speed_10m_max"),
        (h["d"] * 5 + h["t"] * 4).cast("double").alias("wind_gusts_10m_max"),
        F.when(h["f"] != "A", (h["q"].cast("long") * 37 + h["d"] * 11) % 360).cast("double").alias("wind_direction_10m_dominant"),
        F.when(c["f"] != "A", c["t"] * 2).cast("double").alias("precipitation_sum"),
        F.when(c["s"] == "O", c["t"]).cast("double").alias("rain_sum"),
        F.when(c["s"] == "F", F.greatest(c["d"] - 4, F.lit(0))).cast("double").alias("snowfall_sum"),
        F.when(c["f"] != "N", h["d"] * c["t"]).cast("double").alias("weather_code"),
        F.when(h["f"] != "N", F.floor(F.col("n_open") * 60.0 / F.col("k")) + 40).cast("double").alias("relative_humidity_2m_mean"),
        (F.floor((F.col("min_q") + mean_q) / 2) - 15).cast("double").alias("dew_point_2m_mean"),
        F.when(h["s"] == "O", F.floor(F.col("sum_p") / (F.col("k") * 100000.0)) + 980).cast("double").alias("surface_pressure_mean"),
        F.floor(h["p"] / 1000000.0).cast("double").alias("shortwave_radiation_sum"),
    ]


# A line of a day packed into one whole number, the price first: the dearest and the cheapest
# line of a day are then a maximum and a minimum of numbers, which aggregate by hash, not sort.
PACKED_SQL = (
    "((((p * 16 + d) * 16 + t) * 64 + CAST(q AS BIGINT)) * 4 + CASE f WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) * 2 "
    "+ CASE s WHEN 'F' THEN 0 ELSE 1 END"
)


def _unpacked(name: str, divide) -> str:
    """The packed fields of a number by their letters, as an expression text of either engine."""
    k = f"{name}k"
    return {
        "s": f"CASE WHEN {k} % 2 = 0 THEN 'F' ELSE 'O' END",
        "f": f"CASE {divide(k, 2)} % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END",
        "q": f"CAST({divide(k, 8)} % 64 AS DOUBLE)",
        "t": f"{divide(k, 512)} % 16",
        "d": f"{divide(k, 8192)} % 16",
        "p": divide(k, 131072),
    }


def _by_day(rows: DataFrame) -> DataFrame:
    packed = rows.withColumn("packed", F.expr(PACKED_SQL))
    days = packed.groupBy("city", "date").agg(
        F.count(F.lit(1)).alias("k"), F.sum("q").alias("sum_q"), F.max("q").alias("max_q"), F.min("q").alias("min_q"),
        F.sum("p").alias("sum_p"), F.sum((F.col("s") == "O").cast("long")).alias("n_open"),
        F.max("packed").alias("hk"), F.min("packed").alias("ck"),
    )
    parts = {n: _unpacked(n, lambda k, by: f"({k} div {by})") for n in ("h", "c")}
    return days.withColumns(
        {n: F.struct(*[F.expr(e).alias(letter) for letter, e in fields.items()]) for n, fields in parts.items()}
    )


_FIELDS_SQL = ", ".join(
    f"{{{', '.join(f'{chr(39)}{letter}{chr(39)}: {e}' for letter, e in _unpacked(n, lambda k, by: f'({k} // {by})').items())}}} AS {n}" for n in ("h", "c")
)
_BY_DAY_SQL = (
    f"SELECT *, {_FIELDS_SQL} FROM (SELECT city, date, count(*) AS k, sum(q) AS sum_q, max(q) AS max_q, min(q) AS min_q, CAST(sum(p) AS DOUBLE) AS sum_p, "
    f"count(*) FILTER (s = 'O') AS n_open, max({PACKED_SQL}) AS hk, min({PACKED_SQL}) AS ck FROM {{src}} GROUP BY city, date)"
).replace("{{src}}", "{src}")
_MEASURES_SQL = """SELECT city, date,
  max_q - 10 AS temperature_2m_max, min_q - 10 AS temperature_2m_min,
  floor(sum_q / k) - 10 AS temperature_2m_mean, floor((max_q + min_q) / 2) - 10 AS apparent_temperature_mean,
  CAST(h.d * 6 AS DOUBLE) AS wind_speed_10m_max, CAST(h.d * 5 + h.t * 4 AS DOUBLE) AS wind_gusts_10m_max,
  CAST(CASE WHEN h.f <> 'A' THEN (CAST(h.q AS BIGINT) * 37 + h.d * 11) % 360 END AS DOUBLE) AS wind_direction_10m_dominant,
  CAST(CASE WHEN c.f <> 'A' THEN c.t * 2 END AS DOUBLE) AS precipitation_sum,
  CAST(CASE WHEN c.s = 'O' THEN c.t END AS DOUBLE) AS rain_sum,
  CAST(CASE WHEN c.s = 'F' THEN greatest(c.d - 4, 0) END AS DOUBLE) AS snowfall_sum,
  CAST(CASE WHEN c.f <> 'N' THEN h.d * c.t END AS DOUBLE) AS weather_code,
  CAST(CASE WHEN h.f <> 'N' THEN floor(n_open * 60.0::DOUBLE / k) + 40 END AS DOUBLE) AS relative_humidity_2m_mean,
  CAST(floor((min_q + sum_q / k) / 2) - 15 AS DOUBLE) AS dew_point_2m_mean,
  CAST(CASE WHEN h.s = 'O' THEN floor(sum_p / (k * 100000.0::DOUBLE)) + 980 END AS DOUBLE) AS surface_pressure_mean,
  CAST(floor(h.p / 1000000.0::DOUBLE) AS DOUBLE) AS shortwave_radiation_sum
FROM {src}"""

block("day_lines", "lines", _BY_DAY_SQL.replace("{src}", "lines"))
block("weather", "day_lines", _MEASURES_SQL.replace("{src}", "day_lines"))
block("open_lines", "lines", _BY_DAY_SQL.replace("{src}", "(SELECT * FROM lines WHERE s = 'O')"))
block("open_days", "open_lines", _MEASURES_SQL.replace("{src}", "open_lines"))
FORECAST_COLUMNS = [
    "temperature_2m_max", "temperature_2m_min", "wind_speed_10m_max", "wind_gusts_10m_max",
    "precipitation_sum", "snowfall_sum", "weather_code", "relative_humidity_2m_mean",
]
block("forecast", "open_days", f"SELECT city, date, {', '.join(FORECAST_COLUMNS)} FROM open_days")


@planned
def weather(spark: SparkSession, sf: str) -> DataFrame:
    return _by_day(lines(spark, sf)).select(*_measures())


@planned
def forecast(spark: SparkSession, sf: str) -> DataFrame:
    """A second opinion on the same days: the open lines only."""
    days = _by_day(lines(spark, sf).where(F.col("s") == "O")).select(*_measures())
    return days.select("city", "date", *FORECAST_COLUMNS)


@planned
def orders(spark: SparkSession, sf: str) -> DataFrame:
    place = _with_region(table(spark, sf, "customer"), spark, sf, "c_nationkey", "c_custkey")
    return table(spark, sf, "orders").join(place, F.col("o_custkey") == F.col("c_custkey")).select(
        "city", F.to_date("o_orderdate").alias("date"), F.col("o_orderkey").alias("o"),
        hundredths("o_totalprice").alias("p"),
    )


@planned
def visibility(spark: SparkSession, sf: str) -> DataFrame:
    """Last and first order of the day stand for its mean and its minimum."""
    days = orders(spark, sf).groupBy("city", "date").agg(F.max_by("p", "o").alias("h"), F.min_by("p", "o").alias("c"))
    h, c = F.col("h"), F.col("c")
    return days.select(
        "city", "date",
        F.floor(h / 5000.0).cast("double").alias("visibility_mean"),
        F.floor(F.least(h, c) / 10000.0).cast("double").alias("visibility_min"),
        F.floor(h / 9000000.0).cast("double").alias("visibility_hours_below_1km"),
    )


block(
    "custplace", "",
    "SELECT c_custkey, r_name AS city FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "JOIN region ON n_regionkey = r_regionkey",
)
block(
    "day_orders", "custplace",
    "SELECT city, CAST(o_orderdate AS DATE) AS date, o_orderkey AS o, CAST(round(o_totalprice*100) AS BIGINT) AS p "
    "FROM orders JOIN custplace ON o_custkey = c_custkey",
)
block(
    "vis", "day_orders",
    "SELECT city, date, floor(arg_max(p, o) / 5000.0::DOUBLE) AS visibility_mean, "
    "floor(least(arg_max(p, o), arg_min(p, o)) / 10000.0::DOUBLE) AS visibility_min, "
    "floor(arg_max(p, o) / 9000000.0::DOUBLE) AS visibility_hours_below_1km FROM day_orders GROUP BY city, date",
)


@planned
def caps(spark: SparkSession) -> DataFrame:
    return clean.caps_table(spark, CAPS)


@planned
def fetch(spark: SparkSession) -> DataFrame:
    return long_fetch_table(spark, FETCH)


@planned
def joined(spark: SparkSession, sf: str) -> DataFrame:
    return layers.join_visibility(weather(spark, sf), visibility(spark, sf))


@planned
def staging(spark: SparkSession, sf: str) -> DataFrame:
    return layers.clean_to_staging(weather(spark, sf), visibility(spark, sf), caps(spark))


@planned
def daily(spark: SparkSession, sf: str) -> DataFrame:
    return layers.analytics_daily(staging(spark, sf), fetch(spark))


@planned
def monthly(spark: SparkSession, sf: str) -> DataFrame:
    from daypanel.operators.rollup import monthly_summary

    return monthly_summary(daily(spark, sf))


@planned
def preset(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return layers.preset_layers(weather(spark, sf), visibility(spark, sf))


@planned
def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Events as an hourly series; the value in cents keeps sums exact."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("city"), F.col("ts").alias("datetime"), hundredths("value").cast("double").alias("visibility")
    )


block("hourly", "", "SELECT event_type AS city, ts AS datetime, round(value*100) AS visibility FROM events")


@planned
def marine(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as a marine row: zeros, unknown values and all three components occur."""
    k = F.get_json_object("props", "$.k").try_cast("double")
    value = F.col("value")
    return table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("city"), F.to_date("ts").alias("date"),
        (F.floor(value / 10) / 4).alias("wave_height_max"),
        F.when(k != 50, F.floor(k / 10) / 4).alias("wind_wave_height_max"),
        F.when(value > 20, F.floor(value / 20) / 8).alias("swell_wave_height_max"),
        F.when(k >= 20, F.floor(k / 10)).cast("double").alias("wave_period_max"),
    )


block(
    "marine", "",
    "SELECT event_id, event_type AS city, CAST(ts AS DATE) AS date, floor(value / 10) / 4 AS wave_height_max, "
    "CASE WHEN k <> 50 THEN floor(k / 10) / 4 END AS wind_wave_height_max, "
    "CASE WHEN value > 20 THEN floor(value / 20) / 8 END AS swell_wave_height_max, "
    "CASE WHEN k >= 20 THEN floor(k / 10) END AS wave_period_max "
    "FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)",
)


@planned
def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as scored rows: the label is a closed order, the score its relative price."""
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("city"), F.to_date("o_orderdate").alias("date"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        (hundredths("o_totalprice") / 50000000.0).alias("probability"),
    )


block(
    "scored", "",
    "SELECT o_orderpriority AS city, CAST(o_orderdate AS DATE) AS date, CAST(o_orderstatus = 'F' AS INTEGER) AS label, "
    "round(o_totalprice*100) / 50000000.0::DOUBLE AS probability FROM orders",
)
