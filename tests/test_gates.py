"""Gates compiled into one pass over a layer."""

import datetime as dt

from daypanel.functions.columns import small_table
from daypanel.operators import quality


def day(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def layer(spark, tmp_path, rows):
    path = str(tmp_path / "layer")
    small_table(spark, rows, "city string, date date, temperature_2m_max double, is_risk_day int, high_risk_month int").write.parquet(path)
    return spark.read.parquet(path)


ROWS = [("a", day(k), 20.0, k % 2, k % 2) for k in (0, 1, 2, 9, 9, 9, 10)] + [("b", day(k), None if k else 99.0, 0, 0) for k in range(4)] + [("c", day(0), 1.0, 0, 0)]


def scans(df):
    """Scans of files in the plan that ran; reused exchanges stand for what ran once."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan parquet")


def test_staging_gate_reads_the_layer_once(spark, tmp_path):
    df = layer(spark, tmp_path, ROWS)
    got = quality.run_checks("staging", df)
    assert scans(got) == 1
    rows = {r.check_name: r for r in got.collect()}
    apart = quality.check_null_ratio(df).unionByName(quality.check_date_continuity(df)).unionByName(quality.check_value_ranges(df))
    assert {tuple(map(str, r)) for r in rows.values()} == {tuple(map(str, r)) for r in apart.collect()}
    assert rows["null_ratio"].details["offenders"] == "temperature_2m_max=25.0" and rows["null_ratio"].status == "WARN"
    assert rows["date_continuity"].details | {} == {"max_gap_allowed": "3", "gaps_found": "1", "worst_gap_days": "7", "entities_with_gaps": "1"}
    assert rows["value_ranges"].status == "FLAG" and rows["value_ranges"].details["flagged_by_column"] == "temperature_2m_max=1"


def test_gate_of_an_empty_layer(spark, tmp_path):
    rows = {r.check_name: r.status for r in quality.run_checks("staging", layer(spark, tmp_path, ROWS).limit(0)).collect()}
    assert rows == {"null_ratio": "FAIL", "date_continuity": "PASS", "value_ranges": "PASS"}


def test_validation_of_layers(spark, tmp_path):
    df = layer(spark, tmp_path, ROWS)
    got = {r.check: (r.status, r.detail) for r in quality.validate_layers(df, df, df, df, 3, "2024-01-02", "2024-01-11", min_rows=4).collect()}
    assert got == {
        **{f"rows in {x}": ("PASS", "12") for x in ("raw", "staging", "daily", "monthly")}, "entity count": ("PASS", "3"), "rows of a": ("PASS", "7"), "rows of b": ("PASS", "4"),
        "rows of c": ("FAIL", "1"), "range start": ("PASS", "2024-01-01"), "range end": ("PASS", "2024-01-11"), "duplicates": ("FAIL", "1"), "date gaps": ("FAIL", "1"),
        "both labels": ("PASS", "2"), "risk days": ("PASS", "4"),
    }
    none = {r.check: r.status for r in quality.validate_layers(df.limit(0), df.limit(0), df, df, 3, "2024-01-02", "2024-01-11").collect()}
    assert none["rows in raw"] == "FAIL" and none["range start"] == "FAIL" and none["duplicates"] == "PASS"


def test_forecast_state_equals_what_reads_the_layer(spark, sf):
    from catalog import views
    from daypanel.operators import forecast, timeseries

    daily = views.daily(spark, sf)
    state = forecast.day_of_year_state(daily)
    rows = lambda df: {tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*sorted(df.columns)).collect()}
    assert rows(state.rates()) == rows(timeseries.climatology(daily))
    assert rows(state.sea_climate()) == rows(forecast.offshore_climatology(daily))
    assert rows(state.entities()) == rows(daily.select("city").distinct())
    one = spark.range(1).select(state.global_rate().alias("a"), timeseries.global_rate(daily).alias("b")).first()
    assert abs(one.a - one.b) < 1e-12
