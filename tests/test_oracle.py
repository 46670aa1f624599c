"""Registered queries beside their SQL counterparts on the smallest tables."""

import duckdb
import pytest

import oracle_check

FAST = [
    "p1_risk_day", "p2_risk_breakdown", "p6_winsorize", "p20_risk_bands", "j3_overlap", "j11_missing_dates", "x7_wave_height", "x9_sea_risk",
    "a1_hours_to_days", "a5_monthly_labels", "a33_histogram", "a34_box_large_groups", "w1_rolling_in_blocks", "w9_anomaly", "w14_outliers_iqr",
    "w14_outliers_iqr_large_groups", "w18_gap_summary", "w19_constant_runs", "w24_interpolate", "q5_flag_rows", "q8_prediction_coverage",
    "t6_t7_chi_square_yates", "m6_threshold_grid", "m12_select_winner", "m17_roc_curve", "s13_upsert_partial", "f7_monthly_summary", "c1_staging",
]


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    for t in oracle_check.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return connection


@pytest.mark.parametrize("name", FAST)
def test_same_as_sql(spark, con, sf, name):
    assert oracle_check.compare(spark, con, name, sf).startswith("ok")


def test_every_counterpart_belongs_to_a_query():
    assert set(oracle_check.SQL) <= set(oracle_check.QUERIES)


def test_entry_has_rows(spark):
    from __spark_entry__ import entry

    assert not entry(spark).isEmpty()
