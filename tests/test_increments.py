"""Layers by month and features of changed days beside full builds."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog import views
from daypanel.functions.columns import small_table
from daypanel.operators.clean import upsert
from daypanel.operators.features import CHAIN_REACH
from daypanel.plans.increments import changed_features, reached_rows
from daypanel.plans.layers import analytics_daily, clean_to_staging
from daypanel.sources import versions

KEYS = ["city", "date"]


def day(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def rows(spark, days, value, **more):
    names = ["city", "date", "v", *more]
    kinds = ["string", "date", "double", *["string"] * len(more)]
    return small_table(spark, [(c, day(k), value, *more.values()) for k in days for c in "ab"], ", ".join(f"{n} {t}" for n, t in zip(names, kinds)))


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_a_run_writes_only_the_months_it_touches(spark, tmp_path):
    path, full = str(tmp_path / "layer"), rows(spark, range(120), 1.0)
    assert versions.merge_layer(full, path, KEYS, "r1") == ["2024-01", "2024-02", "2024-03", "2024-04"]
    first, second = rows(spark, range(58, 62), 2.0), rows(spark, range(118, 125), 3.0)
    assert versions.merge_layer(first, path, KEYS, "r2", "r1") == ["2024-02", "2024-03"]
    assert versions.merge_layer(second, path, KEYS, "r3", "r2") == ["2024-04", "2024-05"]
    assert versions.manifest(spark, path, "r3") == {"2024-01": "r1", "2024-02": "r2", "2024-03": "r2", "2024-04": "r3", "2024-05": "r3"}
    assert sorted(p.name for p in (tmp_path / "layer" / "run=r3").glob("month=*")) == ["month=2024-04", "month=2024-05"]
    expected = upsert(upsert(full, first, KEYS), second, KEYS)
    assert as_set(versions.read_layer(spark, path, "r3")) == as_set(expected)
    # earlier versions stay as they were
    assert as_set(versions.read_layer(spark, path, "r1")) == as_set(full)
    assert versions.read_layer(spark, path, "r3", ["2024-05"]).count() == 2 * 4


def test_merges_without_rows_with_new_columns_and_without_dates(spark, tmp_path):
    path, full = str(tmp_path / "layer"), rows(spark, range(40), 1.0)
    versions.merge_layer(full, path, KEYS, "r1")
    assert versions.merge_layer(full.limit(0), path, KEYS, "r2", "r1") == []
    assert as_set(versions.read_layer(spark, path, "r2")) == as_set(full)
    wider = rows(spark, [39], 5.0, note="x").unionByName(small_table(spark, [("a", None, 7.0, None)], "city string, date date, v double, note string"))
    assert versions.merge_layer(wider, path, KEYS, "r3", "r2") == ["2024-02", versions.NO_DATE]
    got = versions.read_layer(spark, path, "r3")
    assert got.columns == ["city", "date", "v", "note"] and got.count() == 81
    assert as_set(got.where("note is not null").select("v")) == {(5.0,)} and got.where("date is null").first()["v"] == 7.0
    partial = small_table(spark, [("a", day(0), None, "y")], "city string, date date, v double, note string")
    versions.merge_layer(partial, path, KEYS, "r4", "r3", partial=True)
    assert versions.read_layer(spark, path, "r4").where(F.col("note") == "y").first()["v"] == 1.0
    empty = str(tmp_path / "empty")
    versions.merge_layer(full.limit(0), empty, KEYS, "r1")
    assert versions.read_layer(spark, empty, "r1").columns == ["city", "date", "v"] and not versions.has_version(spark, empty, "r9")


def test_changed_rows(spark):
    old = rows(spark, range(10), 1.0)
    new = upsert(old, rows(spark, [3], 2.0), KEYS).unionByName(small_table(spark, [(None, None, 1.0)], "city string, date date, v double"))
    got = versions.changed_rows(new, old, KEYS)
    assert got.columns == new.columns and as_set(got) == {("a", day(3), 2.0), ("b", day(3), 2.0), (None, None, 1.0)}


@pytest.fixture(scope="module")
def layers(spark, sf):
    caps, fetch = views.caps(spark), views.fetch(spark)
    weather, visibility = views.weather(spark, sf), views.visibility(spark, sf)
    before = clean_to_staging(weather, visibility, caps).where("city IN ('ASIA', 'EUROPE')").persist()
    end = before.agg(F.max("date")).first()[0]
    # the last two weeks arrive, one old day is corrected, another has a gap filled behind it
    kept = before.where(F.col("date") <= F.lit(end - dt.timedelta(days=14))).persist()
    days = sorted(r["date"] for r in before.where("city = 'ASIA'").select("date").collect())
    odd = (F.col("city") == "ASIA") & F.col("date").isin(days[len(days) // 4], days[len(days) // 2])
    after = before.withColumn("wind_speed_10m_max", F.when(odd, F.col("wind_speed_10m_max") + 7).otherwise(F.col("wind_speed_10m_max"))).persist()
    return kept, after, fetch, days


def assert_same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(want.columns)
    a, b = (df.select(*columns).toPandas().sort_values(KEYS).reset_index(drop=True) for df in (got, want))
    assert len(a) == len(b)
    for c in columns:
        if a[c].dtype.kind == "f" and b[c].dtype.kind == "f":
            assert np.allclose(a[c], b[c], rtol=1e-9, atol=1.1e-3 if c.endswith("_anom") else 1e-9, equal_nan=True), c
        else:
            assert ((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all(), c


def test_changed_features_equal_a_full_build(spark, layers):
    before, after, fetch, days = layers
    previous = analytics_daily(before, fetch).persist()
    changed = versions.changed_rows(after, before, KEYS).persist()
    assert changed.where(F.col("date") <= F.lit(days[len(days) // 2])).count() == 2
    update = changed_features(after, changed, previous, fetch).persist()
    assert_same(upsert(previous, update, KEYS), analytics_daily(after, fetch))
    # a small part of the layer is read and rewritten
    flags = reached_rows(after, changed).agg(*[F.count(F.when(F.col(c), 1)).alias(c) for c in ("recompute", "shares_day", "read")]).first()
    n = after.count()
    assert update.count() < 0.35 * n and flags["recompute"] < 0.06 * n and flags["read"] < 0.5 * n


def test_reach_of_one_row(spark):
    keys = small_table(spark, [("a", day(k)) for k in range(800)], "city string, date date")
    got = reached_rows(keys, keys.where(F.col("date") == F.lit(day(400)))).collect()
    place = {r["date"]: r for r in got}
    assert [k for k in range(800) if place[day(k)]["recompute"]] == list(range(400, 401 + CHAIN_REACH))
    assert {day(k).strftime("%j") for k in range(800) if place[day(k)]["shares_day"]} == {day(400).strftime("%j")}
    assert all(place[day(k)]["read"] for k in range(400 - CHAIN_REACH, 401 + CHAIN_REACH)) and not place[day(400 - CHAIN_REACH - 1)]["read"]


def test_nothing_changed(spark, layers):
    before, _, fetch, _ = layers
    previous = analytics_daily(before, fetch)
    assert changed_features(before, before.limit(0), previous, fetch).isEmpty()
