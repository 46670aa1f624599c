"""Files, ledgers, layer tables, the gated job and the streaming forms."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from catalog import views
from daypanel.constants import MARINE_MEASURES
from daypanel.functions.columns import small_table
from daypanel.operators import models, rollup
from daypanel.plans import jobs
from daypanel.sources import dimensions, files, ledgers, payload, tables, versions
from daypanel.sources.schemas import FETCH_LOG
from daypanel.streaming import jobs as streams

D = dt.date


def write(path, text):
    path.write_text(text)


@pytest.fixture()
def raw(tmp_path):
    write(tmp_path / "a_historical_1.csv", "city,date,wind_speed_10m_max,unknown\na,2024-01-01,10,x\na,2024-01-02,bad,x\n")
    write(tmp_path / "a_historical_2.csv", "date,city,precipitation_sum,visibility_mean\n2024-01-02,a,3,900\n2024-01-03,a,,\n")
    write(tmp_path / "all_cities_historical_1.csv", "city,date,wind_speed_10m_max\nz,2024-01-01,99\n")
    write(tmp_path / "a_hourly_visibility_1.csv", "city,datetime,visibility\na,2024-01-01T00:00,800\na,2024-01-01T01:00,1200\na,2024-01-01T02:00,\n")
    write(tmp_path / "a_forecast_7day.csv", "city,date,wind_speed_10m_max\na,2024-02-01,5\n")
    return str(tmp_path)


def test_csv_by_pattern(spark, raw):
    rows = {(r["city"], r["date"]): r for r in files.load_weather(spark, raw).collect()}
    assert set(rows) == {("a", D(2024, 1, d)) for d in (1, 2, 3)}
    assert rows["a", D(2024, 1, 1)]["wind_speed_10m_max"] == 10.0
    assert rows["a", D(2024, 1, 2)]["precipitation_sum"] == 3.0  # the later file wins
    vis = {r["date"]: r for r in files.load_visibility(spark, raw).collect()}
    assert vis[D(2024, 1, 2)]["visibility_mean"] == 900.0
    assert (vis[D(2024, 1, 1)]["visibility_mean"], vis[D(2024, 1, 1)]["visibility_hours_below_1km"]) == (1000.0, 1.0)
    assert files.load_forecast(spark, raw).count() == 1
    assert files.visibility_from(spark.range(1)) is None
    report = {r["file_name"]: r["rows"] for r in files.file_report(spark, raw, pattern="a_*.csv").collect()}
    assert report["a_historical_1.csv"] == 2


def test_csv_cells_by_header(spark, tmp_path):
    write(tmp_path / "a.csv", '\ufeffcity,date,"wind, max",\n\na,2024-01-01,"1,5",x\n  \na,2024-01-02\n')
    write(tmp_path / "b.csv", "Date,CITY,extra,extra\r\n2024-01-03,b,1,2,3\r\n")
    write(tmp_path / "c.csv", "city,date\n")
    write(tmp_path / "d.csv", "")
    rows = files.read_csv(spark, str(tmp_path), "*.csv")
    assert {c.casefold() for c in rows.columns} == {"city", "date", "wind, max", "_c3", "extra2", "extra3", "_file"}
    got = {r["date"]: r for r in rows.toDF(*(c.casefold() for c in rows.columns)).collect()}
    assert set(got) == {"2024-01-01", "2024-01-02", "2024-01-03"}
    assert (got["2024-01-01"]["wind, max"], got["2024-01-01"]["_c3"], got["2024-01-01"]["extra2"]) == ("1,5", "x", None)
    assert (got["2024-01-02"]["city"], got["2024-01-02"]["wind, max"]) == ("a", None)
    assert (got["2024-01-03"]["city"], got["2024-01-03"]["extra2"], got["2024-01-03"]["extra3"]) == ("b", "1", "2")
    assert got["2024-01-03"]["_file"].endswith("/b.csv")
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, str(tmp_path), "*.tsv")


def test_csv_of_many_files_is_scanned_once(spark, tmp_path, monkeypatch):
    for k in range(1500):
        write(tmp_path / f"f{k}.csv", f"city,date,m{k % 3}\nc{k},2024-01-01,{k}\nc{k},2024-01-02,{k + 1}\n")
    written = []
    monkeypatch.setattr(files, "scratch_table", lambda df, table=files.scratch_table: written.append(plan(df)) or table(df))
    rows = files.read_csv(spark, str(tmp_path), "f*.csv")
    assert [p.count("FileScan text") for p in written] == [1, 0] and "FileScan text" not in plan(rows)
    assert len(plan(rows)) < 20_000  # follows the layouts, not the files
    assert rows.selectExpr("count(*)", "count(distinct city)", "sum(m0)", "count(m1)").first()[:] == (3000, 1500, float(sum(2 * k + 1 for k in range(0, 1500, 3))), 1000)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_larger_than_a_block(spark, tmp_path):
    write(tmp_path / "big.csv", "city,n\n" + "".join(f"c{k % 7},{k}\n" for k in range(60_000)))
    write(tmp_path / "small.csv", "n,city\n60000,c\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        rows = files.read_csv(spark, str(tmp_path))
        assert rows.selectExpr("count(*)", "sum(cast(n as bigint))", "count(distinct city)").first()[:] == (60_001, 60_000 * 60_001 // 2, 8)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_combined_file_counts_when_alone(spark, tmp_path):
    write(tmp_path / "all_cities_historical_1.csv", "city,date,wind_speed_10m_max\nz,2024-01-01,99\n")
    assert files.load_weather(spark, str(tmp_path)).first()["city"] == "z"


def test_layers_of_the_preset_from_files(spark, raw):
    built = jobs.build_database(spark, raw, 1, "2024-01-01", "2024-01-03")
    status = {r["check"]: r["status"] for r in built["checks"].collect()}
    assert status["duplicates"] == "PASS" and status["rows of a"] == "FAIL" and status["range end"] == "PASS"


def test_save_and_load_raw(spark, tmp_path):
    df = small_table(spark, [("a", D(2024, 1, 1), float("nan"))], "city string, date date, v double")
    for fmt in ("csv", "parquet"):
        files.save_raw(df, f"{tmp_path}/{fmt}_table.{fmt}", fmt)
        back = files.load_raw(spark, str(tmp_path), f"{fmt}_table").first()
        assert back["date"] == D(2024, 1, 1) and back["v"] is None
    with pytest.raises(FileNotFoundError):
        files.load_raw(spark, str(tmp_path), "absent")


def test_payload_files(spark, tmp_path):
    body = {"city": "a", "daily": {"time": ["2024-01-01", "2024-01-02"], "wave_height_max": [1, "bad"]}}
    write(tmp_path / "p.json", json.dumps(body) + "\n" + json.dumps({"city": "b"}))
    read = payload.read_payloads(spark, str(tmp_path / "p.json"), "daily", MARINE_MEASURES)
    rows = payload.marine_rows(read.where("city = 'a'")).orderBy("date").collect()
    assert [r["wave_height_max"] for r in rows] == [1.0, None]
    with pytest.raises(Exception, match="without section"):
        payload.marine_rows(read.where("city = 'b'")).collect()


def test_fetch_ledger_and_pending(spark, tmp_path):
    path = str(tmp_path / "log")
    base = ("a", "archive", "2024-01-01", "2024-01-31")
    for n in (1, 2):
        row = small_table(spark, [(*base, n, dt.datetime(2024, 2, n), "f")], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FETCH_LOG))
        ledgers.record_fetches(row, path)
    log = ledgers.fetch_log(spark, path)
    assert [r["rows"] for r in log.collect()] == [2]
    wanted = small_table(spark, [base, ("b", *base[1:])], "city string, source string, start_date string, end_date string")
    assert [r["city"] for r in ledgers.pending(wanted, log).collect()] == ["b"]


def test_run_ledger_cuts_errors(spark, tmp_path):
    path = str(tmp_path / "runs")
    for n in range(7):
        now = dt.datetime(2024, 1, 1 + n)
        ledgers.record_run(ledgers.run_row(spark, run_id=f"r{n % 6}", mode="full", start_time=now, end_time=now, duration_sec=1.0, status="FAILED", errors="x" * 3000), path)
    latest = ledgers.latest_runs(spark, path).collect()
    assert [r["run_id"] for r in latest] == ["r0", "r5", "r4", "r3", "r2"] and len(latest[0]["errors"]) == 2000


def test_tables_and_listings(spark, tmp_path):
    left = small_table(spark, [("a", 1)], "city string, x int")
    right = small_table(spark, [("a", 1.0)], "city string, y double")
    assert {(r["column_name"], r["only_in"]) for r in tables.schema_difference(left, right).collect()} == {("x", "left"), ("y", "right")}
    assert [r["data_type"] for r in tables.schema_listing(left).orderBy("position").collect()] == ["string", "int"]
    layer = str(tmp_path / "layer")
    tables.upsert_path(spark, layer, left, ["city"], 0)
    target = tables.upsert_path(spark, layer, small_table(spark, [("b", 2)], "city string, x int"), ["city"], 1)
    assert spark.read.parquet(target).count() == 2


def test_catalog_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS raw_t LOCATION '{tmp_path}/db'")
    try:
        tables.create_raw_tables(spark, "raw_t")
        row = small_table(spark, [("a", D(2024, 1, 1), 1.0, 1.0, 1.0)], "city string, date date, visibility_mean double, visibility_min double, visibility_hours_below_1km double")
        row.write.insertInto("raw_t.visibility_daily")
        tables.create_raw_tables(spark, "raw_t", replace=False)
        listed = {r["table_name"]: (r["columns"], r["rows"]) for r in tables.database_inventory(spark, "raw_t").collect()}
        assert listed["raw_t.visibility_daily"] == (5, 1) and listed["raw_t.weather_daily"] == (17, 0)
        tables.replace_table(row, "raw_t.staging")
        assert spark.table("raw_t.staging").count() == 1
    finally:
        spark.sql("DROP DATABASE raw_t CASCADE")


def test_places(spark):
    assert dimensions.places(spark).where("offshore.lat IS NOT NULL").count() == 5


def test_fetch_windows(spark):
    latest = small_table(spark, [("a", D(2024, 1, 10)), ("b", D(2024, 1, 8)), ("c", None)], "city string, max_date date")
    window = lambda *a: tuple(jobs.fetch_window(latest, *a).first())
    assert window("incremental", D(2024, 1, 20)) == (D(2024, 1, 5), D(2024, 1, 19))
    assert window("full", D(2024, 1, 20))[0] == D(2015, 1, 1)
    assert window("incremental", D(2024, 1, 20), "2023-05-01")[0] == D(2023, 5, 1)
    assert jobs.is_current(latest, D(2024, 1, 9)) is not None


def test_gated_job(spark, sf, tmp_path):
    """Two runs: a first load and an incremental one that refreshes the predictions."""
    weather, vis = views.weather(spark, sf), views.visibility(spark, sf)
    end = weather.agg(F.max("date")).first()[0]
    as_of = dt.datetime.combine(end, dt.time()) + dt.timedelta(days=1)
    plain = [c for c in models.CANDIDATES if c.name == "LogisticRegression"]
    common = dict(caps=views.caps(spark), fetch=views.fetch(spark), candidates=plain, options={"logistic": {"maxIter": 15}}, features=["city", "hdd", "temp_range_c"])
    first = jobs.run_job(spark, str(tmp_path), weather, vis, as_of, mode="full", run_id="r1", **common)
    assert first.status == "SUCCESS", first.ledger.first()["errors"]
    tail = weather.where(F.col("date") > F.lit(end - dt.timedelta(days=30)))
    second = jobs.run_job(spark, str(tmp_path), tail, vis, as_of, run_id="r2", **common)
    assert second.status == "SUCCESS", second.ledger.first()["errors"]
    assert second.predictions.count() == 5 * 31
    assert versions.read_layer(spark, f"{tmp_path}/raw_weather", "r2").count() == weather.count()
    # nothing new: every entity has the day before this one
    current = weather.groupBy("city").agg(F.max("date").alias("d")).agg(F.min("d")).first()[0] + dt.timedelta(days=1)
    third = jobs.run_job(spark, str(tmp_path), None, None, dt.datetime.combine(current, dt.time()), run_id="r3", **common)
    assert third.status == "SUCCESS", third.ledger.first()["errors"]
    assert versions.manifest(spark, f"{tmp_path}/daily", "r3") == versions.manifest(spark, f"{tmp_path}/daily", "r2")
    stale = jobs.run_job(spark, str(tmp_path), None, None, as_of + dt.timedelta(days=5), run_id="r4", **common)
    assert stale.status == "FAILED" and "not current" in stale.ledger.first()["errors"]
    assert [r["status"] for r in ledgers.latest_runs(spark, f"{tmp_path}/runs").collect()] == ["FAILED", "SUCCESS", "SUCCESS", "SUCCESS"]


def test_refused_run_is_no_base(spark, sf, tmp_path):
    """A refused run leaves layers behind, but the next one starts from the last success."""
    weather, vis = views.weather(spark, sf), views.visibility(spark, sf)
    as_of = dt.datetime.combine(weather.agg(F.max("date")).first()[0], dt.time()) + dt.timedelta(days=1)
    common = dict(caps=views.caps(spark), fetch=views.fetch(spark), train=False)
    assert jobs.run_job(spark, str(tmp_path), weather, vis, as_of, mode="full", run_id="r1", **common).status == "SUCCESS"
    refused = jobs.run_job(spark, str(tmp_path), weather.limit(0), vis.limit(0), as_of, mode="full", run_id="z9", **common)
    assert refused.status == "FAILED" and jobs.last_success(spark, f"{tmp_path}/runs") == "r1"


def test_gated_job_with_a_forecast(spark, sf, tmp_path):
    """Trains, scores the forecast rows, predicts and passes the gate."""
    weather, vis = views.weather(spark, sf), views.visibility(spark, sf)
    end = weather.agg(F.max("date")).first()[0]
    as_of = dt.datetime.combine(end, dt.time()) + dt.timedelta(days=1)
    past = weather.where(F.col("date") > F.lit(end - dt.timedelta(days=400))).where(F.col("date") <= F.lit(end - dt.timedelta(days=390)))
    future = past.withColumn("date", F.date_add("date", 391))
    plain = [c for c in models.CANDIDATES if c.name == "LogisticRegression"]
    out = jobs.run_job(
        spark, str(tmp_path), weather, vis, as_of, mode="full", run_id="f1", forecast=future, caps=views.caps(spark), fetch=views.fetch(spark), candidates=plain,
        options={"logistic": {"maxIter": 15}}, features=["city", "hdd", "temp_range_c"],
    )
    assert out.status == "SUCCESS", out.ledger.first()["errors"]
    assert {r["source"] for r in out.predictions.select("source").distinct().collect()} == {"short_horizon", "climatology"}


def test_preferred_model_without_a_contest(spark, sf):
    rows = views.daily(spark, sf)
    report = small_table(spark, [("Climatology", 0.1, False), ("LogisticRegression", 0.31, True)], "model string, threshold double, selected boolean")
    picked = models.train_preferred(rows, report, features=["city", "hdd", "temp_range_c"], options={"logistic": {"maxIter": 5}})
    assert (picked.name, picked.threshold) == ("LogisticRegression", 0.31)
    assert models.train_preferred(rows, report, "logistic regression", ["city", "hdd"], options={"logistic": {"maxIter": 5}}).name == "LogisticRegression"
    with pytest.raises(ValueError):
        models.train_preferred(rows, report, "NeuralNet", ["city", "hdd"])


def test_gated_job_stops_on_empty_raw(spark, sf, tmp_path):
    empty = views.weather(spark, sf).limit(0)
    out = jobs.run_job(spark, str(tmp_path), empty, views.visibility(spark, sf), dt.datetime(2001, 11, 10), mode="full", run_id="x")
    assert out.status == "FAILED" and "raw" in out.ledger.first()["errors"]


def test_streamed_days_equal_batch_days(spark, sf, tmp_path):
    hours = views.hourly(spark, sf)
    hours.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(hours.schema).parquet(str(tmp_path / "in"))
    out = streams.hours_to_days_stream(stream)
    run = out.writeStream.format("memory").queryName("streamed_days").outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination(120)
    batch = rollup.hours_to_days(hours).select(*out.columns)
    assert spark.table("streamed_days").exceptAll(batch).isEmpty() and batch.exceptAll(spark.table("streamed_days")).isEmpty()


def test_streamed_upsert_and_range_filter(spark, tmp_path):
    rows = small_table(spark, [("a", D(2024, 1, 1), 600.0), ("a", D(2024, 1, 2), 1.0)], "city string, date date, precipitation_sum double")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    streams.upsert_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), ["city", "date"]).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out/v=0")).count() == 2
    flagged = streams.out_of_range_stream(stream).writeStream.format("memory").queryName("flagged").trigger(availableNow=True).start()
    flagged.awaitTermination(120)
    assert spark.table("flagged").count() == 1
