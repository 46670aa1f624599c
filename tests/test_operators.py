"""Edge rows, golden numbers and properties of the operators."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from daypanel.constants import Rule
from daypanel.functions import hazard, physics, rules, tails
from daypanel.functions.columns import first_number, nan_to_null, small_table
from daypanel.operators import clean, evaluate, features, forecast, models, order_stats, quality, rollup, stats, timeseries

D = dt.date


def panel(spark, values, entity="a", start=D(2024, 1, 1), column="v"):
    rows = [(entity, start + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return small_table(spark, rows, f"city string, date date, {column} double")


def column(df, name, *order):
    return [r[name] for r in df.orderBy(*(order or ("city", "date"))).collect()]


def test_thresholds_are_strict_and_unknown_is_no_risk(spark):
    df = panel(spark, [49.0, 50.0, 51.0, None], column="wind_speed_10m_max")
    assert column(rules.label_risk_days(df), "is_risk_day") == [0, 0, 1, 0]
    vis = panel(spark, [999.0, 1000.0, None], column="visibility_mean")
    assert column(rules.label_risk_days(vis), "is_risk_day") == [1, 0, 0]
    assert column(rules.label_risk_days(vis, null_is_risk=True), "is_risk_day") == [1, 0, 1]


def test_absent_columns_give_zero_flags(spark):
    out = rules.add_rule_flags(panel(spark, [60.0], column="wind_speed_10m_max")).first()
    assert (out["risk_wind"], out["risk_wave"]) == (1, 0)


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert nan_to_null(df).where("v IS NULL").count() == 1


def test_first_number_skips_unreadable_text(spark):
    df = spark.createDataFrame([("x", "2"), ("1.5", "2"), (None, "y")], "a string, b string")
    assert [r[0] for r in df.select(first_number(df, ["a", "b", "absent"])).collect()] == [2.0, 1.5, 0.0]


def test_directional_fills(spark):
    df = panel(spark, [None, 1.0, None, 3.0, None])
    fill = lambda s: column(clean.handle_missing_values(df, {"v": s}), "v")
    assert fill("ffill") == [1.0, 1.0, 1.0, 3.0, 3.0]
    assert fill("bfill") == [1.0, 1.0, 3.0, 3.0, None]
    assert fill("keep") == fill("unheard_of") == [None, 1.0, None, 3.0, None]


def test_group_fills_and_drop(spark):
    df = panel(spark, [None, 1.0, 1.0, 4.0]).unionByName(panel(spark, [None, None], "b"))
    fill = lambda s: column(clean.handle_missing_values(df, {"v": s}), "v")
    assert fill("mean") == [2.0, 1.0, 1.0, 4.0, None, None]
    assert fill("median") == fill("mode") == [1.0, 1.0, 1.0, 4.0, None, None]
    assert fill("drop") == [1.0, 1.0, 4.0]
    tie = panel(spark, [2.0, 1.0, None])
    assert column(clean.handle_missing_values(tie, {"v": "mode"}), "v") == [2.0, 1.0, 1.0]


def test_statistics_agree_on_both_layouts(spark):
    df = panel(spark, [None, 1.0, 5.0, 9.0]).withColumn("w", F.col("v"))
    alone = clean.handle_missing_values(df, {"v": "median"})
    beside = clean.handle_missing_values(df, {"v": "median", "w": "ffill"})
    assert column(alone, "v") == column(beside, "v")


def test_caps_leave_nulls_and_uncapped_entities(spark):
    df = panel(spark, [5.0, 20.0, None]).unionByName(panel(spark, [99.0], "b"))
    caps = clean.caps_table(spark, {"v": {"a": 10.0}})
    assert column(clean.winsorize(df, caps), "v") == [5.0, 10.0, None, 99.0]


@pytest.mark.parametrize("large", [False, True])
def test_outliers_need_spread(spark, large):
    df = panel(spark, [1.0, 2.0, 3.0, 4.0, 100.0, None]).unionByName(panel(spark, [7.0] * 5, "b"))
    got = column(clean.flag_outliers(df, ["v"], large_groups=large), "v_is_outlier")
    assert got == [False] * 4 + [True] + [False] * 6
    with pytest.raises(ValueError):
        clean.flag_outliers(df, ["v"], "other")


def test_dedupe_and_upsert(spark):
    rows = [("a", D(2024, 1, 1), 2.0, None), ("a", D(2024, 1, 1), 1.0, 5.0), ("b", D(2024, 1, 1), 3.0, 1.0)]
    df = small_table(spark, rows, "city string, date date, v double, w double")
    kept = clean.dedupe(df, ["city", "date"], [F.col("v")])
    assert column(kept, "v") == [1.0, 3.0]
    new = small_table(spark, [("b", D(2024, 1, 1), None), ("c", D(2024, 1, 1), 9.0)], "city string, date date, v double")
    assert column(clean.upsert(kept, new, ["city", "date"], partial=True), "v") == [1.0, 3.0, 9.0]
    assert column(clean.upsert(kept, new, ["city", "date"]), "v") == [1.0, None, 9.0]


def test_gaps_and_continuity(spark):
    days = [D(2024, 2, 27), D(2024, 2, 28), D(2024, 3, 3), D(2024, 3, 4)]
    df = small_table(spark, [("a", d, 1.0) for d in days] + [("b", days[0], 1.0)], "city string, date date, v double")
    assert [r["gap_days"] for r in quality.date_gaps(df, 1).collect()] == [4]
    assert quality.date_gaps(df, 4).isEmpty()
    summary = {r["city"]: (r["gap_count"], r["max_gap"]) for r in quality.gap_summary(df).collect()}
    assert summary == {"a": (1, 4), "b": (0, 0)}
    assert [r["date"] for r in clean.missing_dates(df).orderBy("date").collect()] == [D(2024, 2, 29), D(2024, 3, 1), D(2024, 3, 2)]
    assert {r["city"]: r["missing_days"] for r in clean.continuity(df).collect()} == {"a": 3, "b": 0}


def test_rolling_one_is_identity_and_blocks_agree(spark):
    values = [float((i * 37) % 101) for i in range(400)]
    df = panel(spark, values)
    assert column(features.add_rolling_features(df, ["v"], [1]), "v_1d_mean") == values
    plain = column(features.add_rolling_features(df, ["v"], [30]), "v_30d_mean")
    blocks = features.over_blocks(df, {"m": (F.avg("v"), -29, 0)}, "city", "date", lookback=29, block=32)
    assert column(blocks, "m") == plain


def test_single_rows_have_no_anomaly(spark):
    out = features.add_anomaly_scores(panel(spark, [5.0, 6.0]), ["v"])
    assert column(out, "v_anom") == [0.0, 0.0]


def test_leap_day_is_day_366(spark):
    from daypanel.functions.calendar import add_seasonal_features

    row = add_seasonal_features(panel(spark, [1.0], start=D(2024, 12, 31))).first()
    assert (row["day_of_year"], row["day_of_week"], row["season"], row["week_of_year"]) == (366, 1, "Winter", 1)


def test_wave_height_formula_and_sectors(spark):
    df = small_table(spark, [("x", 0.0, None), ("x", 60.0, 359.0), ("y", 60.0, 90.0)], "city string, wind_speed_10m_max double, wind_direction_10m_dominant double")
    fetch = physics.fetch_table(spark, {"x": [400, 1, 1, 1, 1, 1, 1, 1]})
    got = [r["wave_height"] for r in physics.add_wave_height(df, fetch).orderBy("city", "wind_speed_10m_max").collect()]
    u2 = (60 / 3.6) ** 2
    expect = lambda km: round(0.283 * u2 / 9.81 * math.tanh(0.0125 * (9.81 * km * 1000 / u2) ** 0.42), 2)
    assert got == [0.0, expect(400), expect(200)]


def test_hot_group_order_statistics(spark):
    """One group holds most rows, one value a third of them, and the range is heavy-tailed."""
    rng = random.Random(5)
    values = {"hot": [0.0] * 700 + [rng.lognormvariate(0, 4) for _ in range(1400)], "small": [3.0], "flat": [2.0] * 9}
    rows = [(g, v) for g, vs in values.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r["g"]: r for r in order_stats.exact_quantiles(df, ["g"], "v", {"a": 0.25, "m": 0.5, "z": 0.9}).collect()}
    for g, vs in values.items():
        s = sorted(vs)
        for name, p in (("a", 0.25), ("m", 0.5), ("z", 0.9)):
            h = (len(s) - 1) * p
            want = s[int(h)] + (s[math.ceil(h)] - s[int(h)]) * (h - int(h))
            assert got[g][name] == pytest.approx(want, rel=1e-12)
    ranks = {r["v"]: r["mid_rank"] for r in order_stats.mid_ranks(df, ["g"], "v").where("g = 'hot'").collect()}
    ordered = sorted(values["hot"])
    assert ranks[0.0] == 350.5
    assert all(ranks[v] == i + 1 for i, v in enumerate(ordered) if i >= 700)
    whole = order_stats.exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"]
    assert whole == pytest.approx(statistics.median([v for vs in values.values() for v in vs]))


def test_constant_runs_break_at_nulls(spark):
    df = panel(spark, [1.0, 1.0, None, None, 1.0, 1.0, 1.0]).unionByName(panel(spark, [1.0], "b"))
    assert [(r["city"], r["max_constant_run"]) for r in timeseries.constant_runs(df, "v").collect()] == [("a", 3)]


def test_interpolation_stops_after_limit(spark):
    df = panel(spark, [None, 0.0, None, None, None, None, 10.0, None])
    assert column(timeseries.interpolate(df, "v"), "v") == [None, 0.0, 2.0, 4.0, 6.0, None, 10.0, 10.0]


def test_climatology_ring(spark):
    df = panel(spark, [float(i % 2) for i in range(366)], start=D(2024, 1, 1), column="is_risk_day")
    rates = {r["day_of_year"]: r["rate"] for r in timeseries.climatology(df).collect()}
    ring = [float(i % 2) for i in range(366)]
    for day in (1, 180, 366):
        assert rates[day] == pytest.approx(sum(ring[(day - 1 + k) % 366] for k in range(-7, 8)) / 15)


def test_tail_probabilities():
    assert tails.normal_two_sided(1.959963984540054) == pytest.approx(0.05, rel=1e-12)
    assert tails.t_two_sided(2.0, 10) == pytest.approx(0.07338803477074039, rel=1e-10)
    assert tails.chi2_upper(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-10)
    assert tails.f_upper(4.0, 2, 12) == pytest.approx(0.046656, rel=1e-10)


def test_corrections_cap_and_share_ranks(spark):
    df = small_table(spark, [("a", 0.01), ("b", 0.02), ("c", 0.9)], "name string, p_value double")
    out = {r["name"]: r for r in stats.adjust_p_values(df).collect()}
    assert out["a"]["p_bonferroni"] == pytest.approx(0.03) and out["c"]["p_bonferroni"] == 1.0
    assert out["a"]["p_bh"] == pytest.approx(0.03) and out["b"]["p_bh"] == pytest.approx(0.03)


def test_correlations_with_a_constant_feature(spark):
    rows = [("x", k, float(k), float(k * k % 7), 40.0, float(k % 2)) for k in range(30)] + [("y", 0, 1.0, 2.0, 3.0, None)]
    df = spark.createDataFrame(rows, "city string, date int, a double, b double, c double, label double").repartition(7)
    show = lambda out: {(r["feature_1"], r["feature_2"]): r["r"] for r in out.where("city = 'x'").collect()}
    for got in (show(stats.pearson_long(df, ["a", "b", "c"], ["city"])), show(stats.pearson_long(df, ["a", "b", "c"], ["city"], complete=False)), show(stats.spearman_long(df, ["a", "b", "c"], ["city"]))):
        assert -1 < got["a", "b"] < 1 and math.isnan(got["a", "c"]) and math.isnan(got["b", "c"])
    x = df.where("city = 'x'")
    labels = {r["feature"]: r["r"] for r in stats.label_correlations(x, "label", ["a", "c"]).collect()}
    assert labels["a"] == pytest.approx(statistics.correlation([float(k) for k in range(30)], [float(k % 2) for k in range(30)])) and math.isnan(labels["c"])
    vif = {r["feature"]: r["vif"] for r in stats.vif(x, ["a", "b", "c"]).collect()}
    assert vif["c"] == float("inf") and 1 <= vif["a"] < 2
    chosen = {r["feature"]: (r["decision"], r["corr_with_target"]) for r in stats.select_features(x, ["a", "c"], "label").collect()}
    assert chosen["c"] == ("KEEP", None) and chosen["a"][0] == "KEEP"
    trend = stats.linear_trend(x, "a", "c", ["city"]).first()
    assert trend["slope"] == 0 and math.isnan(trend["r_value"])
    assert math.isnan(timeseries.lag1_autocorrelation(x, "c").first()["autocorr_lag1"])
    assert stats.pearson_long(df.where("city = 'y'"), ["a", "b"]).first()["r"] is None


def test_vif_of_equal_columns_is_infinite(spark):
    df = spark.createDataFrame([(float(i), float(i), float((i * 7) % 11)) for i in range(20)], "a double, b double, c double")
    got = {r["feature"]: r for r in stats.vif(df, ["a", "b", "c"]).collect()}
    assert got["a"]["vif"] == float("inf") and got["a"]["flag"] == "severe" and got["c"]["flag"] == "ok"


def test_feature_selection_drops_the_weaker(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(200):
        x = rng.gauss(0, 1)
        rows.append((x, x + rng.gauss(0, 0.2), rng.gauss(0, 1), 1.0 if x > 0.5 else 0.0))
    df = spark.createDataFrame(rows, "x double, near_x double, noise double, y double")
    got = {r["feature"]: r["decision"] for r in stats.select_features(df, ["x", "near_x", "noise"], "y").collect()}
    assert got == {"x": "KEEP", "near_x": "DROP", "noise": "KEEP", "y": "TARGET"}


def test_threshold_grid_reads_grid_values_exactly(spark):
    rows = [(1, t) for t in evaluate.GRID] + [(0, t - 1e-12) for t in evaluate.GRID]
    df = spark.createDataFrame(rows, "label int, probability double")
    for r in evaluate.threshold_grid(df).collect():
        k = round(r["threshold"] * 100)
        assert r["recall"] == pytest.approx((81 - k) / 80)


def test_auc_with_ties_and_one_class(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "label int, probability double")
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(0.875)
    assert evaluate.roc_auc(df.where("label = 1")).first()[0] is None


# A published comparison of candidate models on a hold-out year.
REPORT = [
    ("Climatology", 0.135, 0.724, 0.227, 0.662, 0.078),
    ("LogisticRegression", 0.214, 0.699, 0.328, 0.798, 0.209),
    ("XGBoost", 0.203, 0.506, 0.29, 0.742, 0.178),
    ("RandomForest", 0.241, 0.41, 0.303, 0.77, 0.077),
    ("LogisticRegression_calibrated", 0.219, 0.622, 0.324, 0.798, 0.072),
    ("XGBoost_calibrated", 0.203, 0.487, 0.286, 0.742, 0.074),
    ("RandomForest_calibrated", 0.348, 0.154, 0.213, 0.77, 0.086),
]


def test_published_report_selects_its_winner(spark):
    df = small_table(spark, REPORT, "model string, precision double, recall double, f1 double, roc_auc double, brier double")
    chosen = evaluate.select_winner(df).where("selected").first()
    assert chosen["model"] == "LogisticRegression_calibrated"
    assert chosen["production_score"] == pytest.approx(0.6294, abs=1e-4)


def test_at_least_is_exact(spark):
    p = [0.1, 0.5, 0.9, 0.3, 0.7, 0.2]
    df = spark.createDataFrame([(p,)], "p array<double>")
    dist = [1.0]
    for x in p:
        dist = [(dist[i] if i < len(dist) else 0) * (1 - x) + (dist[i - 1] * x if i else 0) for i in range(len(dist) + 1)]
    for k in (1, 2, 5):
        assert df.select(forecast.at_least(F.col("p"), k)).first()[0] == pytest.approx(sum(dist[k:]))


def test_combined_probability_of_a_stored_row(spark):
    df = spark.range(1).select(hazard.combined_probability(F.lit(0.0249), F.lit(0.0236)).alias("p"))
    assert df.first()["p"] == pytest.approx(0.0353, abs=1e-4)


def test_sea_risk_treats_zero_as_unknown_for_all_but_the_last(spark):
    df = small_table(spark, [(0.0, 1.0), (0.0, 0.0)], "wave_height_max double, wave_height double")
    assert [r["offshore_wave_height_m"] for r in hazard.add_sea_risk(df).collect()] == [1.0, None]


def test_forecast_table_falls_back(spark):
    entities = small_table(spark, [("a",), ("b",)], "city string")
    scored = small_table(spark, [("a", D(2024, 3, 1), 0.6, 80.0)], "city string, date date, model_probability double, wind_gusts_10m_max double")
    rates = small_table(spark, [("a", 62, 0.2)], "city string, day_of_year int, rate double")
    out = forecast.daily_forecast(entities, D(2024, 3, 1), scored, rates, F.lit(0.05), None, None, days_ahead=2)
    rows = {(r["city"], r["date"].day): r for r in out.collect()}
    assert len(rows) == 6
    assert rows["a", 1]["source"] == "short_horizon" and rows["a", 1]["risk_reason"] == "strong wind gusts"
    assert rows["a", 2]["probability"] == 0.2 and rows["b", 3]["probability"] == 0.05
    summary = forecast.summarise_window(out, 1).collect()
    assert sum(r["n_climatology_days"] for r in summary) == 5


def test_gates(spark):
    df = panel(spark, [1.0, None, 600.0], column="precipitation_sum")
    status = lambda r: r.first()["status"]
    assert status(quality.check_row_count(df)) == "PASS" and status(quality.check_row_count(df.limit(0))) == "FAIL"
    assert quality.any_aborting(quality.check_row_count(df.limit(0)))
    assert status(quality.check_null_ratio(df)) == "WARN"
    assert [r["reason"] for r in quality.out_of_range(df).collect()] == ["above_500"]
    assert status(quality.check_freshness(df, D(2024, 1, 5))) == "PASS"
    assert status(quality.check_freshness(df, D(2024, 1, 6))) == "WARN"
    assert status(quality.check_feature_completeness(df)) == "FAIL"
    with pytest.raises(ValueError):
        quality.run_checks("other", df)


def test_leaking_columns_are_left_out():
    got = models.feature_columns(["city", "hdd", "wave_height", "wave_height_lag1", "is_risk_day", "date"])
    assert got == ["city", "hdd", "wave_height_lag1"]


def test_first_category_and_unseen_ones_encode_as_zeros(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None)], "city string, x double")
    fitted = Pipeline(stages=models.preprocess(train, ["x", "city"], ["city"], False)).fit(train)
    test = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0), ("new", 1.0)], "city string, x double")
    got = {r["city"]: r["f"][1:] for r in fitted.transform(test).select("city", vector_to_array("features").alias("f")).collect()}
    assert got == {"a": [0.0, 0.0], "b": [1.0, 0.0], "c": [0.0, 1.0], "new": [0.0, 0.0]}


def test_months_without_rows_are_listed_on_request(spark):
    df = small_table(spark, [("a", D(2024, 1, 5), 1.0), ("a", D(2024, 3, 5), 2.0)], "city string, date date, v double")
    out = rollup.monthly_features(df, ["v"], [Rule("v", 1.5)], 1, fill_months=True)
    assert [(r["month_end"].month, r["total_days"], r["high_risk_month"]) for r in out.orderBy("month_end").collect()] == [(1, 1, 0), (2, 0, 0), (3, 1, 1)]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def labelled_days(spark, n=240):
    rows = [(c, D(2024, 1, 1) + dt.timedelta(days=k), float((k * 37 + j) % 50), (k * 7 + j) % 3 // 2) for k in range(n) for j, c in enumerate(["a", "b"])]
    return spark.createDataFrame(rows, f"city string, date date, wind double, {models.TARGET} int")


def test_intervals_do_not_carry_the_plan_of_their_rows(spark):
    rows = labelled_days(spark).join(spark.createDataFrame([("a", 1), ("b", 2)], "city string, k int"), "city")
    train, test = rows.where("date < '2024-06-01'"), rows.where("date >= '2024-06-01'")
    out = models.prediction_intervals(train, test, "logistic", ["city", "wind"], True, refits=3)
    assert "Join" in plan(test) and "Join" not in plan(out) and "UDF" not in plan(out)
    got = out.collect()
    assert len(got) == test.count() and all(0 <= r["ci_low"] <= r["ci_high"] <= 1 for r in got)


def test_rows_for_models_are_written_once(spark, sf):
    from catalog import learning

    rows = learning.written_rows(spark, sf)
    assert "Join" in plan(learning.rows_for_models(spark, sf)) and "Join" not in plan(rows)
    assert rows.exceptAll(learning.rows_for_models(spark, sf)).isEmpty() and "Join" not in plan(learning.m1(spark, sf))


def test_bootstrap_ranges_are_bounded(spark, monkeypatch):
    scored = spark.range(4000).selectExpr("cast(id % 3 = 0 as int) as label", "(id * 7919 % 4000) / 4000 as probability")
    held = []
    deal = evaluate.value_ranges
    monkeypatch.setattr(evaluate, "value_ranges", lambda *a: held.append(deal(*a)) or held[-1])
    monkeypatch.setattr(evaluate, "SCORES_PER_RANGE", 500)
    got = evaluate.bootstrap_sums(scored, 0.4, replicates=200).agg(F.count("*").alias("n"), F.avg("auc").alias("auc"), F.avg("f1").alias("f1")).first()
    sizes = [r["count"] for r in held[0].groupBy("_range").count().collect()]
    assert sum(sizes) == 4000 and len(sizes) == 8 and max(sizes) <= 1000
    tp, fp, fn = (scored.where(w).count() for w in ("label = 1 and probability >= 0.4", "label = 0 and probability >= 0.4", "label = 1 and probability < 0.4"))
    assert got["n"] == 200 and got["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn), abs=0.01) and got["auc"] == pytest.approx(evaluate.roc_auc(scored).first()[0], abs=0.01)
