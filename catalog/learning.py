"""Model preparation, training and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views
from catalog.registry import big, block, query, r
from daypanel.operators import evaluate, models, timeseries
from daypanel.functions.columns import small_table, stable_round
from daypanel.operators import features as feat
from daypanel.operators.order_stats import prefix_sums
from daypanel.session import scratch_table

GRID = [0.01 + 0.01 * i for i in range(80)]
GRID_SQL = "(SELECT CAST(unnest(generate_series(1, 80)) AS DOUBLE) AS k, unnest([" + ", ".join(f"{t!r}::DOUBLE" for t in GRID) + "]) AS t)"
RATIO = lambda a, b: f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0.0)"
GRID_ROWS = f"""SELECT city, round(k / 100, 2) AS threshold, CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy, {RATIO('tp', 'tp + fp')} AS precision, {RATIO('tp', 'tp + fn')} AS recall,
  {RATIO('2 * tp', '2 * tp + fp + fn')} AS f1, CAST(tp + fp AS DOUBLE) / (tp + fp + fn + tn) AS predicted_positive_rate
FROM (SELECT city, k, count(*) FILTER (probability >= t AND label = 1) AS tp, count(*) FILTER (probability >= t AND label = 0) AS fp,
  count(*) FILTER (probability < t AND label = 1) AS fn, count(*) FILTER (probability < t AND label = 0) AS tn FROM scored CROSS JOIN {GRID_SQL} GROUP BY city, k)"""
block("grid_rows", "scored", GRID_ROWS)


@query("m6_threshold_grid", "@grid_rows|SELECT * FROM grid_rows")
def m6(spark, sf):
    return evaluate.threshold_grid(views.scored(spark, sf), by=["city"])


@query(
    "m6_best_threshold",
    "@grid_rows|SELECT * FROM grid_rows QUALIFY row_number() OVER (PARTITION BY city ORDER BY f1 DESC, recall DESC, precision DESC, abs(threshold - 0.1), threshold) = 1",
)
def m6_best(spark, sf):
    grid = evaluate.threshold_grid(views.scored(spark, sf), by=["city"])
    return evaluate.best_threshold(grid, ["city"])


AUC_SQL = """SELECT {g}sum(pos * (before + neg / 2.0::DOUBLE)) / (sum(pos) * CAST(sum(neg) AS DOUBLE)) AS roc_auc FROM (
  SELECT *, coalesce(sum(neg) OVER ({p}ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (
    SELECT {g}probability, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scored GROUP BY {g}probability)) {t}"""


@query("m7_roc_auc", "@scored|SELECT city, round(roc_auc, 9) AS roc_auc FROM (" + AUC_SQL.format(g="city, ", p="PARTITION BY city ", t="GROUP BY city") + ")")
def m7(spark, sf):
    return evaluate.roc_auc(views.scored(spark, sf), by=["city"]).withColumn("roc_auc", F.round("roc_auc", 9))


@query("m7_roc_auc_overall", "@scored|SELECT round(roc_auc, 9) AS roc_auc FROM (" + AUC_SQL.format(g="", p="", t="") + ")")
def m7_all(spark, sf):
    return evaluate.roc_auc(views.scored(spark, sf)).withColumn("roc_auc", F.round("roc_auc", 9))


@query("m8_brier", "@scored|SELECT city, round(avg(pow(probability - label, 2)), 9) AS brier FROM scored GROUP BY city")
def m8(spark, sf):
    return evaluate.brier(views.scored(spark, sf), by=["city"]).withColumn("brier", F.round("brier", 9))


# a wave of 0.0 is unknown here, because a later alternative name exists
@query(
    "m9_sea_adjusted_scores",
    """@daily|SELECT city, date, wave_height, label, CAST(round(CAST(least(1.0 - (1.0 - p) * (1.0 - 0.45::DOUBLE * sea), 0.95) AS DECIMAL(30,12)), 6) AS DOUBLE) AS probability
FROM (SELECT city, date, wave_height, is_risk_day AS label, day_of_year / 400::DOUBLE AS p,
  CASE WHEN coalesce(wave_height, 0) = 0 THEN 0.0::DOUBLE ELSE round(0.85::DOUBLE / (exp((greatest(wave_height, 0) / 2.5::DOUBLE - 1.0) * -6.0) + 1.0), 4) END AS sea FROM daily)""",
)
def m9(spark, sf):
    daily = views.daily(spark, sf).select("city", "date", "wave_height", F.col("is_risk_day").alias("label"), (F.col("day_of_year") / 400).alias("probability"))
    return models.with_sea_adjustment(daily).withColumn("probability", stable_round(F.col("probability"), 6))


CLIM_SQL = lambda source, label: f"""raw AS (SELECT city, CAST(dayofyear(date) AS INTEGER) AS day_of_year, avg({label}) AS raw FROM {source} GROUP BY ALL),
slots AS (SELECT city, CAST(d AS INTEGER) AS day_of_year FROM (SELECT DISTINCT city FROM raw), generate_series(1, 366) AS g(d)),
held AS (SELECT city, day_of_year, last_value(raw IGNORE NULLS) OVER (PARTITION BY city ORDER BY day_of_year ROWS UNBOUNDED PRECEDING) AS held FROM slots LEFT JOIN raw USING (city, day_of_year)),
clim AS (SELECT a.city, a.day_of_year, CASE WHEN count(b.held) = 15 THEN avg(b.held) END AS rate FROM held a, generate_series(-7, 7) AS g(k), held b
  WHERE b.city = a.city AND b.day_of_year = ((a.day_of_year - 1 + k + 366) % 366) + 1 GROUP BY a.city, a.day_of_year)"""


@query("f8_climatology", "@daily|WITH " + CLIM_SQL("daily", "is_risk_day") + " SELECT city, day_of_year, round(rate, 9) AS rate FROM clim")
def f8(spark, sf):
    return timeseries.climatology(views.daily(spark, sf)).withColumn("rate", F.round("rate", 9))


@query("f8_climatology_unsmoothed", "@daily|WITH " + CLIM_SQL("daily", "is_risk_day") + " SELECT city, day_of_year, round(held, 9) AS rate FROM held")
def f8_raw(spark, sf):
    return timeseries.climatology(views.daily(spark, sf), half_window=0).withColumn("rate", F.round("rate", 9))


@query(
    "m10_baseline_scores",
    "@daily|WITH train AS (SELECT * FROM daily WHERE year < 2001), " + CLIM_SQL("train", "is_risk_day")
    + " SELECT d.city, d.date, round(coalesce(rate, (SELECT avg(is_risk_day) FROM train)), 9) AS probability FROM daily d LEFT JOIN clim c ON c.city = d.city AND c.day_of_year = dayofyear(d.date) WHERE year = 2001",
)
def m10(spark, sf):
    train, test = models.split_by_year(views.daily(spark, sf), 2001)
    out = models.baseline_scores(train, test, "is_risk_day")
    return out.select("city", "date", F.round("probability", 9).alias("probability"))


block("model_rows", "scored", """SELECT CASE city WHEN '1-URGENT' THEN 'Climatology' ELSE city END AS model, round(avg(probability), 4) AS f1, round(avg(label) + 0.2, 4) AS recall,
  round(0.5 + avg(probability * label), 4) AS roc_auc, round(avg(pow(probability - label, 2)), 4) AS brier FROM scored GROUP BY city""")


def model_rows(spark, sf):
    p, y = F.col("probability"), F.col("label")
    rows = views.scored(spark, sf).groupBy("city").agg(
        F.round(F.avg(p), 4).alias("f1"), F.round(F.avg(y) + 0.2, 4).alias("recall"), F.round(F.avg(p * y) + 0.5, 4).alias("roc_auc"), F.round(F.avg((p - y) * (p - y)), 4).alias("brier")
    )
    name = F.when(F.col("city") == "1-URGENT", "Climatology").otherwise(F.col("city"))
    return rows.select(name.alias("model"), "f1", "recall", "roc_auc", "brier")


@query(
    "m12_select_winner",
    """@model_rows|WITH b AS (SELECT f1 AS bf, roc_auc AS ba, brier AS bb FROM model_rows WHERE model = 'Climatology'),
e AS (SELECT m.*, model <> 'Climatology' AND f1 >= bf AND roc_auc >= ba AND brier <= bb + 0.005 AND recall >= 0.25 AS eligible,
  CASE WHEN model <> 'Climatology' THEN 0.35::DOUBLE * f1 + 0.20::DOUBLE * recall + 0.20::DOUBLE * roc_auc + 0.25::DOUBLE * (1.0 - brier) END AS score FROM model_rows m, b),
w AS (SELECT model AS winner FROM e WHERE model <> 'Climatology' ORDER BY eligible DESC, score DESC, brier, f1 DESC, recall DESC LIMIT 1)
SELECT model, f1, recall, roc_auc, brier, eligible, round(score, 9) AS production_score, model = (SELECT winner FROM w) AS selected FROM e""",
)
def m12(spark, sf):
    return evaluate.select_winner(model_rows(spark, sf)).withColumn("production_score", F.round("production_score", 9))


@query("m15_confusion", "@scored|SELECT city, label AS actual, CAST(probability >= 0.5 AS INTEGER) AS predicted, count(*) AS n FROM scored GROUP BY ALL")
def m15(spark, sf):
    return evaluate.confusion(views.scored(spark, sf), 0.5, by=["city"])


@query(
    "m16_metrics_by_entity",
    f"""@scored|WITH a AS (SELECT city, round(roc_auc, 9) AS roc_auc FROM ({AUC_SQL.format(g="city, ", p="PARTITION BY city ", t="GROUP BY city")})),
k AS (SELECT city, count(*) AS n_test, avg(CAST(label AS DOUBLE)) AS pos_rate, round(avg(pow(probability - label, 2)), 9) AS brier, count(*) FILTER (probability >= 0.4 AND label = 1) AS tp,
  count(*) FILTER (probability >= 0.4 AND label = 0) AS fp, count(*) FILTER (probability < 0.4 AND label = 1) AS fn, count(*) FILTER (probability < 0.4 AND label = 0) AS tn FROM scored GROUP BY city)
SELECT city, n_test, pos_rate, brier, CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy, {RATIO('tp', 'tp + fp')} AS precision, {RATIO('tp', 'tp + fn')} AS recall, {RATIO('2 * tp', '2 * tp + fp + fn')} AS f1,
  CAST(tp + fp AS DOUBLE) / (tp + fp + fn + tn) AS predicted_positive_rate, roc_auc FROM k JOIN a USING (city)""",
)
def m16(spark, sf):
    out = evaluate.metrics_at(views.scored(spark, sf), 0.4, by=["city"])
    return out.withColumns({"brier": F.round("brier", 9), "roc_auc": F.round("roc_auc", 9)})


@query(
    "m17_roc_curve",
    """@scored|WITH c AS (SELECT city, probability AS threshold, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scored GROUP BY city, probability)
SELECT city, threshold, CAST(sum(neg) OVER w AS DOUBLE) / sum(neg) OVER (PARTITION BY city) AS fpr, CAST(sum(pos) OVER w AS DOUBLE) / sum(pos) OVER (PARTITION BY city) AS tpr
FROM c WINDOW w AS (PARTITION BY city ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)""",
)
def m17(spark, sf):
    return evaluate.roc_curve(views.scored(spark, sf), by=["city"])


EDGES = "[" + ", ".join(f"0.{i}" for i in range(1, 10)) + "]"


@query(
    "m18_calibration_curve",
    f"""@scored|WITH e AS (SELECT city, quantile_cont(probability, {EDGES}) AS q FROM scored GROUP BY city)
SELECT city, CAST(len(list_filter(q, lambda x: probability > x)) AS INTEGER) AS bin, count(*) AS n, avg(CAST(label AS DOUBLE)) AS fraction_positive, round(avg(probability), 9) AS mean_predicted
FROM scored JOIN e USING (city) GROUP BY ALL""",
)
def m18(spark, sf):
    return evaluate.calibration_curve(views.scored(spark, sf), by=["city"]).withColumn("mean_predicted", F.round("mean_predicted", 9))


@query("m19_bootstrap_intervals")
def m19(spark, sf):
    return evaluate.bootstrap_intervals(views.scored(spark, sf), 0.4)


@query(
    "m19_bootstrap_properties",
    f"""@scored|SELECT 1000::BIGINT AS replicates, round(f1, 9) AS f1, round(roc_auc, 9) AS roc_auc, true AS f1_inside, true AS auc_inside, true AS f1_spread_fits, true AS auc_spread_fits
FROM (SELECT CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) AS f1 FROM (SELECT count(*) FILTER (probability >= 0.4 AND label = 1) AS tp, count(*) FILTER (probability >= 0.4 AND label = 0) AS fp, count(*) FILTER (probability < 0.4 AND label = 1) AS fn FROM scored)),
  ({AUC_SQL.format(g="", p="", t="")})""",
)
def m19_properties(spark, sf):
    """The sample's own values lie inside the intervals, and the resamples spread about as theory says (delta method, a factor of 1.25)."""
    scored = views.scored(spark, sf)
    hit, y = F.col("probability") >= 0.4, F.col("label") == 1
    counted = scored.agg(*[F.sum(x.cast("long")).cast("double").alias(n) for n, x in (("tp", hit & y), ("fp", hit & ~y), ("fn", ~hit & y), ("p", y), ("q", ~y))])
    drawn = evaluate.bootstrap_sums(scored, 0.4).agg(
        F.count(F.lit(1)).alias("replicates"), *[F.percentile(m, F.lit(q)).alias(f"{m}_{n}") for m in ("f1", "auc") for n, q in (("low", 0.025), ("high", 0.975))],
        F.stddev_samp("f1").alias("f1_sd"), F.stddev_samp("auc").alias("auc_sd"),
    )
    sums = prefix_sums(evaluate._score_cells(scored, "label", "probability", []), [], "probability", ("pos", "neg"))
    # placements: how often a row of one class beats the other; their variances make that of the area
    over, under = (F.col("neg_before") + F.col("neg") / 2) / F.col("neg_total"), (F.col("pos_total") - F.col("pos_before") - F.col("pos") / 2) / F.col("pos_total")
    mean = lambda n, v: F.sum(F.col(n) * v) / F.sum(n)
    area = sums.agg(mean("pos", over).alias("roc_auc"), (mean("pos", over * over) - mean("pos", over) ** 2).alias("v1"), (mean("neg", under * under) - mean("neg", under) ** 2).alias("v0"))
    tp, errors = F.col("tp"), F.col("fp") + F.col("fn")
    f1 = 2 * tp / (2 * tp + errors)
    f1_sd = 2 * F.sqrt(tp * errors * (tp + errors)) / F.pow(2 * tp + errors, 2)
    auc_sd = F.sqrt(F.col("v1") / F.col("p") + F.col("v0") / F.col("q"))
    fits = lambda sd, want: (sd < want * 1.25) & (sd > want / 1.25)
    one = drawn.join(counted).join(area)
    return one.select(
        "replicates", F.round(f1, 9).alias("f1"), F.round("roc_auc", 9).alias("roc_auc"), f1.between(F.col("f1_low"), F.col("f1_high")).alias("f1_inside"),
        F.col("roc_auc").between(F.col("auc_low"), F.col("auc_high")).alias("auc_inside"), fits(F.col("f1_sd"), f1_sd).alias("f1_spread_fits"), fits(F.col("auc_sd"), auc_sd).alias("auc_spread_fits"),
    )


@query(
    "m21_residual_bins",
    """@scored|WITH b AS (SELECT city, min(probability) AS lo, max(probability) AS hi FROM scored GROUP BY city)
SELECT city, CAST(least(floor((probability - lo) * 20 / (hi - lo)), 19) AS INTEGER) AS bin, count(*) AS n, round(avg(probability), 9) AS mean_value, round(avg(label - probability), 9) AS mean_residual
FROM scored JOIN b USING (city) GROUP BY ALL""",
)
def m21(spark, sf):
    out = evaluate.residual_bins(views.scored(spark, sf), "probability", by=["city"])
    return out.withColumns({"mean_value": F.round("mean_value", 9), "mean_residual": F.round("mean_residual", 9)})


@query("m24_class_balance", "@scored|SELECT count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg, CAST(count(*) FILTER (label = 0) AS DOUBLE) / count(*) FILTER (label = 1) AS positive_weight FROM scored")
def m24(spark, sf):
    return evaluate.class_balance(views.scored(spark, sf))


@query("a37_split_sizes", "@daily|SELECT CASE WHEN year < 2001 THEN 'train' ELSE 'test' END AS part, city, count(*) AS n, avg(CAST(is_risk_day AS DOUBLE)) AS positive_rate FROM daily GROUP BY ALL")
def a37(spark, sf):
    return models.split_sizes(*models.split_by_year(views.daily(spark, sf), 2001), "is_risk_day")


# ---- Trained models: the operators' own settings ----

FEATURES = ["city", "season", "month_sin", "month_cos", "temperature_2m_mean", "temp_range_c", "hdd", "wind_3d_max", "precip_3d_sum", "wave_height_lag1", "wave_height_7d_mean"]


@views.planned
def rows_for_models(spark, sf):
    wanted = [f for f in FEATURES if f != "city"]
    rows = feat.next_day_target(views.daily(spark, sf))
    return rows.select("city", "date", *wanted, "wave_height", models.TARGET)


def written_rows(spark, sf):
    """The rows for models, written once: preparation and fits read them many times, each time through every join and window before them."""
    return scratch_table(rows_for_models(spark, sf))


NUMERIC = [f for f in FEATURES if f not in ("city", "season")]
CATEGORIES = {"city": sorted(views.REGIONS), "season": ["Autumn", "Spring", "Summer", "Winter"]}
SLOTS = [*NUMERIC, *[f"{c}_{v}" for c, values in CATEGORIES.items() for v in values[1:]]]
block(
    "model_rows_all", "daily",
    f"SELECT city, date, {', '.join(f for f in FEATURES if f != 'city')}, wave_height, CAST(lead(is_risk_day) OVER (PARTITION BY city ORDER BY date) AS INTEGER) AS {models.TARGET} FROM daily QUALIFY {models.TARGET} IS NOT NULL",
)


@query(
    "m1_preprocess",
    "@model_rows_all|WITH imputed AS (SELECT city, date, season, " + ", ".join(f"coalesce({f}, (SELECT median({f}) FROM model_rows_all)) AS {f}" for f in NUMERIC) + " FROM model_rows_all), "
    "moments AS (SELECT " + ", ".join(f"avg({f}) AS m_{i}, nullif(stddev_samp({f}), 0) AS s_{i}" for i, f in enumerate(NUMERIC)) + " FROM imputed) SELECT city, date, "
    + ", ".join(f"{r(f'coalesce(({f} - m_{i}) / s_{i}, 0)', 5)} AS slot_{i}" for i, f in enumerate(NUMERIC)) + ", "
    + ", ".join(f"CASE WHEN {c} = '{v}' THEN 1.0::DOUBLE ELSE 0.0 END AS slot_{len(NUMERIC) + i}" for i, (c, v) in enumerate((c, v) for c, values in CATEGORIES.items() for v in values[1:]))
    + " FROM imputed, moments",
)
def m1(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = written_rows(spark, sf)
    stages = models.preprocess(rows, FEATURES, ["city", "season"], True)
    out = Pipeline(stages=stages).fit(rows).transform(rows).withColumn("_v", vector_to_array("features"))
    return out.select("city", "date", *[(stable_round(F.col("_v")[i], 5) + 0.0).alias(f"slot_{i}") for i in range(len(SLOTS))])


def _trained(spark, sf, family: str, scale: bool):
    train, test = models.split_by_year(written_rows(spark, sf), 2001)
    model = models.fit(train, family, FEATURES, scale)
    return models.score(model, test).select("city", "date", models.TARGET, "probability")


@query("m2_logistic_regression")
def m2(spark, sf):
    return _trained(spark, sf, "logistic", True)


@query(
    "m2_logistic_certificate",
    f"SELECT CAST(unnest(range({len(SLOTS) + 1})) AS INTEGER) AS slot, true AS at_optimum, 0.0::DOUBLE AS gradient",
)
def m2_certificate(spark, sf):
    """The gradient of the penalised, weighted loss at the fitted coefficients, over all training rows: 0 at its only optimum. The last slot is the intercept."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    train, _ = models.split_by_year(written_rows(spark, sf), 2001)
    model = models.fit(train, "logistic", FEATURES, True)
    weights, intercept, penalty = model.stages[-1].coefficients.toArray().tolist(), model.stages[-1].intercept, model.stages[-1].getRegParam()
    ready = models.balanced_weights(PipelineModel(model.stages[:-1]).transform(train)).select(vector_to_array("features").alias("x"), models.TARGET, "_weight")
    margin = F.aggregate(F.zip_with("x", F.array(*map(F.lit, weights)), lambda a, b: a * b), F.lit(float(intercept)), lambda a, b: a + b)
    slope = F.col("_weight") * (1 / (1 + F.exp(-margin)) - F.col(models.TARGET))
    long = ready.select("_weight", slope.alias("_slope"), F.posexplode(F.concat("x", F.array(F.lit(1.0)))).alias("slot", "_x"))
    beta = F.element_at(F.array(*map(F.lit, [*weights, 0.0])), F.col("slot") + 1)
    sums = long.groupBy("slot").agg((F.sum(F.col("_slope") * F.col("_x")) / F.sum("_weight")).alias("_g"))
    gradient = F.col("_g") + beta * penalty
    return sums.select("slot", (F.abs(gradient) < 5e-5).alias("at_optimum"), (F.round(F.abs(gradient), 4) + 0.0).alias("gradient"))


@query("m3_random_forest")
def m3(spark, sf):
    return _trained(spark, sf, "forest", False)


@query("m4_boosted_trees")
def m4(spark, sf):
    return _trained(spark, sf, "boosted", False)


@query("m5_calibrated_logistic")
def m5(spark, sf):
    train, test = models.split_by_year(written_rows(spark, sf), 2001)
    model = models.fit_calibrated(train, "logistic", FEATURES, True)
    return model.score(test).select("city", "date", models.TARGET, "probability")


@query("m11_m13_train_and_select")
def m11(spark, sf):
    return models.train_and_select(written_rows(spark, sf), FEATURES, year=2001).report


@query(
    "m14_preferred_model",
    f"@model_rows_all|SELECT 'LogisticRegression' AS model_name, false AS is_calibrated, 0.3::DOUBLE AS decision_threshold, [{', '.join(repr(f) for f in FEATURES)}] AS feature_columns, "
    f"'threshold of the stored report' AS validation_note, TIMESTAMP '2001-11-10 00:00:00' AS trained_at, count(*) AS trained_rows, avg(CAST({models.TARGET} AS DOUBLE)) AS positive_rate FROM model_rows_all",
)
def m14(spark, sf):
    rows = written_rows(spark, sf)
    report = small_table(spark, [("Climatology", 0.1, False), ("LogisticRegression", 0.3, True)], "model string, threshold double, selected boolean")
    picked = models.train_preferred(rows, report, features=FEATURES)
    import datetime as dt

    return models.metadata(picked, rows, dt.datetime(2001, 11, 10))


@query("m20_prediction_intervals")
def m20(spark, sf):
    train, test = models.split_by_year(written_rows(spark, sf), 2001)
    return models.prediction_intervals(train, test, "logistic", FEATURES, True)


@query(
    "m20_interval_properties",
    f"@model_rows_all|SELECT city, date, true AS ordered, true AS within, true AS near FROM model_rows_all WHERE year(date) = 2001",
)
def m20_properties(spark, sf):
    """The intervals of ``m20``: in order, within 0 and 1, and around the point prediction with a slack of a tenth."""
    train, test = models.split_by_year(written_rows(spark, sf), 2001)
    point = models.score(models.fit(train, "logistic", FEATURES, True), test, "_point").select("city", "date", "_point")
    got = models.prediction_intervals(train, test, "logistic", FEATURES, True).join(point, ["city", "date"])
    low, high, p = F.col("ci_low"), F.col("ci_high"), F.col("_point")
    return got.select("city", "date", (low <= high).alias("ordered"), ((low >= 0) & (high <= 1)).alias("within"), p.between(low - 0.1, high + 0.1).alias("near"))


@query("m22_coefficients")
def m22(spark, sf):
    rows = written_rows(spark, sf)
    return models.coefficient_table(models.fit(rows, "logistic", FEATURES, True), rows)


def _report_sql(name: str, p: str) -> str:
    """The best row of the threshold grid, AUC and Brier of scores ``p``, as one row."""
    grid = f"""SELECT round(k / 100, 2) AS threshold, CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy, {RATIO('tp', 'tp + fp')} AS precision, {RATIO('tp', 'tp + fn')} AS recall,
  {RATIO('2 * tp', '2 * tp + fp + fn')} AS f1, CAST(tp + fp AS DOUBLE) / (tp + fp + fn + tn) AS predicted_positive_rate
FROM (SELECT k, count(*) FILTER ({p} >= t AND label = 1) AS tp, count(*) FILTER ({p} >= t AND label = 0) AS fp, count(*) FILTER ({p} < t AND label = 1) AS fn, count(*) FILTER ({p} < t AND label = 0) AS tn
  FROM scored CROSS JOIN {GRID_SQL} GROUP BY k)"""
    best = f"(SELECT * FROM ({grid}) ORDER BY f1 DESC, recall DESC, precision DESC, abs(threshold - 0.1), threshold LIMIT 1)"
    auc = AUC_SQL.format(g="", p="", t="").replace("FROM scored", f"FROM (SELECT label, {p} AS probability FROM scored)")
    rounded = ", ".join(f"{r(c, 3)} AS {c}" for c in ("accuracy", "precision", "recall", "f1", "predicted_positive_rate", "roc_auc", "brier"))
    return f"SELECT threshold, {rounded}, '{name}' AS model, '' AS notes FROM {best}, ({auc}), (SELECT avg(pow({p} - label, 2)) AS brier FROM scored)"


@query("m23_comparison_table", f"@scored|{_report_sql('score', 'probability')} UNION ALL {_report_sql('reversed', '(1 - probability)')}")
def m23(spark, sf):
    reports = [
        models.report_row(views.scored(spark, sf), "score", "label"),
        models.report_row(views.scored(spark, sf).withColumn("probability", 1 - F.col("probability")), "reversed", "label"),
    ]
    return evaluate.report_rows(reports)
