"""Hypothesis tests, correlation, collinearity and feature selection.

Statistics are compared with SQL; p-values with tails that SQL integrates numerically.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views
from catalog.registry import block, query
from daypanel.operators import rollup, stats

WIND = "wind_speed_10m_max"


def seasons():
    return F.col("season") == "Winter", F.col("season") == "Summer"


def rounded(df, digits: int, *names: str):
    return df.withColumns({n: F.round(n, digits) for n in names})


TWO = "FROM daily GROUP BY city"
W, S = f"{WIND} FILTER (season = 'Winter')", f"{WIND} FILTER (season = 'Summer')"
MOMENTS = (
    "SELECT city, " + ", ".join(
        f"count({WIND}) FILTER (season = '{s}') AS n{i}, avg({WIND}) FILTER (season = '{s}') AS m{i}, var_samp({WIND}) FILTER (season = '{s}') AS v{i}"
        for i, s in ((1, "Winter"), (2, "Summer"))
    ) + " FROM daily GROUP BY city"
)


@query(
    "t1_t2_welch_and_cohen",
    f"""@daily|SELECT city, n1, n2, m1, m2, round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 7) AS t,
round(pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)), 5) AS dof,
round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)), 8) AS cohens_d,
CASE WHEN abs((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2))) > 0.8 THEN 'large' WHEN abs((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2))) > 0.5 THEN 'medium'
  WHEN abs((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2))) > 0.2 THEN 'small' ELSE 'negligible' END AS effect
FROM ({MOMENTS})""",
)
def t1(spark, sf):
    out = stats.welch_test(views.daily(spark, sf), WIND, *seasons(), by=["city"], p_value=False)
    return rounded(rounded(rounded(out, 7, "t"), 5, "dof"), 8, "cohens_d")


@query(
    "t3_mann_whitney",
    f"""@daily|WITH d AS (SELECT city, season, {WIND} AS v FROM daily WHERE season IN ('Winter', 'Summer') AND {WIND} IS NOT NULL),
g AS (SELECT city, v, count(*) AS n, count(*) FILTER (season = 'Winter') AS n1 FROM d GROUP BY city, v),
k AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY city ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (n + 1) / 2.0::DOUBLE AS mid FROM g),
s AS (SELECT city, CAST(sum(n1) AS DOUBLE) AS a, CAST(sum(n) - sum(n1) AS DOUBLE) AS b, sum(n1 * mid) AS r1, CAST(sum(n * n * n - n) AS DOUBLE) AS ties FROM k GROUP BY city)
SELECT city, CAST(a AS BIGINT) AS n1, CAST(b AS BIGINT) AS n2, r1 - a * (a + 1) / 2 AS u,
round((abs(r1 - a * (a + 1) / 2 - a * b / 2) - 0.5) / sqrt(a * b / 12 * ((a + b + 1) - ties / ((a + b) * (a + b - 1)))), 8) AS z FROM s""",
)
def t3(spark, sf):
    return rounded(stats.mann_whitney(views.daily(spark, sf), WIND, *seasons(), by=["city"], p_value=False), 8, "z")


@query(
    "t4_levene",
    f"""@daily|WITH d AS (SELECT city, season, abs({WIND} - median({WIND}) OVER (PARTITION BY city, season)) AS z FROM daily WHERE season IN ('Winter', 'Summer')),
g AS (SELECT city, season, count(*) AS n, avg(z) AS m, var_pop(z) AS v FROM d GROUP BY city, season),
s AS (SELECT *, sum(n * m) OVER (PARTITION BY city) / sum(n) OVER (PARTITION BY city) AS grand FROM g)
SELECT city, CAST(sum(n) AS BIGINT) AS n, round(sum(n * pow(m - grand, 2)) * (sum(n) - 2) / sum(n * v), 7) AS w, 1.0::DOUBLE AS d1, CAST(sum(n) - 2 AS DOUBLE) AS d2 FROM s GROUP BY city""",
)
def t4(spark, sf):
    group = F.when(F.col("season").isin("Winter", "Summer"), F.col("season"))
    return rounded(stats.levene(views.daily(spark, sf), WIND, group, ["city"], p_value=False), 7, "w")


@query(
    "t5_t8_proportions",
    """@daily|WITH c AS (SELECT CAST(sum(is_risk_day) FILTER (city = 'ASIA') AS BIGINT) AS x1, count(*) FILTER (city = 'ASIA') AS n1, CAST(sum(is_risk_day) FILTER (city <> 'ASIA') AS BIGINT) AS x2, count(*) FILTER (city <> 'ASIA') AS n2 FROM daily),
p AS (SELECT *, CAST(x1 + x2 AS DOUBLE) / (n1 + n2) AS pool FROM c),
o AS (SELECT unnest([x1 - n1 * pool, (n1 - x1) - n1 * (1 - pool), x2 - n2 * pool, (n2 - x2) - n2 * (1 - pool)]) AS gap, unnest([n1 * pool, n1 * (1 - pool), n2 * pool, n2 * (1 - pool)]) AS e FROM p),
k AS (SELECT sum(pow(abs(gap) - least(0.5, abs(gap)), 2) / e) AS chi2, min(e) AS least_e FROM o)
SELECT x1, n1, x2, n2, round((CAST(x1 AS DOUBLE) / n1 - CAST(x2 AS DOUBLE) / n2) / sqrt(pool * (1 - pool) * (1.0 / n1 + 1.0 / n2)), 8) AS z, round(chi2, 7) AS chi2,
round(sqrt(chi2 / (n1 + n2)), 9) AS cramers_v, CASE WHEN sqrt(chi2 / (n1 + n2)) > 0.5 THEN 'strong' WHEN sqrt(chi2 / (n1 + n2)) > 0.3 THEN 'moderate' WHEN sqrt(chi2 / (n1 + n2)) > 0.1 THEN 'weak' ELSE 'negligible' END AS association,
round(least_e, 7) AS min_expected FROM p, k""",
)
def t5(spark, sf):
    out = stats.proportions_test(views.daily(spark, sf), F.col("is_risk_day") == 1, F.col("city") == "ASIA", F.col("city") != "ASIA", p_value=False)
    out = out.drop("p1", "p2")
    return rounded(rounded(rounded(out, 8, "z"), 7, "chi2", "min_expected"), 9, "cramers_v")


CHI_SQL = """WITH c AS (SELECT {a} AS a, {b} AS b, count(*) AS o FROM {s} GROUP BY ALL),
f AS (SELECT x.a, y.b, coalesce(o, 0) AS o, x.t * y.t / CAST((SELECT sum(o) FROM c) AS DOUBLE) AS e FROM (SELECT a, sum(o) AS t FROM c GROUP BY a) x CROSS JOIN (SELECT b, sum(o) AS t FROM c GROUP BY b) y LEFT JOIN c ON c.a = x.a AND c.b = y.b)
SELECT CAST(sum(o) AS BIGINT) AS n, (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof, round(sum(pow({gap}, 2) / e), 6) AS chi2,
round(sqrt(sum(pow({gap}, 2) / e) / (sum(o) * (least(count(DISTINCT a), count(DISTINCT b)) - 1))), 9) AS cramers_v FROM f"""


@query("t6_t7_chi_square", "@daily|" + CHI_SQL.format(a="city", b="season", s="daily", gap="o - e"))
def t6(spark, sf):
    return rounded(rounded(stats.chi_square(views.daily(spark, sf), "city", "season", p_value=False), 6, "chi2"), 9, "cramers_v")


@query("t6_t7_chi_square_yates", CHI_SQL.format(a="l_linestatus", b="CAST(l_quantity > 25 AS VARCHAR)", s="lineitem", gap="(abs(o - e) - least(0.5, abs(o - e)))"))
def t6_yates(spark, sf):
    rows = views.table(spark, sf, "lineitem").select("l_linestatus", (F.col("l_quantity") > 25).cast("string").alias("large"))
    return rounded(rounded(stats.chi_square(rows, "l_linestatus", "large", p_value=False), 6, "chi2"), 9, "cramers_v")


@query(
    "t9_linear_trend",
    "@daily|WITH y AS (SELECT city, year, CAST(sum(is_risk_day) AS DOUBLE) AS risk_days FROM daily GROUP BY city, year) SELECT city, count(*) AS n, round(regr_slope(risk_days, year), 8) AS slope, "
    "round(regr_intercept(risk_days, year), 5) AS intercept, round(corr(year, risk_days), 8) AS r_value, "
    "round(sqrt((1 - pow(corr(year, risk_days), 2)) / (count(*) - 2)) * stddev_samp(risk_days) / stddev_samp(year), 8) AS std_err FROM y GROUP BY city",
)
def t9(spark, sf):
    out = stats.linear_trend(annual(spark, sf), "year", "risk_days", ["city"], p_value=False)
    return rounded(rounded(out, 8, "slope", "r_value", "std_err"), 5, "intercept")


def annual(spark, sf):
    return views.daily(spark, sf).groupBy("city", "year").agg(F.sum("is_risk_day").alias("risk_days"))


def trend_p(spark, sf):
    """A p-like number per entity and month for the corrections: no test, just values in 0..1."""
    return views.monthly(spark, sf).groupBy("city").agg(F.round(F.avg("risk_day_pct") / 1000, 6).alias("p_value"))


@query(
    "t10_t11_corrections",
    """@monthly|WITH p AS (SELECT city, round(avg(risk_day_pct) / 1000, 6) AS p_value FROM monthly GROUP BY city),
k AS (SELECT *, count(*) OVER () AS m, count(*) OVER (ORDER BY p_value RANGE UNBOUNDED PRECEDING) AS i FROM p),
b AS (SELECT *, least(min(p_value * m / i) OVER (ORDER BY p_value DESC ROWS UNBOUNDED PRECEDING), 1.0) AS bh FROM k)
SELECT city, p_value, least(p_value * m, 1.0) AS p_bonferroni, round(bh, 12) AS p_bh, least(p_value * m, 1.0) < 0.05 AS sig_bonferroni, bh < 0.05 AS sig_bh FROM b""",
)
def t10(spark, sf):
    return rounded(stats.adjust_p_values(trend_p(spark, sf)), 12, "p_bh")


# Simpson's rule over the tail of each density: Student's t by the angle whose tangent is t over the root of its degrees of freedom,
# the normal and the chi-square as they are. F with one and n degrees of freedom is the square of a t with n.
TAILS_SQL = f"""@daily|WITH welch AS (SELECT city, 'welch' AS test, 't' AS kind, abs(m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS x, pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS nu FROM ({MOMENTS})),
d AS (SELECT city, season, {WIND} AS v FROM daily WHERE season IN ('Winter', 'Summer') AND {WIND} IS NOT NULL),
g AS (SELECT city, v, count(*) AS n, count(*) FILTER (season = 'Winter') AS n1 FROM d GROUP BY city, v),
k AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY city ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (n + 1) / 2.0::DOUBLE AS mid FROM g),
s AS (SELECT city, CAST(sum(n1) AS DOUBLE) AS a, CAST(sum(n) - sum(n1) AS DOUBLE) AS b, sum(n1 * mid) AS r1, CAST(sum(n * n * n - n) AS DOUBLE) AS ties FROM k GROUP BY city),
mann AS (SELECT city, 'mann_whitney', 'z', (abs(r1 - a * (a + 1) / 2 - a * b / 2) - 0.5) / sqrt(a * b / 12 * ((a + b + 1) - ties / ((a + b) * (a + b - 1)))), 0.0 FROM s),
z AS (SELECT city, season, abs(v - median(v) OVER (PARTITION BY city, season)) AS z FROM d),
q AS (SELECT city, season, count(*) AS n, avg(z) AS m, var_pop(z) AS v FROM z GROUP BY city, season),
l AS (SELECT *, sum(n * m) OVER (PARTITION BY city) / sum(n) OVER (PARTITION BY city) AS grand FROM q),
levene AS (SELECT city, 'levene', 't', sqrt(sum(n * pow(m - grand, 2)) * (sum(n) - 2) / sum(n * v)), CAST(sum(n) - 2 AS DOUBLE) FROM l GROUP BY city),
y AS (SELECT city, year, CAST(sum(is_risk_day) AS DOUBLE) AS risk_days FROM daily GROUP BY city, year),
trend AS (SELECT city, 'trend', 't', abs(corr(year, risk_days)) * sqrt((count(*) - 2) / (1 - pow(corr(year, risk_days), 2))), CAST(count(*) - 2 AS DOUBLE) FROM y GROUP BY city),
c AS (SELECT city, season, count(*) AS o FROM daily GROUP BY ALL),
f AS (SELECT coalesce(o, 0) AS o, x.t * w.t / CAST((SELECT sum(o) FROM c) AS DOUBLE) AS e, x.city, w.season FROM (SELECT city, sum(o) AS t FROM c GROUP BY city) x CROSS JOIN (SELECT season, sum(o) AS t FROM c GROUP BY season) w LEFT JOIN c ON c.city = x.city AND c.season = w.season),
chi AS (SELECT 'all', 'chi_square', 'c', sum(pow(o - e, 2) / e), CAST((count(DISTINCT city) - 1) * (count(DISTINCT season) - 1) AS DOUBLE) FROM f),
tests AS (SELECT * FROM welch UNION ALL SELECT * FROM mann UNION ALL SELECT * FROM levene UNION ALL SELECT * FROM trend UNION ALL SELECT * FROM chi),
spans AS (SELECT *, CASE kind WHEN 't' THEN atan(x / sqrt(nu)) ELSE x END AS lo, CASE kind WHEN 't' THEN pi() / 2 WHEN 'z' THEN x + 12 ELSE x + 400 END AS hi,
  CASE kind WHEN 't' THEN ln(2) + lgamma((nu + 1) / 2) - lgamma(nu / 2) - ln(pi()) / 2 WHEN 'z' THEN ln(2) - ln(2 * pi()) / 2 ELSE -nu / 2 * ln(2) - lgamma(nu / 2) END AS front FROM tests),
steps AS (SELECT city, test, kind, nu, front, (hi - lo) / 20000 AS h, lo + i * (hi - lo) / 20000 AS u, CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM spans, range(20001) AS r(i))
SELECT city, test, round(least(sum(w * h / 3 * exp(front + CASE kind WHEN 't' THEN (nu - 1) * ln(greatest(cos(u), 1e-300)) WHEN 'z' THEN -u * u / 2 ELSE (nu / 2 - 1) * ln(u) - u / 2 END)), 1.0), 7) AS p_value FROM steps GROUP BY city, test"""


@query("t18_p_values", TAILS_SQL)
def t18(spark, sf):
    daily = views.daily(spark, sf)
    welch = stats.welch_test(daily, WIND, *seasons(), by=["city"]).select("city", F.lit("welch").alias("test"), "p_value")
    ranks = stats.mann_whitney(daily, WIND, *seasons(), by=["city"]).select("city", F.lit("mann_whitney").alias("test"), "p_value")
    group = F.when(F.col("season").isin("Winter", "Summer"), F.col("season"))
    spread = stats.levene(daily, WIND, group, ["city"]).select("city", F.lit("levene").alias("test"), "p_value")
    trend = stats.linear_trend(annual(spark, sf), "year", "risk_days", ["city"]).select("city", F.lit("trend").alias("test"), "p_value")
    chi = stats.chi_square(daily, "city", "season").select(F.lit("all").alias("city"), F.lit("chi_square").alias("test"), "p_value")
    return rounded(welch.unionByName(ranks).unionByName(spread).unionByName(trend).unionByName(chi), 7, "p_value")


FEATURES = ["temperature_2m_max", "temperature_2m_mean", "apparent_temperature_mean", WIND, "wind_gusts_10m_max", "precipitation_sum", "visibility_mean", "shortwave_radiation_sum"]
PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i + 1, len(FEATURES))]


def pairs_sql(source: str, value: str = "corr({a}, {b})", by: str = "") -> str:
    head = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"SELECT {head}{i} AS i, {j} AS j, '{FEATURES[i]}' AS feature_1, '{FEATURES[j]}' AS feature_2, {value.format(a=FEATURES[i], b=FEATURES[j])} AS r FROM {source}{tail}"
        for i, j in PAIRS
    )


block("complete", "joined", "SELECT city, " + ", ".join(FEATURES) + " FROM joined WHERE " + " AND ".join(f"{f} IS NOT NULL" for f in FEATURES))
RANKED = ", ".join(f"rank() OVER (PARTITION BY city ORDER BY {f}) + (count(*) OVER (PARTITION BY city, {f}) - 1) / 2.0::DOUBLE AS {f}" for f in FEATURES)
block("ranked", "complete", f"SELECT city, {RANKED} FROM complete")
RANKED_ALL = ", ".join(f"rank() OVER (ORDER BY {f}) + (count(*) OVER (PARTITION BY {f}) - 1) / 2.0::DOUBLE AS {f}" for f in FEATURES)
block("ranked_all", "complete", f"SELECT {RANKED_ALL} FROM complete")


def pairs(spark, sf, **options):
    return stats.pearson_long(views.joined(spark, sf), FEATURES, **options)


@query("t12_pearson", "@complete|SELECT * REPLACE (round(r, 8) AS r) FROM (" + pairs_sql("complete", by="city") + ")")
def t12(spark, sf):
    return rounded(pairs(spark, sf, by=["city"]), 8, "r")


@query("t12_pearson_pairwise", "@joined|SELECT * REPLACE (round(r, 8) AS r) FROM (" + pairs_sql("joined") + ")")
def t12_pairwise(spark, sf):
    return rounded(pairs(spark, sf, complete=False), 8, "r")


@query("t13_spearman", "@ranked|SELECT * REPLACE (round(r, 8) AS r) FROM (" + pairs_sql("ranked", by="city") + ")")
def t13(spark, sf):
    rows = views.joined(spark, sf).dropna(subset=FEATURES)
    return rounded(stats.spearman_long(rows, FEATURES, ["city"]), 8, "r")


block("pearson_all", "complete", pairs_sql("complete"))
GAP4 = " UNION ALL ".join(
    f"SELECT '{FEATURES[i]}' AS feature_1, '{FEATURES[j]}' AS feature_2, (SELECT corr({FEATURES[i]}, {FEATURES[j]}) FROM complete) AS pearson, corr({FEATURES[i]}, {FEATURES[j]}) AS spearman FROM ranked_all"
    for i, j in PAIRS
)


@query("t14_disagreeing_pairs", "@complete,ranked_all|SELECT feature_1, feature_2, round(pearson, 8) AS pearson, round(spearman, 8) AS spearman, round(abs(spearman - pearson), 8) AS gap FROM (" + GAP4 + ") ORDER BY abs(spearman - pearson) DESC LIMIT 10")
def t14(spark, sf):
    rows = views.joined(spark, sf).dropna(subset=FEATURES)
    out = stats.disagreeing_pairs(stats.pearson_long(rows, FEATURES), stats.spearman_long(rows, FEATURES), 10)
    return rounded(out, 8, "pearson", "spearman", "gap")


@query("t15_redundant_pairs", "@pearson_all|SELECT i, j, feature_1, feature_2, round(r, 8) AS r FROM pearson_all WHERE abs(r) > 0.5")
def t15(spark, sf):
    return rounded(stats.redundant_pairs(pairs(spark, sf), 0.5), 8, "r")


# with two other features the inflation factor has a closed form in the three correlations
VIF3 = ["temperature_2m_max", "temperature_2m_mean", WIND]
VIF_SQL = (
    "WITH c AS (SELECT corr(temperature_2m_max, temperature_2m_mean) AS a, corr(temperature_2m_max, wind_speed_10m_max) AS b, corr(temperature_2m_mean, wind_speed_10m_max) AS d FROM weather), "
    "k AS (SELECT *, 1 + 2 * a * b * d - a * a - b * b - d * d AS det FROM c) "
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round((1 - {x} * {x}) / det, 6) AS vif, CASE WHEN (1 - {x} * {x}) / det > 50 THEN 'severe' WHEN (1 - {x} * {x}) / det > 10 THEN 'problematic' ELSE 'ok' END AS flag FROM k"
        for f, x in zip(VIF3, ("d", "b", "a"))
    )
)


@query("t16_vif", "@weather|" + VIF_SQL)
def t16(spark, sf):
    return rounded(stats.vif(views.weather(spark, sf), VIF3), 6, "vif")


def cell(i: str, j: str) -> str:
    return f"m[1 + ({i}) * {len(FEATURES)} + ({j})]"


# the inverse of the correlation matrix, one pivot at a time; its diagonal are the inflation factors
VIF_ALL_SQL = (
    "@complete|WITH RECURSIVE g AS (SELECT 0 AS k, ["
    + ", ".join("1.0::DOUBLE" if i == j else f"corr({FEATURES[i]}, {FEATURES[j]})" for i in range(len(FEATURES)) for j in range(len(FEATURES)))
    + f"] AS m FROM complete UNION ALL SELECT k + 1, list_transform(range({len(FEATURES) ** 2}), lambda t: CASE "
    f"WHEN t // {len(FEATURES)} = k AND t % {len(FEATURES)} = k THEN 1 / {cell('k', 'k')} WHEN t // {len(FEATURES)} = k THEN m[1 + t] / {cell('k', 'k')} WHEN t % {len(FEATURES)} = k THEN -m[1 + t] / {cell('k', 'k')} "
    f"ELSE m[1 + t] - {cell(f't // {len(FEATURES)}', 'k')} * {cell('k', f't % {len(FEATURES)}')} / {cell('k', 'k')} END) FROM g WHERE k < {len(FEATURES)}), "
    f"d AS (SELECT unnest([{', '.join(repr(f) for f in FEATURES)}]) AS feature, unnest([{', '.join(cell(str(i), str(i)) for i in range(len(FEATURES)))}]) AS vif FROM g WHERE k = {len(FEATURES)}) "
    "SELECT feature, round(vif, 5) AS vif, CASE WHEN vif > 50 THEN 'severe' WHEN vif > 10 THEN 'problematic' ELSE 'ok' END AS flag FROM d"
)


@query("t16_vif_all_features", VIF_ALL_SQL)
def t16_all(spark, sf):
    return rounded(stats.vif(views.joined(spark, sf), FEATURES), 5, "vif")


CHOSEN = [
    "temperature_2m_max", "temperature_2m_min", "temperature_2m_mean", "apparent_temperature_mean", "temp_range_c", "temp_range_7d", "hdd", "cdd", "wind_speed_10m_max", "wind_gusts_10m_max", "wave_height",
    "precipitation_sum", "rain_sum", "relative_humidity_2m_mean", "dew_point_2m_mean", "surface_pressure_mean", "shortwave_radiation_sum", "visibility_mean", "visibility_min", "wind_3d_max", "precip_3d_sum",
    "wave_height_7d_mean", "wave_height_30d_mean", "wind_speed_10m_max_lag1", "precipitation_sum_lag1", "month_sin", "month_cos", "doy_sin", "doy_cos",
]
CHOSEN_PAIRS = [(i, j) for i in range(len(CHOSEN) + 1) for j in range(i + 1, len(CHOSEN) + 1)]
NAMES = [*CHOSEN, "is_risk_day"]
# each strong pair in order of strength: the weaker correlate of the target goes unless one of the two has gone
SELECT_SQL = (
    "@daily|WITH RECURSIVE whole AS (SELECT * FROM daily WHERE " + " AND ".join(f"{f} IS NOT NULL" for f in CHOSEN) + "), c AS (SELECT "
    + ", ".join(f"CASE WHEN isfinite(corr({NAMES[i]}, {NAMES[j]})) THEN corr({NAMES[i]}, {NAMES[j]}) END AS c_{i}_{j}" for i, j in CHOSEN_PAIRS) + " FROM whole), "
    f"p AS (SELECT unnest([{', '.join(str(i) for i, _ in CHOSEN_PAIRS)}]) AS i, unnest([{', '.join(str(j) for _, j in CHOSEN_PAIRS)}]) AS j, unnest([{', '.join(f'c_{i}_{j}' for i, j in CHOSEN_PAIRS)}]) AS r FROM c), "
    f"name AS (SELECT unnest(range({len(NAMES)})) AS i, unnest([{', '.join(repr(f) for f in NAMES)}]) AS feature), "
    f"strength AS (SELECT n.i, feature, CASE WHEN n.i = {len(CHOSEN)} THEN 1.0::DOUBLE ELSE abs(r) END AS s FROM name n LEFT JOIN p ON p.i = n.i AND p.j = {len(CHOSEN)}), "
    "strong AS (SELECT p.*, row_number() OVER (ORDER BY abs(r) DESC, p.i, p.j) AS k, a.feature AS fa, b.feature AS fb, coalesce(a.s, 0) AS sa, coalesce(b.s, 0) AS sb "
    f"FROM p JOIN strength a ON a.i = p.i JOIN strength b ON b.i = p.j WHERE abs(r) > 0.85 AND p.j < {len(CHOSEN)}), "
    "walk AS (SELECT 0::BIGINT AS k, []::VARCHAR[] AS gone, NULL::VARCHAR AS dropped, NULL::VARCHAR AS reason UNION ALL "
    "SELECT s.k, CASE WHEN hit THEN list_append(gone, loser) ELSE gone END, CASE WHEN hit THEN loser END, "
    "CASE WHEN hit THEN '|r|=' || printf('%.2f', abs(r)) || ' with ' || winner || '; weaker target signal (|r_target|=' || printf('%.2f', least(sa, sb)) || ' vs ' || printf('%.2f', greatest(sa, sb)) || ')' END "
    "FROM (SELECT s.*, w.gone, NOT list_contains(gone, fa) AND NOT list_contains(gone, fb) AS hit, CASE WHEN sa >= sb THEN fb ELSE fa END AS loser, CASE WHEN sa >= sb THEN fa ELSE fb END AS winner "
    "FROM walk w JOIN strong s ON s.k = w.k + 1) s) "
    f"SELECT feature, CASE WHEN i = {len(CHOSEN)} THEN 'TARGET' WHEN dropped IS NOT NULL THEN 'DROP' ELSE 'KEEP' END AS decision, round(s, 3) AS corr_with_target, "
    f"CASE WHEN i = {len(CHOSEN)} THEN 'prediction target' ELSE coalesce(reason, '') END AS reason FROM strength LEFT JOIN (SELECT dropped, reason FROM walk WHERE dropped IS NOT NULL) ON dropped = feature"
)


@query("t17_select_features", SELECT_SQL)
def t17(spark, sf):
    return stats.select_features(views.daily(spark, sf), CHOSEN, "is_risk_day")


@query(
    "t19_label_correlations",
    "@daily|" + " UNION ALL ".join(f"SELECT city, '{f}' AS feature, round(corr({f}, is_risk_day), 8) AS r FROM daily GROUP BY city" for f in FEATURES),
)
def t19(spark, sf):
    return rounded(stats.label_correlations(views.daily(spark, sf), "is_risk_day", FEATURES, ["city"]), 8, "r")


REGION_PAIRS = [(a, b) for n, a in enumerate(views.REGIONS) for b in views.REGIONS[n + 1:]]


@query(
    "t20_entity_correlation",
    "@weather|WITH w AS (SELECT date, " + ", ".join(f"avg(temperature_2m_max) FILTER (city = '{c}') AS \"{c}\"" for c in views.REGIONS) + " FROM weather WHERE year(date) = 2000 GROUP BY date) "
    + " UNION ALL ".join(f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr(\"{a}\", \"{b}\"), 8) AS r FROM w" for a, b in REGION_PAIRS),
)
def t20(spark, sf):
    year = views.weather(spark, sf).where(F.year("date") == 2000)
    wide = rollup.to_wide(year, ["date"], "city", views.REGIONS, "temperature_2m_max")
    safe = wide.select(*[F.col(c).alias(c.replace(" ", "_")) for c in wide.columns])
    out = stats.pearson_long(safe, [c.replace(" ", "_") for c in views.REGIONS], complete=False)
    back = lambda c: F.replace(F.col(c), F.lit("_"), F.lit(" ")).alias(c)
    return out.select(back("feature_1"), back("feature_2"), F.round("r", 8).alias("r"))
