"""Model evaluation on scored rows (label 0/1, probability), as Spark aggregations.

Scored rows have no size bound, so nothing here sorts them: thresholds read an 81-cell
histogram, ranks and resamples come from ranges of distinct scores.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daypanel.constants import DEFAULT_THRESHOLD
from daypanel.functions.columns import count_where, join_groups
from daypanel.operators.order_stats import exact_quantiles, prefix_sums, value_ranges

# 80 decision thresholds, 0.01 to 0.80.
GRID = [0.01 + 0.01 * i for i in range(80)]


def _ratio(a: Column, b: Column) -> Column:
    """0 where the denominator is 0, as the usual precision and recall definitions have it."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _scores(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return {
        "accuracy": _ratio(tp + tn, tp + fp + fn + tn),
        "precision": precision,
        "recall": recall,
        "f1": _ratio(tp * 2, tp * 2 + fp + fn),
        "predicted_positive_rate": _ratio(tp + fp, tp + fp + fn + tn),
    }


def thresholds_reached(p: Column) -> Column:
    """How many grid thresholds lie at or below p: a guess by division, corrected on the grid."""
    grid = F.array(*[F.lit(t) for t in GRID])
    guess = F.greatest(F.least(F.floor(p * 100.0).cast("int"), F.lit(len(GRID))), F.lit(0))
    up = (guess < len(GRID)) & (F.try_element_at(grid, guess + 1) <= p)
    down = (guess > 0) & (F.try_element_at(grid, F.greatest(guess, F.lit(1))) > p)
    return F.when(up, guess + 1).when(down, guess - 1).otherwise(guess)


def threshold_grid(scored: DataFrame, label: str = "label", p: str = "probability", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1 and positive rate at each threshold."""
    by = list(by)
    hist = scored.groupBy(*by, thresholds_reached(F.col(p)).alias("_k")).agg(
        F.sum(F.col(label).cast("long")).alias("_pos"), F.count(F.lit(1)).alias("_n")
    )
    cells = hist.select(*by).distinct() if by else scored.agg(F.count(F.lit(1)).alias("_any"))
    slots = cells.select(*by, F.explode(F.sequence(F.lit(0), F.lit(len(GRID)))).alias("_k"))
    full = slots.join(hist, [*by, "_k"], "left").na.fill(0, ["_pos", "_n"])
    suffix = W.partitionBy(*by).orderBy(F.col("_k").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*by)
    summed = full.select(
        *by, "_k",
        F.sum("_pos").over(suffix).alias("_tp"), F.sum("_n").over(suffix).alias("_pp"),
        F.sum("_pos").over(whole).alias("_p"), F.sum("_n").over(whole).alias("_all"),
    ).where(F.col("_k") > 0)
    tp = F.col("_tp")
    fp, fn = F.col("_pp") - tp, F.col("_p") - tp
    tn = F.col("_all") - F.col("_pp") - fn
    return summed.select(
        *by, (F.round(F.col("_k") / 100.0, 2)).alias("threshold"), *[e.alias(n) for n, e in _scores(tp, fp, fn, tn).items()]
    )


def best_threshold(grid: DataFrame, by: Sequence[str] = (), preferred: float = DEFAULT_THRESHOLD) -> DataFrame:
    """The row with the best F1; then recall, precision and closeness to the preferred threshold."""
    columns = [c for c in grid.columns if c not in by]
    order = F.struct(
        "f1", "recall", "precision", (-F.abs(F.round(F.col("threshold") - preferred, 6))).alias("near"),
        (-F.col("threshold")).alias("low"),
    )
    return grid.groupBy(*by).agg(F.max_by(F.struct(*columns), order).alias("_b")).select(*by, "_b.*")


def _score_cells(scored: DataFrame, label: str, p: str, by: Sequence[str]) -> DataFrame:
    positive = F.col(label).cast("long")
    return scored.where(F.col(p).isNotNull()).groupBy(*by, p).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    )


def roc_auc(scored: DataFrame, label: str = "label", p: str = "probability", by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted one half; null with one class only."""
    by = list(by)
    sums = prefix_sums(_score_cells(scored, label, p, by), by, p, measures=("pos", "neg"))
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    both = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return sums.groupBy(*by).agg(F.try_divide(wins, both).alias("roc_auc"))


def brier(scored: DataFrame, label: str = "label", p: str = "probability", by: Sequence[str] = ()) -> DataFrame:
    gap = F.col(p) - F.col(label)
    return scored.groupBy(*by).agg(F.avg(gap * gap).alias("brier"))


def roc_curve(scored: DataFrame, label: str = "label", p: str = "probability", by: Sequence[str] = ()) -> DataFrame:
    """True and false positive rates at every distinct score."""
    by = list(by)
    sums = prefix_sums(_score_cells(scored, label, p, by), by, p, measures=("pos", "neg"))
    return sums.select(
        *by, F.col(p).alias("threshold"),
        F.try_divide(F.col("neg_total") - F.col("neg_before"), F.col("neg_total")).alias("fpr"),
        F.try_divide(F.col("pos_total") - F.col("pos_before"), F.col("pos_total")).alias("tpr"),
    )


def calibration_curve(scored: DataFrame, label: str = "label", p: str = "probability", by: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """Observed rate and mean score in bins cut at the score quantiles (lower edge exclusive)."""
    by = list(by)
    inner = {f"_q{i}": i / bins for i in range(1, bins)}
    edges = exact_quantiles(scored, by, p, inner)
    if by:
        joined = join_groups(scored, edges, by)
    else:
        edge_row = edges.agg(F.struct(*[F.max(c).alias(c) for c in inner])).scalar()
        joined = scored.withColumns({c: edge_row[c] for c in inner})
    index = reduce(lambda a, b: a + b, [(F.col(p) > F.col(c)).cast("int") for c in inner])
    return joined.where(F.col(p).isNotNull()).groupBy(*by, index.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(label).cast("double")).alias("fraction_positive"),
        F.avg(p).alias("mean_predicted"),
    )


def confusion(scored: DataFrame, threshold: Column | float, label: str = "label", p: str = "probability", by: Sequence[str] = ()) -> DataFrame:
    predicted = (F.col(p) >= threshold).cast("int")
    return scored.groupBy(*by, F.col(label).alias("actual"), predicted.alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def metrics_at(scored: DataFrame, threshold: Column | float, label: str = "label", p: str = "probability", by: Sequence[str] = ()) -> DataFrame:
    """All metrics of each group at a fixed threshold."""
    by = list(by)
    hit, y = F.col(p) >= threshold, F.col(label) == 1
    counted = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_test"), F.avg(F.col(label).cast("double")).alias("pos_rate"),
        count_where(hit & y).alias("_tp"), count_where(hit & ~y).alias("_fp"),
        count_where(~hit & y).alias("_fn"), count_where(~hit & ~y).alias("_tn"),
        F.avg((F.col(p) - F.col(label)) * (F.col(p) - F.col(label))).alias("brier"),
    )
    out = counted.select(
        *by, "n_test", "pos_rate", "brier",
        *[e.alias(n) for n, e in _scores(*[F.col(c) for c in ("_tp", "_fp", "_fn", "_tn")]).items()],
    )
    auc = roc_auc(scored, label, p, by)
    return out.join(auc, by, "left") if by else out.withColumn("roc_auc", auc.scalar())


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Sizes of both classes and the weight that balances them."""
    pos, neg = count_where(F.col(label) == 1), count_where(F.col(label) == 0)
    return df.agg(pos.alias("n_pos"), neg.alias("n_neg"), F.try_divide(neg, pos).alias("positive_weight"))


def select_winner(report: DataFrame, baseline: str = "Climatology") -> DataFrame:
    """Guardrails against the baseline, production score and the selected row.

    The report has one row per candidate model. The baseline is read as a scalar subquery.
    """
    base = report.where(F.col("model") == baseline).agg(
        F.struct(
            F.coalesce(F.max("f1"), F.lit(0.0)).alias("f1"),
            F.coalesce(F.max("roc_auc"), F.lit(0.0)).alias("auc"),
            F.coalesce(F.max("brier"), F.lit(1.0)).alias("brier"),
        )
    ).scalar()
    candidate = F.col("model") != baseline
    eligible = (
        candidate & (F.col("f1") >= base["f1"]) & (F.col("roc_auc") >= base["auc"])
        & (F.col("brier") <= base["brier"] + 0.005) & (F.col("recall") >= 0.25)
    )
    score = F.col("f1") * 0.35 + F.col("recall") * 0.20 + F.col("roc_auc") * 0.20 + (1.0 - F.col("brier")) * 0.25
    scored = report.withColumns(
        {"eligible": F.coalesce(eligible, F.lit(False)), "production_score": F.when(candidate, score)}
    )
    # no eligible candidate: all candidates compete
    order = F.struct(
        F.col("eligible").cast("int"), "production_score", -F.col("brier"), "f1", "recall",
    )
    winner = scored.where(candidate).agg(F.max_by("model", order)).scalar()
    return scored.withColumn("selected", F.coalesce(F.col("model") == winner, F.lit(False)))


def report_rows(reports: Sequence[DataFrame]) -> DataFrame:
    """Comparison table: one frame per model, three decimals for the metrics."""
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports)
    rounded = ["accuracy", "precision", "recall", "f1", "roc_auc", "brier", "predicted_positive_rate"]
    return table.withColumns({c: F.round(c, 3) for c in rounded if c in table.columns})


#: Drawn weights that a task holds at a time.
DRAWS_AT_ONCE = 2_000_000
#: Distinct scores of a range, about: a task holds the whole of one, so many scores are dealt to more ranges, not to larger ones.
SCORES_PER_RANGE = 50_000


def bootstrap_sums(scored: DataFrame, threshold: float, label: str = "label", p: str = "probability", replicates: int = 1000, seed: int = 42) -> DataFrame:
    """F1 and AUC of each Poisson resample: ``replicate``, ``f1``, ``auc``; resamples without one of the classes have no AUC and are left out.

    A sum of Poisson(1) row weights is Poisson(count), so weights are drawn per distinct score and class. The distinct scores lie in ranges; a
    task draws all replicates of one range and leaves five numbers for each: weights of both classes, the wins of positives over negatives
    within the range, and the weights of both classes at or above the threshold. Ranges are then combined in order: a range's
    positives win over all negatives of the ranges before it. A range is written before it is read, so a task that is lost
    draws the same again.
    """

    def resample(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values(p)
        hit = cells[p].to_numpy() >= threshold
        counts = cells[["pos", "neg"]].to_numpy(dtype=float)
        rng, at_once, parts = np.random.default_rng([seed, int(key[0])]), max(1, DRAWS_AT_ONCE // len(cells)), []
        for first in range(0, replicates, at_once):
            n = min(at_once, replicates - first)
            pos, neg = (rng.poisson(counts[:, k], size=(n, len(cells))).astype(float) for k in (0, 1))
            wins = (pos * (np.cumsum(neg, axis=1) - neg / 2.0)).sum(axis=1)
            parts.append(pd.DataFrame({
                "replicate": np.arange(first, first + n), "range": int(key[0]), "pos": pos.sum(axis=1), "neg": neg.sum(axis=1),
                "wins": wins, "tp": pos[:, hit].sum(axis=1), "fp": neg[:, hit].sum(axis=1),
            }))
        return pd.concat(parts)

    cells = _score_cells(scored, label, p, [])
    n = cells.count()
    ranges = value_ranges(cells, [], p, -(-n // SCORES_PER_RANGE) if n > SCORES_PER_RANGE else None)
    sums = ranges.groupBy("_range").applyInPandas(resample, "replicate long, range int, pos double, neg double, wins double, tp double, fp double")
    before = F.coalesce(F.sum("neg").over(W.partitionBy("replicate").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    total = sums.withColumn("wins", F.col("wins") + F.col("pos") * before).groupBy("replicate").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "wins", "tp", "fp")])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("pos") - F.col("tp")
    return total.where((F.col("pos") > 0) & (F.col("neg") > 0)).select(
        "replicate", (2 * tp / (2 * tp + fp + fn)).alias("f1"), (F.col("wins") / (F.col("pos") * F.col("neg"))).alias("auc")
    )


def bootstrap_intervals(scored: DataFrame, threshold: float, label: str = "label", p: str = "probability", replicates: int = 1000, seed: int = 42) -> DataFrame:
    """95% intervals of F1 and AUC by Poisson resampling, on the scores as they are."""
    edges = {"low": 0.025, "high": 0.975}
    return bootstrap_sums(scored, threshold, label, p, replicates, seed).agg(
        F.count(F.lit(1)).alias("replicates"),
        *[F.percentile(m, F.lit(q)).alias(f"{m}_ci_{n}") for m in ("f1", "auc") for n, q in edges.items()],
    )


def residual_bins(scored: DataFrame, against: str, bins: int = 20, label: str = "label", p: str = "probability", by: Sequence[str] = ()) -> DataFrame:
    """Mean residual in equal-width bins of the prediction or of a feature."""
    by = list(by)
    rows = scored.where(F.col(against).isNotNull()).withColumn("_r", F.col(label) - F.col(p))
    if by:
        spans = rows.groupBy(*by).agg(F.min(against).alias("_lo"), F.max(against).alias("_hi"))
        rows = join_groups(rows, spans, by)
    else:
        box = rows.agg(F.struct(F.min(against).alias("a"), F.max(against).alias("b"))).scalar()
        rows = rows.withColumns({"_lo": box["a"], "_hi": box["b"]})
    position = F.try_divide((F.col(against) - F.col("_lo")) * bins, F.col("_hi") - F.col("_lo"))
    index = F.least(F.floor(F.coalesce(position, F.lit(0.0))), F.lit(bins - 1)).cast("int")
    return rows.groupBy(*by, index.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(against).alias("mean_value"), F.avg("_r").alias("mean_residual")
    )
