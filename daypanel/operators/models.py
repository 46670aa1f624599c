"""Next-day risk classifiers on Spark ML: preparation, candidates, calibration, selection."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool
from threading import BoundedSemaphore

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.constants import LEAKING_COLUMNS, WAVE_HISTORY_COLUMNS
from daypanel.functions.columns import present, small_table
from daypanel.functions.hazard import combined_probability, sea_risk
from daypanel.operators import evaluate
from daypanel.session import scratch_table
from daypanel.operators.order_stats import exact_quantiles
from daypanel.operators.rollup import to_long
from daypanel.operators.timeseries import climatology, climatology_lookup, global_rate

TARGET = "target_risk_next_day"
LOG = logging.getLogger(__name__)


def feature_columns(columns: Sequence[str], selected: Sequence[str] | None = None) -> list[str]:
    """The usable features: the selected ones, or all, without leaking columns, plus wave history."""
    blocked = set(LEAKING_COLUMNS) | {"date"}
    chosen = [c for c in (selected if selected is not None else columns) if c in columns and c not in blocked]
    return chosen + [c for c in WAVE_HISTORY_COLUMNS if c in columns and c not in blocked and c not in chosen]


def split_by_year(df: DataFrame, year: int, date: str = "date") -> tuple[DataFrame, DataFrame]:
    return df.where(F.year(date) < year), df.where(F.year(date) == year)


def split_date(df: DataFrame, share: float = 0.8, date: str = "date"):
    """The distinct day at position floor(share * n), kept inside 1..n-1. One row per day at most."""
    from pyspark.sql import Window as W

    days = df.select(F.col(date).alias("d")).distinct()
    ranked = days.select("d", (F.row_number().over(W.orderBy("d")) - 1).alias("i"), F.count(F.lit(1)).over(W.partitionBy()).alias("n"))
    cut = F.greatest(F.lit(1), F.least(F.floor(F.col("n") * share), F.col("n") - 1))
    return ranked.where(F.col("i") == cut).agg(F.min("d")).scalar()


def split_by_date(df: DataFrame, share: float = 0.8, date: str = "date") -> tuple[DataFrame, DataFrame]:
    cut = split_date(df, share, date)
    return df.where(F.col(date) < cut), df.where(F.col(date) >= cut)


def split_stratified(df: DataFrame, label: str = TARGET, share: float = 0.2, seed: int = 42, keys: Sequence[str] = ("city", "date")) -> tuple[DataFrame, DataFrame]:
    """Random test share per label value; the draw is a hash of the key, so it is stable."""
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(label), *keys), F.lit(10000)) / 10000.0
    return df.where(draw >= share), df.where(draw < share)


def split(df: DataFrame, year: int = 2024, label: str = TARGET, date: str = "date") -> tuple[DataFrame, DataFrame, str]:
    """Hold-out year if it has 50 rows of both classes, else the last days, else a random share."""
    is_test = F.year(date) == year
    counts = df.agg(
        F.count(F.when(is_test, 1)).alias("n"), F.count_distinct(F.when(is_test, F.col(label))).alias("k")
    ).first()
    if counts["n"] >= 50 and counts["k"] >= 2:
        train, test = split_by_year(df, year, date)
        note = f"{year} hold-out"
    else:
        train, test = split_by_date(df, date=date)
        note = "temporal hold-out of the last 20% of days"
    sizes = [f.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(label).alias("k")).first() for f in (train, test)]
    if sizes[0]["n"] < 100 or sizes[1]["n"] < 50 or min(s["k"] for s in sizes) < 2:
        train, test = split_stratified(df, label)
        note = "stratified random hold-out"
    return train, test, note


def split_sizes(train: DataFrame, test: DataFrame, label: str = TARGET, entity: str = "city") -> DataFrame:
    """Rows and positive rate per entity and part."""
    parts = train.select(F.lit("train").alias("part"), entity, label).unionByName(
        test.select(F.lit("test").alias("part"), entity, label)
    )
    return parts.groupBy("part", entity).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("positive_rate"))


#: Most values (rows times columns) whose medians one aggregate takes; beyond it they are ranked over many tasks. Both are exact.
VALUES_AT_ONCE = 5_000_000
#: Training rows of a task: iterative fits on few rows run as few tasks, for a job costs more than the rows.
ROWS_PER_TASK = 50_000
#: Forests of few rows are grown in so many parts side by side, each in one task. Many rows are dealt to tasks instead.
FOREST_PARTS = 7
#: Threads of one list of fits, and estimators that fit at the same time in the whole process: what they hold per level adds up.
FITS_AT_ONCE = 6
FITTING = BoundedSemaphore(8)


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """The exact median of each column that has a value; one number per column reaches the driver."""
    if not columns:
        return {}
    if df.count() * len(columns) <= VALUES_AT_ONCE:
        value = {c: F.col(c).cast("double") for c in columns}
        row = df.agg(*[F.median(F.when(~F.isnan(v), v)).alias(c) for c, v in value.items()]).first()
        return {c: row[c] for c in columns if row[c] is not None}
    long = to_long(df, [], columns).select("variable", F.col("value").cast("double").alias("value"))
    rows = exact_quantiles(long.where("not isnan(value)"), ["variable"], "value", {"median": 0.5}).collect()
    return {r["variable"]: float(r["median"]) for r in rows}


def preprocess(df: DataFrame, features: Sequence[str], categorical: Sequence[str], scale: bool = True) -> list:
    """Median imputation, optional standardising, most frequent category and one-hot columns.

    The alphabetically first category is the reference. It shares the dropped last slot of the
    encoder with categories that training has not seen, so both are all zeros.
    """
    numeric = [c for c in features if c not in categorical]
    medians = exact_medians(df, numeric)
    modes = df.agg(*[F.mode(c, True).alias(c) for c in categorical]).first() if categorical else {}
    quoted = {c: str(modes[c]).replace("'", "''") for c in categorical}
    cast = ", ".join(
        [f"coalesce(CAST(`{c}` AS DOUBLE), {medians.get(c, 0.0)!r}D) AS `_i_{c}`" for c in numeric]
        + [f"coalesce(CAST(`{c}` AS STRING), '{quoted[c]}') AS `_c_{c}`" for c in categorical]
    )
    prepare = SQLTransformer(statement=f"SELECT *, {cast} FROM __THIS__")
    stages = [
        prepare,
        VectorAssembler(inputCols=[f"_i_{c}" for c in numeric], outputCol="_numeric", handleInvalid="keep"),
    ]
    if scale:
        stages.append(StandardScaler(inputCol="_numeric", outputCol="_scaled", withMean=True, withStd=True))
    parts = ["_scaled" if scale else "_numeric"]
    ready = prepare.transform(df)
    for c in categorical:
        indexer = StringIndexer(
            inputCol=f"_c_{c}", outputCol=f"_x_{c}", stringOrderType="alphabetAsc", handleInvalid="keep"
        ).fit(ready)
        last = len(indexer.labels) - 1
        shift = f"CASE WHEN `_x_{c}` BETWEEN 1 AND {last} THEN `_x_{c}` - 1D ELSE {last}D END AS `_y_{c}`"
        stages += [
            indexer,
            SQLTransformer(statement=f"SELECT *, {shift} FROM __THIS__"),
            OneHotEncoder(inputCol=f"_y_{c}", outputCol=f"_o_{c}", dropLast=True),
        ]
        parts.append(f"_o_{c}")
    stages.append(VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="keep"))
    return stages


def balanced_weights(df: DataFrame, label: str = TARGET, output: str = "_weight") -> DataFrame:
    """n / (2 * class size), the class sizes read as a scalar subquery."""
    sizes = df.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("p"))
    ).scalar()
    n, p = sizes["n"].cast("double"), sizes["p"].cast("double")
    weight = F.when(F.col(label) == 1, F.try_divide(n, 2 * p)).otherwise(F.try_divide(n, 2 * (n - p)))
    return df.withColumn(output, F.coalesce(weight, F.lit(1.0)))


@dataclass
class Candidate:
    name: str
    family: str
    scale: bool = False
    calibrated: bool = False
    note: str = ""
    options: dict = field(default_factory=dict)


# Candidate families and their settings.
CANDIDATES = [
    Candidate("LogisticRegression", "logistic", True, False, "linear; interpretable coefficients"),
    Candidate("LogisticRegression_calibrated", "logistic", True, True, "logistic with sigmoid calibration"),
    Candidate("RandomForest", "forest", False, False, "bagged trees"),
    Candidate("RandomForest_calibrated", "forest", False, True, "bagged trees with sigmoid calibration"),
    Candidate("BoostedTrees", "boosted", False, False, "boosted trees"),
    Candidate("BoostedTrees_calibrated", "boosted", False, True, "boosted trees with sigmoid calibration"),
]
DEFAULT_OPTIONS = {
    "logistic": {"maxIter": 2000, "C": 1.0},
    "forest": {"numTrees": 350, "minInstancesPerNode": 4, "featureSubsetStrategy": "sqrt", "maxDepth": 30, "seed": 42},
    "boosted": {"maxIter": 250, "maxDepth": 3, "stepSize": 0.05, "subsamplingRate": 0.85, "featureSubsetStrategy": "0.85", "seed": 42},
}
#: How trees grow, without effect on the trees: each row keeps the id of its node, so the grown forest isn't sent out again with
#: every level; what the rows keep is checkpointed every few levels.
GROWTH = {"cacheNodeIds": True, "maxMemoryInMB": 512, "checkpointInterval": 10}


def estimator(family: str, rows: float, label: str = TARGET, **options):
    """A classifier of the family. The penalty 1/C on the weighted sum of losses becomes 1/(C * rows)."""
    settings = {**DEFAULT_OPTIONS[family], **options}
    if family == "logistic":
        c = settings.pop("C")
        return LogisticRegression(
            featuresCol="features", labelCol=label, weightCol="_weight", standardization=False,
            regParam=1.0 / (c * max(rows, 1.0)), **settings,
        )
    kind = RandomForestClassifier if family == "forest" else GBTClassifier
    special = {"weightCol": "_weight", **GROWTH} if family == "forest" else {}
    return kind(featuresCol="features", labelCol=label, **{**special, **settings})


def trained(classifier, rows: DataFrame):
    with FITTING:
        return classifier.fit(rows)


def side_by_side(work: Sequence[Callable[[], object]], at_once: int | None = None) -> list:
    """Runs the functions in threads of this session, ``at_once`` at a time, and returns their results in order; the first error is raised."""
    if not work:
        return []
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPool(max(1, min(FITS_AT_ONCE if at_once is None else at_once, len(work)))) as pool:
        return [run.get() for run in [pool.apply_async(inherit(f)) for f in work]]


@contextmanager
def kept(df: DataFrame):
    """Training reads its rows many times: they are kept for the block, lineage intact."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


@dataclass
class Forest:
    """A forest grown in parts: the mean of its parts' probabilities, weighted by their trees, is that of the whole."""

    prepared: PipelineModel
    parts: list

    @property
    def n_trees(self) -> int:
        return sum(part.getNumTrees for part in self.parts)

    def score(self, df: DataFrame, output: str) -> DataFrame:
        keep = list(df.columns)
        rows = self.prepared.transform(df).select(*keep, "features")
        for k, part in enumerate(self.parts):
            scored = part.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_probability").transform(rows)
            rows = scored.withColumn(f"_part{k}", vector_to_array("_probability")[1] * (part.getNumTrees / self.n_trees)).drop("_probability")
        return rows.select(*keep, reduce(lambda a, b: a + b, [F.col(f"_part{k}") for k in range(len(self.parts))]).alias(output))


def grow(rows: DataFrame, n: int, label: str, **options) -> list:
    """The parts of a forest: few rows are one task's, and the trees are dealt to parts; of many rows there is one part."""
    trees = options.pop("numTrees", DEFAULT_OPTIONS["forest"]["numTrees"])
    seed = options.pop("seed", DEFAULT_OPTIONS["forest"]["seed"])
    parts = min(FOREST_PARTS, trees) if n <= ROWS_PER_TASK else 1
    sizes = [trees // parts + (k < trees % parts) for k in range(parts)]
    return side_by_side([lambda k=k: trained(estimator("forest", n, label, numTrees=sizes[k], seed=seed + k, **options), rows) for k in range(parts)], FOREST_PARTS)


def fit(df: DataFrame, family: str, features: Sequence[str], scale: bool, label: str = TARGET, **options) -> PipelineModel | Forest:
    categorical = [c for c in ("city", "season") if c in features]
    with kept(df.select(*features, label)) as held:
        n = held.count()
        rows = held.coalesce(max(1, -(-n // ROWS_PER_TASK)))
        prepared = Pipeline(stages=preprocess(rows, features, categorical, scale)).fit(rows)
        # an estimator reads its rows many times: the prepared ones are kept, not prepared again
        with kept(balanced_weights(prepared.transform(rows), label).select("features", label, "_weight")) as ready:
            if family == "forest":
                return Forest(prepared, grow(ready, n, label, **options))
            fitted = trained(estimator(family, n, label, **options), ready)
    return PipelineModel([*prepared.stages, fitted])


def score(model: PipelineModel | Forest, df: DataFrame, output: str = "probability", decision: bool = False) -> DataFrame:
    """Adds the probability of label 1, or with ``decision`` the value before the logistic curve."""
    if isinstance(model, Forest):
        return model.score(df, output)
    keep = list(df.columns)
    scored = model.transform(df.withColumn("_weight", F.lit(1.0)))
    return scored.select(*keep, vector_to_array("rawPrediction" if decision else "probability")[1].alias(output))


@dataclass
class CalibratedModel:
    """Mean of per-fold models, each with its own sigmoid on its held-out scores."""

    folds: list[tuple[PipelineModel, float, float]]
    decision: bool = False

    def score(self, df: DataFrame, output: str = "probability") -> DataFrame:
        keep = list(df.columns)
        rows = df
        parts = []
        for i, (model, slope, intercept) in enumerate(self.folds):
            rows = score(model, rows, f"_p{i}", self.decision)
            parts.append(1.0 / (1.0 + F.exp(-(F.col(f"_p{i}") * slope + intercept))))
        return rows.select(*keep, (sum(parts[1:], parts[0]) / len(parts)).alias(output))


def fit_calibrated(
    df: DataFrame, family: str, features: Sequence[str], scale: bool, label: str = TARGET, folds: int = 3,
    keys: Sequence[str] = ("city", "date"), **options,
) -> CalibratedModel:
    """Fits on all but one fold, then a sigmoid on the scores of that fold.

    The sigmoid sees the decision value of a linear model and the probability of trees. Its targets are smoothed to
    (n1 + 1) / (n1 + 2) and 1 / (n0 + 2): every row enters once with each label, weighted by its target.
    Folds are drawn by a hash of the key and so hold about the same share of both labels.
    """
    decision = family == "logistic"
    fold = F.pmod(F.xxhash64(F.lit(7), *keys), F.lit(folds)).alias("_fold")

    with kept(df.select(*features, label, fold)) as folded:

        def fold_model(k: int) -> tuple[PipelineModel, float, float]:
            model = fit(folded.where(F.col("_fold") != k), family, features, scale, label, **options)
            held_out = scratch_table(score(model, folded.where(F.col("_fold") == k), "_score", decision).select("_score", label))
            size = held_out.agg(F.struct(F.sum(F.col(label).cast("double")).alias("p"), F.count(label).cast("double").alias("n"))).scalar()
            target = F.when(F.col(label) == 1, (size["p"] + 1) / (size["p"] + 2)).otherwise(1 / (size["n"] - size["p"] + 2))
            both = F.explode(F.array(F.struct(F.lit(1.0).alias("y"), target.alias("w")), F.struct(F.lit(0.0).alias("y"), (1 - target).alias("w"))))
            soft = held_out.select("_score", both.alias("_t")).select("_score", "_t.y", "_t.w")
            vector = VectorAssembler(inputCols=["_score"], outputCol="_v")
            curve = LogisticRegression(featuresCol="_v", labelCol="y", weightCol="w", maxIter=200, tol=1e-9, probabilityCol="_q", rawPredictionCol="_w")
            with kept(vector.transform(soft).select("_v", "y", "w")) as seen:
                sigmoid = curve.fit(seen)
            return model, float(sigmoid.coefficients[0]), float(sigmoid.intercept)

        parts = side_by_side([lambda k=k: fold_model(k) for k in range(folds)])
    return CalibratedModel(parts, decision)


def fit_candidate(df: DataFrame, candidate: Candidate, features: Sequence[str], label: str = TARGET, **options):
    settings = {**candidate.options, **options}
    if candidate.calibrated:
        return fit_calibrated(df, candidate.family, features, candidate.scale, label, **settings)
    return fit(df, candidate.family, features, candidate.scale, label, **settings)


def score_with(model, df: DataFrame, output: str = "probability") -> DataFrame:
    return model.score(df, output) if isinstance(model, CalibratedModel) else score(model, df, output)


def with_sea_adjustment(scored: DataFrame, p: str = "probability") -> DataFrame:
    """Validation probabilities raised by the sea-state hazard of the same row."""
    sea = sea_risk(scored)["offshore_sea_probability"]
    return scored.withColumn("_sea", sea).withColumn(p, combined_probability(F.col(p), F.col("_sea"))).drop("_sea")


def baseline_scores(train: DataFrame, test: DataFrame, label: str = TARGET, half_window: int = 7) -> DataFrame:
    """Climatology of the training rows looked up for the test rows."""
    table = climatology(train, label, half_window)
    return climatology_lookup(test, table, global_rate(train, label), output="probability")


def report_row(scored: DataFrame, name: str, label: str = TARGET, notes: str = "") -> DataFrame:
    """One row: tuned threshold with its metrics, AUC, Brier."""
    best = evaluate.best_threshold(evaluate.threshold_grid(scored, label))
    return best.withColumns(
        {
            "roc_auc": evaluate.roc_auc(scored, label).scalar(),
            "brier": evaluate.brier(scored, label).scalar(),
            "model": F.lit(name),
            "notes": F.lit(notes),
        }
    )


SEA_COLUMNS = ["wave_height_max", "wave_height", "wave_height_estimated", "wind_wave_height_max", "swell_wave_height_max",
               "wave_period_max", "swell_wave_period_max"]
REPORT_SCHEMA = (
    "threshold double, accuracy double, precision double, recall double, f1 double, predicted_positive_rate double, "
    "roc_auc double, brier double, model string, notes string"
)


@dataclass
class Selection:
    model: object
    name: str
    threshold: float
    report: DataFrame
    features: list[str]
    validation: str


def train_and_select(
    daily: DataFrame, features: Sequence[str] | None = None, candidates: Sequence[Candidate] = CANDIDATES,
    year: int = 2024, label: str = TARGET, options: dict[str, dict] | None = None,
) -> Selection:
    """Evaluates the candidates on the hold-out, picks the winner and refits it on all rows.

    Candidates of one kind train side by side, and so do the folds of a calibrated one. A candidate that fails to train is skipped and stands in the report with its error. Training rows are cached for the
    several passes of the fits.
    """
    from daypanel.operators.features import next_day_target

    rows = daily if label in daily.columns else next_day_target(daily, output=label)
    chosen = feature_columns(rows.columns, features)
    if not chosen:
        raise ValueError("no usable feature columns")
    used = {*chosen, label, "city", "date", *present(rows, SEA_COLUMNS)}
    with kept(rows.select(*[c for c in rows.columns if c in used])) as rows:
        train, test, note = split(rows, year, label)
        baseline = baseline_scores(train, test, label)
        collected = report_row(baseline, "Climatology", label, "baseline rate by entity and day of year").collect()

        def contest(candidate: Candidate):
            extra = (options or {}).get(candidate.family, {})
            try:
                fitted = fit_candidate(train, candidate, chosen, label, **extra)
                adjusted = with_sea_adjustment(score_with(fitted, test)).select(label, "probability")
                # written, not kept: a plan through hundreds of trees is slow to analyse again for each measure
                return report_row(scratch_table(adjusted), candidate.name, label, candidate.note).collect(), None
            except Exception as error:  # a candidate may fail on degenerate data; the others go on
                LOG.warning("candidate %s skipped: %s", candidate.name, error)
                return [], (candidate.name, f"failed: {type(error).__name__}: {error}"[:2000])

        # boosting is many short jobs and would wait behind the long tasks of forests
        waves = [[c for c in candidates if (c.family == "forest") == deep] for deep in (False, True)]
        with kept(train) as train, kept(test) as test:
            found = {c.name: r for wave in waves for c, r in zip(wave, side_by_side([lambda c=c: contest(c) for c in wave]))}
        results = [found[c.name] for c in candidates]
        usable = [c for c, (_, error) in zip(candidates, results) if error is None]
        failed = [error for _, error in results if error is not None]
        collected += [row for found, _ in results for row in found]
        if not usable:
            raise RuntimeError("all candidates failed")
        # one row per candidate
        table = daily.sparkSession.createDataFrame(collected, REPORT_SCHEMA)
        report = evaluate.select_winner(evaluate.report_rows([table]))
        named = {r["model"]: r for r in report.collect()}
        winner = next(n for n, r in named.items() if r["selected"])
        candidate = next(c for c in usable if c.name == winner)
        final = fit_candidate(rows, candidate, chosen, label, **(options or {}).get(candidate.family, {}))
    if failed:
        rows_failed = small_table(daily.sparkSession, failed, "model string, notes string").withColumns({"eligible": F.lit(False), "selected": F.lit(False)})
        report = report.unionByName(rows_failed, allowMissingColumns=True)
    return Selection(final, winner, float(named[winner]["threshold"]), report, chosen, note)


def selected_row(report: DataFrame) -> tuple[str, float]:
    """Name and threshold that a stored report selects; without a selected row, the row that the guardrails and scores pick."""
    if "selected" not in report.columns or report.where("selected").isEmpty():
        rest = [c for c in ("eligible", "production_score", "selected") if c in report.columns]
        report = evaluate.select_winner(report.drop(*rest).where("f1 is not null"))
    row = report.where("selected").select("model", "threshold").first()
    if row is None:
        raise ValueError("the report has no model to select")
    return row["model"], float(row["threshold"])


def train_preferred(
    daily: DataFrame, report: DataFrame, preferred: str | None = None, features: Sequence[str] | None = None, candidates: Sequence[Candidate] = CANDIDATES,
    label: str = TARGET, options: dict[str, dict] | None = None,
) -> Selection:
    """Retrains one candidate on all rows, without a contest or a hold-out.

    Name and threshold come from the stored report; ``preferred`` names another row of it. Names match whatever their case and blanks.
    An unknown name raises, and so does a fit that fails.
    """
    from daypanel.operators.features import next_day_target

    plain = lambda name: "".join(name.lower().split())
    if preferred is None:
        name, threshold = selected_row(report)
    else:
        same = [r for r in report.select("model", "threshold").collect() if plain(r["model"]) == plain(preferred)]
        if not same:
            raise ValueError(f"the report has no model {preferred!r}")
        name, threshold = same[0]["model"], float(same[0]["threshold"])
    candidate = next((c for c in candidates if plain(c.name) == plain(name)), None)
    if candidate is None:
        raise ValueError(f"no candidate is named {name!r}")
    rows = daily if label in daily.columns else next_day_target(daily, output=label)
    chosen = feature_columns(rows.columns, features)
    if not chosen:
        raise ValueError("no usable feature columns")
    model = fit_candidate(rows, candidate, chosen, label, **(options or {}).get(candidate.family, {}))
    return Selection(model, candidate.name, threshold, report, chosen, "threshold of the stored report")


def metadata(selection: Selection, daily: DataFrame, as_of: dt.datetime, label: str = TARGET) -> DataFrame:
    """One row that describes the refitted model."""
    return daily.agg(F.count(F.lit(1)).alias("trained_rows"), F.avg(F.col(label).cast("double")).alias("positive_rate")).withColumns(
        {
            "model_name": F.lit(selection.name),
            "is_calibrated": F.lit(selection.name.endswith("_calibrated")),
            "decision_threshold": F.lit(selection.threshold),
            "feature_columns": F.array(*[F.lit(c) for c in selection.features]),
            "validation_note": F.lit(selection.validation),
            "trained_at": F.lit(as_of),
        }
    )


def coefficient_table(model: PipelineModel, df: DataFrame, n: int | None = None) -> DataFrame:
    """Coefficients with the names of their vector slots, by absolute value."""
    attributes = model.transform(df.limit(1).withColumn("_weight", F.lit(1.0))).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    values = model.stages[-1].coefficients.toArray()
    rows = [(names.get(i, str(i)), float(v)) for i, v in enumerate(values)]
    table = small_table(df.sparkSession, rows, "feature string, coefficient double")
    ordered = table.orderBy(F.abs("coefficient").desc(), "feature")
    return ordered if n is None else ordered.limit(n)


def prediction_intervals(
    train: DataFrame, test: DataFrame, family: str, features: Sequence[str], scale: bool, refits: int = 30,
    label: str = TARGET, keys: Sequence[str] = ("city", "date"), seed: int = 42, **options,
) -> DataFrame:
    """Per-row 95% interval from refits on Poisson-weighted rows.

    The weight of a row in a refit is a function of the hash of its key, so a lost task
    redraws the same sample. Weights are the Poisson(1) quantiles of the hash value.
    """
    categorical = [c for c in ("city", "season") if c in features]
    needed = dict.fromkeys([*keys, *features])
    # both parts are written first and the scores of each refit as well: each of its jobs would carry the plan of the rows, which the driver keeps
    base, unseen = scratch_table(train.select(*dict.fromkeys([*needed, label]))), scratch_table(test.select(*needed))
    with kept(base) as base:

        def refit(i: int) -> DataFrame:
            u = F.pmod(F.xxhash64(F.lit(seed), F.lit(i), *keys), F.lit(1 << 30)) / float(1 << 30)
            cumulative, mass, weight = 0.0, 0.36787944117144233, F.lit(0.0)
            for k in range(13):  # beyond 12 the tail is below the resolution of the hash
                cumulative += mass
                mass /= k + 1
                weight = weight + (u >= cumulative).cast("double")
            drawn = base.withColumn("_draw", weight).where(F.col("_draw") > 0)
            with kept(drawn) as held:
                n = held.count()
                rows = held.coalesce(max(1, -(-n // ROWS_PER_TASK)))
                weighted = balanced_weights(rows, label).withColumn("_weight", F.col("_weight") * F.col("_draw"))
                stages = preprocess(rows, features, categorical, scale)
                stages.append(estimator(family, n, label, **options))
                model = Pipeline(stages=stages).fit(weighted)
            return scratch_table(score(model, unseen, "_p").select(*keys, "_p"))

        scores = side_by_side([lambda i=i: refit(i) for i in range(refits)])
    scored = reduce(lambda a, b: a.unionByName(b), scores)
    return scored.groupBy(*keys).agg(
        F.percentile("_p", F.lit(0.025)).alias("ci_low"), F.percentile("_p", F.lit(0.975)).alias("ci_high")
    )
