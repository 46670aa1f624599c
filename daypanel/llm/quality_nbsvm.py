"""Quality classifier: support vectors over Naive Bayes features."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.llm.base import gram_hashes, mix, word_hashes
from daypanel.llm.linear import Rows, dual_coordinate_descent, log_count_ratio, platt, sigmoid

#: Labelled rows that the model is fitted to at most: the first by a hash of the id. All rows are scored.
TRAIN_ROWS = 12_000
BITS = 18
_RUN = re.compile(rb"(.)\1+", re.S)
# letters, digits and other bytes by class: upper, lower, digit; symbols stay themselves
_CLASS = bytes(0x41 if 0x41 <= c <= 0x5A else 0x61 if 0x61 <= c <= 0x7A or c >= 0x80 else 0x39 if 0x30 <= c <= 0x39 else c for c in range(256))


def _shape_hashes(words: list[bytes]) -> np.ndarray:
    from pandas.util import hash_array

    shapes = _RUN.sub(rb"\1", b" ".join(words).translate(_CLASS)).split(b" ") if words else []
    return hash_array(np.array(shapes, dtype=object), categorize=False)


def features(text: str | None) -> np.ndarray:
    """The n-gram indicators of a whole text, as distinct numbers below ``2 ** BITS``.

    Words in lower case alone; and n-grams up to three of word shapes (runs of capitals, small letters, digits
    and symbols shortened to one), with a mark where a word equals the one before.
    """
    words = (text or "").encode("utf-8", "surrogatepass").split()
    plain = word_hashes(text)
    shapes = _shape_hashes(words)
    if len(shapes) != len(plain):  # a shape can't be empty; kept as a guard against other white space
        shapes = plain
    again = np.zeros(len(plain), dtype=np.uint64)
    again[1:] = plain[1:] == plain[:-1]
    shapes = mix(shapes ^ again)
    every = [plain, *(gram_hashes(shapes, n) for n in (1, 2, 3))]
    return np.unique(np.concatenate(every) & np.uint64((1 << BITS) - 1)).astype(np.int32)


def remainder(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's text, modulo ``folds``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


class Model:
    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.bias, self.slope, self.offset = weights.astype(np.float32), bias, slope, offset

    def score(self, found: np.ndarray) -> float:
        return float(sigmoid(self.slope * (float(self.weights[found].sum(dtype=np.float64)) + self.bias) + self.offset))


def fit(found: list[np.ndarray], y: np.ndarray, cost: float = 0.1, folds: int = 3) -> Model:
    """Fits weights on all rows, and the sigmoid on margins of models that didn't see their rows."""
    dim = 1 << BITS
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(dim), 0.0, 0.0, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    x = Rows(found)

    def one(rows: Rows, labels: np.ndarray) -> tuple[np.ndarray, float]:
        seen = rows.add(np.ones(len(rows)), dim) >= 3
        ratio = np.where(seen, log_count_ratio(rows, labels, dim), 0.0)
        balance = np.where(labels > 0, len(labels) / (2.0 * max(labels.sum(), 1)), len(labels) / (2.0 * max((1 - labels).sum(), 1)))
        norm = np.sqrt(np.maximum(np.diff(rows.start), 1)).mean()
        w, b = dual_coordinate_descent(rows, labels, ratio / norm, cost * balance)
        return w * ratio / norm, b

    part = np.arange(len(y)) % folds
    margin = np.zeros(len(y))
    for k in range(folds):
        w, b = one(x.take(np.flatnonzero(part != k)), y[part != k])
        margin[part == k] = x.take(np.flatnonzero(part == k)).dot(w) + b
    w, b = one(x, y)
    return Model(w, b, *platt(margin, y))


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents, ``doc_id``, ``text``, ``y``: the first by a hash of the id; of repeated ids the least text and label."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    first = y.groupBy("doc_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(first), "doc_id")
    return texts.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("y").alias("y")).orderBy("doc_id")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array([features(t) for t in batch.column("text").to_pylist()], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("y"), found], ["y", "found"])


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.value.score(features(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Scores the quality of whole texts.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``quality``. Returns per document ``doc_id``,
    ``held_out``, ``score`` and ``predicted``. The model sees labels of ids that aren't held out, and of those at most
    ``train_rows``; it scores from the text alone. Null labels and ids don't train; with no labels or one class the
    score is the constant share of label 1. Null and empty texts have no n-gram and get the score of the bias.
    Repeated rows come back as often, a null id too; extra columns are ignored.
    """
    seen = labelled(docs, labels.where(remainder(F.col("doc_id")) != 0), "quality", train_rows)
    rows = seen.select("y", "text").mapInArrow(_features, "y int, found array<int>").toArrow()
    found = [np.asarray(f.values, dtype=np.int32) for f in rows.column("found")]
    model = docs.sparkSession.sparkContext.broadcast(fit(found, rows.column("y").to_numpy().astype(float)))
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scores(model), "doc_id long, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
