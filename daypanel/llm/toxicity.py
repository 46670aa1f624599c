"""Toxicity by a chain of linear classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.llm.linear import Rows, sigmoid
from daypanel.llm.quality_nbsvm import labelled

#: Labelled rows that the chain is fitted to at most: the first by a hash of the id. All rows are scored.
TRAIN_ROWS = 8_000
BITS = 20
#: Most features that the chain keeps, and the least log-likelihood ratio of one against chance.
FEATURES, LEAST_RATIO = 240, 30.0
#: Word starts that count as features beside whole words: inflected forms share them.
STEMS = (4, 5, 6)
#: Categories of a labelled toxic document by its number of distinct cue words; cues are features that only toxic
#: rows have. The last link of the chain is the label itself.
LEVELS = (("severe", 6), ("repeated", 3))
CHAIN = (*(name for name, _ in LEVELS), "toxic")
_DROP = bytes(c for c in range(128) if not (0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c in b" \t\n\x0b\f\r"))


def tokens(text: str | None) -> list[str]:
    """The distinct words in lower case without ASCII digits and punctuation, ascending."""
    return sorted(set((text or "").encode("utf-8", "surrogatepass").translate(None, _DROP).decode("utf-8", "replace").lower().split()))


def _hash(words: list[str]) -> np.ndarray:
    return (hash_array(np.array(words, dtype=object), categorize=False) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def features(text: str | None) -> np.ndarray:
    words = tokens(text)
    stems = {f"{w[:n]}-" for n in STEMS for w in words if len(w) > n}
    return np.unique(_hash(words + sorted(stems)))


def cue_words(text: str | None, cues: np.ndarray) -> int:
    """Distinct words that are a cue or start with one."""
    words, n = tokens(text), 0
    forms = [[w, *(f"{w[:k]}-" for k in STEMS if len(w) > k)] for w in words]
    found = np.isin(_hash([f for each in forms for f in each]), cues) if words else np.empty(0, bool)
    for each in forms:
        n, found = n + bool(found[: len(each)].any()), found[len(each) :]
    return n


class Chain:
    """Features that count, and per link weights: of features, of the probabilities of earlier links, and the bias."""

    def __init__(self, kept: np.ndarray, links: list[np.ndarray]):
        self.kept, self.links = kept, links

    def place(self, found: np.ndarray) -> np.ndarray:
        if not len(self.kept):
            return np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.kept, found), len(self.kept) - 1)
        return at[self.kept[at] == found]

    def score(self, found: np.ndarray) -> list[float]:
        at, n, out = self.place(found), len(self.kept), []
        for w in self.links:
            out.append(float(sigmoid(np.float64(w[at].sum() + sum(v * p for v, p in zip(w[n:-1], out)) + w[-1]))))
        return out


def select(found: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features that separate the labels best, and among them the cues: at least five rows, all toxic."""
    dim, x = 1 << BITS, Rows(found)
    total, hits, share = x.add(np.ones(len(y)), dim), x.add(y, dim), y.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2.0 * sum(np.where(n > 0, n * np.log(n / np.maximum(total * part, 1e-12)), 0.0) for n, part in ((hits, share), (total - hits, 1.0 - share)))
    best = np.argsort(-ratio, kind="stable")[:FEATURES]
    kept = np.sort(best[ratio[best] >= LEAST_RATIO])
    return kept, kept[hits[kept] >= 0.99 * total[kept]]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Weights and, last, the bias of a logistic regression by Newton steps."""
    x = np.column_stack((x, np.ones(len(x))))
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(25):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(found: list[np.ndarray], texts: list[str], y: np.ndarray, folds: int = 3, ridge: float = 0.3) -> Chain:
    """Fits the chain on texts, their features and their labels.

    Each later link sees out-of-fold probabilities of the earlier ones, so it learns how far to trust them.
    """
    n = len(found)
    if not n or y.min() == y.max():
        return Chain(np.empty(0, np.int64), [np.append(np.zeros(k), 20.0 if n and y[0] else -20.0) for k in range(len(CHAIN))])
    kept, cues = select(found, y)
    chain = Chain(kept, [])
    x = np.zeros((n, len(kept)))
    for k, f in enumerate(found):
        x[k, chain.place(f)] = 1.0
    number = np.array([cue_words(t, cues) if label else 0 for t, label in zip(texts, y)])
    part = np.arange(n) % folds
    for target in [*((number >= least).astype(float) for _, least in LEVELS), y]:
        held = np.zeros(n)
        for j in range(folds):
            w = logistic(x[part != j], target[part != j], ridge)
            held[part == j] = sigmoid(x[part == j] @ w[:-1] + w[-1])
        chain.links.append(logistic(x, target, ridge))
        x = np.column_stack((x, held))
    return chain


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array([features(x) for x in batch.column("text").to_pylist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("text"), batch.column("y"), found], ["text", "y", "found"])


def _scores(chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([chain.value.score(features(t)) for t in batch.column("text").to_pylist()]).reshape(-1, len(CHAIN))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(scores[:, k]) for k in range(len(CHAIN)))], [*batch.schema.names, *(f"p_{c}" for c in CHAIN)])

    return run


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Adds the chain's probabilities ``p_severe``, ``p_repeated``, ``p_toxic`` and the verdict ``toxic`` to documents.

    ``docs`` has ``text`` and ``doc_id`` among its columns, which are kept; ``labels`` has ``doc_id`` and ``toxic``. At most ``train_rows`` labelled
    documents fit the chain; every document is scored from its whole text. Null labels and ids don't train;
    without labels nothing is toxic. Null and empty texts get the probabilities of the biases.
    Repeated rows and null ids come back as they came; columns of ``docs`` with a name added here are replaced.
    """
    added = [*(f"p_{c}" for c in CHAIN), "toxic"]
    docs = docs.drop(*added)
    rows = labelled(docs, labels, "toxic", train_rows).select("y", "text").mapInArrow(_train, "text string, y int, found array<long>").toArrow()
    found = [np.asarray(f.values, dtype=np.int64) for f in rows.column("found")]
    model = fit(found, rows.column("text").to_pylist(), rows.column("y").to_numpy().astype(float))
    chain = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([f"`{c}` {t}" for c, t in docs.dtypes] + [f"p_{c} double" for c in CHAIN])
    return docs.mapInArrow(_scores(chain), schema).withColumn("toxic", (F.col("p_toxic") >= threshold).cast("int"))
