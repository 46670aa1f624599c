"""Importance resampling towards a target distribution of hashed n-grams."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypanel.llm.base import cut
from daypanel.operators.ranges import range_places

#: Per byte of UTF-8: A-Z to a-z, any other ASCII character but digits and letters to a space, the rest as it is.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SPACES = re.compile(rb" {2,}")


def span_pattern(n: int) -> regex.Pattern:
    """Runs of ``n`` words in a text with single spaces; overlapped matches start at every word that has ``n - 1`` after it."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}+(?![^ ])" % (n - 1))


def collapse(text: str | None) -> bytes:
    """The text as lower-cased words with one space between them."""
    return _SPACES.sub(b" ", (text or "").encode("utf-8", "surrogatepass").translate(FOLD)).strip(b" ")


def spans(flat: bytes, patterns: list[regex.Pattern]) -> Iterator[bytes]:
    """All n-grams of a collapsed text, repeats included, cut out of it by their spans."""
    for pattern in patterns:
        for found in pattern.finditer(flat, overlapped=True):
            yield flat[found.start() : found.end()]


def _hashed(n_min: int, n_max: int, n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [span_pattern(n) for n in range(n_min, n_max + 1)]
        crc = zlib.crc32
        for batch in batches:
            words, features, ends, buckets, counts = [], [], [0], [], []
            for text in batch["text"]:
                flat = collapse(text.as_py())
                hashed = np.fromiter((crc(gram) for gram in spans(flat, patterns)), dtype=np.int64) % n_buckets
                bucket, count = np.unique(hashed, return_counts=True)
                words.append(flat.count(b" ") + 1 if flat else 0)
                features.append(len(hashed))
                ends.append(ends[-1] + len(bucket))
                buckets.append(bucket)
                counts.append(count)
            lists = [
                pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.concatenate([np.empty(0, np.int64), *values]).astype(kind))).cast(pa.list_(pa.from_numpy_dtype(kind)))
                for values, kind in ((buckets, np.int32), (counts, np.int64))
            ]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(words, pa.int64()), pa.array(features, pa.int64()), *lists], ["doc_id", "n_words", "n_features", "buckets", "counts"])

    return run


def hashed_ngrams(docs: DataFrame, n_min: int = 1, n_max: int = 1, n_buckets: int = 10_000) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, ``n_features`` and the distinct ``buckets`` of its n-grams with their ``counts``."""
    return docs.select("doc_id", "text").mapInArrow(_hashed(n_min, n_max, n_buckets), "doc_id long, n_words long, n_features long, buckets array<int>, counts array<long>")


def _totals(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            np.add.at(total, batch["buckets"].flatten().to_numpy(), batch["counts"].flatten().to_numpy())
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], ["bucket", "n"])

    return run


def bucket_counts(hashed: DataFrame, n_buckets: int) -> DataFrame:
    """Features per bucket: each task sums its own documents first, so at most ``n_buckets`` rows of each are shuffled."""
    return hashed.select("buckets", "counts").mapInArrow(_totals(n_buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, n_buckets: int) -> DataFrame:
    """Per bucket the floored thousandfold log ratio of its smoothed share in the target and in the source; ``n_buckets`` rows."""
    every = source.sparkSession.range(n_buckets).withColumnRenamed("id", "bucket")
    s, t = source.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    both = every.join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0, ["s", "t"])
    # no features at all on a side: the sum over no rows is null
    big_s, big_t = (F.coalesce(x.agg(F.sum("n")).scalar(), F.lit(0)).cast("double") for x in (source, target))
    ratio = ((F.col("t").cast("double") + 1) * (big_s + n_buckets)) / ((F.col("s").cast("double") + 1) * (big_t + n_buckets))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))


def _weights(gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch["n_features"].to_numpy()
            sums = np.concatenate([[0], np.cumsum(gains[batch["buckets"].flatten().to_numpy()] * batch["counts"].flatten().to_numpy())])
            ends = np.concatenate([[0], np.cumsum(batch["buckets"].value_lengths().to_numpy())])
            weight = np.where(n > 0, (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_words"], batch["n_features"], pa.array(weight, pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    return run


def gumbel(seed: int, doc_id: Column) -> Column:
    """Thousandfold Gumbel noise of a document, a function of seed and id alone, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, n_min: int = 1, n_max: int = 1, n_buckets: int = 10_000, min_words: int = 20, percent: int = 10, seed: int = 2024) -> DataFrame:
    """Draws documents without replacement, likelier the more their n-grams look like the target's.

    ``docs`` has ``doc_id`` and ``text``, ``target`` has ``text``. Returns per document ``doc_id``, ``n_features``, ``weight`` (floored
    mean gain of its n-grams), ``score`` (weight plus Gumbel noise) and ``rank``: the ``percent`` % highest scores among documents with
    at least ``min_words`` words, from 1, ties to the smaller id; null for the rest.

    Texts are read once; what is kept of them are their bucket counts. The gains are ``n_buckets`` numbers and the only thing
    that goes through the driver. Ranks come from range partitions of (score, id), so no task
    sees all documents.

    Null and empty texts, and texts without words, have no features and weight 0. A null id draws its noise from an empty id and comes last
    among ties. Repeated rows are documents of their own. No documents give no rows, no target texts a target without features.
    Extra columns are ignored; ids that aren't integers raise.
    """
    hashed = cut(hashed_ngrams(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), n_min, n_max, n_buckets))
    wanted = hashed_ngrams(target.select(F.lit(0).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), n_min, n_max, n_buckets)
    gains = cut(bucket_gains(cut(bucket_counts(hashed, n_buckets)), cut(bucket_counts(wanted, n_buckets)), n_buckets))
    table = np.array([r.gain for r in gains.orderBy("bucket").collect()], np.int64)
    weighed = hashed.mapInArrow(_weights(table), "doc_id long, n_words long, n_features long, weight long")
    scored = weighed.select("doc_id", "n_features", "weight", (F.col("weight") + gumbel(seed, F.col("doc_id"))).alias("score"), (F.col("n_words") < min_words).alias("short"))
    # the group of the drawable documents comes with their number
    placed = range_places(scored, [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features", "weight"], ["short"])
    drawn = ~F.col("short") & (F.col("place") < F.floor(F.col("group_rows") * percent / 100))
    return placed.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("place") + 1).alias("rank"))
