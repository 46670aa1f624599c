"""Helpers of this subpackage: tables, words, checkpoints, hashes."""

from __future__ import annotations

import numpy as np
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.session import scratch_table

#: A word of the contracts: a run of characters other than space and the controls 09 to 0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The rows of a frame, written as a table to the shared checkpoint folder and read from there.
cut = scratch_table

#: Tasks that a table of known size is dealt to at least, and narrow rows of each beyond them.
TASKS, TASK_ROWS = 12, 20_000


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more partitions than about ``rows`` rows need, so that a small table isn't written as a file per shuffle partition."""
    return df.coalesce(TASKS + rows // TASK_ROWS)


def n_words(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*parts: Column) -> Column:
    """A repeatable number in [0, 1) drawn from the given values."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / float(1 << 52)


_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_M = 0x9E3779B97F4A7C55  # odd multiplier of the polynomial over the words of a window


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser on each number."""
    with np.errstate(over="ignore"):
        x = (x + _A).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * _B
        x = (x ^ (x >> np.uint64(27))) * _C
        return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in order, A-Z lower-cased, as UTF-8; none for null or blank texts."""
    # bytes.lower and bytes.split know ASCII only: exactly A-Z, and exactly the white space of WORD
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, in order."""
    return hash_array(np.array(words_of(text), dtype=object), categorize=False)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` words, in order; none if there are fewer."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(m, np.uint64(n))
        for k in range(n):
            out = out * np.uint64(_M) + words[k : k + m]
    return mix(out)


def shingles(text: str | None, n: int = 5) -> np.ndarray:
    """The distinct shingles of ``n`` words, ascending; a shorter text has its whole sequence as one, a text without words none."""
    words = word_hashes(text)
    if not len(words):
        return words
    return np.unique(gram_hashes(words, min(n, len(words))))
