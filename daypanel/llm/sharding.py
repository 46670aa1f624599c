"""Uniform shuffle into shards of exact sizes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.functions.columns import small_table
from daypanel.llm.base import cut
from daypanel.operators.ranges import range_places

SEED = 13


def hypergeometric(good: int, bad: int, n: int, u: float) -> int:
    """How many of ``n`` rows drawn without replacement are among the ``good`` of ``good + bad``, by inversion at ``u`` in [0, 1).

    Probabilities are ratios to that of the mode, out to where they are below 1e-25 of it, so counts of any size are exact to
    rounding.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    share = good / (good + bad)
    reach = int(12 * np.sqrt(n * share * (1 - share))) + 60
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)  # the step from k to k + 1
    steps = np.log((good - k) * (n - k)) - np.log((k + 1) * (bad - n + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    p = np.exp(logs - logs.max())
    return first + int(np.searchsorted(np.cumsum(p) / p.sum(), u, side="right").clip(0, last - first))


def communication_matrix(rows: list[int], shards: list[int], seed: int = SEED) -> np.ndarray:
    """How many rows of each partition go to each shard in a uniform random deal of all rows.

    ``rows`` and ``shards`` have the same sum. Partition by partition the counts are drawn from what the shards have left, shard by
    shard; the last partition gets what is left of each.
    """
    rng, left, out = np.random.default_rng(seed), list(shards), np.zeros((len(rows), len(shards)), np.int64)
    for p, n in enumerate(rows):
        rest = sum(left)
        for s, room in enumerate(left):
            rest -= room
            k = hypergeometric(room, rest, n, rng.random())
            out[p, s], left[s], n = k, room - k, n - k
    return out


def _deal(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shards = None, None
        for batch in batches:
            parts, places = batch["part"].to_numpy(), batch["at"].to_numpy()
            out = np.empty(len(parts), np.int32)
            for part in np.unique(parts):
                here = np.flatnonzero(parts == part)
                if part != known:
                    counts = np.array(batch["counts"][int(here[0])].as_py(), np.int64)
                    # the local permutation: a shuffled deck that has each shard as often as the matrix says
                    known, shards = part, np.random.default_rng([seed, int(part)]).permutation(np.repeat(np.arange(len(counts), dtype=np.int32), counts))
                out[here] = shards[places[here]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["size"], batch["text_crc32"], pa.array(out), batch["draw"]], ["doc_id", "size", "text_crc32", "shard", "draw"])

    return run


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = SEED) -> DataFrame:
    """Deals documents to ``shards`` in a uniform random order; the shards' row counts differ by one at most.

    Returns per row ``doc_id``, ``size`` (UTF-8 bytes of the text and 1), ``text_crc32``, ``law`` (``rows``), ``shard``, ``slot`` (place in the
    shard, gapless from 0) and ``grown_shard`` (null: a shard more deals all rows anew).

    Input partitions are numbered and written without their texts. The number of rows of each goes to the driver, one number
    per partition, and comes back as a row of the communication matrix. Each row's shard is its place in the shuffled deck of its
    partition, which any task can make again; the exchange then orders the rows of a shard by a random key over as many
    tasks as they need, which permutes them again, and their places are the slots.

    The deal is a function of the partitions, their order of rows and the seed; a lost task repeats it. Another layout of the files is another
    uniform deal. Null texts have size 1 and no checksum; null ids, repeated rows and equal texts are rows like any other and
    are dealt one by one. No rows give no rows. Extra columns are ignored; ids that aren't integers raise.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    rows = cut(rows.withColumn("_id", F.monotonically_increasing_id())).select("doc_id", "size", "text_crc32", F.shiftright("_id", 33).alias("part"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    held = [(r["part"], r["count"]) for r in rows.groupBy("part").count().orderBy("part").collect()]
    total = sum(n for _, n in held)
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix([n for _, n in held], sizes, seed)
    counts = small_table(docs.sparkSession, [(part, row.tolist()) for (part, _), row in zip(held, matrix)], "of_part long, counts array<long>")
    draw = F.xxhash64(F.lit(seed), "part", "at").alias("draw")
    dealt = rows.join(counts, F.col("part") == F.col("of_part")).select("doc_id", "size", "text_crc32", "part", "at", "counts", draw)
    dealt = dealt.mapInArrow(_deal(seed), "doc_id long, size long, text_crc32 long, shard int, draw long")
    placed = range_places(dealt, ["draw"], ["shard"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("place").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
