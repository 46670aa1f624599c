"""Mixes sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypanel.llm.base import cut, n_words

#: Documents that one task pairs at a time, and residuals that one node of the tree combines.
BLOCK = 2000
SEED = 20


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """Per source: ``source``, ``source_size``, ``n_docs``, ``target``.

    ``sizes`` has ``source`` and ``size``. Sources by code point, null last, get the weights in turn and share the
    sum of all sizes; a target stops at ``most`` times its source's size and the excess is shared
    by weight among the rest until none is above. The windows see one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int")).cast("double"))
    # sources reach their limit in the order of limit / weight; the rest share what the limits leave
    everything = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = everything.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    per = per.withColumn("limit", F.col("source_size") * float(most))
    per = per.withColumns({
        "left": F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
        "rest": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    # the first source that stays under its limit sets the level of all after it
    per = per.withColumn("level", F.min(F.when(F.col("left") * F.col("weight") <= F.col("limit") * F.col("rest"), F.struct(F.col("limit") / F.col("weight"), F.col("left") / F.col("rest")))).over(whole))
    level = F.col("level.col2")
    return per.select("source", "source_size", "n_docs", F.when(level.isNull() | (F.col("limit") < level * F.col("weight")), F.col("limit")).otherwise(level * F.col("weight")).alias("target"))


def pivot(p: list[float], size: list[int], draws: np.ndarray) -> list[float]:
    """Rounds probabilities in order, one pair at a time, and keeps the sum of ``p * size``.

    Two fractional entries exchange expected words until one of them is 0 or 1; the direction is drawn so that both
    keep their expectation. All but one entry at most come back integral.
    """
    p, at = list(p), -1
    for k in range(len(p)):
        if p[k] <= 0.0 or p[k] >= 1.0:
            continue
        if at < 0:
            at = k
            continue
        a, b = size[at], size[k]
        up, down = min(a * (1 - p[at]), b * p[k]), min(a * p[at], b * (1 - p[k]))
        if draws[k] * (up + down) < down:
            first = up == a * (1 - p[at])
            p[at], p[k] = (1.0, p[k] - up / b) if first else (p[at] + up / a, 0.0)
        else:
            first = down == a * p[at]
            p[at], p[k] = (0.0, p[k] + down / b) if first else (p[at] - down / a, 1.0)
        # an exchange that ends both at once leaves a rounding error of the other
        p[at], p[k] = (float(round(x)) if abs(x - round(x)) < 1e-12 else x for x in (p[at], p[k]))
        at = k if 0.0 < p[k] < 1.0 else at if 0.0 < p[at] < 1.0 else -1
    return p


def _round(level: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # from large to small: what is left in the end is a fraction of a small document
        rows = rows.sort_values(["size", "order", "doc_id", "copy"], ascending=[False, True, True, True], na_position="last", kind="stable")
        name = None if pd.isna(key[0]) else key[0]
        seed = int.from_bytes(hashlib.blake2b(repr((SEED, level, name, int(key[1]))).encode(), digest_size=8).digest(), "little")
        return rows.assign(p=pivot(rows["p"].tolist(), rows["size"].tolist(), np.random.default_rng(seed).random(len(rows))))

    return run


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: float = 3.0, block: int = BLOCK) -> DataFrame:
    """How often each document enters the mix.

    Takes ``doc_id``, ``text``, ``source`` and returns per row ``doc_id``, ``source``, ``size`` (words), ``source_size``,
    ``target`` (words of its source in the mix), ``copies`` and ``taken`` (= copies * size).
    Every document of a source has the same expected number of copies, ``target / source_size``, which is at most ``most``. Its
    whole part is certain; the fractional parts are rounded pair by pair (``pivot``) in blocks of
    about ``block`` documents, each of which leaves at most one fraction; those are combined in
    the same way, ``block`` at a time, until one is left per source and drawn. A source's taken words so
    differ from its target by less than one document, and large documents are paired first, so it is mostly a small one.

    Draws are hashes of ids, so reruns agree. Null texts have size 0; documents of size 0 are taken 0
    times. A null source is a source. Repeated rows are documents of their own. No rows give
    no rows; extra columns are ignored.
    """
    sized = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words("text").alias("size")))
    targets = cut(source_targets(sized, weights, most))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    same = sized.groupBy("source", "doc_id", "size").count()
    rows = same.join(targets.hint("broadcast") if targets.count() <= 100_000 else targets, same["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count")))).withColumn("whole", F.floor(rate + 1e-12))
    rows = rows.withColumns({
        "p": F.when((F.col("size") == 0) | (rate - F.col("whole") < 1e-12), 0.0).otherwise(rate - F.col("whole")), "order": F.xxhash64(F.lit(SEED), "doc_id", "copy"),
        "whole": F.when(F.col("size") == 0, 0).otherwise(F.col("whole")),
    })
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id", "copy"), F.ceil(F.col("n_docs") / block)))
    rows = rows.select("source", "doc_id", "size", "copy", "source_size", "target", "whole", "p", "order", "block")
    most_blocks = math.ceil((targets.agg(F.max("n_docs")).first()[0] or 1) / block)
    done, level = None, 0
    while True:
        rows = cut(rows.groupBy("source", "block").applyInPandas(_round(level), rows.schema))
        fraction = (F.col("p") > 0) & (F.col("p") < 1)
        if most_blocks == 1:
            drawn = F.when(F.pmod(F.xxhash64(F.lit(SEED + 2), "doc_id", "copy"), F.lit(1 << 52)) < F.col("p") * float(1 << 52), 1.0).otherwise(0.0)
            last = rows.withColumn("p", F.when(fraction, drawn).otherwise(F.col("p")))
            done = last if done is None else done.unionByName(last)
            break
        ended = rows.where(~fraction)
        done = ended if done is None else done.unionByName(ended)
        rows, most_blocks, level = rows.where(fraction).withColumn("block", F.floor(F.col("block") / block)), math.ceil(most_blocks / block), level + 1
    copies = (F.col("whole") + F.col("p")).cast("long")
    return done.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
