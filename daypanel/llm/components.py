"""Connected components of an undirected graph of links, as joins that end when no label changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypanel.llm.base import cut, gathered


def _relabelled(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The links between labels instead of nodes; a node without one keeps its name."""
    for side in "ab":
        links = links.join(labels.select(F.col("node").alias(side), F.col("comp").alias(f"comp_{side}")), side, "left")
    return links.select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b"))


def components(links: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """Per node that has a link: ``node`` and ``comp``, the smallest node it reaches.

    ``links`` has columns ``a`` and ``b``, null-free, in any order and with repeats allowed; no links
    give no rows. ``start`` may hold the result of an earlier call: its nodes come back too, and only the links
    that the earlier call hasn't seen are needed, which are followed between its components. Every round
    all nodes of a label take the smallest label that any of them is linked with, and then that label's own choice, twice. A label that
    isn't the smallest around it goes, at least half of those left in a component, so the number of rounds follows the logarithm of the
    component's size, whatever its shape and the order of its names. A hub's rows are combined before they are shuffled.
    """
    rows = 2 * links.count()
    links = links.select("a", "b").where("a <> b")
    apart = links if start is None else _relabelled(links, start).where("a <> b")
    both = cut(gathered(apart.unionByName(apart.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), rows))
    labels = cut(gathered(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("comp")), rows))
    while True:
        pairs = _relabelled(both, labels)
        least = pairs.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("low"))
        for _ in range(2):
            least = least.join(least.select(F.col("a").alias("low"), F.col("low").alias("lower")), "low").select("a", F.col("lower").alias("low"))
        labels = labels.join(least.withColumnRenamed("a", "comp"), "comp").select("node", F.col("comp").alias("old"), F.col("low").alias("comp"))
        labels = cut(gathered(labels, rows))
        if labels.where("comp <> old").isEmpty():
            break
        labels = labels.select("node", "comp")
    labels = labels.select("node", "comp")
    if start is None:
        return labels
    new = links.select(F.explode(F.array("a", "b")).alias("node")).withColumn("comp", F.col("node"))
    every = start.select("node", "comp").unionByName(new).groupBy("node").agg(F.min("comp").alias("known"))  # a label is no larger than its node
    every = every.join(labels.select(F.col("node").alias("known"), "comp"), "known", "left")
    return cut(gathered(every.select("node", F.coalesce("comp", "known").alias("comp")), rows + start.count()))
