"""Features of changed days: which rows a change reaches, and the recomputation of those alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daypanel.constants import RISK_RULES, Rule
from daypanel.operators.features import CHAIN_REACH
from daypanel.plans.layers import analytics_daily


def reached_rows(staging: DataFrame, changed: DataFrame, entity: str = "city", date: str = "date", reach: int | None = None) -> DataFrame:
    """Marks the keys of ``staging`` that a change reaches.

    Returns ``entity``, ``date`` and three flags. ``recompute``: the row or one of the ``reach`` rows before it has changed, so its windows
    see the change. ``shares_day``: another row of its (entity, day of year) has, so its anomalies do. ``read``: its values are
    needed for either: one of the ``reach`` rows after it is recomputed, or a row of its (entity, day of year) is
    recomputed or shares its day. Only keys are read.
    """
    reach = CHAIN_REACH if reach is None else reach
    marks = changed.select(F.col(entity).alias("_entity"), F.col(date).alias("_date")).distinct().withColumn("_changed", F.lit(True))
    keys = staging.select(entity, date)
    marked = keys.join(marks, (F.col(entity) == F.col("_entity")) & (F.col(date) == F.col("_date")), "left")
    marked = marked.select(entity, date, F.coalesce("_changed", F.lit(False)).alias("_changed"))
    along = W.partitionBy(entity).orderBy(date)
    same_day = W.partitionBy(entity, F.dayofyear(date))
    marked = marked.withColumn("recompute", F.max("_changed").over(along.rowsBetween(-reach, 0)))
    marked = marked.withColumn("_before", F.max("recompute").over(along.rowsBetween(0, reach)))
    marked = marked.withColumns({"shares_day": F.max("_changed").over(same_day), "_day_read": F.max("recompute").over(same_day)})
    return marked.select(entity, date, "recompute", "shares_day", (F.col("_before") | F.col("_day_read")).alias("read"))


def changed_features(
    staging: DataFrame, changed: DataFrame, previous: DataFrame, fetch: DataFrame, rules: Sequence[Rule] = RISK_RULES,
    entity: str = "city", date: str = "date",
) -> DataFrame:
    """The rows of the features layer that differ from ``previous`` after the rows ``changed`` of ``staging`` have.

    The chain runs over the rows marked ``read``: a window of a recomputed row finds there the very rows that it finds in the whole
    layer, and a day of year all its years. Rows that only share a day of year with a change keep their columns but the
    anomalies. Merged into ``previous`` by key the result equals a full build.
    """
    flags = reached_rows(staging, changed, entity, date).where("read")
    wanted = staging.join(flags, [entity, date])
    built = analytics_daily(wanted.drop("recompute", "shares_day", "read"), fetch, rules)
    built = built.join(flags.select(entity, date, "recompute", "shares_day"), [entity, date])
    columns = [c for c in built.columns if c not in ("recompute", "shares_day")]
    anomalies = [c for c in columns if c.endswith("_anom")]
    whole = built.where("recompute").select(*columns)
    fresh = built.where(~F.col("recompute") & F.col("shares_day")).select(entity, date, *[F.col(c).alias(f"_new_{c}") for c in anomalies])
    kept = [F.col(f"_new_{c}").alias(c) if c in anomalies else F.col(c) for c in columns]
    return whole.unionByName(previous.join(fresh, [entity, date]).select(*kept))
