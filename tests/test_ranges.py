"""Places in a global order."""

import pytest

from daypanel.functions.columns import join_groups
from daypanel.operators import order_stats
from daypanel.operators.ranges import range_places


def want(rows):
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    return sorted(((g, v, k, len(vs)) for g, vs in groups.items() for k, v in enumerate(sorted(vs))), key=repr)


@pytest.mark.parametrize("hot", [0, 2000])
def test_places_within_groups(spark, hot):
    rows = [(g, float((k * 7919) % 997)) for k in range(300) for g in ("a", "b", None)] + [("a", 1e6 + k) for k in range(hot)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = range_places(df, ["v"], ["g"])
    assert got.columns == ["g", "v", "place", "group_rows"]
    assert sorted(map(tuple, got.collect()), key=repr) == want(rows)


def test_one_group_and_none(spark):
    df = spark.range(1000)
    got = range_places(df.selectExpr("1000 - id as v"), ["v"])
    assert sorted((r.v, r.place) for r in got.collect()) == [(k + 1, k) for k in range(1000)]
    assert range_places(df.where("false"), ["id"]).count() == 0


def pareto(k):
    return 1e8 ** ((k + 0.5) / 40_000)


def decades(k):
    return float((k * 7919) % 40_000) * 10.0 ** (k % 8)


def close(k):
    return 1e6 + k * 1e-6


@pytest.mark.parametrize("value_of", [pareto, decades, close])
def test_no_range_holds_many_values(spark, value_of):
    """One group of 40,000 values over any spread, most of them repeated, is dealt evenly."""
    rows = [("hot", value_of(k), 1) for k in range(40_000)] + [("cold", float(k), 1) for k in range(50)]
    cells = order_stats.value_counts(spark.createDataFrame(rows, "g string, v double, one int"), ["g"], "v")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in order_stats.value_ranges(cells, ["g"], "v").groupBy("_range").count().collect()]
        got = {(r.g, r.v): (r.n_before, r.n_total) for r in order_stats.prefix_sums(cells, ["g"], "v").collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(sizes) < 0.05 * sum(sizes)
    for g in ("hot", "cold"):
        values = sorted(v for h, v, _ in rows if h == g)
        place = {}
        for i, v in enumerate(values):
            place.setdefault(v, i)
        assert all(got[(g, v)] == (i, len(values)) for v, i in place.items())


def test_groups_meet_their_statistics_without_a_shuffle_of_rows(spark):
    rows = spark.range(20_000).selectExpr("if(id < 15000, 'hot', concat('g', id % 7)) as g", "1 as same")
    stats = rows.groupBy("g").agg({"same": "sum"}).withColumnRenamed("sum(same)", "n")
    joined = join_groups(rows, stats, ["g"])
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert {(r.g, r.n) for r in joined.distinct().collect()} == {(r.g, r.n) for r in stats.collect()} and joined.count() == 20_000
