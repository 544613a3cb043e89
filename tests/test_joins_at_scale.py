"""Joins whose inputs are skewed or grow: same rows, and plans that do not move what they need not."""

import random
import re

from pyspark.sql import functions as F

from tracklore.operators import joins
from tracklore.operators.history import History


def test_a_history_is_not_exchanged(spark, tmp_path):
    path = str(tmp_path / "h")
    history = History(spark, path, "k", "long", buckets=4)
    rows = spark.createDataFrame([(i, i % 7) for i in range(500)] + [(None, 1)], "k long, v long")
    history.remember(rows.filter("v = 0"))
    history.remember(rows.filter("v < 3"))  # some of them again
    assert {r["k"] for r in history.not_yet(rows).collect()} == {i for i in range(500) if i % 7 >= 3} | {None}
    counted = history.counts(rows).first()
    assert (counted["already"], counted["pending"]) == (len([i for i in range(500) if i % 7 < 3]), len([i for i in range(500) if i % 7 >= 3]) + 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, most in ((history.not_yet(rows), 1), (history.counts(rows), 2)):  # the second one is the last sum
            plan = df._jdf.queryExecution().executedPlan().toString()
            scan = plan.index("FileScan parquet")
            above = plan[:scan].rsplit("Exchange", 1)[-1]
            assert plan.count("Exchange") == most and "Bucketed: true" in plan and "SortMergeJoin" in plan and "Join" not in above
            assert re.search(r"Exchange hashpartitioning\(k#\d+L?, 4\)", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    again = History(spark, path, "k", "long", buckets=4)
    assert again.keys().distinct().count() == len([i for i in range(500) if i % 7 < 3])
    empty = History(spark, str(tmp_path / "e"), "k", "long", buckets=4)
    assert empty.not_yet(rows).count() == 501


def test_a_crowded_cell_is_many_groups(spark):
    """Nine tenths of the points and most sites lie within one cell."""
    r = random.Random(6)
    points = [(i, 59.0 + r.uniform(0, 0.004), 18.0 + r.uniform(0, 0.008)) for i in range(3000)] + [(5000 + i, 59.0 + r.uniform(-1, 1), 18.0 + r.uniform(-1, 1)) for i in range(300)]
    points += [(9000 + i, *points[i][1:]) for i in range(100)] + [(9999, None, 18.0)]
    sites = [(j, 59.0 + r.uniform(0, 0.004), 18.0 + r.uniform(0, 0.008)) for j in range(60)] + [(100 + j, 59.0 + r.uniform(-1, 1), 18.0 + r.uniform(-1, 1)) for j in range(40)]
    p, s = spark.createDataFrame(points, "id int, latitude double, longitude double"), spark.createDataFrame(sites, "site int, latitude double, longitude double")
    key = lambda df: sorted(map(repr, df.collect()))
    plain = key(joins.proximity(p, s, 1.0, "id", "site"))
    assert key(joins.proximity(p, s, 1.0, "id", "site", most_pairs=2000)) == plain and len(plain) == len(points)
    import tests.test_semantics as t

    for row in joins.proximity(p.filter("id % 50 = 0"), s, 1.0, "id", "site", most_pairs=2000).collect():
        near = sorted((t.geo_m(row["latitude"], row["longitude"], b, c) / 1000, j) for j, b, c in sites)
        assert row["near_site"] == (near[0][1] if near[0][0] <= 1 else None)


def test_parts_of_a_crowded_cell_are_even(spark):
    p = spark.range(20_000).select(F.lit(0).alias("__r"), F.lit(0).alias("__c"), (F.col("id") / 1e6).alias("__la"), F.lit(1.0).alias("__lo"))
    s = spark.range(50).select(F.lit(0).alias("__r"), F.lit(0).alias("__c"))
    parts = joins._crowded(p, s, 10_000).first()["__parts"]
    assert parts == 100
    sizes = p.groupBy(F.pmod(F.xxhash64("__la", "__lo"), F.lit(parts)).alias("g")).count().agg(F.max("count"), F.expr("median(count)")).first()
    assert sizes[0] < 10 * sizes[1]
