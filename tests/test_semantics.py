"""Hand cases and properties of single operators."""

import datetime as dt
import math

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracklore.functions import geo
from tracklore.functions import scalars as s
from tracklore.operators import contracts, episodes, filters, joins, reports, space, weather

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_species_label_pairs(spark):
    pairs = {"cat": "fox", "kitten": "fox", "red_fox": "fox", "vulpes_vulpes": "fox", "marten": "badger", "weasel": "badger", "meles_meles": "badger", "fox": "fox", "badger": "badger", "Bear": "boar", "toaster": None}
    got = spark.createDataFrame([(k,) for k in pairs], "l string").select("l", s.map_species_label(F.col("l"))).collect()
    assert {r[0]: r[1] for r in got} == pairs


def test_five_boxes(spark):
    boxes = [("moose", 0.9, 10, 10, 60, 60), ("boar", 0.2, 5, 5, 15, 15), ("fox", 0.8, 0, 0, 5, 5), ("bear", 0.7, 95, 95, 105, 105), ("lynx", 0.6, 20, 22, 22, 60), ("none", None, 1, 1, 2, 2)]
    df = spark.createDataFrame([(a, b, *map(float, c), 100, 100) for a, b, *c in boxes], "label string, det_score double, x1 double, y1 double, x2 double, y2 double, image_width int, image_height int")
    got = {r[0]: r[1] for r in df.select("label", filters.drop_reason(edge=2)).collect()}
    assert got == {"moose": None, "boar": "confidence", "fox": "area", "bear": "edge_proximity", "lynx": "area", "none": "invalid_bbox"} | {"fox": got["fox"], "lynx": got["lynx"]}
    assert got["fox"] in ("area", "tiny_object") and got["lynx"] in ("area", "tiny_object", "aspect_ratio")
    assert {r[0] for r in filters.filter_bboxes(df, edge=2).collect()} == {"moose"}


def test_anchored_episodes(spark):
    times = [0, 300, 600, 601, 900, 1201, 1202, 5000, 5004]
    rows = spark.createDataFrame([("c", "fox", at(t), 0.9, f"x_frame_{t:06d}.jpg", "v.mp4") for t in times], "camera_id string, label string, timestamp timestamp_ntz, confidence double, crop_path string, source_path string")
    got = episodes.compress(rows, 10, 0).orderBy("start_time").collect()
    assert [(r["start_time"], r["frame_count"]) for r in got] == [(at(0), 3), (at(601), 3), (at(1202), 1), (at(5000), 2)]
    assert [r["start_time"] for r in episodes.compress(rows, 10, 5).orderBy("start_time").collect()] == [at(0), at(601)]
    assert got[0]["timeline"][1]["frame_number"] == 300 and got[0]["source_video"] == "v.mp4"


def test_decayed_mean_equals_loop(spark):
    values = [((i * 37) % 100) / 100 for i in range(40)]
    rows = spark.createDataFrame([("c", "fox", at(i), at(i + 6), 6.0, v, v) for i, v in enumerate(values)], "camera_id string, species string, start_time timestamp_ntz, end_time timestamp_ntz, duration_seconds double, max_confidence double, avg_confidence double")
    loop = 0.0
    for v in values:
        loop = (loop + v) / 2
    assert episodes.report_species(rows).first()["avg_confidence_decayed"] == pytest.approx(loop, abs=1e-9)


def _sequential(points, radius):
    clusters, out = [], {}
    for seq, lat, lon in points:
        for c in clusters:
            if geo_m(lat, lon, c[1] / c[3], c[2] / c[3]) <= radius:
                break
        else:
            c = [seq, 0.0, 0.0, 0]
            clusters.append(c)
        c[1], c[2], c[3] = c[1] + lat, c[2] + lon, c[3] + 1
        out[seq] = c[0]
    return out


def geo_m(a, b, c, d):
    x = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * geo.EARTH_M * math.asin(min(1.0, math.sqrt(x)))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4000), st.integers(0, 8000)), min_size=1, max_size=60))
def test_leader_clusters_equal_sequential(spark, places):
    points = [(i, 59.0 + a / 1e6, 18.0 + b / 1e6) for i, (a, b) in enumerate(places)]
    got = space.leader_clusters(spark.createDataFrame(points, "seq long, latitude double, longitude double")).collect()
    assert {r["seq"]: r["cluster"] for r in got} == _sequential(points, 5.0)


def test_leader_clusters_go_on_from_an_earlier_run(spark):
    import random

    r = random.Random(8)
    points = [(i, 59.0 + r.randrange(4000) / 1e7, 18.0 + r.randrange(8000) / 1e7) for i in range(120)]
    df = spark.createDataFrame(points, "seq long, latitude double, longitude double")
    first = space.leader_clusters(df.filter("seq < 70"))
    later = space.leader_clusters(df.filter("seq >= 70"), earlier=space.centres(first))
    assert {g["seq"]: g["cluster"] for g in first.unionByName(later).collect()} == _sequential(points, 5.0)
    stats = space.batch_stats(df, df.filter("seq < 70")).first()
    old = {g["cluster"] for g in first.collect()}
    assert (stats["processed"], stats["clustered"], stats["errors"]) == (50, 50, 0) and stats["new_clusters"] == len({g["cluster"] for g in later.collect()} - old)


def test_hull_area_and_perimeter(spark):
    square = [("a", x, y) for x in (0.0, 0.5, 1.0) for y in (0.0, 0.5, 1.0)]
    got = space.convex_hull(spark.createDataFrame(square, "cluster_id string, latitude double, longitude double")).select(F.size("ring").alias("n"), geo.ring_area_m2(F.col("ring")).alias("a"), geo.ring_perimeter_m(F.col("ring")).alias("p")).first()
    assert got["n"] == 4 and got["a"] == pytest.approx(111320**2 * math.cos(math.radians(0.5)), rel=1e-9) and got["p"] == pytest.approx(4 * 111194.9, rel=1e-3)


def test_nearest_in_time_ties_and_ends(spark):
    left = spark.createDataFrame([(1, "a", at(10)), (2, "a", at(100)), (3, "a", at(-50)), (4, "b", at(0))], "id int, k string, t timestamp_ntz")
    right = spark.createDataFrame([("a", at(0), 7), ("a", at(20), 8), ("a", at(20), 6)], "k string, u timestamp_ntz, w int")
    got = {r["id"]: r["w"] for r in joins.asof_nearest(left, right, "k", "t", "u", ["w"], "w").collect()}
    assert got == {1: 7, 2: 6, 3: 7, 4: None}


def test_nearest_in_time_over_blocks_equals_brute_force(spark):
    import random

    r = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    when = lambda: start + dt.timedelta(seconds=r.randrange(0, 12 * 86_400, 1800))
    left = [(i, r.choice(["a", "a", "b", "none", None]), when() if i % 37 else None) for i in range(300)]
    right = [(j, r.choice(["a", "b", "other", None]), when() if j % 11 else None) for j in range(60)]
    got = joins.asof_nearest(
        spark.createDataFrame(left, "id int, k string, t timestamp_ntz"), spark.createDataFrame(right, "w int, k string, u timestamp_ntz"), "k", "t", "u", ["w"], "w"
    ).collect()
    assert len(got) == len(left)
    for g in got:
        near = sorted((abs(g["t"] - u), u, w) for w, k, u in right if k is not None and k == g["k"] and u is not None and g["t"] is not None)
        assert (g["u_matched"], g["w"]) == (near[0][1:] if near else (None, None))


@pytest.mark.parametrize("minutes", [10, 360])
def test_anchors_over_blocks_equal_a_loop(spark, minutes):
    import random

    r = random.Random(minutes)
    start = dt.datetime(2023, 11, 3)
    rows = [(c, label, start + dt.timedelta(minutes=r.randrange(0, 200 * 1440, 5), microseconds=r.randrange(3)), i) for i, (c, label) in enumerate([("c1", "fox")] * 4000 + [("c2", "fox")] * 30 + [("c1", None)] * 40)]
    got = {g["i"]: g["anchor"] for g in episodes.with_anchor(spark.createDataFrame(rows, "camera_id string, label string, timestamp timestamp_ntz, i int"), minutes).collect()}
    anchor = {}
    for c, label, t, i in sorted(rows, key=lambda x: x[2]):
        a = anchor.get((c, label))
        if a is None or t > a + dt.timedelta(minutes=minutes):
            a = anchor[c, label] = t
        assert got[i] == a
    assert len(got) == len(rows)


def test_places_over_the_date_line(spark):
    points = [(1, 10.0, 179.99999), (2, 10.0, -179.99999), (3, 10.0, 0.0), (4, -10.0, -179.995)]
    df = spark.createDataFrame(points, "seq long, latitude double, longitude double")
    near = joins.proximity(df.filter("seq = 1"), spark.createDataFrame([("s", 10.0, -179.9999)], "site string, latitude double, longitude double"), 1.0, "seq", "site").first()
    assert near["near_site"] == "s" and near["distance_km"] < 0.02
    pairs = space.overlap_pairs(df.select(df.seq.alias("cluster_id"), df.latitude.alias("center_latitude"), df.longitude.alias("center_longitude")), 5.0).collect()
    assert [(p["a"], p["b"]) for p in pairs] == [(1, 2)]
    assert {r["seq"]: r["cluster"] for r in space.leader_clusters(df).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_a_batch_that_runs_again_overwrites_itself(spark, tmp_path):
    from tracklore.streaming import streams

    rows = spark.createDataFrame([(1, "JPEG"), (2, "GIF")], "id int, image_format string")
    rules = tuple(x for x in contracts.EVENTS if x.name == "image_format")
    for number in (0, 1, 1):
        streams.split_valid(rows, number, rules, f"{tmp_path}/good", f"{tmp_path}/bad")
    assert [spark.read.parquet(f"{tmp_path}/{k}/batch_*").count() for k in ("good", "bad")] == [2, 2]


def test_last_wins(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None)], "k string, seq int, v string")
    assert {(r["k"], r["v"]) for r in joins.last_wins(rows, "k", "seq").collect()} == {("a", "z"), ("b", None)}


def test_null_counts_as_a_value(spark):
    rows = spark.createDataFrame([("a",), (None,), ("a",)], "v string")
    assert rows.agg(reports.distinct("v")).first()[0] == 2 and rows.filter("false").agg(reports.distinct("v")).first()[0] == 0


def test_autumn_hour_is_the_later_one(spark):
    rows = spark.createDataFrame([("2024-10-27 02:30:00",), ("2024-10-27 01:30:00",), ("2024-07-01 12:00:00",)], "t string")
    got = [str(r[0]) for r in rows.select(s.normalize_to_utc(F.col("t").cast("timestamp"), F.lit("Europe/Stockholm")).cast("string")).collect()]
    assert got == ["2024-10-27 01:30:00", "2024-10-26 23:30:00", "2024-07-01 10:00:00"]


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.9, 2.5, 2.5, 3.5, 3.5, 100, 100)], "det_score double, x1 double, y1 double, x2 double, y2 double, image_width int, image_height int")
    r = filters.crop_box(df, 0.0).first()
    assert (r["crop_x1"], r["crop_x2"]) == (2, 4)


@pytest.mark.parametrize("name,want", [('a<b>:"c', "a_b___c"), (" .x. ", "x"), ("...", "unnamed"), ("", "unnamed")])
def test_safe_filename(spark, name, want):
    assert spark.createDataFrame([(name,)], "n string").select(s.safe_filename(F.col("n"))).first()[0] == want


@pytest.mark.parametrize("url,want", [("s3://bucket/key/x", ("bucket", "key/x", True)), ("s3://b/key", ("b", "key", False)), ("s3://Bucket/key", ("Bucket", "key", False)), ("http://bucket/key", ("", "", False))])
def test_s3_parts(spark, url, want):
    assert tuple(spark.createDataFrame([(url,)], "u string").select(*s.s3_parts(F.col("u"))).first()) == want


def test_wind_and_conditions(spark):
    rows = spark.createDataFrame([(0.0, 0.0, 0.9), (22.5, 1.0, 0.0), (359.0, 0.0, 0.5), (None, None, None)], "d double, p double, c double")
    got = [tuple(r) for r in rows.select(weather.wind_cardinal(F.col("d")), weather.condition_code(F.col("p"), F.col("c"))).collect()]
    assert got == [("N", "cloudy"), ("NE", "rain"), ("N", "partly_cloudy"), (None, "clear")]


def test_mostly_rule_and_uniqueness(spark):
    rows = spark.createDataFrame([(i, 5 if i else 500) for i in range(20)] + [(3, None)], "id int, v int")
    got = {r["rule"]: (r["evaluated"], r["failed"], r["success"]) for r in contracts.quality_report(rows, (contracts.between("v", 0, 10, 0.95), contracts.between("v", 0, 10)), "id").collect()}
    assert got["id_unique"] == (21, 2, False) and got["v_range"][0:2] == (20, 1)


def test_merge_needs_two(spark):
    points = spark.createDataFrame([("a", 1.0, 1.0), ("b", 3.0, 3.0), ("c", 9.0, 9.0)], "cluster_id string, latitude double, longitude double")
    assert {(r[0], r[1]) for r in space.merge_clusters(points, ["a", "b"], "m").collect()} == {("m", 2.0), ("c", 9.0)}
    assert {r[0] for r in space.merge_clusters(points, ["a", "zz"], "m").collect()} == {"a", "b", "c"}


def test_proximity_against_brute_force(spark):
    points = [(i, 59 + (i * 7919 % 1000) / 5000, 18 + (i * 104729 % 1000) / 3000) for i in range(80)]
    sites = [(j, 59 + (j * 31 % 100) / 500, 18 + (j * 57 % 100) / 300) for j in range(20)]
    got = joins.proximity(spark.createDataFrame(points, "id int, latitude double, longitude double"), spark.createDataFrame(sites, "site int, latitude double, longitude double"), 2.0, "id", "site").collect()
    for r in got:
        near = sorted((geo_m(r["latitude"], r["longitude"], b, c) / 1000, j) for j, b, c in sites)
        assert r["near_site"] == (near[0][1] if near[0][0] <= 2 else None)


def test_plan_prunes_and_filters_at_the_scan(spark):
    from tests.compare import SF

    df = spark.read.parquet(f"{SF}/lineitem.parquet").filter("l_quantity > 10").select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity" in plan and "l_comment" not in plan


def test_pandas_frame(spark):
    from tracklore.sources.readers import from_pandas

    assert from_pandas(spark, pd.DataFrame({"a": [1, 2]})).count() == 2
