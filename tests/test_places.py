"""Leader clusters in rounds and greedy groups against plain loops."""

import math
import random

import pytest

from tests.compare import SF
from tracklore.functions.geo import EARTH_M
from tracklore.operators import graph, leaders, space
from tracklore.plans.views import view

PLACES = "seq long, latitude double, longitude double"


def vector(lat, lon):
    a, o = math.radians(lat), math.radians(lon)
    return math.cos(a) * math.cos(o), math.cos(a) * math.sin(o), math.sin(a)


def loop(points, radius, earlier=()):
    """The rule, one point after the other, each against every cluster."""
    clusters = [[k, *(v * n for v in vector(lat, lon)), n] for k, lat, lon, n in sorted(earlier)]
    out = {}
    for seq, lat, lon in sorted(points):
        own = vector(lat, lon)
        for c in clusters:
            size = math.sqrt(c[1] ** 2 + c[2] ** 2 + c[3] ** 2)
            if 2 * EARTH_M * math.asin(min(1.0, math.dist(own, [v / size for v in c[1:4]]) / 2)) <= radius:
                break
        else:
            c = [seq, 0.0, 0.0, 0.0, 0]
            clusters.append(c)
        c[1:] = [c[1] + own[0], c[2] + own[1], c[3] + own[2], c[4] + 1]
        out[seq] = c[0]
    return out


def clustered(spark, points, radius=5.0, earlier=None, **options):
    df = spark.createDataFrame(points, PLACES).repartition(5)
    before = None if earlier is None else spark.createDataFrame(earlier, "cluster long, latitude double, longitude double, point_count long")
    rows = leaders.leader_clusters(df, radius, before, **options).collect()
    assert len(rows) == len(points)
    return {r["seq"]: r["cluster"] for r in rows}


def test_one_dense_part_over_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(leaders, "TILE_RADII", 9)
    r = random.Random(5)
    # one part of 90 metres a side, with a hot spot: many tiles, the hot ones in blocks of seq
    points = [(i, 59.0 + r.uniform(0, 8e-4), 18.0 + r.uniform(0, 16e-4)) for i in range(500)]
    points += [(i, 59.0004 + r.gauss(0, 3e-5), 18.0008 + r.gauss(0, 6e-5)) for i in range(500, 1200)]
    r.shuffle(points)
    points = [(k, lat, lon) for k, (_, lat, lon) in enumerate(points)]
    assert clustered(spark, points, tile_points=200) == loop(points, 5.0)


def test_a_hot_spot_on_a_tile_border(spark, monkeypatch):
    monkeypatch.setattr(leaders, "BUCKETS", 16)
    r = random.Random(2)
    width = math.degrees(leaders.TILE_RADII * 5.0 / EARTH_M)
    lat = round(59.0 / width) * width  # near a border of tiles in latitude, if not on it
    points = [(3 * i - 500, lat + r.gauss(0, 2e-5), 18.0 + r.gauss(0, 4e-5)) for i in range(900)]
    assert clustered(spark, points, tile_points=100) == loop(points, 5.0)
    assert clustered(spark, points[:300]) == loop(points[:300], 5.0)


@pytest.mark.parametrize("lat,lon", [(10.0, 180.0), (89.99999, 0.0), (-60.0, -180.0), (0.0, 0.0)])
def test_date_line_poles_and_earlier_runs(spark, lat, lon):
    r = random.Random(7)
    wrap = lambda o: (o + 180) % 360 - 180
    points = [(i, min(lat + r.uniform(-1e-4, 1e-4), 90.0), wrap(lon + (r.uniform(-1e-4, 1e-4) if lat < 80 else r.uniform(0, 360)))) for i in range(160)]
    assert clustered(spark, points) == loop(points, 5.0)
    first = loop(points[:80], 5.0)
    df = spark.createDataFrame([(*p, first[p[0]]) for p in points[:80]], f"{PLACES}, cluster long")
    before = [(c["cluster"], c["latitude"], c["longitude"], c["point_count"]) for c in space.centres(df).collect()]
    assert clustered(spark, points[80:], earlier=before) == loop(points[80:], 5.0, before)


def test_centres_over_the_date_line(spark):
    points = [(1, 10.0, 179.99999), (2, 10.0, -179.99999), (3, 10.0, 179.99999)]
    own = leaders.leader_clusters(spark.createDataFrame(points, PLACES))
    centre = space.centres(own).collect()
    assert len(centre) == 1 and 180 - abs(centre[0]["longitude"]) < 1e-5 and centre[0]["latitude"] == pytest.approx(10.0)
    assert all(r["distance_m"] < 5 for r in space.assignments(own).collect())
    later = leaders.leader_clusters(spark.createDataFrame([(4, 10.0, 179.99999)], PLACES), earlier=space.centres(own)).first()
    assert later["cluster"] == 1
    obs = spark.createDataFrame([*points, (5, None, 1.0), (None, 2.0, 2.0)], "seq long, gps_latitude double, gps_longitude double")
    assert [(r["cluster"], r["point_count"]) for r in space.process_observations(obs).collect()] == [(1, 3)]


def test_empty_and_odd_tables(spark):
    none = spark.createDataFrame([], PLACES)
    assert leaders.leader_clusters(none).count() == 0
    assert clustered(spark, [(2**60, 1.0, 1.0), (2**60 + 1, 1.0, 1.0), (-(2**60), 1.0, 1.0)]) == {-(2**60): -(2**60), 2**60: -(2**60), 2**60 + 1: -(2**60)}


def test_queries_equal_the_loop(spark):
    points = [tuple(r) for r in view(spark, SF, "points").select("seq", "latitude", "longitude").collect()]
    from tracklore.plans import catalogue

    got = {r["seq"]: r["cluster"] for r in catalogue.QUERIES["gps_leader_clusters"](spark, SF).collect()}
    assert got == loop(points, 5.0)


def groups(pairs):
    near, taken, out = {}, set(), []
    for a, b, d in sorted(pairs):
        near.setdefault(a, []).append((b, d))
    for a in sorted({x for p in pairs for x in p[:2]}):
        free = [(b, d) for b, d in near.get(a, []) if b not in taken]
        if a not in taken and free:
            taken |= {a, *(b for b, _ in free)}
            out.append((a, ",".join(b for b, _ in free), len(free) + 1, min(d for _, d in free)))
        taken.add(a)
    return sorted(out)


def test_first_free_equals_the_loop(spark):
    r = random.Random(4)
    edges = {(a, b) for a, b in ((r.randrange(400), r.randrange(400)) for _ in range(700)) if a < b} | {(i, i + 1) for i in range(1000, 1300)}
    got = {x["node"]: x["free"] for x in graph.first_free(spark.createDataFrame(sorted(edges), "a long, b long")).collect()}
    free = {}
    for n in sorted({x for e in edges for x in e}):
        free[n] = not any(free[a] for a, b in edges if b == n)
    assert got == free


def test_a_long_chain_of_overlaps(spark):
    """Centres along a meridian, each near its neighbours only; ids in order of place, so every one waits for the last."""
    n = 100_000
    step = 1.2e-5
    rows = spark.range(n).selectExpr("lpad(cast(id as string), 6, '0') as cluster_id", f"cast(id as double) * {step} as center_latitude", "18.0d as center_longitude")
    got = space.overlap_groups(rows, 2.0)
    assert got.count() == n // 2
    assert got.filter("leader <> lpad(cast(cast(members as int) - 1 as string), 6, '0') or size <> 2 or cast(leader as int) % 2 <> 0").count() == 0


def test_groups_equal_the_loop(spark):
    r = random.Random(1)
    centres = [(f"c{r.randrange(10**6)}_{i}", 59.0 + r.uniform(0, 3e-4), 18.0 + r.uniform(0, 6e-4)) for i in range(250)]
    df = spark.createDataFrame(centres, "cluster_id string, center_latitude double, center_longitude double")
    pairs = [tuple(p) for p in space.overlap_pairs(df, 3.0).select("a", "b", "distance_m").collect()]
    got = sorted(tuple(x) for x in space.overlap_groups(df, 3.0).select("leader", "members", "size", "overlap_distance_m").collect())
    assert len(pairs) > 100 and got == groups(pairs)


def test_numbers_over_the_whole_table(spark):
    from pyspark.sql import functions as F

    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g")).repartition(6)
    got = graph.numbered(rows, F.desc("g"), F.asc("k")).orderBy("n").collect()
    assert [(r["g"], r["k"]) for r in got] == sorted(((r["g"], r["k"]) for r in got), key=lambda x: (-x[0], x[1])) and [r["n"] for r in got] == list(range(1, 5001))
    assert graph.numbered(rows.filter("false"), F.asc("k")).count() == 0


def _query_points(n):
    """What the points view gives for keys from 0 on, as vectors in metres."""
    import numpy as np

    k = np.arange(n)
    a, o = np.radians((590000000 + k * 7919 % 2000) / 1e7), np.radians((180000000 + k * 104729 % 4000) / 1e7)
    return k, np.column_stack([np.cos(a) * np.cos(o), np.cos(a) * np.sin(o), np.sin(a)]) * EARTH_M


@pytest.mark.parametrize("kind", ["dense", "wide", "drift", "same", "pole"])
def test_guessed_runs_equal_one_by_one(kind):
    import numpy as np

    rng = np.random.default_rng(3)
    n = 12_000
    if kind == "dense":
        seqs, xyz = _query_points(n)
    else:
        lat = {"wide": 59 + rng.uniform(0, 1e-3, n), "drift": 59 + np.arange(n) * 2e-8 + rng.normal(0, 2e-5, n), "same": np.full(n, 59.0), "pole": 90 - np.abs(rng.normal(0, 3e-5, n))}[kind]
        lon = {"wide": 18 + rng.uniform(0, 2e-3, n), "drift": 18 + rng.normal(0, 2e-5, n), "same": np.full(n, 18.0), "pole": rng.uniform(-180, 180, n)}[kind]
        a, o = np.radians(lat), np.radians(lon)
        seqs, xyz = np.arange(n), np.column_stack([np.cos(a) * np.cos(o), np.cos(a) * np.sin(o), np.sin(a)]) * EARTH_M
    one, run = leaders._Centres(5.0), leaders._Centres(5.0)
    want = [one.add(s, *p) for s, p in zip(seqs.tolist(), xyz.tolist(), strict=True)]
    got = [c for at in range(0, n, 5000) for c in run.add_all(seqs[at : at + 5000], xyz[at : at + 5000])]
    assert got == want and run.sums == one.sums


def test_a_dense_part_takes_no_round_for_every_few_points(spark, monkeypatch):
    n, kept = 120_000, []
    plain = leaders.stored
    monkeypatch.setattr(leaders, "stored", lambda df: kept.append(1) or plain(df))
    df = spark.range(n).selectExpr("id AS seq", "(590000000 + id * 7919 % 2000) / 1e7D AS latitude", "(180000000 + id * 104729 % 4000) / 1e7D AS longitude")
    got = {r["seq"]: r["cluster"] for r in leaders.leader_clusters(df).collect()}
    one = leaders._Centres(5.0)
    assert [got[k] for k in range(n)] == [one.add(k, *p)[1] for k, p in enumerate(_query_points(n)[1].tolist())]
    assert len(kept) <= 4
