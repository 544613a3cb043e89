"""Queries of clusters and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklore.functions import geo
from tracklore.operators import reports as r
from tracklore.operators import space as s
from tracklore.plans.join_queries import KM, SITES, _sites
from tracklore.plans.registry import query
from tracklore.plans.report_queries import CLUSTERS, GPS, with_clusters

OBS = "observations"
query("haversine_km", "points", f"SELECT seq, round({KM}, 9) AS km, round({KM} * 1000, 6) AS m FROM points p, (SELECT 59.0e0 AS latitude, 18.0e0 AS longitude) s")(
    lambda p: p.select("seq", F.round(geo.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(59.0), F.lit(18.0)), 9).alias("km"), F.round(geo.haversine_m(F.col("latitude"), F.col("longitude"), F.lit(59.0), F.lit(18.0)), 6).alias("m"))
)
UNIT = "cos(radians(latitude)) * cos(radians(longitude)) AS x, cos(radians(latitude)) * sin(radians(longitude)) AS y, sin(radians(latitude)) AS z"
CENTRE = "degrees(atan2(avg(z), sqrt(avg(x) * avg(x) + avg(y) * avg(y)))) AS latitude, degrees(atan2(avg(y), avg(x))) AS longitude"


def _one_by_one(name: str, rows: str, start: str = "[]::STRUCT(k BIGINT, x DOUBLE, y DOUBLE, z DOUBLE)[]") -> str:
    """The rule of leader clusters, a point a step: the list of clusters so far goes from step to step."""
    apart = "2 * 6371000.0e0 * asin(least(1.0e0, sqrt(pow(c.x / sqrt(c.x * c.x + c.y * c.y + c.z * c.z) - o.x, 2) + pow(c.y / sqrt(c.x * c.x + c.y * c.y + c.z * c.z) - o.y, 2) + pow(c.z / sqrt(c.x * c.x + c.y * c.y + c.z * c.z) - o.z, 2)) / 2))"
    return f"""{name}_rows AS (SELECT row_number() OVER (ORDER BY seq) AS i, seq, latitude, longitude, {UNIT} FROM ({rows}) WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
    {name}_run(i, seq, cluster, cs) AS (SELECT 0::BIGINT, NULL::BIGINT, NULL::BIGINT, {start} UNION ALL
     SELECT i, seq, coalesce(hit, seq), CASE WHEN hit IS NULL THEN list_append(cs, {{'k': seq, 'x': x, 'y': y, 'z': z}}) ELSE list_transform(cs, lambda c: CASE WHEN c.k = hit THEN {{'k': c.k, 'x': c.x + x, 'y': c.y + y, 'z': c.z + z}} ELSE c END) END
     FROM (SELECT o.*, r.cs, list_filter(r.cs, lambda c: {apart} <= 5)[1].k AS hit FROM {name}_run r JOIN {name}_rows o ON o.i = r.i + 1)),
    {name} AS (SELECT o.seq, o.latitude, o.longitude, o.x, o.y, o.z, r.cluster FROM {name}_run r JOIN {name}_rows o ON o.i = r.i),
    {name}_centres AS (SELECT cluster, {CENTRE}, count(*) AS point_count FROM {name} GROUP BY cluster)"""


LED = _one_by_one("led", "SELECT seq, latitude, longitude FROM points")
query("gps_leader_clusters", "points", "SELECT seq, latitude, longitude, cluster FROM led", more=LED, recursive=True)(s.leader_clusters)
BEFORE = f"(SELECT coalesce(list({{'k': cluster, 'x': x * n, 'y': y * n, 'z': z * n}} ORDER BY cluster), []) FROM (SELECT cluster, point_count AS n, {UNIT} FROM first_centres))"
BATCHES = ", ".join([_one_by_one("first", "SELECT seq, latitude, longitude FROM points WHERE latitude >= 59.0001e0"), _one_by_one("later", "SELECT seq, latitude, longitude FROM points WHERE latitude < 59.0001e0", BEFORE)])
query(
    "cluster_batch_stats",
    "points",
    "SELECT count(*) AS processed, 0 AS errors, (SELECT count(*) FROM later) AS clustered, (SELECT count(DISTINCT cluster) FROM later WHERE cluster NOT IN (SELECT cluster FROM first)) AS new_clusters FROM points WHERE latitude < 59.0001e0",
    more=BATCHES,
    recursive=True,
)(lambda p: s.batch_stats(p, p.filter("latitude >= 59.0001")))
SEEN = _one_by_one("led", "SELECT seq, gps_latitude AS latitude, gps_longitude AS longitude FROM observations")
query("process_observations", OBS, "SELECT cluster, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude, point_count FROM led_centres", more=SEEN, recursive=True)(s.process_observations)
query("cluster_assignments", "points", f"SELECT p.seq, p.cluster, round({KM} * 1000, 6) AS distance_m FROM led p JOIN led_centres s ON p.cluster = s.cluster", more=LED, recursive=True)(lambda p: s.assignments(s.leader_clusters(p)))
query("gps_cell_clusters", "points", "SELECT cast(floor(latitude / 0.0001e0) AS bigint) AS r, cast(floor(longitude / 0.0001e0) AS bigint) AS c, count(*) AS n, round(avg(latitude), 9) AS latitude, round(avg(longitude), 9) AS longitude FROM points GROUP BY 1, 2")(s.cell_clusters)
C = "cluster_id, cluster_name, point_count, center_latitude, center_longitude"
pick = lambda c: c.select("cluster_id", "cluster_name", "point_count", "center_latitude", "center_longitude")
with_clusters("named_clusters", f"SELECT {C} FROM clusters WHERE is_named")(lambda o, c: pick(c.filter("is_named")).orderBy("cluster_name"))
with_clusters("all_clusters", f"SELECT {C} FROM clusters")(lambda o, c: pick(c).orderBy("cluster_id"))
with_clusters("cluster_by_name", f"SELECT {C} FROM clusters WHERE cluster_name = 'NATION_3'")(lambda o, c: pick(c.filter("cluster_name = 'NATION_3'")))
with_clusters("cluster_by_id", f"SELECT {C} FROM clusters WHERE cluster_id = 'cluster_012'")(lambda o, c: pick(c.filter("cluster_id = 'cluster_012'")))
FIRST = f"(SELECT cluster_id, string_agg(observation_id, ',' ORDER BY k) AS sample_ids FROM (SELECT cluster_id, observation_id, row_number() OVER (PARTITION BY cluster_id ORDER BY timestamp, observation_id) AS k FROM observations WHERE {GPS}) WHERE k <= 5 GROUP BY 1)"
UNKNOWN = f"SELECT c.cluster_id, point_count, first_seen, last_seen, sample_ids FROM clusters c LEFT JOIN {FIRST} f ON c.cluster_id = f.cluster_id WHERE NOT is_named"
with_clusters("unknown_clusters", UNKNOWN)(s.unknown_clusters)
with_clusters("limit_n", f"{UNKNOWN} ORDER BY point_count DESC, c.cluster_id LIMIT 3")(lambda o, c: s.unknown_clusters(o, c).limit(3))
query("first_n_samples", OBS, f"SELECT cluster_id, observation_id FROM observations WHERE {GPS} QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY timestamp, observation_id) <= 5")(
    lambda o: r.with_gps(o).withColumn("k", F.row_number().over(s.Window.partitionBy("cluster_id").orderBy("timestamp", "observation_id"))).filter("k <= 5").select("cluster_id", "observation_id")
)
LABELS = "SELECT cluster_id, concat('Unknown_Cluster_', row_number() OVER (ORDER BY point_count DESC, cluster_id)) AS {0}, true AS labeling_required FROM clusters WHERE NOT is_named"
with_clusters("unknown_cluster_labels", LABELS.format("generated_name"))(lambda o, c: s.unknown_labels(c))
with_clusters("cluster_analysis_output", f"SELECT cluster_id, cluster_name AS name, false AS labeling_required FROM clusters WHERE is_named UNION ALL {LABELS.format('name')}")(lambda o, c: s.analysis_output(c))
UPDATES = (("cluster_001", "North gate"), ("cluster_015", "Old mill"))
with_clusters("name_clusters", f"SELECT c.cluster_id, coalesce(n, cluster_name) AS cluster_name, coalesce(n, cluster_name) IS NOT NULL AS is_named, n IS NOT NULL AS touched FROM clusters c LEFT JOIN (VALUES {', '.join(map(str, UPDATES))}) u(i, n) ON c.cluster_id = i")(
    lambda o, c: s.name_clusters(c, c.sparkSession.createDataFrame(list(UPDATES), "cluster_id string, new_name string"))
)
with_clusters("naming_changes_since", "SELECT cluster_id, cluster_name, last_seen AS updated_at FROM clusters WHERE is_named AND last_seen > cast('2024-01-20 00:00:00' AS timestamp)")(
    lambda o, c: c.filter("is_named AND last_seen > timestamp_ntz'2024-01-20 00:00:00'").select("cluster_id", "cluster_name", F.col("last_seen").alias("updated_at")).orderBy(F.desc("updated_at"), "cluster_id")
)
MERGED = "CASE WHEN cluster_id IN ('cluster_001', 'cluster_002', 'cluster_003') THEN 'merged' ELSE cluster_id END"
points_of = lambda o: r.with_gps(o).select("cluster_id", F.col("observation_id").alias("id"), F.col("gps_latitude").alias("latitude"), F.col("gps_longitude").alias("longitude"))
query("merge_clusters", OBS, f"SELECT {MERGED} AS cluster_id, round(avg(gps_latitude), 9) AS latitude, round(avg(gps_longitude), 9) AS longitude, count(*) AS point_count FROM observations WHERE {GPS} GROUP BY 1")(lambda o: s.merge_clusters(points_of(o), ["cluster_001", "cluster_002", "cluster_003"], "merged"))
BOX = "min(gps_latitude) AS min_lat, max(gps_latitude) AS max_lat, min(gps_longitude) AS min_lon, max(gps_longitude) AS max_lon"
EXTREME = "arg_min(observation_id, (gps_latitude, observation_id)) AS south, arg_min(observation_id, (-gps_latitude, observation_id)) AS north, arg_min(observation_id, (gps_longitude, observation_id)) AS west, arg_min(observation_id, (-gps_longitude, observation_id)) AS east"
query("cluster_boundary_box", OBS, f"SELECT cluster_id, {BOX}, {EXTREME} FROM observations WHERE {GPS} GROUP BY 1")(lambda o: s.boundary_box(points_of(o)))
CORNERS = f"(SELECT cluster_id, {BOX} FROM observations WHERE {GPS} GROUP BY 1)"
TWICE = "abs((min_lat * max_lon - min_lat * min_lon) + (min_lat * max_lon - max_lat * max_lon) + (max_lat * min_lon - max_lat * max_lon) + (max_lat * min_lon - min_lat * min_lon))"
query("polygon_area_m2", OBS, f"SELECT cluster_id, round({TWICE} / 2 * 111320.0e0 * 111320.0e0 * cos(radians((min_lat + min_lat + max_lat + max_lat) / 4)), 0) AS area_m2 FROM {CORNERS}")(lambda o: s.boundary_box(points_of(o)).select("cluster_id", F.round(geo.ring_area_m2(s.box_ring()), 0).alias("area_m2")))


def _metres(a: str, b: str, c: str, d: str) -> str:
    return KM.replace("s.latitude", c).replace("p.latitude", a).replace("s.longitude", d).replace("p.longitude", b) + " * 1000"


SIDES = " + ".join(_metres(*x) for x in (("min_lat", "min_lon", "min_lat", "max_lon"), ("min_lat", "max_lon", "max_lat", "max_lon"), ("max_lat", "max_lon", "max_lat", "min_lon"), ("max_lat", "min_lon", "min_lat", "min_lon")))
query("polygon_perimeter_m", OBS, f"SELECT cluster_id, round({SIDES}, 4) AS perimeter_m FROM {CORNERS}")(lambda o: s.boundary_box(points_of(o)).select("cluster_id", F.round(geo.ring_perimeter_m(s.box_ring()), 4).alias("perimeter_m")))
query("cluster_convex_hull", OBS)(lambda o: s.convex_hull(points_of(o)))
RING = f"""spots AS (SELECT DISTINCT cluster_id, gps_latitude AS la, gps_longitude AS lo FROM observations WHERE {GPS}),
 sides AS (SELECT a.cluster_id, a.la AS la1, a.lo AS lo1, b.la AS la2, b.lo AS lo2 FROM spots a JOIN spots b ON a.cluster_id = b.cluster_id AND (a.la, a.lo) <> (b.la, b.lo)
  WHERE NOT EXISTS (SELECT 1 FROM spots c WHERE c.cluster_id = a.cluster_id AND (c.la, c.lo) <> (a.la, a.lo) AND (c.la, c.lo) <> (b.la, b.lo)
   AND ((b.lo - a.lo) * (c.la - a.la) - (b.la - a.la) * (c.lo - a.lo) < -1e-13 OR abs((b.lo - a.lo) * (c.la - a.la) - (b.la - a.la) * (c.lo - a.lo)) <= 1e-13 AND (c.lo - a.lo) * (c.lo - b.lo) + (c.la - a.la) * (c.la - b.la) > 0))),
 hulls AS (SELECT cluster_id, count(*) AS corners, abs(sum((la1 - 59) * (lo2 - 18) - (la2 - 59) * (lo1 - 18))) / 2 * 111320.0e0 * 111320.0e0 * cos(radians(avg(la1))) AS area, sum(2 * 6371000.0e0 * asin(least(1.0e0, sqrt(pow(sin(radians(la2 - la1) / 2), 2) + cos(radians(la1)) * cos(radians(la2)) * pow(sin(radians(lo2 - lo1) / 2), 2))))) AS perimeter FROM sides GROUP BY cluster_id)"""
query("boundary_figures", "observations cluster_names", "SELECT c.cluster_id, is_named, point_count, corners, round(area, 0) AS area_m2, round(perimeter, 1) AS perimeter_m FROM clusters c LEFT JOIN hulls h ON c.cluster_id = h.cluster_id", more=f"{CLUSTERS}, {RING}")(
    lambda o, n: s.boundaries(points_of(o), r.cluster_table(o, n)).select("cluster_id", "is_named", "point_count", F.col("corners").cast("long").alias("corners"), F.round("area_m2", 0).alias("area_m2"), F.round("perimeter_m", 1).alias("perimeter_m"))
)
query("all_cluster_boundaries", "observations cluster_names")(lambda o, n: s.boundaries(points_of(o), r.cluster_table(o, n)))
NEAR = "cells AS (SELECT concat('p', cast(floor(latitude / 0.00002e0) AS bigint), '_', cast(floor(longitude / 0.00002e0) AS bigint)) AS cluster_id, avg(latitude) AS latitude, avg(longitude) AS longitude FROM points GROUP BY 1)"


def _cells(p):
    key = F.concat(F.lit("p"), F.floor(F.col("latitude") / 0.00002), F.lit("_"), F.floor(F.col("longitude") / 0.00002))
    return p.groupBy(key.alias("cluster_id")).agg(F.avg("latitude").alias("center_latitude"), F.avg("longitude").alias("center_longitude"))


query("cluster_overlap_pairs", "points", f"SELECT p.cluster_id AS a, s.cluster_id AS b, round(round({KM} * 1000, 6), 3) AS distance_m FROM cells p JOIN cells s ON p.cluster_id < s.cluster_id WHERE {KM} * 1000 <= 3", more=NEAR)(lambda p: s.overlap_pairs(_cells(p), 3.0).withColumn("distance_m", F.round("distance_m", 3)))
GREEDY = f"""{NEAR}, near AS (SELECT p.cluster_id AS a, s.cluster_id AS b, round({KM} * 1000, 6) AS d FROM cells p JOIN cells s ON p.cluster_id < s.cluster_id WHERE {KM} * 1000 <= 2),
 nodes AS (SELECT node, row_number() OVER (ORDER BY node) AS i, list(a) FILTER (a IS NOT NULL) AS earlier FROM (SELECT DISTINCT a AS node FROM near UNION SELECT b FROM near) LEFT JOIN near ON b = node GROUP BY node),
 walk(i, node, lead, leads) AS (SELECT 0::BIGINT, ''::VARCHAR, false, []::VARCHAR[] UNION ALL
  SELECT i, node, free, CASE WHEN free THEN list_append(leads, node) ELSE leads END FROM (SELECT n.i, n.node, w.leads, NOT list_has_any(w.leads, coalesce(n.earlier, []::VARCHAR[])) AS free FROM walk w JOIN nodes n ON n.i = w.i + 1)),
 own AS (SELECT b, min(a) AS leader FROM near JOIN walk ON walk.node = a AND lead WHERE b NOT IN (SELECT node FROM walk WHERE lead) GROUP BY b)"""
query("cluster_overlap_groups", "points", "SELECT leader, string_agg(own.b, ',' ORDER BY own.b) AS members, count(*) + 1 AS size, round(min(d), 3) AS overlap_distance_m FROM own JOIN near ON near.a = leader AND near.b = own.b GROUP BY leader", more=GREEDY, recursive=True)(
    lambda p: s.overlap_groups(_cells(p), 2.0).withColumn("overlap_distance_m", F.round("overlap_distance_m", 3))
)
query("cluster_locations", OBS, f"SELECT observation_id AS id, gps_latitude AS latitude, gps_longitude AS longitude FROM observations WHERE {GPS} AND cluster_id = 'cluster_004'")(lambda o: points_of(o).filter("cluster_id = 'cluster_004'").drop("cluster_id"))
query("cluster_mean", OBS, f"SELECT cluster_id, round(avg(gps_latitude), 9) AS latitude, round(avg(gps_longitude), 9) AS longitude, count(*) AS point_count FROM observations WHERE {GPS} AND cluster_id = 'cluster_004' GROUP BY 1")(lambda o: r.cluster_means(o.filter("cluster_id = 'cluster_004'")))
query(
    "location_classify",
    "observations cluster_names",
    f"""SELECT p.observation_id, coalesce(b, 'review') AS location, CASE WHEN b IS NULL THEN 'review' ELSE 'known' END AS status FROM (SELECT observation_id, gps_latitude AS latitude, gps_longitude AS longitude FROM observations) p
    LEFT JOIN (SELECT p.observation_id, arg_min(s.site, ({KM}, s.site)) AS b FROM (SELECT observation_id, gps_latitude AS latitude, gps_longitude AS longitude FROM observations) p JOIN sites s ON {KM} <= 1 GROUP BY 1) m ON p.observation_id = m.observation_id""",
    more=SITES,
)(lambda o, n: s.location_classify(o.select("observation_id", F.col("gps_latitude").alias("latitude"), F.col("gps_longitude").alias("longitude")), _sites(o, n), 1.0, "observation_id"))
query("haversine_m", "points", f"SELECT seq, round({KM} * 1000, 6) AS m FROM points p, (SELECT 59.0e0 AS latitude, 18.0e0 AS longitude) s")(lambda p: p.select("seq", F.round(geo.haversine_m(F.col("latitude"), F.col("longitude"), F.lit(59.0), F.lit(18.0)), 6).alias("m")))
MORE = (("cluster_001", "North gate"), ("cluster_016", "Ridge"), ("cluster_020", "Ford"))
with_clusters("batch_name_clusters", f"SELECT c.cluster_id, n AS new_name FROM clusters c JOIN (VALUES {', '.join(map(str, MORE))}) u(i, n) ON c.cluster_id = i")(
    lambda o, c: s.name_clusters(c, c.sparkSession.createDataFrame(list(MORE), "cluster_id string, new_name string")).filter("touched").select("cluster_id", F.col("cluster_name").alias("new_name"))
)
