"""Clusters of places: leader clustering, hulls, boxes, overlap, merging and names."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklore.functions.geo import EARTH_M, haversine_m, mean_place, ring_area_m2, ring_perimeter_m
from tracklore.operators.graph import first_free, numbered, stored
from tracklore.operators.leaders import leader_clusters
from tracklore.operators.joins import lon_cell, proximity
from tracklore.operators.reports import count_true, mean


def centres(clustered: DataFrame) -> DataFrame:
    """cluster, latitude, longitude and point_count of the result of leader_clusters: what a later run starts from."""
    latitude, longitude = mean_place("latitude", "longitude")
    return clustered.groupBy("cluster").agg(latitude.alias("latitude"), longitude.alias("longitude"), F.count("*").alias("point_count"))


def batch_stats(points: DataFrame, done: DataFrame, radius: float = 5.0) -> DataFrame:
    """Counts of a run over points of which ``done`` are assigned already: those are skipped, but their clusters are there for
    the others to join; rows without place or id are errors."""
    todo = points.join(done.select("seq"), "seq", "left_anti")
    old = stored(centres(leader_clusters(done, radius)))
    clustered = leader_clusters(todo, radius, old)
    made = clustered.join(old.select("cluster", F.lit(1).alias("old")), "cluster", "left").agg(F.count("*").alias("clustered"), F.countDistinct(F.when(F.col("old").isNull(), F.col("cluster"))).alias("new_clusters"))
    bad = F.col("latitude").isNull() | F.col("longitude").isNull() | F.col("seq").isNull()
    return todo.agg(F.count("*").alias("processed"), count_true(bad).alias("errors")).join(F.broadcast(made))


def process_observations(obs: DataFrame, radius: float = 5.0) -> DataFrame:
    """Clusters of observations: centre and number of points."""
    p = leader_clusters(obs.select("seq", F.col("gps_latitude").alias("latitude"), F.col("gps_longitude").alias("longitude")), radius)
    return centres(p).select("cluster", F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"), "point_count")


def assignments(clustered: DataFrame) -> DataFrame:
    """Each point with its distance to its cluster's centre."""
    centre = centres(clustered).select("cluster", F.col("latitude").alias("la"), F.col("longitude").alias("lo"))
    return clustered.join(centre, "cluster").select("seq", "cluster", F.round(haversine_m(F.col("latitude"), F.col("longitude"), F.col("la"), F.col("lo")), 6).alias("distance_m"))


def cell_clusters(points: DataFrame, step: float = 0.0001) -> DataFrame:
    """A plain alternative: one cluster per grid cell."""
    return points.groupBy(F.floor(F.col("latitude") / step).alias("r"), F.floor(F.col("longitude") / step).alias("c")).agg(F.count("*").alias("n"), mean("latitude").alias("latitude"), mean("longitude").alias("longitude"))


#: Degrees (a tenth of a micrometre) by which a point may lie off a side and still be on it: what doubles cannot tell.
ON_SIDE = 1e-12


def _hull(rows: pd.DataFrame) -> list[tuple[float, float]]:
    """Convex hull by monotone chains, counter-clockwise in (longitude, latitude), from the least point; points on a side are no corners."""
    pts = sorted(set(zip(rows["longitude"], rows["latitude"], strict=True)))
    if len(pts) < 3:
        return pts
    chains = []
    for order in (pts, pts[::-1]):
        chain: list[tuple[float, float]] = []
        for x, y in order:
            while len(chain) > 1:
                (ax, ay), (bx, by) = chain[-2:]
                if (bx - ax) * (y - ay) - (by - ay) * (x - ax) > ON_SIDE * (abs(x - ax) + abs(y - ay)):
                    break
                chain.pop()
            chain.append((x, y))
        chains += chain[:-1]
    return chains


def convex_hull(points: DataFrame, salts: int = 32) -> DataFrame:
    """cluster_id and ring (array of lat, lon). The hull of parts' hulls is the hull, so a large cluster is split by salt first."""

    def part(rows: pd.DataFrame) -> pd.DataFrame:
        hull = _hull(rows)
        return pd.DataFrame({"cluster_id": [rows["cluster_id"].iloc[0]] * len(hull), "latitude": [p[1] for p in hull], "longitude": [p[0] for p in hull]})

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"cluster_id": [rows["cluster_id"].iloc[0]], "ring": [[{"lat": p[1], "lon": p[0]} for p in _hull(rows)]]})

    p = points.filter("latitude IS NOT NULL AND longitude IS NOT NULL").select("cluster_id", "latitude", "longitude").distinct()
    parts = p.groupBy("cluster_id", F.pmod(F.xxhash64("latitude", "longitude"), F.lit(salts)).alias("salt")).applyInPandas(lambda g: part(g), "cluster_id string, latitude double, longitude double")
    return parts.groupBy("cluster_id").applyInPandas(lambda g: whole(g), "cluster_id string, ring array<struct<lat:double,lon:double>>")


def boundary_box(points: DataFrame) -> DataFrame:
    """Least and greatest coordinates, and the first point at each extreme."""
    ends = {"south": ("latitude", 1), "north": ("latitude", -1), "west": ("longitude", 1), "east": ("longitude", -1)}
    return points.filter("latitude IS NOT NULL AND longitude IS NOT NULL").groupBy("cluster_id").agg(
        F.min("latitude").alias("min_lat"), F.max("latitude").alias("max_lat"), F.min("longitude").alias("min_lon"), F.max("longitude").alias("max_lon"),
        *[F.min_by("id", F.struct(F.col(c) * sign, F.col("id"))).alias(name) for name, (c, sign) in ends.items()],
    )


def box_ring() -> Column:
    corner = lambda a, b: F.struct(F.col(a).alias("lat"), F.col(b).alias("lon"))
    return F.array(corner("min_lat", "min_lon"), corner("min_lat", "max_lon"), corner("max_lat", "max_lon"), corner("max_lat", "min_lon"))


def boundaries(points: DataFrame, clusters: DataFrame) -> DataFrame:
    """Hull, area and perimeter with each cluster's name, points and times."""
    hulls = convex_hull(points).select("cluster_id", F.size("ring").alias("corners"), F.round(ring_area_m2(F.col("ring")), 3).alias("area_m2"), F.round(ring_perimeter_m(F.col("ring")), 3).alias("perimeter_m"))
    return clusters.select("cluster_id", "cluster_name", "is_named", "point_count", "first_seen", "last_seen").join(hulls, "cluster_id", "left")


def overlap_pairs(clusters: DataFrame, metres: float = 10.0) -> DataFrame:
    """Pairs of centres within the distance, smaller id first; a grid, which goes on over the date line, makes it an equi join."""
    step = metres * 1.000001 / (EARTH_M * math.pi / 180)
    row = F.floor(F.col("center_latitude") / step)
    c = clusters.select("cluster_id", F.col("center_latitude").alias("la"), F.col("center_longitude").alias("lo"), row.alias("r"))
    left = c.select(F.col("cluster_id").alias("a"), F.col("la").alias("la1"), F.col("lo").alias("lo1"), "r", lon_cell(F.col("lo"), F.col("r"), step).alias("k"))
    near = c.withColumn("r", F.explode(F.array(*[F.col("r") + i for i in (-1, 0, 1)])))
    near = near.select(F.col("cluster_id").alias("b"), F.col("la").alias("la2"), F.col("lo").alias("lo2"), "r", F.explode(F.array_distinct(F.array(*[lon_cell(F.col("lo"), F.col("r"), step, d) for d in (-1, 0, 1)]))).alias("k"))
    distance = haversine_m(F.col("la1"), F.col("lo1"), F.col("la2"), F.col("lo2"))
    return left.join(near, ["r", "k"]).filter("a < b").withColumn("d", distance).filter(F.col("d") <= metres).select("a", "b", F.round("d", 6).alias("distance_m"))


def overlap_groups(clusters: DataFrame, metres: float = 10.0) -> DataFrame:
    """Groups in order of id: the first cluster not yet taken leads, and takes all free clusters near it.

    A cluster is taken if one before it, near it, is not: the others lead. A taken one belongs to the first leader near it.
    """
    pairs = stored(overlap_pairs(clusters, metres))
    leads = first_free(pairs.select("a", "b")).filter("free").select(F.col("node").alias("a"))
    own = pairs.join(leads, "a").join(leads.withColumnRenamed("a", "b"), "b", "left_anti")
    taken = own.groupBy("b").agg(F.min(F.struct("a", "distance_m")).alias("first")).select("b", "first.a", "first.distance_m")
    return taken.groupBy(F.col("a").alias("leader")).agg(
        F.array_join(F.array_sort(F.collect_list("b")), ",").alias("members"), (F.count("*") + 1).alias("size"), F.min("distance_m").alias("overlap_distance_m")
    )


def unknown_clusters(obs: DataFrame, clusters: DataFrame, samples: int = 5) -> DataFrame:
    """Unnamed clusters, most points first, with their first observation ids."""
    first = Window.partitionBy("cluster_id").orderBy("timestamp", "observation_id")
    ids = obs.filter("gps_latitude IS NOT NULL AND gps_longitude IS NOT NULL").withColumn("k", F.row_number().over(first)).filter(F.col("k") <= samples)
    ids = ids.groupBy("cluster_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "observation_id"))), lambda x: x["observation_id"]), ",").alias("sample_ids"))
    return clusters.filter(~F.col("is_named")).select("cluster_id", "point_count", "first_seen", "last_seen").join(ids, "cluster_id", "left").orderBy(F.desc("point_count"), "cluster_id")


def unknown_labels(clusters: DataFrame) -> DataFrame:
    """Generated names by rank among the unnamed clusters, most points first."""
    ranked = numbered(clusters.filter(~F.col("is_named")).select("cluster_id", "point_count"), F.desc("point_count"), F.asc("cluster_id"))
    return ranked.select("cluster_id", F.concat(F.lit("Unknown_Cluster_"), "n").alias("generated_name"), F.lit(True).alias("labeling_required"))


def name_clusters(clusters: DataFrame, updates: DataFrame) -> DataFrame:
    """updates(cluster_id, new_name): the table with names set, and which rows were touched."""
    return clusters.join(updates, "cluster_id", "left").select("cluster_id", F.coalesce("new_name", "cluster_name").alias("cluster_name"), F.coalesce("new_name", "cluster_name").isNotNull().alias("is_named"), F.col("new_name").isNotNull().alias("touched"))


def merge_clusters(points: DataFrame, ids: list[str], into: str) -> DataFrame:
    """Clusters after the given ones are made one: at least two of them must have points, else nothing changes."""
    there = points.filter(F.col("cluster_id").isin(ids)).agg(F.countDistinct("cluster_id").alias("n"))
    moved = points.join(F.broadcast(there)).withColumn("cluster_id", F.when((F.col("n") >= 2) & F.col("cluster_id").isin(ids), F.lit(into)).otherwise(F.col("cluster_id")))
    return moved.groupBy("cluster_id").agg(mean("latitude").alias("latitude"), mean("longitude").alias("longitude"), F.count("*").alias("point_count"))


def analysis_output(clusters: DataFrame) -> DataFrame:
    """Named clusters by name, the others under generated names."""
    named = clusters.filter("is_named").select("cluster_id", F.col("cluster_name").alias("name"), F.lit(False).alias("labeling_required"))
    return named.unionByName(unknown_labels(clusters).withColumnRenamed("generated_name", "name"))


def location_classify(points: DataFrame, known: DataFrame, radius_km: float, key: str) -> DataFrame:
    """The nearest known location within the radius, else for review."""
    near = proximity(points, known, radius_km, key, "site")
    return near.select(key, F.coalesce("near_site", F.lit("review")).alias("location"), F.when(F.col("near_site").isNull(), "review").otherwise("known").alias("status"))
