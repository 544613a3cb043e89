"""Join queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tracklore.functions.geo import within
from tracklore.operators import joins as j
from tracklore.operators import reports as r
from tracklore.operators.graph import shared_folder
from tracklore.operators.history import History
from tracklore.plans.registry import query
from tracklore.plans.views import LAST_MANIFEST

NAMED = "observations cluster_names"
query("enrich_cluster_names", NAMED, "SELECT o.observation_id, o.cluster_id, coalesce(n.cluster_name, o.cluster_id) AS cluster_name FROM observations o LEFT JOIN cluster_names n ON o.cluster_id = n.cluster_id")(lambda o, n: r.enrich_cluster_names(o.select("observation_id", "cluster_id"), n))
query("enrich_names_records", NAMED, "SELECT o.camera_id, coalesce(n.cluster_name, o.cluster_id) AS cluster_name, count(*) AS n FROM observations o LEFT JOIN cluster_names n ON o.cluster_id = n.cluster_id GROUP BY ALL")(lambda o, n: r.enrich_cluster_names(o.select("camera_id", "cluster_id"), n).groupBy("camera_id", "cluster_name").agg(F.count("*").alias("n")))
MEANS = "means AS (SELECT cluster_id, round(avg(gps_latitude), 9) AS mean_latitude, round(avg(gps_longitude), 9) AS mean_longitude FROM observations WHERE gps_latitude IS NOT NULL AND gps_longitude IS NOT NULL GROUP BY 1)"
query("enrich_names_and_means", NAMED, "SELECT o.observation_id, o.cluster_id, coalesce(n.cluster_name, o.cluster_id) AS cluster_name, mean_latitude, mean_longitude FROM observations o LEFT JOIN cluster_names n ON o.cluster_id = n.cluster_id LEFT JOIN means m ON o.cluster_id = m.cluster_id", more=MEANS)(
    lambda o, n: j.names_and_means(o.select("observation_id", "cluster_id"), n, r.cluster_means(o))
)
PARTS = "manifest predictions"
TWICE = "twice AS (SELECT crop_path, label, confidence, 1 AS seq FROM predictions UNION ALL SELECT crop_path, 'fox', confidence / 2, 2 FROM predictions WHERE label = 'boar')"


def _twice(p):
    """Predictions, some of them given twice; the second is later."""
    first = p.select("crop_path", "label", "confidence", F.lit(1).alias("seq"), "place")
    return first.unionByName(p.filter("label = 'boar'").select("crop_path", F.lit("fox").alias("label"), (F.col("confidence") / 2).alias("confidence"), F.lit(2).alias("seq"), "place"))


LAST = "(SELECT * FROM twice QUALIFY row_number() OVER (PARTITION BY crop_path ORDER BY seq DESC) = 1)"
query("materialize_left_join", PARTS, f"SELECT m.crop_path, m.camera_id, m.timestamp, p.label, p.confidence FROM manifest m LEFT JOIN {LAST} p ON m.crop_path = p.crop_path", more=TWICE, reads="manifest placed_predictions")(
    lambda m, p: j.materialize_left_join(m.select("crop_path", "camera_id", "timestamp"), _twice(p), "place")
)
query("upsert_last_wins", "predictions", f"SELECT crop_path, label, confidence, seq FROM {LAST}", more=TWICE, reads="placed_predictions")(lambda p: j.last_wins(_twice(p), "crop_path", "seq", "place"))
query("stage3_inner_join", PARTS, f"SELECT m.crop_path, m.camera_id, m.timestamp, p.label, p.confidence FROM {LAST_MANIFEST} m JOIN predictions p ON m.crop_path = p.crop_path WHERE p.confidence >= 0.5 AND m.timestamp IS NOT NULL")(
    lambda m, p: j.stage3_inner_join(m.select("crop_path", "camera_id", "timestamp", "seq"), p, seq="seq").select("crop_path", "camera_id", "timestamp", "label", "confidence")
)
BOTH = "observations detections"
CHILD = "(SELECT event_id AS observation_id, label, confidence FROM detections WHERE confidence IS NOT NULL)"


def _child(d):
    return d.filter("confidence IS NOT NULL").select(F.col("event_id").alias("observation_id"), "label", "confidence")


def _number_free(df):
    """JSON numbers are written differently by engines: publish labels in the list's order."""
    labels = F.transform(F.from_json("detections", "array<struct<confidence:double,label:string>>"), lambda x: x["label"])
    return df.withColumn("labels", F.array_join(labels, ",")).drop("detections")


query("detections_nested", BOTH, f"SELECT o.observation_id, o.camera_id, o.timestamp, coalesce(n, 0) AS n, coalesce(labels, '') AS labels FROM observations o LEFT JOIN (SELECT observation_id, count(*) AS n, string_agg(label, ',' ORDER BY confidence, label) AS labels FROM {CHILD} GROUP BY 1) c ON o.observation_id = c.observation_id")(
    lambda o, d: _number_free(j.detections_nested(o.select("observation_id", "camera_id", "timestamp"), _child(d)))
)
query("detections_by_species", BOTH, f"SELECT o.observation_id, o.camera_id, n, best FROM observations o JOIN (SELECT observation_id, count(*) AS n, max(confidence) AS best FROM {CHILD} WHERE label = 'moose' GROUP BY 1) c ON o.observation_id = c.observation_id")(lambda o, d: j.detections_by_species(o.select("observation_id", "camera_id"), _child(d), "moose"))
query("detections_flat_export", BOTH, "SELECT o.observation_id, o.timestamp, d.detection_id, d.label, d.confidence FROM observations o LEFT JOIN detections d ON o.observation_id = d.event_id")(
    lambda o, d: o.select("observation_id", "timestamp").join(d.select(F.col("event_id").alias("observation_id"), "detection_id", "label", "confidence"), "observation_id", "left")
)
query("detections_with_gps", BOTH, "SELECT o.observation_id, o.gps_latitude, o.gps_longitude, count(d.detection_id) AS n FROM observations o LEFT JOIN detections d ON o.observation_id = d.event_id WHERE gps_latitude IS NOT NULL AND gps_longitude IS NOT NULL GROUP BY ALL")(
    lambda o, d: r.with_gps(o).select("observation_id", "gps_latitude", "gps_longitude").join(d.groupBy(F.col("event_id").alias("observation_id")).agg(F.count("detection_id").alias("n")), "observation_id", "left").na.fill(0, ["n"])
)
query("weather_with_camera_count", "weather observations", "SELECT count(*) AS n FROM weather WHERE cluster_id IN (SELECT cluster_id FROM observations WHERE camera_id IS NOT NULL)")(j.weather_with_camera_count)
query("unknown_clusters_from_data", NAMED, "SELECT DISTINCT cluster_id FROM observations WHERE cluster_id NOT IN (SELECT cluster_id FROM cluster_names)")(j.unknown_ids)
DONE = "SELECT observation_id FROM observations WHERE NOT needs_review"


def _history(o):
    """What two earlier runs have done."""
    found = History(o.sparkSession, f"{shared_folder(o.sparkSession)}/history/{uuid.uuid4().hex}", "observation_id", buckets=8)
    for part in ("seq % 3 = 0", "seq % 3 > 0"):
        found.remember(o.filter(f"NOT needs_review AND {part}"))
    return found


query("skip_already_assigned", "observations", f"SELECT observation_id, cluster_id FROM observations WHERE observation_id NOT IN ({DONE})")(lambda o: _history(o).not_yet(o.select("observation_id", "cluster_id")))
query("skip_already_enriched", "observations", f"SELECT count(*) FILTER (observation_id IN ({DONE})) AS already, count(*) FILTER (observation_id NOT IN ({DONE})) AS pending FROM observations")(lambda o: _history(o).counts(o.select("observation_id")))
READINGS = "readings AS (SELECT cluster_id, wid, temp_c, precip_mm, cast('2024-01-01 00:00:00' AS timestamp) + to_hours(cast(hour_offset AS int)) AS at FROM weather)"


def _readings(w):
    return w.select("cluster_id", "wid", "temp_c", "precip_mm", F.expr("cast('2024-01-01 00:00:00' AS timestamp_ntz) + make_dt_interval(0, cast(hour_offset AS int), 0, 0)").alias("at"))


def _nearest(o, w):
    return j.asof_nearest(o.select("observation_id", "cluster_id", "timestamp"), _readings(w), "cluster_id", "timestamp", "at", ["wid", "temp_c"], "wid")


NEAREST = "SELECT o.observation_id, o.cluster_id, o.timestamp, arg_min(struct_pack(a := r.at, w := r.wid, t := r.temp_c), (abs(epoch_us(o.timestamp) - epoch_us(r.at)), r.at, r.wid)) AS b FROM observations o LEFT JOIN readings r ON o.cluster_id = r.cluster_id GROUP BY ALL"
query("asof_nearest_weather", "observations weather", f"SELECT observation_id, cluster_id, timestamp, b.a AS at_matched, b.w AS wid, b.t AS temp_c FROM ({NEAREST})", more=READINGS)(_nearest)
query(
    "asof_cached_weather",
    "observations weather",
    f"SELECT observation_id, cluster_id, timestamp, b.a AS at_matched, b.w AS wid, b.t AS temp_c FROM ({NEAREST.replace('o.cluster_id = r.cluster_id', 'o.cluster_id = r.cluster_id AND r.at >= cast(\'2024-01-16 00:00:00\' AS timestamp)')})",
    more=READINGS,
)(lambda o, w: _nearest(o, w.filter("hour_offset >= 360")))
SITES = "sites AS (SELECT cluster_id AS site, round(avg(gps_latitude), 9) AS latitude, round(avg(gps_longitude), 9) AS longitude FROM observations WHERE gps_latitude IS NOT NULL AND cluster_id IN (SELECT cluster_id FROM cluster_names) GROUP BY 1)"
POINTS = "(SELECT observation_id, gps_latitude AS latitude, gps_longitude AS longitude FROM observations)"
KM = "2 * asin(least(sqrt(pow(sin(radians(s.latitude - p.latitude) / 2), 2) + cos(radians(p.latitude)) * cos(radians(s.latitude)) * pow(sin(radians(s.longitude - p.longitude) / 2), 2)), 1.0e0)) * 6371.0e0"


def _sites(o, n):
    """Known sites are the clusters with a name."""
    return r.cluster_means(o).join(n, "cluster_id", "left_semi").select(F.col("cluster_id").alias("site"), "latitude", "longitude")


def _near(o, n, km):
    return j.proximity(o.select("observation_id", F.col("gps_latitude").alias("latitude"), F.col("gps_longitude").alias("longitude")), _sites(o, n), km, "observation_id", "site")


PROBE = f"SELECT p.observation_id, p.latitude, p.longitude, b.s AS near_site, round(b.d, 6) AS distance_km FROM {POINTS} p LEFT JOIN (SELECT p.observation_id, arg_min(struct_pack(s := s.site, d := {KM}), ({KM}, s.site)) AS b FROM {POINTS} p JOIN sites s ON {KM} <= {{0}} GROUP BY 1) m ON p.observation_id = m.observation_id"
query("proximity_weather_join", NAMED, PROBE.format("10"), more=SITES)(lambda o, n: _near(o, n, 10.0))
query("proximity_probe", NAMED, f"SELECT observation_id, near_site IS NOT NULL AS found, near_site, round(distance_km, 2) AS distance_km FROM ({PROBE.format('0.5')})", more=SITES)(
    lambda o, n: _near(o, n, 0.5).select("observation_id", F.col("near_site").isNotNull().alias("found"), "near_site", F.round("distance_km", 2).alias("distance_km"))
)
query("proximity_then_exact_then_miss", NAMED, f"SELECT CASE WHEN near_site IS NOT NULL THEN 'proximity' WHEN observation_id IN (SELECT observation_id FROM observations WHERE needs_review) THEN 'exact' ELSE 'miss' END AS source, count(*) AS n FROM ({PROBE.format('0.5')}) GROUP BY 1", more=SITES)(
    lambda o, n: j.proximity_then_exact_then_miss(_near(o, n, 0.5), o.filter("needs_review"), "observation_id", "site")
)
query("is_within_proximity", "observations", f"SELECT p.observation_id, {KM} <= 30 AS near FROM {POINTS} p, (SELECT 59.0e0 AS latitude, 18.0e0 AS longitude) s")(
    lambda o: o.select("observation_id", within(F.col("gps_latitude"), F.col("gps_longitude"), F.lit(59.0), F.lit(18.0), 30).alias("near"))
)
VALID = "o.camera_id = c.camera_id AND c.effective_from <= cast(o.timestamp AS timestamp) AND (c.effective_to IS NULL OR cast(o.timestamp AS timestamp) <= c.effective_to)"
SCD = "SELECT o.{row}, o.{by}, o.timestamp, {cols} FROM observations o LEFT JOIN {versions} c ON {valid} QUALIFY row_number() OVER (PARTITION BY o.{row} ORDER BY c.created_seq DESC NULLS LAST) = 1"
query("scd2_exif_correction", "observations exif_corrections", SCD.format(row="observation_id", by="camera_id", cols="c.correction_id, c.delta_seconds", versions="exif_corrections", valid=VALID))(
    lambda o, c: j.scd2(o.select("observation_id", "camera_id", "timestamp"), c, "camera_id", "timestamp", ["correction_id", "delta_seconds"], "observation_id")
)
SERIALS = "serials AS (SELECT camera_id, concat('sn_', correction_id) AS physical_serial, effective_from, effective_to, created_seq, rule_id AS map_version FROM exif_corrections)"


def _serials(c):
    return c.select("camera_id", F.concat(F.lit("sn_"), "correction_id").alias("physical_serial"), "effective_from", "effective_to", "created_seq", F.col("rule_id").alias("map_version"))


query("scd2_serial_for_camera", "observations exif_corrections", SCD.format(row="observation_id", by="camera_id", cols="c.physical_serial", versions="serials", valid=VALID), more=SERIALS)(
    lambda o, c: j.scd2(o.select("observation_id", "camera_id", "timestamp"), _serials(c), "camera_id", "timestamp", ["physical_serial"], "observation_id")
)
query("scd2_mapping_info", "observations exif_corrections", SCD.format(row="observation_id", by="camera_id", cols="c.physical_serial, c.map_version", versions="serials", valid=VALID), more=SERIALS)(
    lambda o, c: j.scd2(o.select("observation_id", "camera_id", "timestamp"), _serials(c), "camera_id", "timestamp", ["physical_serial", "map_version"], "observation_id")
)
query(
    "scd2_camera_id_for_serial",
    "observations exif_corrections",
    "SELECT o.observation_id, o.physical_serial, o.timestamp, c.camera_id FROM (SELECT observation_id, concat('sn_corr_', seq % 25) AS physical_serial, timestamp FROM observations) o LEFT JOIN serials c ON o.physical_serial = c.physical_serial AND c.effective_from <= cast(o.timestamp AS timestamp) AND (c.effective_to IS NULL OR cast(o.timestamp AS timestamp) <= c.effective_to) QUALIFY row_number() OVER (PARTITION BY o.observation_id ORDER BY c.created_seq DESC NULLS LAST) = 1",
    more=SERIALS,
)(lambda o, c: j.scd2(o.select("observation_id", F.concat(F.lit("sn_corr_"), F.col("seq") % 25).alias("physical_serial"), "timestamp"), _serials(c), "physical_serial", "timestamp", ["camera_id"], "observation_id"))
AT = "cast('2024-01-08 12:00:00' AS timestamp)"
query("active_cameras_at", "exif_corrections", f"SELECT camera_id, correction_id, effective_from, effective_to FROM exif_corrections WHERE effective_from <= {AT} AND (effective_to IS NULL OR {AT} <= effective_to)")(lambda c: j.active_at(c.select("camera_id", "correction_id", "effective_from", "effective_to"), F.expr(AT)))
query("latest_version_pick", "exif_corrections", "SELECT camera_id, correction_id, created_seq FROM exif_corrections QUALIFY row_number() OVER (PARTITION BY camera_id ORDER BY created_seq DESC, correction_id) = 1")(lambda c: j.last_wins(c.select("camera_id", "correction_id", "created_seq"), "camera_id", "created_seq"))
query("cluster_weather", NAMED + " weather", "SELECT r.cluster_id, r.wid, r.at, r.temp_c FROM readings r WHERE r.cluster_id IN (SELECT cluster_id FROM cluster_names) AND r.at BETWEEN cast('2024-01-05 00:00:00' AS timestamp) AND cast('2024-01-07 23:59:59' AS timestamp)", more=READINGS)(
    lambda o, n, w: _readings(w).filter("at BETWEEN timestamp_ntz'2024-01-05 00:00:00' AND timestamp_ntz'2024-01-07 23:59:59'").join(n, "cluster_id", "left_semi").select("cluster_id", "wid", "at", "temp_c")
)
