"""Report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklore.operators import reports as r
from tracklore.plans.registry import query

OBS = "observations"
NU = "count(DISTINCT {0}) + coalesce(max(CASE WHEN {0} IS NULL THEN 1 ELSE 0 END), 0)"
LABELS, CAMERAS = NU.format("top_label"), NU.format("camera_id")
GPS = "gps_latitude IS NOT NULL AND gps_longitude IS NOT NULL"
PLACES = "round(avg(gps_latitude), 9) AS avg_latitude, round(avg(gps_longitude), 9) AS avg_longitude, round(stddev_samp(gps_latitude), 9) AS lat_std, round(stddev_samp(gps_longitude), 9) AS lon_std"
CLUSTERS = f"""clusters AS (SELECT c.*, n.cluster_name, n.cluster_name IS NOT NULL AS is_named FROM (
 SELECT cluster_id, round(avg(gps_latitude), 9) AS center_latitude, round(avg(gps_longitude), 9) AS center_longitude, count(*) AS point_count, min(timestamp) AS first_seen, max(timestamp) AS last_seen
 FROM observations WHERE {GPS} GROUP BY cluster_id) c LEFT JOIN cluster_names n ON c.cluster_id = n.cluster_id)"""
SECONDS = "(epoch_us({1}) - epoch_us({0})) / 1000000.0"
PCT = "round(CASE WHEN {1} > 0 THEN cast({0} AS double) * cast(100 AS double) / {1} ELSE cast(0 AS double) END, 6)"

query("species_counts", OBS, "SELECT top_label, count(observation_id) AS total_detections, round(avg(top_confidence), 9) AS avg_confidence, max(top_confidence) AS max_confidence, min(top_confidence) AS min_confidence, count(*) FILTER (needs_review) AS needs_review_count FROM observations GROUP BY top_label")(r.species_counts)
query("camera_activity", OBS, f"SELECT camera_id, count(*) AS total_observations, min(timestamp) AS first_observation, max(timestamp) AS last_observation, {LABELS} AS unique_species FROM observations GROUP BY camera_id")(r.camera_activity)
query("daily_species", OBS, "SELECT cast(timestamp AS date) AS date, top_label, count(*) AS daily_count, round(avg(top_confidence), 9) AS avg_confidence FROM observations GROUP BY ALL")(r.daily_species)
query("gps_by_species", OBS, f"SELECT top_label, {PLACES} FROM observations WHERE {GPS} GROUP BY top_label")(r.gps_by_species)
query("species_summary", OBS, f"SELECT count(*) AS total_observations, {LABELS} AS unique_species, {CAMERAS} AS unique_cameras, min(timestamp) AS first, max(timestamp) AS last FROM observations")(r.species_summary)
query(
    "camera_metrics",
    OBS,
    f"""SELECT *, round({SECONDS.format("first_activity", "last_activity")}, 3) AS active_seconds, round(review_count / total_observations, 9) AS review_rate FROM (
    SELECT camera_id, count(*) AS total_observations, {LABELS} AS species_diversity, round(avg(top_confidence), 9) AS avg_confidence, count(*) FILTER (needs_review) AS review_count, min(timestamp) AS first_activity, max(timestamp) AS last_activity FROM observations GROUP BY camera_id)""",
)(r.camera_metrics)
query("species_per_camera", OBS, "SELECT camera_id, top_label, count(*) AS species_count, round(avg(top_confidence), 9) AS avg_confidence FROM observations GROUP BY ALL")(r.species_per_camera)
query("camera_hourly", OBS, "SELECT camera_id, cast(hour(timestamp) AS int) AS hour, count(*) AS hourly_count FROM observations GROUP BY ALL")(r.camera_hourly)
query("activity_by_window", OBS, f"SELECT date_trunc('hour', timestamp) AS time_window, count(*) AS observation_count, {LABELS} AS unique_species, {CAMERAS} AS active_cameras, round(avg(top_confidence), 9) AS avg_confidence FROM observations GROUP BY 1")(r.activity_by_window)
query("hourly_patterns", OBS, f"SELECT cast(hour(timestamp) AS int) AS hour, count(*) AS observation_count, {LABELS} AS unique_species, {CAMERAS} AS active_cameras FROM observations GROUP BY 1")(r.hourly_patterns)
query("weekly_patterns", OBS, f"SELECT cast(isodow(timestamp) AS int) AS weekday, count(*) AS observation_count, {LABELS} AS unique_species, {CAMERAS} AS active_cameras FROM observations GROUP BY 1")(r.weekly_patterns)
query("spatial_by_species", OBS, f"SELECT top_label, {PLACES}, count(*) AS observation_count FROM observations WHERE {GPS} GROUP BY top_label")(r.spatial_by_species)
query("camera_locations", OBS, f"SELECT camera_id, {PLACES}, count(*) AS observation_count FROM observations WHERE {GPS} GROUP BY camera_id")(r.camera_locations)
query("spatial_grid_clusters", OBS, f"SELECT cast(round(gps_latitude * cast(100 AS double)) AS bigint) AS lat_cell, cast(round(gps_longitude * cast(100 AS double)) AS bigint) AS lon_cell, count(*) AS cluster_size, {LABELS} AS unique_species, {CAMERAS} AS unique_cameras FROM observations WHERE {GPS} GROUP BY 1, 2")(r.spatial_grid_clusters)
query("gps_coverage", OBS, f"SELECT *, {PCT.format('observations_with_gps', 'total_observations')} AS coverage_percent FROM (SELECT count(*) FILTER ({GPS}) AS observations_with_gps, count(*) AS total_observations FROM observations)")(r.gps_coverage)
query(
    "full_report",
    OBS,
    " UNION ALL ".join(
        f"SELECT '{name}' AS report, {key} AS key, count(*) AS n, round(avg(top_confidence), 9) AS avg_confidence FROM observations GROUP BY {key}"
        for name, key in (("species", "top_label"), ("camera", "camera_id"), ("temporal", "cast(hour(timestamp) AS varchar)"), ("spatial", f"CASE WHEN {GPS} THEN 'gps' ELSE 'no gps' END"))
    ),
)(r.full_report)

NAMED = "observations cluster_names"
JOIN = "LEFT JOIN cluster_names n ON o.cluster_id = n.cluster_id"
NAME = "coalesce(n.cluster_name, o.cluster_id) AS cluster_name"
query("cluster_species_report", NAMED, f"SELECT o.cluster_id, {NAME}, top_label, count(*) AS observation_count, round(avg(top_confidence), 9) AS avg_confidence, min(timestamp) AS first_seen, max(timestamp) AS last_seen FROM observations o {JOIN} GROUP BY ALL")(r.cluster_species_report)
query("cluster_species_summary", OBS, "SELECT count(DISTINCT cluster_id) AS clusters, count(DISTINCT top_label) AS species, count(*) AS observations FROM observations")(r.cluster_species_summary)
query("cluster_temporal", NAMED, f"SELECT o.cluster_id, {NAME}, cast(timestamp AS date) AS date, cast(hour(timestamp) AS int) AS hour, count(*) AS observation_count, {LABELS} AS unique_species FROM observations o {JOIN} GROUP BY ALL")(r.cluster_temporal)
query("cluster_temporal_summary", OBS, "SELECT min(cast(timestamp AS date)) AS first_date, max(cast(timestamp AS date)) AS last_date, count(*) AS observations, count(DISTINCT cluster_id) AS clusters FROM observations")(r.cluster_temporal_summary)
MODES = "(SELECT cluster_id, string_agg(cast(v AS varchar), ',' ORDER BY v) AS {1} FROM (SELECT cluster_id, {0} AS v, count(*) AS c FROM observations GROUP BY cluster_id, {0} QUALIFY rank() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC) = 1) GROUP BY cluster_id)"
query(
    "cluster_activity",
    NAMED,
    f"""SELECT o.*, coalesce(n.cluster_name, o.cluster_id) AS cluster_name, peak_hours, peak_weekdays FROM (SELECT cluster_id, count(*) AS total_observations, {LABELS} AS unique_species, min(timestamp) AS first_activity, max(timestamp) AS last_activity FROM observations GROUP BY cluster_id) o
    JOIN {MODES.format("hour(timestamp)", "peak_hours")} h ON o.cluster_id = h.cluster_id JOIN {MODES.format("isodow(timestamp)", "peak_weekdays")} d ON o.cluster_id = d.cluster_id {JOIN}""",
)(r.cluster_activity)
query(
    "cluster_activity_summary",
    NAMED,
    f"SELECT clusters, observations, coalesce(n.cluster_name, o.cluster_id) AS most_active_cluster FROM (SELECT count(*) AS clusters, cast(sum(c) AS bigint) AS observations, arg_max(cluster_id, (c, cluster_id)) AS cluster_id FROM (SELECT cluster_id, count(*) AS c FROM observations GROUP BY cluster_id)) o {JOIN}",
)(r.cluster_activity_summary)
query("cluster_summary", NAMED, "SELECT count(*) AS total_observations, count(DISTINCT o.cluster_id) AS clusters, count(DISTINCT n.cluster_id) AS named_clusters, count(DISTINCT o.cluster_id) - count(DISTINCT n.cluster_id) AS unnamed_clusters FROM observations o LEFT JOIN cluster_names n ON o.cluster_id = n.cluster_id")(r.cluster_summary)
query("cluster_report", NAMED, f"SELECT o.cluster_id, {NAME}, count(*) AS observation_count, {LABELS} AS unique_species, {PCT.format('count(*)', '(SELECT count(*) FROM observations)')} AS share_percent FROM observations o {JOIN} GROUP BY ALL")(r.cluster_report)
query("example_value_counts", OBS, "SELECT top_label, count(*) AS n, min(gps_latitude) AS lat_min, max(gps_latitude) AS lat_max, min(gps_longitude) AS lon_min, max(gps_longitude) AS lon_max FROM observations GROUP BY 1")(r.value_counts)
query("top10_clusters", OBS, "SELECT cluster_id, count(*) AS observation_count FROM observations GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")(lambda o: r.top_n(o, "cluster_id", 10))
query("top5_active_clusters", OBS, "SELECT cluster_id, count(*) AS observation_count FROM observations GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")(lambda o: r.top_n(o, "cluster_id", 5))
query("top3_stands", OBS, "SELECT camera_id, count(*) AS observation_count FROM observations GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")(lambda o: r.top_n(o, "camera_id", 3))


def with_clusters(name: str, sql: str):
    """A query over the cluster table derived from the views."""
    return lambda f: query(name, NAMED, sql, more=CLUSTERS)(lambda o, n: f(o, r.cluster_table(o, n)))


STATS = "count(*) AS total_clusters, count(*) FILTER (is_named) AS named_clusters, count(*) FILTER (NOT is_named) AS unknown_clusters, cast(sum(point_count) AS bigint) AS total_assignments, round(avg(point_count), 2) AS avg_points_per_cluster"
with_clusters("cluster_statistics", f"SELECT *, {PCT.format('named_clusters', 'total_clusters')} AS naming_rate FROM (SELECT {STATS} FROM clusters)")(lambda o, c: r.cluster_statistics(c))
with_clusters("cluster_analytics", "SELECT count(*) AS total_clusters, count(cluster_name) AS named_clusters, count(*) FILTER (cluster_name IS NULL) AS unnamed_clusters, cast(sum(point_count) AS bigint) AS total_points, round(avg(point_count), 9) AS avg_points FROM clusters")(lambda o, c: r.cluster_analytics(c))
TOTALS = f"SELECT count(*) AS total_clusters, cast(sum(point_count) AS bigint) AS total_points, round(avg(point_count), 9) AS avg_points, {PCT.format('count(*) FILTER (is_named)', 'count(*)')} AS naming_rate FROM clusters"
with_clusters("cluster_activity_patterns", f"SELECT * FROM (SELECT cluster_id, point_count FROM clusters ORDER BY point_count DESC, cluster_id LIMIT 5), ({TOTALS})")(lambda o, c: r.cluster_activity_patterns(c))
SPAN = f"cast(floor({SECONDS.format('first_seen', 'last_seen')} / 86400) AS bigint) AS span_days, round({SECONDS.format('first_seen', 'last_seen')} / 3600, 6) AS span_hours"
with_clusters("cluster_temporal_span", f"SELECT cluster_id, first_seen, last_seen, {SPAN} FROM clusters")(lambda o, c: r.cluster_temporal_span(c))
COVER = f"SELECT count(*) AS total_observations, count(*) FILTER ({GPS}) AS gps_observations FROM observations"
with_clusters("cluster_coverage", f"SELECT *, {PCT.format('gps_observations', 'total_observations')} AS gps_percent, {PCT.format('assignments', 'gps_observations')} AS assignment_percent FROM ({COVER}), (SELECT cast(sum(point_count) AS bigint) AS assignments, round(avg(point_count), 9) AS avg_points FROM clusters)")(r.cluster_coverage)
PROFILE = "SELECT *, cast(ntile(3) OVER (ORDER BY observations, cluster_id) AS int) AS activity FROM (SELECT cluster_id, count(*) AS diversity, cast(sum(c) AS bigint) AS observations, arg_min(top_label, (-c, top_label)) AS dominant_species FROM (SELECT cluster_id, top_label, count(*) AS c FROM observations WHERE top_label IS NOT NULL GROUP BY ALL) GROUP BY cluster_id)"
query("species_by_cluster_profile", OBS, PROFILE)(r.species_by_cluster_profile)
with_clusters("cluster_aware_report", f"SELECT p.*, {SPAN}, cluster_name, point_count FROM ({PROFILE}) p LEFT JOIN clusters c ON p.cluster_id = c.cluster_id")(r.cluster_aware_report)
query("cluster_means", OBS, f"SELECT cluster_id, round(avg(gps_latitude), 9) AS latitude, round(avg(gps_longitude), 9) AS longitude, count(*) AS point_count FROM observations WHERE {GPS} GROUP BY 1")(r.cluster_means)
query("cluster_lookup_stats", "cluster_names observations", f"SELECT * FROM (SELECT count(*) AS names, count(*) FILTER (cluster_name <> '') AS named FROM cluster_names), (SELECT count(*) AS means, cast(sum(c) AS bigint) AS points FROM (SELECT count(*) AS c FROM observations WHERE {GPS} GROUP BY cluster_id))")(r.cluster_lookup_stats)
query("species_camera_breakdown", OBS, "SELECT 'species' AS kind, coalesce(top_label, 'unknown') AS name, count(*) AS n FROM observations GROUP BY 2 UNION ALL SELECT 'camera', coalesce(camera_id, 'unknown'), count(*) FROM observations GROUP BY 2")(r.species_camera_breakdown)
query("detection_run_summary", "manifest", f"SELECT *, {PCT.format('files_with_detections', 'files')} AS detection_rate FROM (SELECT count(*) AS files, count(*) FILTER (c > 0) AS files_with_detections, cast(sum(c) AS bigint) AS detections FROM (SELECT source_path, count(*) FILTER (det_score >= 0.5) AS c FROM manifest GROUP BY 1))")(r.detection_run_summary)
query("db_summary_stats", OBS, "SELECT camera_id, count(*) AS n, min(timestamp) AS first, max(timestamp) AS last FROM observations GROUP BY 1")(r.db_summary_stats)
query("converter_summary", "capture_events", "SELECT count(*) AS total, count(*) FILTER (observation_any) AS with_observation, count(*) FILTER (detection_count > 2) AS needs_review, count(DISTINCT camera_id) AS cameras FROM capture_events")(r.converter_summary)
query("species_collect", OBS, "SELECT camera_id, count(*) AS image_count, string_agg(DISTINCT top_label, ',' ORDER BY top_label) AS species, round(avg(top_confidence), 9) AS avg_confidence FROM observations WHERE top_label IS NOT NULL GROUP BY 1")(r.species_collect)
query("pipeline_status", "manifest predictions observations", " UNION ALL ".join(f"SELECT '{s}' AS stage, count(*) AS n, count(*) > 0 AS done FROM {t}" for s, t in (("stage1", "manifest"), ("stage2", "predictions"), ("stage3", "(SELECT * FROM observations WHERE false)"))))(lambda m, p, o: r.pipeline_status(stage1=m, stage2=p, stage3=o.filter("false")))
query("detections_contract_stats", "detections", "SELECT count(*) AS total, count(DISTINCT event_id) AS events, count(DISTINCT camera_id) AS cameras, count(DISTINCT label) AS labels, round(avg(confidence), 9) AS avg_confidence, min(confidence) AS min_confidence, max(confidence) AS max_confidence FROM detections")(r.detections_contract_stats)
query("events_contract_stats", "capture_events", "SELECT count(*) AS total_events, cast(sum(detection_count) AS bigint) AS detections, count(DISTINCT camera_id) AS cameras FROM capture_events")(r.events_contract_stats)
AT = "cast('2024-01-08 12:00:00' AS timestamp)"
query("camera_contract_stats", "exif_corrections", f"SELECT count(*) AS total, count(DISTINCT CASE WHEN effective_from <= {AT} AND (effective_to IS NULL OR effective_to >= {AT}) THEN camera_id END) AS active_cameras FROM exif_corrections")(lambda m: r.camera_contract_stats(m, F.expr(AT)))
query("top_label_of_observation", "detections", "SELECT event_id, label AS top_label, confidence AS top_confidence FROM detections WHERE confidence IS NOT NULL QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY confidence DESC, detection_id, label) = 1")(r.top_label_of_observation)
FIXED = "SELECT regexp_extract(path, '([.][^.]*)$', 1) AS file_type, regexp_matches(path, '/[0-9]{14}_') AS ok FROM file_listing"
query(
    "timestamp_fix_summary",
    "file_listing",
    f"SELECT file_type, total, fixed, failed, {PCT.format('fixed', 'total')} AS success_percent FROM (SELECT CASE WHEN grouping(file_type) = 1 THEN 'all' ELSE file_type END AS file_type, count(*) AS total, count(*) FILTER (ok) AS fixed, count(*) FILTER (NOT ok) AS failed FROM ({FIXED}) x GROUP BY ROLLUP (x.file_type))",
)(lambda f: r.timestamp_fix_summary(f.select(F.regexp_extract("path", r"([.][^.]*)$", 1).alias("file_type"), F.col("path").rlike("/[0-9]{14}_").alias("ok"))))
PRICES = (("cam01", 0.02, 0.08), ("cam02", 0.05, 0.2))
query(
    "instance_cost_report",
    OBS,
    f"""SELECT instance_type, round(h, 6) AS hours, round(h * coalesce(spot, 0.03e0), 6) AS cost, round(h * coalesce(on_demand, 0.1e0), 6) AS on_demand_cost, round(h * (coalesce(on_demand, 0.1e0) - coalesce(spot, 0.03e0)), 6) AS savings
    FROM (SELECT camera_id AS instance_type, count(*) / cast(8 AS double) AS h FROM observations GROUP BY 1) LEFT JOIN (VALUES {", ".join(f"('{a}', {b}e0, {c}e0)" for a, b, c in PRICES)}) p(t, spot, on_demand) ON instance_type = t""",
)(lambda o: r.instance_cost_report(o.select(F.col("camera_id").alias("instance_type"), F.lit(0.125).alias("hours")), o.sparkSession.createDataFrame(list(PRICES), "instance_type string, spot double, on_demand double")))
query(
    "job_cost_report",
    OBS,
    f"""SELECT jobs, succeeded, {PCT.format("succeeded", "jobs")} AS success_percent, round(h, 6) AS span_hours, round(h * 0.03e0, 6) AS spot_cost, round(h * 0.1e0, 6) AS on_demand_cost, round(h * 0.1e0 - h * 0.03e0, 6) AS savings
    FROM (SELECT count(*) AS jobs, count(*) FILTER (NOT needs_review) AS succeeded, {SECONDS.format("min(timestamp)", "max(timestamp)")} / 3600 AS h FROM observations)""",
)(lambda o: r.job_cost_report(o.select(F.when(F.col("needs_review"), "FAILED").otherwise("SUCCEEDED").alias("status"), F.col("timestamp").alias("started"), F.col("timestamp").alias("ended"))))
DURATION = "CASE WHEN {0} < 60 THEN printf('%.1fs', {0}) WHEN {0} < 3600 THEN printf('%.1fm', {0} / 60) ELSE printf('%.1fh', {0} / 3600) END"
query(
    "run_report",
    OBS,
    f"""SELECT camera_id, n, auto_percent, round(n * 0.001e0, 6) AS cost, {DURATION.format("s")} AS runtime FROM (SELECT camera_id, count(*) AS n, {PCT.format("count(*) FILTER (NOT needs_review)", "count(*)")} AS auto_percent, {SECONDS.format("min(timestamp)", "max(timestamp)")} AS s FROM observations GROUP BY 1) ORDER BY n DESC, camera_id LIMIT 3""",
)(r.run_report)
