"""Queries of filters, flags and column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklore.functions import scalars as s
from tracklore.operators import filters as f
from tracklore.plans.registry import query

M = "manifest"
REL = "(x2 - x1) * (y2 - y1) / (cast(image_width AS double) * image_height)"
ASPECT = "(x2 - x1) / nullif(y2 - y1, 0)"
EDGE = "(x1 < 12 OR y1 < 12 OR image_width - x2 < 12 OR image_height - y2 < 12)"
REASON = f"""CASE WHEN x1 IS NULL OR det_score IS NULL THEN 'invalid_bbox' WHEN det_score < 0.3 THEN 'confidence' WHEN x2 <= x1 OR y2 <= y1 THEN 'invalid_bbox'
 WHEN {REL} < 0.003 OR {REL} > 0.8 THEN 'area' WHEN {REL} < 0.01 THEN 'tiny_object' WHEN {ASPECT} < 0.2 OR {ASPECT} > 5.0 THEN 'aspect_ratio' WHEN {EDGE} THEN 'edge_proximity' END"""
KEEP = ("crop_path", "camera_id", "det_score")
query("filter_bboxes", M, f"SELECT crop_path, camera_id, det_score FROM manifest WHERE {REASON} IS NULL")(lambda m: f.filter_bboxes(m).select(*KEEP))
query("filter_bboxes_drop_reasons", M, f"SELECT coalesce({REASON}, 'kept') AS reason, count(*) AS n FROM manifest GROUP BY 1")(f.drop_reasons)
query("is_doubtful", M, f"SELECT crop_path, (x2 <= x1 OR y2 <= y1 OR (det_score >= 0.3 AND det_score < 0.35) OR {EDGE} OR {REL} < 0.01 OR ({REL} >= 0.003 AND {REL} < 0.0045)) AS doubtful FROM manifest")(lambda m: m.select("crop_path", f.is_doubtful().alias("doubtful")))
query("simple_filter_and_flag", M, f"SELECT crop_path, round({REL}, 9) AS area, det_score < 0.3 AS is_doubtful FROM manifest WHERE det_score >= 0.5 AND {REL} >= 0.01")(lambda m: f.simple_filter_and_flag(m).select("crop_path", F.round("area", 9).alias("area"), "is_doubtful"))
PAD = lambda a, b, sign, top: f"cast(round_even(least(greatest({a if sign < 0 else b} {'-' if sign < 0 else '+'} greatest(1.0e0, {b} - {a}) * 0.15e0, 0.0e0), cast({top} AS double)), 0) AS int)"
query(
    "crop_box_geometry",
    M,
    f"""SELECT crop_path, crop_x1, crop_y1, CASE WHEN crop_x2 <= crop_x1 THEN least(image_width, crop_x1 + 1) ELSE crop_x2 END AS crop_x2, CASE WHEN crop_y2 <= crop_y1 THEN least(image_height, crop_y1 + 1) ELSE crop_y2 END AS crop_y2 FROM (
    SELECT *, {PAD("x1", "x2", -1, "image_width")} AS crop_x1, {PAD("y1", "y2", -1, "image_height")} AS crop_y1, {PAD("x1", "x2", 1, "image_width")} AS crop_x2, {PAD("y1", "y2", 1, "image_height")} AS crop_y2 FROM manifest)""",
)(lambda m: f.crop_box(m).select("crop_path", "crop_x1", "crop_y1", "crop_x2", "crop_y2"))
query("conf_threshold_detections", M, "SELECT crop_path, camera_id, det_score FROM manifest WHERE det_score >= 0.35")(lambda m: m.filter("det_score >= 0.35").select(*KEEP))
query("xywh_to_xyxy", M, "SELECT crop_path, x1, y1, x1 + w AS x2, y1 + h AS y2 FROM (SELECT crop_path, x1, y1, x2 - x1 AS w, y2 - y1 AS h FROM manifest)")(
    lambda m: f.xywh_to_xyxy(m.select("crop_path", F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h")))
)
query("auto_ok_flag", "predictions", "SELECT crop_path, confidence >= 0.5 AS auto_ok FROM predictions")(lambda p: p.select("crop_path", (F.col("confidence") >= 0.5).alias("auto_ok")))
query("needs_review_flag", "observations", "SELECT camera_id, top_label, max(top_confidence) < 0.8 AS needs_review FROM observations GROUP BY 1, 2")(lambda o: o.groupBy("camera_id", "top_label").agg((F.max("top_confidence") < 0.8).alias("needs_review")))
query("review_status_rule", "manifest predictions", f"SELECT p.crop_path, (NOT p.auto_ok OR d) AS review, (p.auto_ok AND (NOT p.auto_ok OR d)) AS violation FROM predictions p JOIN (SELECT crop_path, ({EDGE} OR x2 <= x1 OR y2 <= y1) AS d FROM manifest) m ON p.crop_path = m.crop_path")(
    lambda m, p: f.review_status(p.join(m.select("crop_path", (f.near_edge(12) | f.flat_box()).alias("doubtful")), "crop_path").withColumn("needs_review", ~F.col("auto_ok"))).select("crop_path", "review", "violation")
)
query("gps_not_null", "observations", "SELECT observation_id FROM observations WHERE gps_latitude IS NOT NULL AND gps_longitude IS NOT NULL")(lambda o: o.filter("gps_latitude IS NOT NULL AND gps_longitude IS NOT NULL").select("observation_id"))
ZERO = "(SELECT observation_id, CASE WHEN seq % 7 = 0 THEN cast(0 AS double) ELSE gps_latitude END AS gps_latitude, gps_longitude FROM observations)"
query("gps_truthy", "observations", f"SELECT observation_id FROM {ZERO} WHERE gps_latitude <> 0 AND gps_longitude <> 0")(
    lambda o: o.withColumn("gps_latitude", F.when(F.col("seq") % 7 == 0, F.lit(0.0)).otherwise(F.col("gps_latitude"))).filter(f.gps_truthy()).select("observation_id")
)
query("positive_observations", "observations", "SELECT observation_id, timestamp, top_label FROM observations WHERE top_label IS NOT NULL AND gps_latitude IS NOT NULL AND gps_longitude IS NOT NULL AND timestamp >= cast('2024-01-20 00:00:00' AS timestamp) - INTERVAL 7 DAY")(
    lambda o: f.positive_observations(o, F.expr("cast('2024-01-20 00:00:00' AS timestamp)"), 7).select("observation_id", "timestamp", "top_label")
)
query("confidence_band", "observations", "SELECT CASE WHEN top_confidence >= 0.7 THEN 'high' WHEN top_confidence >= 0.4 THEN 'medium' WHEN top_confidence >= 0.2 THEN 'low' ELSE 'none' END AS band, count(*) AS n FROM observations GROUP BY 1")(lambda o: o.groupBy(f.confidence_band(F.col("top_confidence")).alias("band")).agg(F.count("*").alias("n")))
LIMITS = (("moose", 0.6, 0.01, 0.8, 8), ("boar", 0.5, 0.005, 0.6, 8), ("fox", 0.4, 0.002, 0.4, 4))
query("species_threshold_filter", "manifest predictions", f"SELECT p.crop_path, p.label, p.confidence FROM predictions p JOIN manifest m ON p.crop_path = m.crop_path JOIN (VALUES {', '.join(str(x) for x in LIMITS)}) l(label, c, lo, hi, e) ON p.label = l.label WHERE confidence >= c AND {REL} BETWEEN lo AND hi AND x1 >= e AND y1 >= e AND image_width - x2 >= e AND image_height - y2 >= e")(
    lambda m, p: f.species_thresholds(p.select("crop_path", "label", "confidence").join(m.select("crop_path", "x1", "y1", "x2", "y2", "image_width", "image_height"), "crop_path"), p.sparkSession.createDataFrame(list(LIMITS), "label string, min_conf double, min_rel double, max_rel double, edge int")).select("crop_path", "label", "confidence")
)
query("readme_table", "observations", "SELECT strftime(timestamp, '%Y-%m-%d') AS \"Dato\", strftime(timestamp, '%H:%M') AS \"Tid\", camera_id AS \"Sted\", top_label AS \"Art\", count(*) AS \"Antal\", round(max(top_confidence), 2) AS \"Kvalitet\", min(observation_id) AS \"Billede\" FROM observations WHERE top_label IS NOT NULL GROUP BY 1, 2, 3, 4")(f.readme_table)

# --- column functions --------------------------------------------------------------------------------------------------
D = "detections"
#: Species of the labels that the detections have, written out: the query looks them up in the table of all labels.
SPECIES = "CASE lower(label) WHEN 'cat' THEN 'fox' WHEN 'cow' THEN 'moose' WHEN 'dog' THEN 'boar' WHEN 'deer' THEN 'roedeer' WHEN 'moose' THEN 'moose' WHEN 'person' THEN 'person' WHEN 'lynx' THEN 'lynx' END"
query("map_species_label", D, f"SELECT species, count(*) AS n, count(DISTINCT label) AS labels FROM (SELECT label, {SPECIES} AS species FROM detections) WHERE species IS NOT NULL GROUP BY 1")(
    lambda d: d.withColumn("species", s.map_species_label(F.col("label"))).filter("species IS NOT NULL").groupBy("species").agg(F.count("*").alias("n"), F.countDistinct("label").alias("labels"))
)
query("available_species", D, f"SELECT DISTINCT {SPECIES} AS species FROM detections WHERE {SPECIES} IS NOT NULL")(lambda d: d.select(s.map_species_label(F.col("label")).alias("species")).filter("species IS NOT NULL").distinct())
query("exif_timestamp", "observations", "SELECT observation_id, CASE WHEN seq % 3 = 0 THEN date_trunc('second', timestamp) WHEN seq % 3 = 1 THEN date_trunc('second', timestamp) + INTERVAL 1 HOUR ELSE timestamp END AS taken FROM observations")(
    lambda o: o.select("observation_id", "timestamp", F.when(F.col("seq") % 3 == 0, F.create_map(F.lit("DateTimeOriginal"), F.date_format("timestamp", "yyyy:MM:dd HH:mm:ss"))).when(F.col("seq") % 3 == 1, F.create_map(F.lit("DateTimeOriginal"), F.lit("no time"), F.lit("DateTime"), F.date_format(F.col("timestamp") + F.expr("INTERVAL 1 HOUR"), "yyyy:MM:dd HH:mm:ss"))).otherwise(F.create_map(F.lit("Make"), F.lit("x"))).alias("tags")).select(
        "observation_id", s.exif_timestamp(F.col("tags"), F.col("timestamp").cast("timestamp")).cast("timestamp_ntz").alias("taken")
    )
)
query("dms_to_decimal", "observations", "SELECT observation_id, round(CASE WHEN abs(v) <= 90 THEN v END, 9) AS decimal FROM (SELECT observation_id, CASE WHEN seq % 2 = 0 THEN 1 ELSE -1 END * ((seq % 100) + CASE WHEN seq % 5 = 0 THEN 0 ELSE cast(seq % 60 AS double) / (seq % 5) END / 60 + cast(seq % 3600 AS double) / 60 / 3600) AS v FROM observations)")(
    lambda o: o.select(
        "observation_id",
        F.round(s.dms_to_decimal(F.struct((F.col("seq") % 100).alias("num"), F.lit(1).alias("den")), F.struct((F.col("seq") % 60).alias("num"), (F.col("seq") % 5).alias("den")), F.struct((F.col("seq") % 3600).alias("num"), F.lit(60).alias("den")), F.when(F.col("seq") % 2 == 0, "N").otherwise("S")), 9).alias("decimal"),
    )
)
query("infer_camera_id", "file_listing", "SELECT camera_id, count(*) AS n FROM (SELECT CASE WHEN contains(path, '/') THEN split_part(path, '/', 1) ELSE 'unknown' END AS camera_id FROM (SELECT CASE WHEN size_bytes % 17000 = 0 THEN regexp_replace(path, '^.*/', '') ELSE path END AS path FROM file_listing)) GROUP BY 1")(
    lambda l: l.withColumn("path", F.when(F.col("size_bytes") % 17000 == 0, F.regexp_replace("path", "^.*/", "")).otherwise(F.col("path"))).groupBy(s.infer_camera_id(F.col("path")).alias("camera_id")).agg(F.count("*").alias("n"))
)
MOVED = "(epoch_us(timestamp) + cast(offset_seconds AS bigint) * 1000000)"
CORRECT = f"SELECT o.observation_id, o.camera_id, o.timestamp, offset_seconds, clock_drift_ppm, make_timestamp(CASE WHEN c.camera_id IS NULL THEN epoch_us(timestamp) ELSE {MOVED} + cast(round_even(clock_drift_ppm / 1e6 * ({MOVED} / 1e6) * 1e6, 0) AS bigint) END) AS corrected FROM observations o LEFT JOIN time_corrections c ON o.camera_id = c.camera_id"
OC = "observations time_corrections"


def _correct(o, c):
    joined = o.select("observation_id", "camera_id", "timestamp").join(c, "camera_id", "left")
    micros = F.coalesce(s.corrected_micros(F.col("timestamp"), F.col("offset_seconds"), F.col("clock_drift_ppm")), F.unix_micros(F.col("timestamp").cast("timestamp")))
    return joined.withColumn("corrected", F.timestamp_micros(micros).cast("timestamp_ntz"))


query("correct_timestamp", OC, f"SELECT observation_id, corrected FROM ({CORRECT})")(lambda o, c: _correct(o, c).select("observation_id", "corrected"))
query("correction_audit", OC, f"SELECT camera_id, CASE WHEN offset_seconds IS NULL THEN 'no_corrections' ELSE 'corrected' END AS outcome, count(*) AS n, min(epoch_us(corrected) - epoch_us(timestamp)) AS least_moved, max(epoch_us(corrected) - epoch_us(timestamp)) AS most_moved FROM ({CORRECT}) GROUP BY 1, 2")(
    lambda o, c: _correct(o, c).withColumn("moved", F.unix_micros(F.col("corrected").cast("timestamp")) - F.unix_micros(F.col("timestamp").cast("timestamp"))).groupBy("camera_id", F.when(F.col("offset_seconds").isNull(), "no_corrections").otherwise("corrected").alias("outcome")).agg(F.count("*").alias("n"), F.min("moved").alias("least_moved"), F.max("moved").alias("most_moved"))
)
query("normalize_to_utc", "observations", "SELECT observation_id, timestamp - INTERVAL 1 HOUR AS utc FROM observations")(
    lambda o: o.select("observation_id", s.normalize_to_utc(F.col("timestamp").cast("timestamp"), F.lit("Europe/Stockholm")).cast("timestamp_ntz").alias("utc"))
)
query("validate_gps_region", "observations", "SELECT coalesce(gps_latitude BETWEEN 55.3 AND 69.1 AND gps_longitude BETWEEN 10.6 AND 24.2, false) AS inside, count(*) AS n FROM observations GROUP BY 1")(lambda o: o.groupBy(s.in_region(F.col("gps_latitude"), F.col("gps_longitude")).alias("inside")).agg(F.count("*").alias("n")))
query("seasonal_offset", "observations", "SELECT observation_id, CASE WHEN timestamp >= cast('2024-01-10 00:00:00' AS timestamp) AND timestamp < cast('2024-01-20 00:00:00' AS timestamp) THEN 3600 ELSE 0 END AS offset_seconds FROM observations")(
    lambda o: o.select("observation_id", F.when(F.expr("timestamp >= timestamp_ntz'2024-01-10 00:00:00' AND timestamp < timestamp_ntz'2024-01-20 00:00:00'"), 3600).otherwise(0).alias("offset_seconds"))
)
query("iso_parse", "capture_events", "SELECT event_id, try_strptime(regexp_replace(timestamp_utc, 'Z$', ''), '%Y-%m-%dT%H:%M:%S') AS at FROM capture_events")(lambda e: e.select("event_id", s.iso_time(F.col("timestamp_utc")).cast("timestamp_ntz").alias("at")))
query("truncate_time", "observations", "SELECT date_trunc('day', timestamp) AS day, count(*) AS n FROM observations GROUP BY 1")(lambda o: o.groupBy(F.date_trunc("day", "timestamp").cast("timestamp_ntz").alias("day")).agg(F.count("*").alias("n")))
query("hour_weekday_date", "observations", "SELECT observation_id, cast(hour(timestamp) AS int) AS hour, cast(isodow(timestamp) AS int) AS weekday, cast(timestamp AS date) AS date FROM observations")(lambda o: o.select("observation_id", F.hour("timestamp").alias("hour"), (F.weekday("timestamp") + 1).alias("weekday"), F.to_date("timestamp").alias("date")))
query("format_duration", "observations", "SELECT observation_id, CASE WHEN x < 60 THEN printf('%.1fs', x) WHEN x < 3600 THEN printf('%.1fm', x / 60) ELSE printf('%.1fh', x / 3600) END AS text FROM (SELECT observation_id, cast(seq * 4 AS double) AS x FROM observations)")(lambda o: o.select("observation_id", s.format_duration((F.col("seq") * 4).cast("double")).alias("text")))
query("safe_filename", "file_listing", "SELECT path, coalesce(nullif(trim(translate(path, '<>:\"/\\|?*', '_________'), ' .'), ''), 'unnamed') AS name FROM file_listing")(lambda l: l.select("path", s.safe_filename(F.col("path")).alias("name")))
EXT = "lower(regexp_extract(path, '(\\.[^./]+)$', 1))"
TYPE = f"CASE WHEN {EXT} IN {s.IMAGE} THEN 'image' WHEN {EXT} IN {s.VIDEO} THEN 'video' ELSE 'other' END"
query("media_type_flags", "file_listing", f"SELECT media_type, count(*) AS n, cast(sum(size_bytes) AS bigint) AS size_bytes FROM (SELECT {TYPE} AS media_type, size_bytes FROM file_listing) GROUP BY 1")(lambda l: l.groupBy(s.media_type(F.col("path")).alias("media_type")).agg(F.count("*").alias("n"), F.sum("size_bytes").alias("size_bytes")))
query("media_manifest", "file_listing", f"SELECT path, {TYPE} AS media_type, CASE WHEN regexp_matches(name, '^[0-9]{{8}}') THEN substr(name, 1, 14) END AS timestamp, 'pending' AS status FROM (SELECT *, regexp_replace(path, '^.*/', '') AS name FROM file_listing)")(
    lambda l: l.withColumn("name", F.regexp_replace("path", "^.*/", "")).select("path", s.media_type(F.col("path")).alias("media_type"), F.when(F.col("name").rlike("^[0-9]{8}"), F.substring("name", 1, 14)).alias("timestamp"), F.lit("pending").alias("status"))
)
URL = "concat(CASE seq % 4 WHEN 0 THEN 's3://' WHEN 1 THEN 'gs://' WHEN 2 THEN 'file://' ELSE '' END, 'bucket-', seq % 9, CASE WHEN seq % 13 = 0 THEN '' ELSE concat('/', observation_id) END)"


def _urls(o):
    return o.select("observation_id", F.expr(URL).alias("url"))


def _scheme(o):
    scheme, path = s.storage_url_parts(F.col("url"))
    return _urls(o).select("observation_id", scheme.alias("scheme"), path.alias("path"))


def _bucket(o):
    bucket, key, valid = s.s3_parts(F.col("url"))
    return _urls(o).select("observation_id", bucket.alias("bucket"), key.alias("key"), valid.alias("valid"))


U = f"(SELECT observation_id, {URL} AS url FROM observations)"
query("storage_url_parts", "observations", f"SELECT observation_id, coalesce(nullif(regexp_extract(url, '^([a-z0-9]+)://', 1), ''), 'file') AS scheme, regexp_replace(url, '^[a-z0-9]+://', '') AS path FROM {U}")(_scheme)
query("s3_path_parts", "observations", f"SELECT *, regexp_matches(bucket, '^[a-z0-9.-]{{3,63}}$') AND key <> '' AND NOT starts_with(key, '/') AS valid FROM (SELECT observation_id, regexp_extract(url, '^s3://([^/]*)/', 1) AS bucket, regexp_extract(url, '^s3://[^/]*/(.*)$', 1) AS key FROM {U})")(_bucket)
query("url_valid", "observations", f"SELECT observation_id, regexp_matches(url, '^(http|https|s3|file)://[^/?#]+') AS valid FROM {U}")(lambda o: _urls(o).select("observation_id", s.url_valid(F.col("url")).alias("valid")))
query("redact_sensitive", "observations", "SELECT observation_id, '***REDACTED***' AS token_value, camera_id AS camera FROM observations")(
    lambda o: o.select("observation_id", s.redact_sensitive(F.create_map(F.lit("Api_Token"), F.col("observation_id"), F.lit("camera"), F.col("camera_id"))).alias("m")).select("observation_id", F.col("m")["Api_Token"].alias("token_value"), F.col("m")["camera"].alias("camera"))
)
query("numeric_range_check", "observations", "SELECT count(*) FILTER (top_confidence BETWEEN 0.2 AND 0.9) AS valid, count(*) FILTER (NOT top_confidence BETWEEN 0.2 AND 0.9) AS invalid, count(*) FILTER (length(observation_id) BETWEEN 5 AND 7) AS length_valid FROM observations")(
    lambda o: o.agg(F.count_if(F.col("top_confidence").between(0.2, 0.9)).alias("valid"), F.count_if(~F.col("top_confidence").between(0.2, 0.9)).alias("invalid"), F.count_if(F.length("observation_id").between(5, 7)).alias("length_valid"))
)
JSON = "'{\"camera_id\":\"' || camera_id || '\",\"seq\":' || seq || '}'"
query("config_hash", "observations", f"SELECT observation_id, substr(sha256({JSON}), 1, 16) AS hash FROM observations")(lambda o: o.select("observation_id", s.config_hash(F.struct("camera_id", "seq")).alias("hash")))
query("json_encode_nested", "observations", f"SELECT observation_id, {JSON} AS json FROM observations")(lambda o: o.select("observation_id", F.to_json(F.struct("camera_id", "seq")).alias("json")))
query("probabilities_valid", "observations", "SELECT count(*) FILTER (v) AS valid, count(*) FILTER (NOT v) AS invalid FROM (SELECT top_confidence + (1 - top_confidence) * CASE WHEN seq % 5 = 0 THEN 0.5e0 ELSE 1.0e0 END BETWEEN 0.99 AND 1.01 AS v FROM observations)")(
    lambda o: o.select(s.probabilities_valid(F.create_map(F.lit("a"), F.col("top_confidence"), F.lit("b"), (1 - F.col("top_confidence")) * F.when(F.col("seq") % 5 == 0, 0.5).otherwise(1.0)), F.col("top_confidence")).alias("v")).agg(F.count_if("v").alias("valid"), F.count_if(~F.col("v")).alias("invalid"))
)
query("result_duration", "observations", "SELECT camera_id, (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1000000.0 AS seconds, count(*) > 0 AS success FROM observations GROUP BY 1")(
    lambda o: o.groupBy("camera_id").agg(((F.unix_micros(F.max("timestamp").cast("timestamp")) - F.unix_micros(F.min("timestamp").cast("timestamp"))) / 1000000).alias("seconds"), (F.count("*") > 0).alias("success"))
)
VALID = "o.camera_id = c.camera_id AND c.effective_from <= cast(o.timestamp AS timestamp) AND (c.effective_to IS NULL OR cast(o.timestamp AS timestamp) <= c.effective_to)"


def _apply_delta(o, c):
    from tracklore.operators.joins import scd2

    m = scd2(o.select("observation_id", "camera_id", "timestamp"), c, "camera_id", "timestamp", ["delta_seconds"], "observation_id")
    return m.select("observation_id", (F.col("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.coalesce("delta_seconds", F.lit(0)).cast("decimal(18,6)"))).alias("corrected"))


query("apply_exif_delta", "observations exif_corrections", f"SELECT observation_id, timestamp + to_seconds(coalesce(delta_seconds, 0)) AS corrected FROM (SELECT o.observation_id, o.timestamp, c.delta_seconds FROM observations o LEFT JOIN exif_corrections c ON {VALID} QUALIFY row_number() OVER (PARTITION BY o.observation_id ORDER BY c.created_seq DESC NULLS LAST) = 1)")(_apply_delta)
query("numeric_range", "observations", "SELECT observation_id, top_confidence BETWEEN 0.2 AND 0.9 AS valid FROM observations")(lambda o: o.select("observation_id", F.col("top_confidence").between(0.2, 0.9).alias("valid")))
query("string_length", "observations", "SELECT observation_id, length(observation_id) BETWEEN 5 AND 7 AS valid FROM observations")(lambda o: o.select("observation_id", F.length("observation_id").between(5, 7).alias("valid")))
query("content_hash", "file_listing", "SELECT path, sha256(path) AS hash FROM file_listing")(lambda l: l.select("path", F.sha2("path", 256).alias("hash")))
