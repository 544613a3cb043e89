"""Queries of streams, readers and writers: the views' rows are written to the shared folder and come back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklore.operators import contracts as c
from tracklore.operators import reports as r
from tracklore.operators import space as s
from tracklore.operators.episodes import compress
from tracklore.operators.graph import shared_folder
from tracklore.operators.joins import scd2
from tracklore.plans.episode_queries import common, rows_of
from tracklore.plans.registry import query
from tracklore.plans.report_queries import GPS
from tracklore.plans.space_queries import points_of
from tracklore.sources import metadata, readers, schemas, writers
from tracklore.streaming import streams

OBS = "observations"


def place(df: DataFrame) -> str:
    return f"{shared_folder(df.sparkSession)}/files/{uuid.uuid4().hex}"


# --- writers and readers -----------------------------------------------------------------------------------------------
ALL = "SELECT observation_id, camera_id, timestamp, top_label, top_confidence FROM observations"
KEEP = ("observation_id", "camera_id", "timestamp", "top_label", "top_confidence")


def _through(write, read):
    def run(df: DataFrame) -> DataFrame:
        path = place(df)
        write(df, path)
        return read(df, path)

    return run


SCHEMA = "observation_id string, camera_id string, timestamp timestamp_ntz, top_label string, top_confidence double"
few = lambda o: o.select(*KEEP)
back = _through(writers.parquet, lambda d, p: readers.observations(d.sparkSession, p, SCHEMA))
query("scan_parquet_observations", OBS, f"{ALL} WHERE top_confidence >= 0.5")(lambda o: back(few(o)).filter("top_confidence >= 0.5"))
query("sink_parquet_snappy", OBS, ALL)(lambda o: back(few(o)))


def _suffixed(o: DataFrame) -> DataFrame:
    """One table through each format by its suffix."""
    out = None
    for kind in ("parquet", "csv", "json"):
        path = f"{place(o)}.{kind}"
        writers.by_format(few(o), path, kind)
        rows = readers.by_extension(o.sparkSession, path, SCHEMA).withColumn("format", F.lit(kind))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("format", "camera_id").agg(F.count("*").alias("n"), F.count("top_label").alias("labels"), F.min("timestamp").alias("first"), F.round(F.sum("top_confidence"), 6).alias("confidence"))


FORMATS = "SELECT format, camera_id, count(*) AS n, count(top_label) AS labels, min(timestamp) AS first, round(sum(top_confidence), 6) AS confidence FROM observations, (VALUES ('parquet'), ('csv'), ('json')) f(format) GROUP BY 1, 2"
query("scan_by_extension", OBS, FORMATS)(_suffixed)
query("sink_by_format", OBS, FORMATS)(_suffixed)
query("sink_csv", OBS, ALL)(lambda o: _through(writers.csv, lambda d, p: d.sparkSession.read.schema(SCHEMA).option("header", True).csv(p))(few(o)))
query("sink_partitioned_dt", OBS, "SELECT cast(timestamp AS date) AS dt, count(*) AS n FROM observations WHERE cast(timestamp AS date) >= cast('2024-01-10' AS date) GROUP BY 1")(
    lambda o: _through(writers.partitioned_by_day, lambda d, p: d.sparkSession.read.parquet(p))(few(o)).filter("dt >= date'2024-01-10'").groupBy("dt").agg(F.count("*").alias("n"))
)
query("sink_jsonl", "manifest", "SELECT seq, crop_path, camera_id, timestamp, det_score FROM manifest")(
    lambda m: _through(writers.json_lines, lambda d, p: readers.json_lines(d.sparkSession, p, "seq bigint, crop_path string, camera_id string, timestamp timestamp_ntz, det_score double"))(m.select("seq", "crop_path", "camera_id", "timestamp", "det_score"))
)


def _with_bad_lines(df: DataFrame, schema: str, good: str) -> DataFrame:
    """Lines of which every eleventh can't be read."""
    path = place(df)
    text = F.when(F.col("seq") % 11 == 0, F.lit("{not json")).otherwise(F.to_json(F.struct(*good.split(","))))
    df.select(text.alias("value")).write.text(path)
    return readers.json_lines(df.sparkSession, path, schema)


query("scan_manifest_jsonl", "manifest", "SELECT seq, crop_path, camera_id, det_score FROM manifest WHERE seq % 11 <> 0")(lambda m: _with_bad_lines(m, "seq bigint, crop_path string, camera_id string, det_score double", "seq,crop_path,camera_id,det_score"))
query("scan_predictions_jsonl", "manifest predictions", "SELECT p.crop_path, p.label, p.confidence FROM predictions p JOIN manifest m ON p.crop_path = m.crop_path WHERE m.seq % 11 <> 0")(
    lambda m, p: _with_bad_lines(p.join(m.select("crop_path", "seq"), "crop_path"), "crop_path string, label string, confidence double", "crop_path,label,confidence")
)
def _record_lists(o: DataFrame) -> DataFrame:
    """Files by day, each one JSON list of at most 5,000 records."""
    path = place(o)
    day = writers.iso_times(o.select("seq", *KEEP)).withColumn("day", F.substring("timestamp", 1, 10))
    day.groupBy("day", F.floor(F.col("seq") / 5000).alias("part")).agg(F.to_json(F.collect_list(F.struct(*KEEP))).alias("value")).repartition("day", "part").write.partitionBy("day", "part").text(path)
    return readers.records(o.sparkSession, path, SCHEMA).select(*KEEP)


query("scan_records_json_yaml", OBS, ALL)(_record_lists)
query("scan_time_corrections_csv", "time_corrections", "SELECT camera_id, offset_seconds, clock_drift_ppm FROM time_corrections")(
    lambda t: _through(writers.csv, lambda d, p: readers.time_corrections(d.sparkSession, p, schemas.TIME_CORRECTIONS))(t.select("camera_id", F.lit("north").alias("location"), "timezone", "offset_seconds", "clock_drift_ppm", F.lit("set, by hand").alias("notes"))).select("camera_id", "offset_seconds", "clock_drift_ppm")
)
query("scan_pandas", "cluster_names", "SELECT cluster_id, cluster_name FROM cluster_names")(lambda n: readers.from_pandas(n.sparkSession, n.toPandas(), "cluster_id string, cluster_name string"))
EPISODES = "SELECT camera_id, species, strftime(start_time, '%Y-%m-%dT%H:%M:%S.%f') AS start_time, frame_count FROM episodes"
query("sink_compressed_json", "manifest predictions", EPISODES, more=common(360), recursive=True)(
    lambda m, p: _through(writers.json_lines, lambda d, x: d.sparkSession.read.schema("camera_id string, species string, start_time string, frame_count bigint").json(x))(compress(rows_of(m, p), 360).drop("timeline"))
)
query("flatten_to_relational", OBS, "SELECT observation_id, '{\"camera_id\":\"' || camera_id || '\",\"seq\":' || seq || '}' AS source, '[\"' || camera_id || '\"]' AS cameras FROM observations")(
    lambda o: _through(lambda d, p: writers.parquet(writers.flatten_nested(d), p), lambda d, p: d.sparkSession.read.parquet(p))(o.select("observation_id", F.struct("camera_id", "seq").alias("source"), F.array("camera_id").alias("cameras")))
)
NAMED = "observations cluster_names"
MEANS = f"(SELECT cluster_id, round(avg(gps_latitude), 9) AS latitude, round(avg(gps_longitude), 9) AS longitude, count(*) AS point_count FROM observations WHERE {GPS} GROUP BY 1)"
query("export_cluster_means_csv", NAMED, f"SELECT m.cluster_id, coalesce(n.cluster_name, m.cluster_id) AS cluster_name, latitude, longitude, point_count FROM {MEANS} m LEFT JOIN cluster_names n ON m.cluster_id = n.cluster_id")(
    lambda o, n: _through(writers.csv, lambda d, p: d.sparkSession.read.schema("cluster_id string, cluster_name string, latitude double, longitude double, point_count bigint").option("header", True).csv(p))(writers.cluster_means_table(r.cluster_means(o), n))
)
query("export_cluster_table", NAMED, f"SELECT cluster_id, point_count FROM {MEANS}")(lambda o, n: _through(lambda d, p: writers.by_format(d, p, "json"), lambda d, p: d.sparkSession.read.schema("cluster_id string, point_count bigint").json(p))(r.cluster_table(o, n)))


def _geojson(o: DataFrame) -> DataFrame:
    hulls = s.convex_hull(points_of(o))
    features = hulls.select(writers.geojson_feature(F.col("ring"), F.col("cluster_id"), F.lit(0.0), F.lit(0.0)).alias("value"))
    back_ = _through(lambda d, p: d.write.text(p), lambda d, p: d.sparkSession.read.text(p))(features)
    parsed = F.from_json("value", "type string, geometry struct<type:string,coordinates:array<array<array<double>>>>, properties struct<cluster_id:string>")
    ring = F.col("f.geometry.coordinates")[0]
    return back_.select(parsed.alias("f")).select(F.col("f.properties.cluster_id").alias("cluster_id"), F.col("f.type").alias("type"), (F.element_at(ring, 1) == F.element_at(ring, -1)).alias("closed"), F.array_max(F.transform(ring, lambda p: p[1])).alias("max_lat"))


query("export_boundaries_geojson", OBS, f"SELECT cluster_id, 'Feature' AS type, true AS closed, max(gps_latitude) AS max_lat FROM observations WHERE {GPS} GROUP BY 1")(_geojson)
query("export_boundaries_kml", OBS, f"SELECT DISTINCT cluster_id AS name, true AS whole FROM observations WHERE {GPS}")(
    lambda o: s.convex_hull(points_of(o)).select(writers.kml_placemark(F.col("ring"), F.col("cluster_id")).alias("k")).select(F.regexp_extract("k", "<name>(.*)</name>", 1).alias("name"), F.col("k").rlike("^<Placemark>.*,0</coordinates>.*</Placemark>$").alias("whole"))
)
query("export_names_json", "cluster_names", "SELECT cluster_id, cluster_name FROM cluster_names")(lambda n: writers.names_from_json(writers.names_as_json(n), "names"))
query("import_names_json", "cluster_names", "SELECT cluster_id, cluster_name FROM cluster_names")(lambda n: _through(lambda d, p: d.write.text(p), lambda d, p: writers.names_from_json(d.sparkSession.read.text(p), "value"))(writers.names_as_json(n)))


def _enriched_files(o: DataFrame, n: DataFrame) -> DataFrame:
    """Files of a folder enriched in one read; rows and named rows per file."""
    path = place(o)
    o.select("cluster_id", "camera_id").withColumn("file", F.col("camera_id")).write.partitionBy("file").parquet(path)
    named = r.enrich_cluster_names(o.sparkSession.read.parquet(path), n)
    return named.groupBy("file").agg(F.count("*").alias("n"), F.count(F.when(F.col("cluster_name") != F.col("cluster_id"), 1)).alias("named"))


query("batch_enrich_files", NAMED, "SELECT camera_id AS file, count(*) AS n, count(c.cluster_id) AS named FROM observations o LEFT JOIN cluster_names c ON o.cluster_id = c.cluster_id GROUP BY 1")(_enriched_files)
NOW = "2024-06-01 12:00:00"
#: Records that are there, and new ones that say no more than their camera, shift and start; every third not even its start.
HAVE = "SELECT correction_id, camera_id, delta_seconds, effective_from, effective_to, rule_id, cast('2024-01-01 00:00:00' AS timestamp) AS created_at FROM exif_corrections WHERE created_seq < 15"
ADDED = f"SELECT camera_id, delta_seconds, CASE WHEN created_seq % 3 = 0 THEN cast('{NOW}' AS timestamp) ELSE effective_from END AS effective_from FROM exif_corrections WHERE created_seq >= 15"
APPENDED = f"""appended AS ({HAVE} UNION ALL SELECT concat_ws('_', 'correction', camera_id, cast(cast(epoch(effective_from) AS bigint) AS varchar)), camera_id, delta_seconds, effective_from, NULL, 'manual_correction', cast('{NOW}' AS timestamp) FROM ({ADDED}))"""


def _appended(x: DataFrame) -> DataFrame:
    have = x.filter("created_seq < 15").select("correction_id", "camera_id", "delta_seconds", "effective_from", "effective_to", "rule_id", F.lit("2024-01-01").cast("timestamp").alias("created_at"))
    added = x.filter("created_seq >= 15").select("camera_id", "delta_seconds", F.when(F.col("created_seq") % 3 != 0, F.col("effective_from")).alias("effective_from"))
    return metadata.append_effective(have, added, "correction", NOW)


query("append_effective_record", "exif_corrections", "SELECT * FROM appended", more=APPENDED)(_appended)
query(
    "effective_overlaps",
    "exif_corrections",
    """SELECT a.*, b.correction_id AS meets FROM appended a JOIN appended b ON a.camera_id = b.camera_id AND (b.effective_from, b.correction_id) < (a.effective_from, a.correction_id) AND (b.effective_to IS NULL OR b.effective_to >= a.effective_from)
    QUALIFY row_number() OVER (PARTITION BY a.camera_id, a.effective_from, a.correction_id ORDER BY b.effective_to IS NULL DESC, b.effective_to DESC, b.correction_id DESC) = 1""",
    more=APPENDED,
)(lambda x: metadata.overlaps(_appended(x), "camera_id", "correction_id"))
query(
    "append_then_look_up",
    "observations exif_corrections",
    "SELECT o.observation_id, o.timestamp, o.camera_id, c.correction_id, c.delta_seconds FROM observations o LEFT JOIN appended c ON o.camera_id = c.camera_id AND c.effective_from <= cast(o.timestamp AS timestamp) AND (c.effective_to IS NULL OR cast(o.timestamp AS timestamp) <= c.effective_to) QUALIFY row_number() OVER (PARTITION BY o.observation_id ORDER BY c.created_at DESC NULLS LAST, c.correction_id DESC) = 1",
    more=APPENDED,
)(
    lambda o, x: scd2(
        o.select("observation_id", "camera_id", "timestamp"), _appended(x).withColumn("created_seq", F.struct("created_at", "correction_id")), "camera_id", "timestamp", ["correction_id", "delta_seconds"], "observation_id"
    )
)
RECORD = "correction_id, camera_id, delta_seconds, effective_from, effective_to"


def _versions(x: DataFrame) -> DataFrame:
    """Three versions, of which the second is published, a third one only staged, and then the first made current again."""
    spark, path, rows = x.sparkSession, place(x), x.select(*RECORD.split(", "), "created_seq")
    metadata.publish(rows.filter("created_seq < 10"), path, "1")
    metadata.publish(rows, path, "2")
    second = metadata.read_version(spark, path)
    metadata.stage(rows.filter("created_seq < 3"), path, "3")
    out = second.withColumn("read_as", F.lit("current")).unionByName(metadata.read_version(spark, path, "1").withColumn("read_as", F.lit("v1")))
    metadata.point(spark, path, "1")
    return out.unionByName(metadata.read_version(spark, path).withColumn("read_as", F.lit("rolled back"))).drop("created_seq")


query("sink_versioned_metadata", "exif_corrections", f"SELECT {RECORD}, read_as FROM exif_corrections, (VALUES ('current', 1000), ('v1', 10), ('rolled back', 10)) v(read_as, below) WHERE created_seq < below")(_versions)


def _manifests(x: DataFrame) -> DataFrame:
    """Of three versions: rows, whether the stored rows still have the manifest's checksum, and which one is current."""
    spark, path = x.sparkSession, place(x)
    for k in (1, 2, 3):
        metadata.publish(x.filter(F.col("created_seq") < 8 * k), path, str(k))
    metadata.point(spark, path, "2")
    current = metadata.manifest_of(spark, path)["version"]
    sound = [k for k in "123" if metadata.verify(spark, path, k)]
    return metadata.manifests(spark, path).select("version", "n", F.col("version").isin(sound).alias("sound"), (F.col("version") == current).alias("current"))


query("metadata_manifests", "exif_corrections", "SELECT cast(v AS varchar) AS version, count(*) AS n, true AS sound, v = 2 AS current FROM exif_corrections, (VALUES (1), (2), (3)) t(v) WHERE created_seq < 8 * v GROUP BY v")(_manifests)
query("metadata_export_parquet", "exif_corrections", "SELECT camera_id, correction_id, effective_from, effective_to FROM exif_corrections")(
    lambda x: _through(writers.parquet, lambda d, p: d.sparkSession.read.parquet(p))(x.select("camera_id", "correction_id", "effective_from", "effective_to"))
)
query("sort_reports_by_time", OBS, "SELECT camera_id, max(timestamp) AS at FROM observations GROUP BY 1")(
    lambda o: _through(writers.json_lines, lambda d, p: d.sparkSession.read.schema("camera_id string, at timestamp_ntz").json(p).orderBy(F.desc("at"), "camera_id"))(o.groupBy("camera_id").agg(F.max("timestamp").alias("at")))
)


def _files(o: DataFrame) -> str:
    path = place(o)
    o.select("camera_id", F.col("observation_id").alias("value")).repartition("camera_id").sortWithinPartitions("camera_id", "value").write.partitionBy("camera_id").text(path)
    return path


SIZES = "SELECT camera_id, cast(sum(length(observation_id) + 1) AS bigint) AS size_bytes{0} FROM observations GROUP BY camera_id"
query("file_inventory", OBS, SIZES.format(", '.txt' AS extension, 'other' AS media_type, sha256(string_agg(observation_id || chr(10), '' ORDER BY observation_id)) AS sha256"))(lambda o: readers.file_inventory(o.sparkSession, _files(o), (".txt",)).select(F.regexp_extract("path", "camera_id=([^/]+)", 1).alias("camera_id"), "size_bytes", "extension", "media_type", "sha256"))
query("find_files_glob", OBS, SIZES.format(""))(lambda o: readers.find_files(o.sparkSession, _files(o), "*.txt").select(F.regexp_extract("path", "camera_id=([^/]+)", 1).alias("camera_id"), "size_bytes"))

# --- streams -----------------------------------------------------------------------------------------------------------


def _stream(df: DataFrame, files: int = 4) -> DataFrame:
    """The rows as a stream of files, in order of time, two files to a batch."""
    path = place(df)
    df.repartitionByRange(files, "timestamp").write.parquet(path)
    return streams.read_parquet(df.sparkSession, path, df.schema, 2)


def _drain(stream: DataFrame, mode: str, like: DataFrame, work=None) -> DataFrame:
    path = place(like)
    return streams.drain(stream, mode, f"{path}/out", f"{path}/state", work)


query("stream_condense", OBS, "SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, total FROM (SELECT time_bucket(INTERVAL 10 MINUTE, timestamp) AS window_start, count(*) AS total FROM observations GROUP BY 1)")(
    lambda o: streams.latest(_drain(streams.condense(_stream(few(o)), late="60 days"), "update", o), ["window_start", "window_end"]).select("window_start", "window_end", "total")
)
query("stream_enrich_names", NAMED, "SELECT o.observation_id, coalesce(n.cluster_name, o.cluster_id) AS cluster_name FROM observations o LEFT JOIN cluster_names n ON o.cluster_id = n.cluster_id")(
    lambda o, n: _drain(streams.enrich_names(_stream(o.select("observation_id", "cluster_id", "timestamp")), n), "append", o).select("observation_id", "cluster_name")
)
query("stream_dedupe_assigned", OBS, "SELECT observation_id FROM observations")(lambda o: _drain(streams.dedupe(_stream(few(o).unionByName(few(o).filter("top_confidence < 0.3"))), late="60 days"), "append", o).select("observation_id"))
query("stream_species_counts", OBS, "SELECT top_label, count(*) AS total_detections, round(avg(top_confidence), 9) AS avg_confidence, count(*) FILTER (needs_review) AS needs_review_count FROM observations GROUP BY 1")(
    lambda o: streams.latest(_drain(streams.species_counts(_stream(o)), "complete", o), ["top_label"])
)
RULES = tuple(x for x in c.EVENTS if x.name in ("timestamp_utc_format", "image_format"))


def _validated(d: DataFrame) -> DataFrame:
    path = place(d)
    d.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp_ntz")).write.parquet(f"{path}/in")
    stream = streams.read_parquet(d.sparkSession, f"{path}/in", d.schema)
    stream.writeStream.option("checkpointLocation", f"{path}/state").foreachBatch(lambda b, n: streams.split_valid(b, n, RULES, f"{path}/good", f"{path}/bad")).trigger(availableNow=True).start().awaitTermination()
    good, bad = (d.sparkSession.read.parquet(f"{path}/{k}/batch_*").select("event_id", F.lit(k).alias("side")) for k in ("good", "bad"))
    return good.unionByName(bad)


BROKEN = "NOT regexp_matches(timestamp_utc, '" + c.ISO_Z.replace("\\\\", "\\") + f"') OR NOT image_format IN {c.IMAGE_FORMATS}"
query("stream_validate", "capture_events", f"SELECT event_id, CASE WHEN {BROKEN} THEN 'bad' ELSE 'good' END AS side FROM capture_events")(_validated)
LINES = "seq bigint, crop_path string, camera_id string, det_score double"


def _ingested(m: DataFrame) -> DataFrame:
    path = place(m)
    m.select(F.when(F.col("seq") % 11 == 0, F.lit("{not json")).otherwise(F.to_json(F.struct("seq", "crop_path", "camera_id", "det_score"))).alias("value")).repartition(3).write.text(f"{path}/in")
    return _drain(streams.ingest_manifest(m.sparkSession, f"{path}/in", LINES, 2), "append", m).drop("batch")


query("stream_ingest_manifest", "manifest", "SELECT seq, crop_path, camera_id, det_score FROM manifest WHERE seq % 11 <> 0")(_ingested)


def _compressed(m: DataFrame, p: DataFrame) -> DataFrame:
    """All sightings, then one of a later year under another key: it moves the watermark past every open episode."""
    rows = rows_of(m, p).select("camera_id", "label", F.col("timestamp").cast("timestamp").alias("timestamp"), "confidence")
    path = place(m)
    rows.repartitionByRange(3, "timestamp").write.parquet(f"{path}/in")
    last = rows.limit(1).select(F.lit("end").alias("camera_id"), F.lit("end").alias("label"), F.expr("timestamp'2030-01-01 00:00:00'").alias("timestamp"), F.lit(1.0).alias("confidence"))
    last.write.mode("append").parquet(f"{path}/in")
    stream = streams.read_parquet(m.sparkSession, f"{path}/in", rows.schema, 2)
    with streams.rocksdb_state(m.sparkSession):
        out = _drain(streams.compress(stream, 360, late="40 days"), "append", m)
    return out.select("camera_id", "species", F.col("start_time").cast("timestamp_ntz").alias("start_time"), F.col("end_time").cast("timestamp_ntz").alias("end_time"), "frame_count", "max_confidence")


query("stream_compress", "manifest predictions", "SELECT camera_id, species, start_time, end_time, frame_count, max_confidence FROM episodes", more=common(360), recursive=True)(_compressed)
query("enrich_names_pandas", NAMED, "SELECT o.observation_id, coalesce(n.cluster_name, o.cluster_id) AS cluster_name FROM observations o LEFT JOIN cluster_names n ON o.cluster_id = n.cluster_id")(
    lambda o, n: r.enrich_cluster_names(o, readers.from_pandas(n.sparkSession, n.toPandas(), "cluster_id string, cluster_name string")).select("observation_id", "cluster_name")
)
