"""Input views: the driver's tables shaped as camera-trap tables. Each text runs unchanged in Spark SQL and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("events", "nation", "region", "orders", "lineitem", "customer")

VIEWS: dict[str, str] = {
    "observations": """
        SELECT concat('obs_', event_id) AS observation_id, event_id AS seq,
        concat('cam', lpad(cast(user_id % 5 + 1 AS string), 2, '0')) AS camera_id, ts AS timestamp,
        CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type='click' THEN 'moose' WHEN event_type='view' THEN 'roedeer' WHEN event_type='purchase' THEN 'boar' WHEN event_type='signup' THEN 'fox' ELSE 'badger' END AS top_label,
        cast((event_id * 37) % 100 AS double) / cast(100 AS double) AS top_confidence,
        (event_id * 37) % 100 < 50 AS needs_review,
        CASE WHEN event_id % 11 = 0 THEN NULL ELSE cast(590000000 + (user_id % 20) * 100000 + (event_id % 3) * 200 AS double) / cast(10000000 AS double) END AS gps_latitude,
        CASE WHEN event_id % 11 = 0 THEN NULL ELSE cast(180000000 + (user_id % 20) * 100000 + (event_id % 5) * 100 AS double) / cast(10000000 AS double) END AS gps_longitude,
        concat('cluster_', lpad(cast(user_id % 20 + 1 AS string), 3, '0')) AS cluster_id FROM events
    """,
    "cluster_names": """
        SELECT concat('cluster_', lpad(cast(n_nationkey + 1 AS string), 3, '0')) AS cluster_id, n_name AS cluster_name FROM nation WHERE n_nationkey < 10
    """,
    "manifest": """
        SELECT event_id AS seq, concat('crops/v', user_id % 7, CASE WHEN event_id % 2 = 0 THEN '_frame_' ELSE '_img_' END, lpad(cast(event_id AS string), 6, '0'), '.jpg') AS crop_path,
        concat('src/v', user_id % 7, CASE WHEN event_id % 2 = 0 THEN '.mp4' ELSE '.jpg' END) AS source_path,
        concat('cam', lpad(cast(user_id % 5 + 1 AS string), 2, '0')) AS camera_id, ts AS timestamp,
        cast(event_id % 1600 AS double) AS x1, cast(event_id % 900 AS double) AS y1,
        cast(event_id % 1600 + event_id % 331 AS double) AS x2, cast(event_id % 900 + event_id % 173 AS double) AS y2,
        cast((event_id * 53) % 100 AS double) / cast(100 AS double) AS det_score, 1920 AS image_width, 1080 AS image_height FROM events
    """,
    "predictions": """
        SELECT crop_path, CASE WHEN seq % 5 = 0 THEN 'moose' WHEN seq % 5 = 1 THEN 'roedeer' WHEN seq % 5 = 2 THEN 'boar' WHEN seq % 5 = 3 THEN 'fox' ELSE 'badger' END AS label,
        cast((seq * 37) % 100 AS double) / cast(100 AS double) AS confidence, (seq * 37) % 100 >= 50 AS auto_ok FROM manifest WHERE seq % 13 <> 0
    """,
    "weather": """
        SELECT concat('cluster_', lpad(cast(o_custkey % 20 + 1 AS string), 3, '0')) AS cluster_id, o_orderkey AS wid,
        cast(o_orderkey % 400 AS double) / cast(10 AS double) - cast(15 AS double) AS temp_c, cast(o_orderkey % 360 AS double) AS wind_dir_deg,
        cast(o_orderkey % 7 AS double) AS precip_mm, cast(o_orderkey % 101 AS double) AS cloud_pc, o_orderkey % 720 AS hour_offset FROM orders
    """,
    "exif_corrections": """
        SELECT concat('corr_', n_nationkey) AS correction_id, concat('cam', lpad(cast(n_nationkey % 5 + 1 AS string), 2, '0')) AS camera_id,
        cast((n_nationkey - 12) * 60 AS int) AS delta_seconds,
        cast(concat('2024-01-', lpad(cast(n_nationkey % 12 + 1 AS string), 2, '0'), ' 00:00:00') AS timestamp) AS effective_from,
        CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE cast(concat('2024-01-', lpad(cast(n_nationkey % 12 + 10 AS string), 2, '0'), ' 00:00:00') AS timestamp) END AS effective_to,
        concat('rule_', n_nationkey % 4) AS rule_id, n_nationkey AS created_seq FROM nation
    """,
    "time_corrections": """
        SELECT concat('cam', lpad(cast(r_regionkey + 1 AS string), 2, '0')) AS camera_id, 'Europe/Stockholm' AS timezone,
        cast(CASE r_regionkey WHEN 0 THEN 0 WHEN 1 THEN 120 WHEN 2 THEN -180 ELSE 300 END AS int) AS offset_seconds,
        cast(CASE r_regionkey WHEN 0 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 3 ELSE 2 END AS double) AS clock_drift_ppm FROM region WHERE r_regionkey < 4
    """,
    "detections": """
        SELECT concat('det_', l_orderkey, '_', l_linenumber) AS detection_id, concat('obs_', l_orderkey) AS event_id,
        concat('cam', lpad(cast(l_suppkey % 12 + 1 AS string), 2, '0')) AS camera_id, l_shipdate AS timestamp,
        CASE l_partkey % 8 WHEN 0 THEN 'cat' WHEN 1 THEN 'cow' WHEN 2 THEN 'dog' WHEN 3 THEN 'Deer' WHEN 4 THEN 'moose' WHEN 5 THEN 'person' WHEN 6 THEN 'toaster' ELSE 'lynx' END AS label,
        CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_discount * 10 END AS confidence,
        CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE concat('{"x_min":', l_partkey % 1900, ',"y_min":', l_suppkey % 1000, ',"x_max":', l_partkey % 1900 + cast(l_quantity AS int), ',"y_max":', l_suppkey % 1000 + cast(l_quantity AS int), '}') END AS bounding_box,
        1920 AS image_width, 1080 AS image_height, concat('v1.', l_linenumber, '.0') AS model_version FROM lineitem
    """,
    "capture_events": """
        SELECT concat('evt_', event_id) AS event_id, concat('session-', strftime_like, '-', lpad(cast(user_id AS string), 6, '0')) AS session_id,
        concat('cam', lpad(cast(user_id % 105 AS string), 2, '0')) AS camera_id, concat(strftime_like, 'T', lpad(cast(event_id % 24 AS string), 2, '0'), ':00:00', CASE WHEN event_id % 29 = 0 THEN '' ELSE 'Z' END) AS timestamp_utc,
        concat('img/', event_id, '.jpg') AS image_path, cast((event_id * 7) % 10100 AS int) AS image_width, 1080 AS image_height,
        CASE event_id % 6 WHEN 0 THEN 'PNG' WHEN 1 THEN 'TIFF' WHEN 2 THEN 'GIF' ELSE 'JPEG' END AS image_format, cast(event_id % 4 AS int) AS detection_count, event_id % 3 > 0 AS observation_any,
        CASE WHEN event_id % 9 = 0 THEN NULL ELSE cast(event_id % 104 AS double) END AS humidity_percent, CASE WHEN event_id % 500 = 0 THEN 'events_v0' ELSE 'events_v1' END AS contract_version
        FROM (SELECT *, concat('2024-01-', lpad(cast(event_id % 30 + 1 AS string), 2, '0')) AS strftime_like FROM events) e
    """,
    "frames": """
        SELECT concat('video_', user_id % 7) AS video_id, event_id AS frame_no, cast(10 + user_id % 7 AS int) AS fps FROM events
    """,
    "weather_json": """
        SELECT o_orderkey AS id, concat('{"properties":{"timeseries":[{"time":"2024-01-', lpad(cast(o_orderkey % 30 + 1 AS string), 2, '0'), 'T', lpad(cast(o_orderkey % 24 AS string), 2, '0'), ':00:00Z","data":{"instant":{"details":{"air_temperature":', o_orderkey % 30 - 10, ',"wind_from_direction":', o_orderkey % 360, ',"cloud_area_fraction":', o_orderkey % 101, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat(',"precipitation_amount":', o_orderkey % 5) END, '}}}}]}}') AS body FROM orders
    """,
    "file_listing": """
        SELECT concat('cam', lpad(cast(user_id % 5 + 1 AS string), 2, '0'), '/', CASE WHEN event_id % 3 = 0 THEN '20240115143022' ELSE 'IMG' END, '_', event_id, CASE event_id % 4 WHEN 0 THEN '.JPG' WHEN 1 THEN '.mp4' WHEN 2 THEN '.txt' ELSE '.jpeg' END) AS path, cast(event_id * 1000 AS bigint) AS size_bytes, ts AS modified FROM events
    """,
    "points": """
        SELECT vec AS seq, cast(590000000 + (vec * 7919) % 2000 AS double) / cast(10000000 AS double) AS latitude, cast(180000000 + (vec * 104729) % 4000 AS double) / cast(10000000 AS double) AS longitude FROM (SELECT c_custkey AS vec FROM customer) c
    """,
}
#: Predictions with their row's place in the manifest, for queries that must tell apart those of one path.
VIEWS["placed_predictions"] = VIEWS["predictions"].replace("SELECT crop_path,", "SELECT seq AS place, crop_path,")
#: SQL for the manifest with the last row of each path only.
LAST_MANIFEST = "(SELECT * FROM manifest QUALIFY row_number() OVER (PARTITION BY crop_path ORDER BY seq DESC) = 1)"


def needs(name: str) -> list[str]:
    """The view and the views that it reads, those first."""
    found: list[str] = []
    for other in VIEWS:
        if other != name and re.search(rf"\bFROM {other}\b", VIEWS[name]):
            found += [x for x in needs(other) if x not in found]
    return [*found, name]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the tables in sf_dir, planned lazily."""
    texts = [VIEWS[v] for v in needs(name)]
    for table in BASE:
        if any(re.search(rf"\bFROM {table}\b", t) for t in texts):
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    for v in needs(name)[:-1]:
        spark.sql(VIEWS[v]).createOrReplaceTempView(v)
    return spark.sql(VIEWS[name])


def with_views(names: str, body: str, more: str = "", recursive: bool = False) -> str:
    """SQL text: body after a WITH clause of the named views, and further common tables in ``more``."""
    order: list[str] = []
    for name in names.split():
        order += [v for v in needs(name) if v not in order]
    parts = [f"{v} AS ({VIEWS[v]})" for v in order] + ([more] if more else [])
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {body}"
