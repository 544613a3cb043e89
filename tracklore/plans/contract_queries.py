"""Data-contract queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklore.operators import contracts as c
from tracklore.operators import episodes as e
from tracklore.plans.episode_queries import common, rows_of
from tracklore.plans.registry import query


def report_sql(rules: tuple[c.Rule, ...], source: str, unique: str | None = None) -> str:
    """The same report as a union of one scan per rule."""
    parts = []
    for r in rules:
        there = f"{r.column} IS NOT NULL" if r.column else "true"
        valid = r.valid.replace("\\\\", "\\")
        if " RLIKE " in valid:
            left, right = valid.split(" RLIKE ")
            valid = f"regexp_matches({left}, {right})"
        parts.append(f"SELECT '{r.name}' AS rule, count(*) FILTER ({there}) AS evaluated, count(*) FILTER ({there} AND NOT coalesce({valid}, false)) AS failed, {r.mostly}e0 AS mostly FROM {source}")
    if unique:
        parts.append(f"SELECT '{unique}_unique', cast(coalesce(sum(n), 0) AS bigint), cast(coalesce(sum(CASE WHEN n > 1 THEN n ELSE 0 END), 0) AS bigint), 1.0e0 FROM (SELECT count(*) AS n FROM {source} GROUP BY {unique})")
    return f"SELECT rule, evaluated, failed, share, share >= mostly AS success FROM (SELECT *, CASE WHEN evaluated > 0 THEN round((evaluated - failed) / evaluated, 9) ELSE 1 END AS share FROM ({' UNION ALL '.join(parts)}))"


def contract(name: str, view: str, rules: tuple[c.Rule, ...], unique: str | None = None) -> None:
    query(name, view, report_sql(rules, view, unique))(lambda d: c.quality_report(d, rules, unique))


contract("validate_events_contract", "capture_events", c.EVENTS, "event_id")
contract("validate_detections_contract", "detections", c.DETECTIONS, "detection_id")
contract("quality_report", "detections", c.DETECTIONS)
contract("rule_mostly", "capture_events", tuple(r for r in c.EVENTS if r.mostly < 1))
contract("observation_any_consistent", "capture_events", tuple(r for r in c.EVENTS if r.name == "observation_any_consistent"))
contract("label_whitelist", "detections", c.DETECTIONS[:2])
contract("gps_range", "observations", c.GPS_RULES)
contract("manifest_valid", "manifest", c.MANIFEST_RULES)
contract("bbox_order", "manifest", c.MANIFEST_RULES[:1])
contract("conf_range", "detections", (c.between("confidence", 0, 1),))
contract("effective_period", "exif_corrections", c.PERIOD_RULES)
contract("utc_only", "capture_events", c.EVENTS[:1])
INSIDE = "coalesce(cast(json_extract(bounding_box, '$.x_min') AS double) >= 0 AND cast(json_extract(bounding_box, '$.y_min') AS double) >= 0 AND cast(json_extract(bounding_box, '$.x_max') AS double) <= image_width AND cast(json_extract(bounding_box, '$.y_max') AS double) <= image_height, false)"
query("bbox_within_image", "detections", f"SELECT count(*) AS total, count(*) FILTER ({INSIDE}) AS inside, count(*) FILTER (NOT {INSIDE}) AS outside FROM detections WHERE bounding_box IS NOT NULL")(c.bbox_within_image)
query("compressed_valid", "manifest predictions", report_sql(c.EPISODE_RULES, "episodes"), more=common(360), recursive=True)(lambda m, p: c.quality_report(e.compress(rows_of(m, p), 360), c.EPISODE_RULES))
KIND = "CASE WHEN seq % 50 = 0 THEN 'sketch' WHEN seq % 2 = 0 THEN 'image' ELSE 'video' END"
query("artifact_type_valid", "observations", report_sql(c.ARTIFACT_RULES, f"(SELECT {KIND} AS artifact_type FROM observations)"))(lambda o: c.quality_report(o.select(F.expr(KIND).alias("artifact_type")), c.ARTIFACT_RULES))
query("contract_violations", "capture_events", "SELECT event_id, timestamp_utc, image_format FROM capture_events WHERE NOT regexp_matches(timestamp_utc, '" + c.ISO_Z.replace("\\\\", "\\") + f"') OR NOT image_format IN {c.IMAGE_FORMATS}")(
    lambda d: c.violations(d, tuple(r for r in c.EVENTS if r.name in ("timestamp_utc_format", "image_format"))).filter(F.size("broken") > 0).select("event_id", "timestamp_utc", "image_format")
)
query("map_label_then_whitelist", "detections", f"SELECT label, count(*) AS n, lower(label) IN {c.LABELS} AS allowed FROM detections GROUP BY label")(
    lambda d: d.groupBy("label").agg(F.count("*").alias("n")).withColumn("allowed", F.lower("label").isin(*c.LABELS))
)
