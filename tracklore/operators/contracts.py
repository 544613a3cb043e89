"""Data contracts: a table of rules, checked in one pass.

A rule is a name, a predicate that valid rows meet, and the least share of valid rows among those where the predicate's column is not
null (1.0: every one). All rules of a contract become measures of one aggregation, whatever their number; only uniqueness
needs a shuffle of its own, by key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    valid: str
    column: str | None = None
    mostly: float = 1.0


def between(column: str, low: float, high: float, mostly: float = 1.0) -> Rule:
    return Rule(f"{column}_range", f"{column} BETWEEN {low} AND {high}", column, mostly)


# The contract's bounds, formats and names.
IMAGE_FORMATS = ("JPEG", "PNG", "TIFF", "BMP", "WEBP")
LABELS = (
    "deer", "roe_deer", "red_deer", "moose", "elk", "boar", "wild_boar", "bear", "wolf", "lynx", "fox", "red_fox", "badger", "otter", "beaver", "bird", "eagle", "owl", "crow", "raven",
    "human", "vehicle", "bicycle", "motorcycle", "unknown", "other",
)
ISO_Z = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\\.[0-9]+)?Z$"

EVENTS = (
    Rule("timestamp_utc_format", f"timestamp_utc RLIKE '{ISO_Z}'", "timestamp_utc"),
    between("detection_count", 0, 1000),
    Rule("observation_any_consistent", "observation_any = (detection_count > 0)", "observation_any"),
    between("image_width", 1, 10000),
    between("image_height", 1, 10000),
    between("humidity_percent", 0, 100, 0.95),
    Rule("contract_version", "contract_version = 'events_v1'", "contract_version"),
    Rule("image_format", f"image_format IN {IMAGE_FORMATS}", "image_format"),
    Rule("camera_id_format", "camera_id RLIKE '^cam[0-9]{2}$'", "camera_id"),
    Rule("session_id_format", "session_id RLIKE '^session-[0-9]{4}-[0-9]{2}-[0-9]{2}-[0-9]{6}$'", "session_id"),
)
DETECTIONS = (
    Rule("label_whitelist", f"label IN {LABELS}", "label"),
    Rule("label_whitelist_any_case", f"lower(label) IN {LABELS}", "label"),
    between("confidence", 0, 1),
    between("image_width", 1, 10000),
    between("image_height", 1, 10000),
    Rule("camera_id_format", "camera_id RLIKE '^cam[0-9]{2}$'", "camera_id"),
    Rule("model_version_format", r"model_version RLIKE '^v[0-9]+\\.[0-9]+\\.[0-9]+$'", "model_version"),
    Rule("bounding_box_format", r"bounding_box RLIKE '^\\{.*x_min.*y_min.*x_max.*y_max.*\\}$'", "bounding_box"),
)


def quality_report(rows: DataFrame, rules: tuple[Rule, ...], unique: str | None = None) -> DataFrame:
    """rule, evaluated, failed, share and success of each rule; ``unique`` adds a rule that a key doesn't repeat."""
    measures = []
    for i, rule in enumerate(rules):
        there = F.col(rule.column).isNotNull() if rule.column else F.lit(True)
        measures += [F.count(F.when(there, 1)).alias(f"e{i}"), F.count(F.when(there & ~F.coalesce(F.expr(rule.valid), F.lit(False)), 1)).alias(f"f{i}")]
    one = rows.agg(*measures)
    long = one.select(F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"e{i}").alias("evaluated"), F.col(f"f{i}").alias("failed"), F.lit(r.mostly).alias("mostly")) for i, r in enumerate(rules)])).alias("r")).select("r.*")
    if unique:
        keys = rows.groupBy(unique).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("evaluated"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)), F.lit(0)).alias("failed"))
        long = long.unionByName(keys.select(F.lit(f"{unique}_unique").alias("rule"), "evaluated", "failed", F.lit(1.0).alias("mostly")))
    share = F.when(F.col("evaluated") > 0, F.round((F.col("evaluated") - F.col("failed")) / F.col("evaluated"), 9)).otherwise(F.lit(1.0))
    return long.withColumn("share", share).withColumn("success", F.col("share") >= F.col("mostly")).drop("mostly")


def column_set(rows: DataFrame, expected: list[str]) -> DataFrame:
    """Columns missing from, or not in, the contract: a comparison of schemas, no data is read."""
    there = set(rows.columns)
    diff = [(c, "missing") for c in sorted(set(expected) - there)] + [(c, "unexpected") for c in sorted(there - set(expected))]
    return rows.sparkSession.createDataFrame(diff, "column string, problem string")


BOX = "x_min double, y_min double, x_max double, y_max double"


def bbox_inside(box: Column, width: Column, height: Column) -> Column:
    """Whether a JSON box lies in the image; what can't be read lies outside."""
    b = F.from_json(box, BOX)
    return F.coalesce((b["x_min"] >= 0) & (b["y_min"] >= 0) & (b["x_max"] <= width) & (b["y_max"] <= height), F.lit(False))


def bbox_within_image(rows: DataFrame) -> DataFrame:
    inside = bbox_inside(F.col("bounding_box"), F.col("image_width"), F.col("image_height"))
    return rows.filter("bounding_box IS NOT NULL").agg(F.count("*").alias("total"), F.count(F.when(inside, 1)).alias("inside"), F.count(F.when(~inside, 1)).alias("outside"))


def violations(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Adds ``broken``, the names of the rules that a row breaks; valid rows have none."""
    checks = [F.when((F.col(r.column).isNotNull() if r.column else F.lit(True)) & ~F.coalesce(F.expr(r.valid), F.lit(False)), F.lit(r.name)) for r in rules]
    return rows.withColumn("broken", F.array_compact(F.array(*checks)))


GPS_RULES = (between("gps_latitude", -90, 90), between("gps_longitude", -180, 180))
MANIFEST_RULES = (Rule("bbox_order", "x2 > x1 AND y2 > y1"), between("det_score", 0, 1), Rule("bbox_complete", "x1 IS NOT NULL AND y1 IS NOT NULL AND x2 IS NOT NULL AND y2 IS NOT NULL"))
EPISODE_RULES = (Rule("end_after_start", "end_time > start_time"), Rule("duration_positive", "duration_seconds > 0"), Rule("frames_positive", "frame_count > 0"))
PERIOD_RULES = (Rule("effective_period", "effective_to IS NULL OR effective_to > effective_from"), Rule("delta_range", "delta_seconds BETWEEN -86400 AND 86400", "delta_seconds"))
ARTIFACTS = ("image", "video", "crop", "manifest", "other")
ARTIFACT_RULES = (Rule("artifact_type_valid", f"artifact_type IN {ARTIFACTS}", "artifact_type"),)
