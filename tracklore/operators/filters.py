"""Filters, flags and box geometry over detections with corners x1, y1, x2, y2, det_score, image_width and image_height."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def relative_area() -> Column:
    image = F.col("image_width").cast("double") * F.col("image_height")
    return F.when(image > 0, (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) / image).otherwise(F.lit(0.0))


def near_edge(margin: float) -> Column:
    return (F.col("x1") < margin) | (F.col("y1") < margin) | (F.col("image_width") - F.col("x2") < margin) | (F.col("image_height") - F.col("y2") < margin)


def no_box() -> Column:
    return F.col("x1").isNull() | F.col("y1").isNull() | F.col("x2").isNull() | F.col("y2").isNull()


def flat_box() -> Column:
    return (F.col("x2") <= F.col("x1")) | (F.col("y2") <= F.col("y1"))


def drop_reason(conf: float = 0.3, min_rel: float = 0.003, max_rel: float = 0.8, min_asp: float = 0.2, max_asp: float = 5.0, edge: float = 12, tiny: float = 0.01) -> Column:
    """The first test that a box fails, or null for a box that stays. ``tiny`` is the effective lower bound of the area."""
    aspect = (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    return (
        F.when(no_box() | F.col("det_score").isNull(), "invalid_bbox")
        .when(F.col("det_score") < conf, "confidence")
        .when(flat_box(), "invalid_bbox")
        .when((relative_area() < min_rel) | (relative_area() > max_rel), "area")
        .when(relative_area() < tiny, "tiny_object")
        .when((aspect < min_asp) | (aspect > max_asp), "aspect_ratio")
        .when(near_edge(edge), "edge_proximity")
    )


def filter_bboxes(boxes: DataFrame, **limits: float) -> DataFrame:
    return boxes.filter(drop_reason(**limits).isNull())


def drop_reasons(boxes: DataFrame, **limits: float) -> DataFrame:
    return boxes.groupBy(F.coalesce(drop_reason(**limits), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def is_doubtful(conf: float = 0.3, edge: float = 12, tiny: float = 0.01, min_rel: float = 0.003, margin: float = 0.05) -> Column:
    """Whether a box should be reviewed; missing or flat boxes should."""
    s, rel = F.col("det_score"), relative_area()
    bad = no_box() | s.isNull() | flat_box() | (F.col("image_width") <= 0) | (F.col("image_height") <= 0)
    return F.coalesce(bad | ((s >= conf) & (s < conf + margin)) | near_edge(edge) | (rel < tiny) | ((rel >= min_rel) & (rel < min_rel * 1.5)), F.lit(True))


def simple_filter_and_flag(boxes: DataFrame, conf: float = 0.5, area: float = 0.01, doubt: float = 0.3) -> DataFrame:
    return boxes.withColumn("area", relative_area()).filter((F.coalesce("det_score", F.lit(0.0)) >= conf) & (F.coalesce("area", F.lit(0.0)) >= area)).withColumn("is_doubtful", F.col("det_score") < doubt)


def crop_box(boxes: DataFrame, pad: float = 0.15) -> DataFrame:
    """Integer crop corners: padded by a share of the box, held inside the image, rounded half to even, never empty."""
    w, h = F.greatest(F.lit(1.0), F.col("x2") - F.col("x1")), F.greatest(F.lit(1.0), F.col("y2") - F.col("y1"))
    held = lambda v, top: F.bround(F.least(F.greatest(v, F.lit(0.0)), top.cast("double"))).cast("int")
    out = (
        boxes.withColumn("crop_x1", held(F.col("x1") - w * pad, F.col("image_width")))
        .withColumn("crop_y1", held(F.col("y1") - h * pad, F.col("image_height")))
        .withColumn("crop_x2", held(F.col("x2") + w * pad, F.col("image_width")))
        .withColumn("crop_y2", held(F.col("y2") + h * pad, F.col("image_height")))
    )
    for low, high, top in (("crop_x1", "crop_x2", "image_width"), ("crop_y1", "crop_y2", "image_height")):
        out = out.withColumn(high, F.when(F.col(high) <= F.col(low), F.least(F.col(top), F.col(low) + 1)).otherwise(F.col(high)))
    return out


def xywh_to_xyxy(rows: DataFrame) -> DataFrame:
    return rows.withColumn("x2", F.col("x") + F.col("w")).withColumn("y2", F.col("y") + F.col("h")).withColumnsRenamed({"x": "x1", "y": "y1"}).drop("w", "h")


def review_status(rows: DataFrame) -> DataFrame:
    """A doubtful row needs review; an automatically approved row that needs review breaks the rule."""
    needs = F.col("needs_review") | F.col("doubtful")
    return rows.withColumn("review", needs).withColumn("violation", F.col("auto_ok") & needs)


def gps_truthy(lat: str = "gps_latitude", lon: str = "gps_longitude") -> Column:
    """Both present and not zero: zero stands for missing here."""
    return F.coalesce((F.col(lat) != 0) & (F.col(lon) != 0), F.lit(False))


def confidence_band(c: Column) -> Column:
    return F.when(c >= 0.7, "high").when(c >= 0.4, "medium").when(c >= 0.2, "low").otherwise("none")


def species_thresholds(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """limits(label, min_conf, min_rel, max_rel, edge): rows within the limits of their own species."""
    joined = rows.join(limits, "label")
    rel = relative_area()
    edge = (F.col("x1") >= F.col("edge")) & (F.col("y1") >= F.col("edge")) & (F.col("image_width") - F.col("x2") >= F.col("edge")) & (F.col("image_height") - F.col("y2") >= F.col("edge"))
    return joined.filter((F.col("confidence") >= F.col("min_conf")) & rel.between(F.col("min_rel"), F.col("max_rel")) & edge).select(*rows.columns)


def positive_observations(obs: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Sightings with a place within the last days, newest first."""
    recent = F.col("timestamp").cast("timestamp") >= as_of - F.make_dt_interval(F.lit(days))
    return obs.filter(F.col("top_label").isNotNull() & F.col("gps_latitude").isNotNull() & F.col("gps_longitude").isNotNull() & recent).orderBy(F.desc("timestamp"), "observation_id")


def readme_table(obs: DataFrame) -> DataFrame:
    """The output table of the field guide: Dato, Tid, Sted, Art, Antal, Kvalitet, Billede."""
    grouped = obs.filter("top_label IS NOT NULL").groupBy(F.date_format("timestamp", "yyyy-MM-dd").alias("Dato"), F.date_format("timestamp", "HH:mm").alias("Tid"), F.col("camera_id").alias("Sted"), F.col("top_label").alias("Art"))
    return grouped.agg(F.count("*").alias("Antal"), F.round(F.max("top_confidence"), 2).alias("Kvalitet"), F.min("observation_id").alias("Billede"))
