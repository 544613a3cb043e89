"""Schemas of the stored tables."""

OBSERVATIONS = "observation_id string, seq bigint, camera_id string, timestamp timestamp_ntz, top_label string, top_confidence double, needs_review boolean, gps_latitude double, gps_longitude double, cluster_id string"
MANIFEST = "seq bigint, crop_path string, source_path string, camera_id string, timestamp timestamp_ntz, x1 double, y1 double, x2 double, y2 double, det_score double, image_width int, image_height int"
PREDICTIONS = "crop_path string, label string, confidence double, auto_ok boolean"
TIME_CORRECTIONS = "camera_id string, location string, timezone string, offset_seconds int, clock_drift_ppm double, notes string"
