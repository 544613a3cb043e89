"""Column functions on text, time, numbers and maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_decimal(x: Column) -> Column:
    """Half to even on the exact binary value, as C and Python print; format_string rounds the decimal form instead."""
    return F.replace(F.format_number(x, 1), F.lit(","), F.lit(""))


def format_duration(seconds: Column) -> Column:
    """Seconds under a minute, minutes under an hour, else hours; one decimal."""
    unit = lambda x, name: F.concat(one_decimal(x), F.lit(name))
    return F.when(seconds < 60, unit(seconds, "s")).when(seconds < 3600, unit(seconds / 60, "m")).otherwise(unit(seconds / 3600, "h"))


# Corrections of common misreadings, which come first, then direct names.
CORRECTIONS = {
    "deer": "roedeer", "elk": "moose", "wild_boar": "boar", "wildboar": "boar", "roe_deer": "roedeer", "roedeer": "roedeer", "bear": "boar",
    "cow": "moose", "horse": "moose", "sheep": "roedeer", "dog": "boar", "elephant": "boar", "cat": "fox", "kitten": "fox", "red_fox": "fox",
    "vulpes_vulpes": "fox", "marten": "badger", "weasel": "badger", "meles_meles": "badger",
}
GENERIC = {"animal": "animal", "person": "person", "vehicle": "vehicle"}
KNOWN = {
    "moose": "moose", "elk": "moose", "boar": "boar", "wild_boar": "boar", "roe_deer": "roedeer", "roedeer": "roedeer", "red_deer": "red_deer",
    "fallow_deer": "fallow_deer", "bear": "bear", "wolf": "wolf", "lynx": "lynx", "fox": "fox", "badger": "badger", "hare": "hare", "rabbit": "rabbit",
}
LABEL_MAP = {**KNOWN, **GENERIC, **CORRECTIONS}


def map_species_label(label: Column) -> Column:
    """The species of a raw label, null where it is none."""
    pairs = [F.lit(x) for kv in sorted(LABEL_MAP.items()) for x in kv]
    return F.element_at(F.create_map(*pairs), F.lower(label))


def dms_to_decimal(degrees: Column, minutes: Column, seconds: Column, ref: Column) -> Column:
    """Each part is a struct of num and den; a zero denominator gives 0. South and west are negative; out of range is null."""
    part = lambda c: F.when(c["den"] == 0, F.lit(0.0)).otherwise(c["num"].cast("double") / c["den"])
    value = part(degrees) + part(minutes) / 60 + part(seconds) / 3600
    signed = F.when(ref.isin("S", "W"), -value).otherwise(value)
    limit = F.when(ref.isin("N", "S"), 90).otherwise(180)
    return F.when(F.abs(signed) <= limit, signed)


def exif_timestamp(tags: Column, mtime: Column) -> Column:
    """First readable of Original, Digitized and DateTime, in UTC; else the file's time."""
    read = lambda k: F.try_to_timestamp(F.element_at(tags, k), F.lit("yyyy:MM:dd HH:mm:ss"))
    return F.coalesce(read("DateTimeOriginal"), read("DateTimeDigitized"), read("DateTime"), mtime)


def infer_camera_id(path: Column) -> Column:
    """First folder of a relative path; ``unknown`` for a bare file name."""
    return F.when(F.instr(path, "/") > 0, F.element_at(F.split(path, "/"), 1)).otherwise("unknown")


def normalize_to_utc(local: Column, zone: Column) -> Column:
    """Local time to UTC; of the repeated autumn hour, the later reading (standard time)."""
    first = F.to_utc_timestamp(local, zone)
    later = first + F.expr("INTERVAL 1 HOUR")
    return F.when(F.from_utc_timestamp(later, zone) == local.cast("timestamp"), later).otherwise(first)


def corrected_micros(ts: Column, offset: Column, ppm: Column) -> Column:
    """Microseconds since 1970: moved by the offset, then by drift (parts per million of the whole epoch)."""
    moved = F.unix_micros(ts.cast("timestamp")) + offset.cast("long") * 1_000_000
    return moved + F.bround(ppm / F.lit(1e6) * (moved / F.lit(1e6)) * F.lit(1e6)).cast("long")


def in_region(lat: Column, lon: Column) -> Column:
    """Inside the survey region's box."""
    return F.coalesce(lat.between(55.3, 69.1) & lon.between(10.6, 24.2), F.lit(False))


def safe_filename(name: Column) -> Column:
    clean = F.btrim(F.translate(name, '<>:"/\\|?*', "_________"), F.lit(" ."))
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit("unnamed"))


IMAGE = (".jpg", ".jpeg", ".png", ".bmp", ".tiff", ".tif")
VIDEO = (".mp4", ".avi", ".mov", ".mkv", ".wmv")


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def media_type(path: Column) -> Column:
    return F.when(extension(path).isin(*IMAGE), "image").when(extension(path).isin(*VIDEO), "video").otherwise("other")


def storage_url_parts(url: Column) -> tuple[Column, Column]:
    """Scheme (file where there is none) and path."""
    scheme = F.regexp_extract(url, r"^([a-z0-9]+)://", 1)
    return F.when(scheme == "", "file").otherwise(scheme), F.regexp_replace(url, r"^[a-z0-9]+://", "")


def s3_parts(url: Column) -> tuple[Column, Column, Column]:
    """Bucket, key and whether both are well formed."""
    bucket, key = F.regexp_extract(url, r"^s3://([^/]*)/", 1), F.regexp_extract(url, r"(?s)^s3://[^/]*/(.*)$", 1)
    return bucket, key, F.coalesce(bucket.rlike(r"^[a-z0-9.-]{3,63}$") & (key != "") & ~key.startswith("/"), F.lit(False))


def url_valid(url: Column) -> Column:
    return F.coalesce(url.rlike(r"^(http|https|s3|file)://[^/?#]+"), F.lit(False))


# Parts of names whose values are hidden.
SENSITIVE = ("password", "secret", "key", "token", "credential")


def redact_sensitive(values: Column) -> Column:
    """Map values under sensitive names are replaced."""
    hidden = lambda k: F.lower(k).rlike("|".join(SENSITIVE))
    return F.transform_values(values, lambda k, v: F.when(hidden(k), "***REDACTED***").otherwise(v))


def config_hash(value: Column) -> Column:
    """First 16 hex digits of the hash of a struct's JSON."""
    return F.substring(F.sha2(F.to_json(value), 256), 1, 16)


def probabilities_valid(probabilities: Column, confidence: Column) -> Column:
    total = F.aggregate(F.map_values(probabilities), F.lit(0.0), lambda s, x: s + x)
    return F.coalesce(total.between(0.99, 1.01) & confidence.between(0, 1), F.lit(False))


def iso_time(text: Column) -> Column:
    """ISO time with an optional Z or offset; null where it can't be read."""
    return F.try_to_timestamp(F.regexp_replace(text, "Z$", "+00:00"))
