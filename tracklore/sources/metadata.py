"""Effective-dated metadata: records valid from one time to another, appended with defaults, and versions of whole tables.

A table is published in three steps: the rows go to a folder of their own, a manifest with count and checksum is written for the
version, and last the pointer, one small file, is replaced by a rename. Readers follow the pointer, so they see the old version or
the new one, never half of one, and a writer that dies before the last step has changed nothing for them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracklore.sources.writers import checksum

#: Defaults of a record that does not say, by kind.
DEFAULTS = {"correction": {"rule_id": "manual_correction"}, "mapping": {"map_version": "1.0.0", "alias": None}}
POINTER = "current.json"


def effective_records(rows: DataFrame, kind: str, now: str | None = None) -> DataFrame:
    """Whole records of what is known of them: ``<kind>_id`` is ``<kind>_<camera>_<epoch of from>``; a missing or null from is now, a missing
    to is open, kinds have defaults of their own, and created_at is now. now: a timestamp as text; the query's own time if not given."""
    at = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    out = rows
    for name, value in {"effective_from": at, "effective_to": F.lit(None).cast("timestamp"), "created_at": at}.items():
        out = out.withColumn(name, F.coalesce(F.col(name).cast("timestamp"), value) if name in rows.columns else value)
    for name, value in DEFAULTS[kind].items():
        own = F.lit(value).cast("string")
        out = out.withColumn(name, F.coalesce(F.col(name), own) if name in rows.columns else own)
    return out.withColumn(f"{kind}_id", F.concat_ws("_", F.lit(kind), "camera_id", F.unix_seconds("effective_from").cast("string")))


def append_effective(table: DataFrame, rows: DataFrame, kind: str, now: str | None = None) -> DataFrame:
    """The table with the rows' records after its own, in the table's columns; columns that only one side has are null on the other."""
    added = effective_records(rows, kind, now)
    for name, value in table.dtypes:
        if name in added.columns:
            added = added.withColumn(name, F.col(name).cast(value))
    return table.unionByName(added.select(*[c for c in table.columns if c in added.columns]), allowMissingColumns=True)


def overlaps(table: DataFrame, by: str, record_id: str) -> DataFrame:
    """Each record whose time meets that of one of its ``by`` that begins earlier (or with it, with a smaller id): adds
    ``meets``, the id of the one among them that lasts longest. Ends count as valid; an open end lasts for ever.

    A sweep: records of a camera in order of their from; each looks at the furthest end before it.
    """
    end = F.struct(F.col("effective_to").isNull().alias("open"), F.col("effective_to").alias("to"), F.col(record_id).alias("id"))
    before = Window.partitionBy(by).orderBy("effective_from", record_id).rowsBetween(Window.unboundedPreceding, -1)
    furthest = table.withColumn("__f", F.max(end).over(before))
    return furthest.filter(F.col("__f.open") | (F.col("__f.to") >= F.col("effective_from"))).select(*table.columns, F.col("__f.id").alias("meets"))


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file: written beside it under another name, then renamed over it."""
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target, temporary = fs.Path(path), fs.Path(f"{path}.{uuid.uuid4().hex}")
    store = target.getFileSystem(conf)
    out = store.create(temporary, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename = getattr(fs, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    fs.FileContext.getFileContext(store.makeQualified(target).toUri(), conf).rename(temporary, target, options)


def stage(rows: DataFrame, path: str, version: str) -> dict:
    """Steps one and two: the rows and the manifest of a version, which readers do not see yet."""
    spark = rows.sparkSession
    folder = f"v{version}/{uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{folder}")
    found = checksum(spark.read.parquet(f"{path}/{folder}")).first()
    manifest = {"version": version, "folder": folder, "n": found["n"], "checksum": found["checksum"]}
    _put(spark, f"{path}/manifests/v{version}.json", json.dumps(manifest))
    return manifest


def point(spark: SparkSession, path: str, version: str) -> None:
    """Step three, or a way back: from now on readers get this version."""
    _put(spark, f"{path}/{POINTER}", json.dumps(manifest_of(spark, path, version)))


def publish(rows: DataFrame, path: str, version: str) -> dict:
    """Write a version and make it the current one; returns its manifest."""
    manifest = stage(rows, path, version)
    point(rows.sparkSession, path, version)
    return manifest


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """version, folder, n and checksum of every version that was written."""
    return spark.read.schema("version string, folder string, n long, checksum string").json(f"{path}/manifests/*.json")


def manifest_of(spark: SparkSession, path: str, version: str | None = None) -> dict:
    """Of one version, or of the current one: a file of one line."""
    name = POINTER if version is None else f"manifests/v{version}.json"
    return json.loads(spark.read.text(f"{path}/{name}").first()[0])


def read_version(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The rows of a version, or of the current one."""
    return spark.read.parquet(f"{path}/{manifest_of(spark, path, version)['folder']}")


def verify(spark: SparkSession, path: str, version: str | None = None) -> bool:
    """Whether the stored rows still have the count and checksum of their manifest."""
    want = manifest_of(spark, path, version)
    found = checksum(read_version(spark, path, version)).first()
    return (found["n"], found["checksum"]) == (want["n"], want["checksum"])
