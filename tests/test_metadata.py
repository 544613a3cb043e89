"""Published metadata, file inventories and held stream rows."""

import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tracklore.sources import metadata, readers
from tracklore.streaming import streams


def test_a_writer_that_dies_changes_nothing_for_readers(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    rows = spark.range(10)
    metadata.publish(rows, path, "1")

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(metadata, "point", dies)
        with pytest.raises(RuntimeError):
            metadata.publish(rows.filter("id < 5"), path, "2")
    assert metadata.read_version(spark, path).count() == 10 and metadata.manifest_of(spark, path)["version"] == "1"
    with monkeypatch.context() as m:
        m.setattr(metadata, "_put", dies)
        with pytest.raises(RuntimeError):
            metadata.publish(rows.filter("id < 3"), path, "1")  # the same version again, cut off before its manifest
    assert metadata.read_version(spark, path).count() == 10
    metadata.point(spark, path, "2")
    assert metadata.read_version(spark, path).count() == 5 and metadata.read_version(spark, path, "1").count() == 10
    assert metadata.verify(spark, path, "1") and {r["version"]: r["n"] for r in metadata.manifests(spark, path).collect()} == {"1": 10, "2": 5}


def test_changed_rows_are_found_out(spark, tmp_path):
    path = str(tmp_path / "m")
    metadata.publish(spark.range(10), path, "1")
    folder = metadata.manifest_of(spark, path)["folder"]
    spark.range(9).withColumn("id", F.when(F.col("id") == 3, 33).otherwise(F.col("id"))).write.mode("overwrite").parquet(f"{path}/{folder}")
    assert not metadata.verify(spark, path)


def test_appended_records_and_overlaps(spark):
    have = spark.createDataFrame([("a", "c1", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 10), "x"), ("b", "c1", dt.datetime(2024, 1, 10), None, "x"), ("c", "c2", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), "x")], "mapping_id string, camera_id string, effective_from timestamp, effective_to timestamp, physical_serial string")
    more = spark.createDataFrame([("c2", "s", None, 7), ("c1", None, dt.datetime(2024, 2, 1), 8)], "camera_id string, physical_serial string, effective_from timestamp, extra int")
    got = metadata.append_effective(have, more, "mapping", "2024-03-01 00:00:00")
    assert got.columns == have.columns
    rows = {r["mapping_id"]: r for r in got.collect()}
    assert rows["mapping_c2_1709251200"]["effective_to"] is None and rows["mapping_c1_1706745600"]["physical_serial"] is None and len(rows) == 5
    assert {(r["mapping_id"], r["meets"]) for r in metadata.overlaps(got, "camera_id", "mapping_id").collect()} == {("b", "a"), ("mapping_c1_1706745600", "b")}
    whole = metadata.effective_records(more, "mapping", "2024-03-01 00:00:00").filter("camera_id = 'c2'").first()
    assert (whole["map_version"], whole["alias"], str(whole["created_at"])) == ("1.0.0", None, "2024-03-01 00:00:00")
    assert metadata.append_effective(have, more.filter("false"), "mapping").count() == 3 and metadata.overlaps(have.filter("false"), "camera_id", "mapping_id").count() == 0


def test_large_files_are_hashed_in_pieces(spark, tmp_path):
    """A sparse file of three gigabytes, more than one row may hold."""
    (tmp_path / "a b").mkdir()
    with open(tmp_path / "a b" / "clip é.MP4", "wb") as f:
        f.truncate(3 << 30)
    (tmp_path / "note.txt").write_bytes(b"note")
    got = {os.path.basename(r["path"]): r for r in readers.file_inventory(spark, str(tmp_path)).collect()}
    digest = hashlib.sha256()
    for _ in range(3 << 4):
        digest.update(bytes(1 << 26))
    clip = got["clip é.MP4"]
    assert clip["sha256"] == digest.hexdigest() and clip["size_bytes"] == 3 << 30 and clip["media_type"] == "video"
    assert got["note.txt"]["sha256"] == hashlib.sha256(b"note").hexdigest() and len(got) == 2
    assert readers.file_inventory(spark, str(tmp_path), (".txt",)).count() == 1


def test_a_hot_key_does_not_rewrite_what_it_holds(spark, tmp_path):
    """A million rows of one key are held over several batches: a batch writes its own chunks to the state, no more."""
    rows = spark.range(1_000_000).select(F.lit("c").alias("camera_id"), F.lit("fox").alias("label"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 36_000).alias("timestamp"), ((F.col("id") % 100) / 100.0).alias("confidence"), (F.col("id") % 5).cast("int").alias("file"))
    path = str(tmp_path)
    rows.repartition(5, "file").write.partitionBy("file").parquet(f"{path}/in")
    source = spark.readStream.schema("camera_id string, label string, timestamp timestamp, confidence double").option("maxFilesPerTrigger", 1)
    with streams.rocksdb_state(spark):
        both = source.parquet(f"{path}/in/*")
        query = streams.compress(both, 600, late="1 day").writeStream.outputMode("append").option("checkpointLocation", f"{path}/state").format("noop").trigger(availableNow=True).start()
        query.awaitTermination()
        written = [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"]]
        total = query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    # ten hours in buckets of 75 minutes: a batch adds one chunk and one counter to each of nine buckets
    assert len(written) == 5 and max(written) <= 60 and total <= 200


def test_held_rows_become_the_same_episodes(spark, tmp_path):
    import random

    r = random.Random(9)
    start = dt.datetime(2024, 1, 1)
    rows = [("c", r.choice(["fox", "moose", None]), start + dt.timedelta(seconds=r.randrange(0, 86_400)), r.random()) for _ in range(600)]
    schema = "camera_id string, label string, timestamp timestamp, confidence double"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{tmp_path}/in")
    spark.createDataFrame([("end", "end", dt.datetime(2030, 1, 1), 1.0)], schema).write.mode("append").parquet(f"{tmp_path}/in")
    with streams.rocksdb_state(spark):
        out = streams.drain(streams.compress(streams.read_parquet(spark, f"{tmp_path}/in", schema, 2), 10, 5, "3 days"), "append", f"{tmp_path}/out", f"{tmp_path}/state")
    got = sorted((repr(x["species"]), x["start_time"], x["end_time"], x["frame_count"], x["max_confidence"]) for x in out.collect())
    want = []
    for label in ("fox", "moose", None):
        now = None
        for _, _, t, c in sorted((x for x in rows if x[1] == label), key=lambda x: x[2]):
            if now and t > now[0] + dt.timedelta(minutes=10):
                want.append((repr(label), *now))
                now = None
            now = (now[0], t, now[2] + 1, max(now[3], c)) if now else (t, t, 1, c)
        want.append((repr(label), *now))
    assert got == sorted(w for w in want if w[2] - w[1] >= dt.timedelta(seconds=5))
