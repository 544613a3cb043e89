"""Continuous forms of the operators, on Structured Streaming.

``drain`` runs a stream over all that is there now and stops, so that a batch of files can be replayed and compared with the
batch operator; in production the same plans run under a processing-time trigger.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tracklore.operators.contracts import Rule, violations
from tracklore.operators.reports import count_true, enrich_cluster_names, mean


def read_parquet(spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def ingest_manifest(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """Line-JSON files as they arrive; lines that can't be read are left out."""
    rows = spark.readStream.schema(f"{schema}, _corrupt_record string").option("maxFilesPerTrigger", files_per_trigger).json(path)
    return rows.filter("_corrupt_record IS NULL").drop("_corrupt_record")


def drain(stream: DataFrame, mode: str, out: str, checkpoint: str, work: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run to the end of what is there; every batch is one folder of ``out``, so a batch that runs again overwrites its own."""
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        (work(batch) if work else batch).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch_{number:09d}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/batch_*")


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of an update-mode result, the last batch's row of each key."""
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")


def timed(rows: DataFrame, late: str) -> DataFrame:
    """Event time as an instant (streams know no zoneless time), with its watermark."""
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", late)


def condense(obs: DataFrame, minutes: int = 10, late: str = "1 hour") -> DataFrame:
    """Rows per tumbling window; rows later than the watermark are dropped, and their windows' state with them."""
    w = F.window("timestamp", f"{minutes} minutes")
    return timed(obs, late).groupBy(w.alias("w")).agg(F.count("*").alias("total")).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), "total")


def condense_sessions(obs: DataFrame, gap: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Gap-based variant per camera, beside the anchored episodes."""
    s = F.session_window("timestamp", gap)
    return timed(obs, late).groupBy("camera_id", s.alias("s")).agg(F.count("*").alias("total")).select("camera_id", F.col("s.start").alias("session_start"), "total")


def enrich_names(obs: DataFrame, names: DataFrame) -> DataFrame:
    """Stream-static left join; the static side is read anew for each batch."""
    return enrich_cluster_names(obs, names)


def dedupe(obs: DataFrame, key: str = "observation_id", late: str = "1 day") -> DataFrame:
    return timed(obs, late).dropDuplicatesWithinWatermark([key])


def species_counts(obs: DataFrame) -> DataFrame:
    """Running counts; one row per species is kept as state."""
    return obs.groupBy("top_label").agg(F.count("observation_id").alias("total_detections"), mean("top_confidence").alias("avg_confidence"), count_true("needs_review").alias("needs_review_count"))


def split_valid(batch: DataFrame, number: int, rules: tuple[Rule, ...], good: str, bad: str) -> None:
    """For foreachBatch: rows that break no rule go to one table, the others to another, with the rules' names.

    Every batch is one folder of each, so a batch that runs again after a failure overwrites its own rows.
    """
    marked = violations(batch, rules).persist()
    marked.filter(F.size("broken") == 0).drop("broken").write.mode("overwrite").parquet(f"{good}/batch_{number:09d}")
    marked.filter(F.size("broken") > 0).write.mode("overwrite").parquet(f"{bad}/batch_{number:09d}")
    marked.unpersist()


EPISODE = "camera_id string, species string, start_time timestamp, end_time timestamp, frame_count long, max_confidence double"


#: Rows of a key (16 bytes each) that become one set of chunks.
CHUNK_ROWS = 1_000_000


class _Episodes(StatefulProcessor):
    """Of one camera and label. State: the open episode; the rows that the watermark has not passed, as they came, in chunks by bucket
    of time and arrival; and how many chunks a bucket has. A batch writes its own rows only, and a bucket is read once, when
    its time is over."""

    def __init__(self, window: int, least: int):
        self.window, self.least = window, least
        self.size = max(window // 8, 60_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "first long, last long, frames long, best double")
        self.chunks = handle.getMapState("chunks", "bucket long, part long", "times binary, confidences binary")
        self.parts = handle.getMapState("parts", "bucket long", "n long")

    def _timer(self, us: int) -> None:
        """Wake up when the watermark has passed the bucket that holds this time."""
        self.handle.registerTimer((us // self.size + 1) * self.size // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in rows:
            held.append((batch["timestamp"].to_numpy("datetime64[us]").astype(np.int64), batch["confidence"].to_numpy(np.float64)))
            if sum(len(t) for t, _ in held) >= CHUNK_ROWS:
                self._hold(held)
                held = []
        if held:
            self._hold(held)
        return iter(())

    def _hold(self, held: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """One more chunk for every bucket that has rows among these."""
        times, confidences = (np.concatenate(x) for x in zip(*held, strict=True))
        buckets = times // self.size
        for bucket in np.unique(buckets).tolist():
            own = buckets == bucket
            n = self.parts.getValue((bucket,))[0] if self.parts.containsKey((bucket,)) else 0
            self.chunks.updateValue((bucket, n), (times[own].tobytes(), confidences[own].tobytes()))
            self.parts.updateValue((bucket,), (n + 1,))
            if n == 0:
                self._timer(bucket * self.size)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        over = timerValues.getCurrentWatermarkInMs() * 1000 // self.size  # buckets before this one are over
        now = tuple(self.open.get()) if self.open.exists() else None
        done = []
        for bucket, n in sorted((k[0], v[0]) for k, v in self.parts.iterator()):
            if bucket >= over:
                continue
            held = [self.chunks.getValue((bucket, i)) for i in range(n)]
            times, confidences = (np.concatenate([np.frombuffer(h[i], kind) for h in held]) for i, kind in ((0, np.int64), (1, np.float64)))
            order = np.argsort(times, kind="stable")
            now = self._fold(now, times[order], confidences[order], done)
            for i in range(n):
                self.chunks.removeKey((bucket, i))
            self.parts.removeKey((bucket,))
        if now and now[0] + self.window < over * self.size:
            done.append(now)
            now = None
        if now:
            self.open.update(now)
            self._timer(now[0] + self.window)
        elif self.open.exists():
            self.open.clear()
        out = [d for d in done if d[1] - d[0] >= self.least]
        if out:
            stamp = lambda v: dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=v)
            yield pd.DataFrame([(key[0], key[1], stamp(a), stamp(b), n, m) for a, b, n, m in out], columns=["camera_id", "species", "start_time", "end_time", "frame_count", "max_confidence"])

    def _fold(self, now: tuple | None, times: np.ndarray, confidences: np.ndarray, done: list[tuple]) -> tuple | None:
        """The open episode after rows in order of time; episodes that end meanwhile go to done."""
        at = 0
        while at < len(times):
            first = now[0] if now else int(times[at])
            end = int(np.searchsorted(times, first + self.window, side="right"))
            if end > at:
                best = float(confidences[at:end].max())
                now = (first, int(times[end - 1]), (now[2] if now else 0) + end - at, max(now[3], best) if now else best)
                at = end
            if at < len(times):
                done.append(now)
                now = None
        return now

    def close(self) -> None:
        pass


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """State with timers needs the RocksDB store: streams that start inside use it; the session's own setting comes back after."""
    name, before = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def compress(rows: DataFrame, minutes: float = 10, least_seconds: float = 5, late: str = "1 hour") -> DataFrame:
    """Anchored episodes of a stream of (camera_id, label, timestamp, confidence).

    Rows of a key are held, in buckets of time, until the watermark has passed their bucket, then folded in order; an episode
    is given out when the buckets that its window reaches into are over. Start it inside ``rocksdb_state``.
    """
    keyed = timed(rows.filter("timestamp IS NOT NULL"), late)
    work = _Episodes(int(minutes * 60_000_000), int(least_seconds * 1_000_000))
    return keyed.groupBy("camera_id", "label").transformWithStateInPandas(work, EPISODE, "append", "eventTime")
