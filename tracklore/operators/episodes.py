"""Episodes: repeated sightings of one species at one camera, condensed."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklore.operators.graph import stored
from tracklore.operators.reports import mean

KEYS = ["camera_id", "label"]


def is_video(path: Column) -> Column:
    return F.contains(path, F.lit("_frame_"))


def frame_number(path: Column) -> Column:
    """Integer after ``_frame_`` in the file's stem; null where it is none."""
    return F.regexp_extract(path, r"_frame_([^/]*?)\.[^./]*$", 1).try_cast("int")


#: A block of time is at least so many windows and so many days long.
BLOCK_WINDOWS, BLOCK_DAYS = 64, 30


def _chain(times: np.ndarray, at: int, window: int) -> list[int]:
    """Places of the anchors from place ``at`` on: each the first time more than the window after the last."""
    out = []
    while at < len(times):
        out.append(at)
        at = int(np.searchsorted(times, times[at] + window, side="right"))
    return out


def _lasts(window: int, span: int):
    """Of one key and block: for each time that may be the block's first anchor, the block's last anchor, as runs of times."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        times = np.sort(rows["us"].to_numpy())
        block = int(rows["block"].iloc[0])
        # the anchor before the block reaches less than a window into it
        count = min(len(times), int(np.searchsorted(times, block * span + window)) + 1)
        # the chain from any time passes one of the window before its end: last anchors by places, from the back
        onward = np.searchsorted(times, times + window, side="right")
        ahead = np.where(onward < len(times), onward, np.arange(len(times)))
        last = ahead
        while not np.array_equal(further := last[last], last):  # each step doubles the reach of the jumps
            last = further
        last = last[:count]
        ends = np.flatnonzero(np.r_[last[1:] != last[:-1], True])
        return pd.DataFrame({"camera_id": rows["camera_id"].iloc[0], "label": rows["label"].iloc[0], "block": block, "until": times[ends], "last": times[last[ends]]})

    return run


def _carries(window: int):
    """Of one key: the last anchor before each block."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["block", "until"])
        carry, out = None, []
        for block, part in rows.groupby("block", sort=True):
            out.append((rows["camera_id"].iloc[0], rows["label"].iloc[0], block, carry))
            k = 0 if carry is None else int(np.searchsorted(part["until"].to_numpy(), carry + window, side="right"))
            if k < len(part):
                carry = int(part["last"].iloc[k])
        return pd.DataFrame(out, columns=["camera_id", "label", "block", "carry"]).astype({"carry": "Int64"})

    return run


def _assigned(window: int):
    """Of one key and block, with the last anchor before it: the anchor of each time."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("us")
        times, carry = rows["us"].to_numpy(), rows["carry"].iloc[0]
        start = 0 if pd.isna(carry) else int(np.searchsorted(times, int(carry) + window, side="right"))
        anchors = times[_chain(times, start, window)] if start < len(times) else times[:0]
        place = np.searchsorted(anchors, times, side="right") - 1
        own = np.r_[anchors, 0 if pd.isna(carry) else int(carry)][place]  # -1: the anchor carried in
        return pd.DataFrame({"camera_id": rows["camera_id"], "label": rows["label"], "us": times, "anchor_us": own})

    return run


def with_anchor(rows: DataFrame, minutes: float = 10) -> DataFrame:
    """Adds ``anchor``, the time of the first row of each row's episode: all rows within the window *of that row*.

    Each anchor depends on the one before, over the whole series of a camera and label. The distinct times of a series are cut
    into blocks; each block tells, for every time that may come to be its first anchor, which one would be its last; a fold
    over blocks (a row or a few each) carries the true one along; then each block places its times. So no task holds a
    whole series, however hot its key, and rows meet their anchor in a join on key and time.
    """
    window = int(minutes * 60_000_000)
    span = max(BLOCK_WINDOWS * window, BLOCK_DAYS * 86_400_000_000)
    us = F.unix_micros(F.col("timestamp").cast("timestamp"))
    keyed = rows.withColumn("__us", us)
    times = stored(keyed.filter("__us IS NOT NULL").select(*KEYS, F.col("__us").alias("us")).distinct().withColumn("block", F.floor(F.col("us") / span)))
    lasts = times.groupBy(*KEYS, "block").applyInPandas(lambda g: _lasts(window, span)(g), "camera_id string, label string, block long, until long, last long")
    carries = lasts.groupBy(*KEYS).applyInPandas(lambda g: _carries(window)(g), "camera_id string, label string, block long, carry long")
    on = lambda a, b, names: [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names]
    placed = times.alias("t").join(carries.alias("c"), on("t", "c", [*KEYS, "block"])).select("t.*", "c.carry")
    anchors = placed.groupBy(*KEYS, "block").applyInPandas(lambda g: _assigned(window)(g), "camera_id string, label string, us long, anchor_us long")
    anchors = anchors.select(*[F.col(k).alias(f"__{k}") for k in KEYS], F.col("us").alias("__at"), F.col("anchor_us").alias("__anchor"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in KEYS] + [F.col("__us") == F.col("__at")]
    kind = rows.schema["timestamp"].dataType
    return keyed.join(anchors, same).withColumn("anchor", F.timestamp_micros("__anchor").cast(kind)).select(*rows.columns, "anchor")


def compress(rows: DataFrame, minutes: float = 10, least_seconds: float = 5) -> DataFrame:
    """Episodes of rows(camera_id, label, timestamp, confidence, crop_path, source_path); shorter ones are dropped."""
    first = F.struct(F.col("timestamp"), F.col("crop_path"))
    seconds = (F.unix_micros(F.max("timestamp").cast("timestamp")) - F.unix_micros(F.min("timestamp").cast("timestamp"))) / 1e6
    return (
        with_anchor(rows, minutes)
        .groupBy(*KEYS, "anchor")
        .agg(
            F.max("timestamp").alias("end_time"),
            seconds.alias("duration_seconds"),
            F.max("confidence").alias("max_confidence"),
            mean("confidence").alias("avg_confidence"),
            F.count("*").alias("frame_count"),
            F.min_by(F.when(is_video(F.col("crop_path")), F.col("source_path")), first).alias("source_video"),
            F.sort_array(F.collect_list(F.struct("timestamp", "crop_path", "confidence", frame_number(F.col("crop_path")).alias("frame_number")))).alias("timeline"),
        )
        .filter(F.col("duration_seconds") >= least_seconds)
        .withColumnRenamed("anchor", "start_time")
        .withColumnRenamed("label", "species")
        .withColumn("needs_review", F.col("max_confidence") < 0.8)
    )


def episode_stats(episodes: DataFrame) -> DataFrame:
    """The figures of each episode, and those of its species: episodes, frames, the longest one, and how many need review."""
    own = stored(episodes.drop("timeline"))
    species = own.groupBy(F.col("species").alias("__species")).agg(
        F.count("*").alias("species_episodes"), F.sum("frame_count").alias("species_frames"), F.max("duration_seconds").alias("species_longest"), F.count_if("needs_review").alias("species_needs_review")
    )
    return own.join(species, F.col("species").eqNullSafe(F.col("__species"))).drop("__species")


#: Weights of earlier episodes are under 2^-60 of the last one's: less than a double tells apart.
LAST_EPISODES = 60


def report_species(episodes: DataFrame) -> DataFrame:
    """Per species: count, total duration, best and mean confidence, and the decayed mean (each step halves what came before).

    The running half-average over episodes in time order has a closed form, the k-th from the end weighing 2^-k, so only the
    last ones count: each task keeps those of its rows before the shuffle, and no task sees all episodes of a hot species.
    """
    last = Window.partitionBy("species").orderBy(F.desc("start_time"), F.desc("camera_id"))
    tail = episodes.select("species", "start_time", "camera_id", "avg_confidence").withColumn("k", F.row_number().over(last)).filter(F.col("k") <= LAST_EPISODES)
    decayed = tail.groupBy("species").agg(F.round(F.sum(F.col("avg_confidence") * F.pow(F.lit(0.5), F.col("k").cast("double"))), 9).alias("avg_confidence_decayed"))
    whole = episodes.groupBy("species").agg(F.count("*").alias("count"), F.round(F.sum("duration_seconds"), 6).alias("total_duration"), F.max("max_confidence").alias("max_confidence"), mean("avg_confidence").alias("avg_confidence"))
    d = decayed.withColumnRenamed("species", "__species")
    return whole.join(d, F.col("species").eqNullSafe(F.col("__species"))).drop("__species")


def report_camera(episodes: DataFrame) -> DataFrame:
    return episodes.groupBy("camera_id").agg(F.count("*").alias("count"), F.array_join(F.sort_array(F.collect_set("species")), ",").alias("species"))


def report_totals(episodes: DataFrame) -> DataFrame:
    hours = (F.unix_micros(F.max("end_time").cast("timestamp")) - F.unix_micros(F.min("start_time").cast("timestamp"))) / 3.6e9
    return episodes.agg(F.count("*").alias("total"), F.min("start_time").alias("first"), F.max("end_time").alias("last"), F.round(hours, 6).alias("hours"), F.count("source_video").alias("video_episodes"), F.count(F.when(F.col("source_video").isNull(), 1)).alias("image_episodes"))


def compression_ratio(rows: DataFrame, episodes: DataFrame) -> DataFrame:
    both = rows.agg(F.count("*").alias("inputs")).join(F.broadcast(episodes.agg(F.count("*").alias("outputs"))))
    return both.withColumn("ratio", F.when(F.col("outputs") > 0, F.round(F.col("inputs") / F.col("outputs"), 9)).otherwise(F.lit(0.0)))


def download_summary(episodes: DataFrame) -> DataFrame:
    return episodes.agg(F.countDistinct("species").alias("species"), F.countDistinct("camera_id").alias("cameras"), F.min("start_time").alias("first"), F.max("end_time").alias("last"))


def window_start(ts: Column, minutes: int) -> Column:
    """Start of the tumbling window inside the hour; the last one of an hour is shorter where minutes don't divide 60."""
    hour = F.date_trunc("hour", ts)
    return hour + F.make_dt_interval(F.lit(0), F.lit(0), (F.floor(F.minute(ts) / minutes) * minutes).cast("int"))


def condense_windows(obs: DataFrame, minutes: int = 10) -> DataFrame:
    """Rows per tumbling window, with the count of each species as a map."""
    start = window_start(F.col("timestamp"), minutes).cast("timestamp_ntz")
    counted = obs.groupBy(start.alias("window_start"), F.coalesce("top_label", F.lit("unknown")).alias("species")).agg(F.count("*").alias("n"))
    return counted.groupBy("window_start").agg(F.sum("n").alias("total"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("species", "n")))).alias("species_count")).withColumn("window_end", F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes)))


def condense_pivot(obs: DataFrame, species: list[str], minutes: int = 10) -> DataFrame:
    """One column per species, null where it is absent."""
    start = window_start(F.col("timestamp"), minutes).cast("timestamp_ntz")
    return obs.groupBy(start.alias("window_start")).pivot("top_label", species).agg(F.count(F.lit(1)))


def frame_sampling(frames: DataFrame, seconds: float = 0.5, most: int = 100) -> DataFrame:
    """Every int(fps * seconds)-th frame of a video (at least every one), the first min(total // step, most) of them."""
    step = F.greatest(F.lit(1), F.floor(F.col("fps") * seconds).cast("int"))
    place = Window.partitionBy("video_id").orderBy("frame_no")
    numbered = frames.withColumn("step", step).withColumn("i", F.row_number().over(place) - 1).withColumn("total", F.count("*").over(Window.partitionBy("video_id")))
    picked = numbered.filter(F.col("i") % F.col("step") == 0)
    keep = F.col("i") / F.col("step") < F.least(F.floor(F.col("total") / F.col("step")), F.lit(most))
    return picked.filter(keep).select("video_id", "frame_no")


def video_summary(frames: DataFrame, seconds: float = 0.5, most: int = 100) -> DataFrame:
    picked = frame_sampling(frames, seconds, most).groupBy("video_id").agg(F.count("*").alias("extracted"))
    per = frames.groupBy("video_id").agg(F.count("*").alias("frames"), F.max("fps").alias("fps"), F.round(F.count("*") / F.max("fps"), 6).alias("duration_seconds"))
    return per.join(picked, "video_id", "left").withColumn("extracted", F.coalesce("extracted", F.lit(0)))
