"""Grouped reports over observations. Averages are rounded to 9 places, so that the order of addition leaves no trace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklore.operators.graph import numbered


def mean(c: str | Column) -> Column:
    return F.round(F.avg(c), 9)


def spread(c: str) -> Column:
    """Sample standard deviation; null for one row."""
    return F.round(F.stddev_samp(c), 9)


def distinct(c: str) -> Column:
    """Distinct values, null counted as one."""
    return F.countDistinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))


def count_true(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.count(F.when(c, 1))


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.when(whole > 0, part.cast("double") * F.lit(100).cast("double") / whole).otherwise(F.lit(0).cast("double")), 6)


def weekday(ts: str | Column) -> Column:
    """ISO weekday, Monday is 1."""
    return F.weekday(ts) + 1


def species_counts(obs: DataFrame) -> DataFrame:
    return (
        obs.groupBy("top_label")
        .agg(
            F.count("observation_id").alias("total_detections"),
            mean("top_confidence").alias("avg_confidence"),
            F.max("top_confidence").alias("max_confidence"),
            F.min("top_confidence").alias("min_confidence"),
            count_true("needs_review").alias("needs_review_count"),
        )
        .orderBy(F.desc("total_detections"), F.asc_nulls_last("top_label"))
    )


def camera_activity(obs: DataFrame) -> DataFrame:
    return (
        obs.groupBy("camera_id")
        .agg(F.count("observation_id").alias("total_observations"), F.min("timestamp").alias("first_observation"), F.max("timestamp").alias("last_observation"), distinct("top_label").alias("unique_species"))
        .orderBy(F.desc("total_observations"), "camera_id")
    )


def daily_species(obs: DataFrame) -> DataFrame:
    return (
        obs.groupBy(F.to_date("timestamp").alias("date"), "top_label")
        .agg(F.count("observation_id").alias("daily_count"), mean("top_confidence").alias("avg_confidence"))
        .orderBy(F.desc("date"), "top_label")
    )


def with_gps(obs: DataFrame) -> DataFrame:
    """Both coordinates present."""
    return obs.filter(F.col("gps_latitude").isNotNull() & F.col("gps_longitude").isNotNull())


def _places(by: str, counted: bool = False):
    def report(obs: DataFrame) -> DataFrame:
        measures = [mean("gps_latitude").alias("avg_latitude"), mean("gps_longitude").alias("avg_longitude"), spread("gps_latitude").alias("lat_std"), spread("gps_longitude").alias("lon_std")]
        if counted:
            measures.append(F.count("observation_id").alias("observation_count"))
        return with_gps(obs).groupBy(by).agg(*measures)

    return report


gps_by_species = _places("top_label")
spatial_by_species = _places("top_label", counted=True)
camera_locations = _places("camera_id", counted=True)


def species_summary(obs: DataFrame) -> DataFrame:
    return obs.agg(F.count("*").alias("total_observations"), distinct("top_label").alias("unique_species"), distinct("camera_id").alias("unique_cameras"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))


def seconds_between(first: Column, last: Column) -> Column:
    return F.unix_micros(last.cast("timestamp")).cast("double") / 1e6 - F.unix_micros(first.cast("timestamp")).cast("double") / 1e6


def camera_metrics(obs: DataFrame) -> DataFrame:
    return (
        obs.groupBy("camera_id")
        .agg(
            F.count("observation_id").alias("total_observations"),
            distinct("top_label").alias("species_diversity"),
            mean("top_confidence").alias("avg_confidence"),
            count_true("needs_review").alias("review_count"),
            F.min("timestamp").alias("first_activity"),
            F.max("timestamp").alias("last_activity"),
        )
        .withColumn("active_seconds", F.round(seconds_between(F.col("first_activity"), F.col("last_activity")), 3))
        .withColumn("review_rate", F.round(F.col("review_count") / F.col("total_observations"), 9))
    )


def species_per_camera(obs: DataFrame) -> DataFrame:
    return obs.groupBy("camera_id", "top_label").agg(F.count("observation_id").alias("species_count"), mean("top_confidence").alias("avg_confidence")).orderBy("camera_id", F.desc("species_count"), "top_label")


def camera_hourly(obs: DataFrame) -> DataFrame:
    return obs.groupBy("camera_id", F.hour("timestamp").alias("hour")).agg(F.count("observation_id").alias("hourly_count")).orderBy("camera_id", "hour")


def _pattern(obs: DataFrame, key: Column, name: str, confidence: bool = False) -> DataFrame:
    measures = [F.count("observation_id").alias("observation_count"), distinct("top_label").alias("unique_species"), distinct("camera_id").alias("active_cameras")]
    if confidence:
        measures.append(mean("top_confidence").alias("avg_confidence"))
    return obs.groupBy(key.alias(name)).agg(*measures).orderBy(name)


def activity_by_window(obs: DataFrame, unit: str = "hour") -> DataFrame:
    return _pattern(obs, F.date_trunc(unit, "timestamp").cast("timestamp_ntz"), "time_window", confidence=True)


def hourly_patterns(obs: DataFrame) -> DataFrame:
    return _pattern(obs, F.hour("timestamp"), "hour")


def weekly_patterns(obs: DataFrame) -> DataFrame:
    return _pattern(obs, weekday("timestamp"), "weekday")


def spatial_grid_clusters(obs: DataFrame, scale: int = 100) -> DataFrame:
    cell = lambda c: F.round(F.col(c) * F.lit(scale).cast("double")).cast("long")
    return (
        with_gps(obs)
        .groupBy(cell("gps_latitude").alias("lat_cell"), cell("gps_longitude").alias("lon_cell"))
        .agg(F.count("observation_id").alias("cluster_size"), distinct("top_label").alias("unique_species"), distinct("camera_id").alias("unique_cameras"))
        .orderBy(F.desc("cluster_size"), "lat_cell", "lon_cell")
    )


def gps_coverage(obs: DataFrame) -> DataFrame:
    there = F.col("gps_latitude").isNotNull() & F.col("gps_longitude").isNotNull()
    return obs.agg(count_true(there).alias("observations_with_gps"), F.count("*").alias("total_observations")).withColumn("coverage_percent", percent(F.col("observations_with_gps"), F.col("total_observations")))


def full_report(obs: DataFrame) -> DataFrame:
    """The four reports as one long table (report, key, n, avg_confidence): one pass with grouping sets."""
    hour = obs.withColumn("hour", F.hour("timestamp").cast("string")).withColumn("place", F.when(F.col("gps_latitude").isNotNull() & F.col("gps_longitude").isNotNull(), "gps").otherwise("no gps"))
    keys = ["top_label", "camera_id", "hour", "place"]
    sets = hour.groupingSets([[k] for k in keys], *keys).agg(F.count("*").alias("n"), mean("top_confidence").alias("avg_confidence"), F.grouping_id().alias("g"))
    # the bit of a set's own key is 0, all others are 1
    report = F.when(F.col("g") == 7, "species").when(F.col("g") == 11, "camera").when(F.col("g") == 13, "temporal").otherwise("spatial")
    key = F.when(F.col("g") == 7, F.col("top_label")).when(F.col("g") == 11, F.col("camera_id")).when(F.col("g") == 13, F.col("hour")).otherwise(F.col("place"))
    return sets.select(report.alias("report"), key.alias("key"), "n", "avg_confidence")


# --- reports by cluster ------------------------------------------------------------------------------------------------


def enrich_cluster_names(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Left join to the name dimension; a cluster without name keeps its id. The planner broadcasts the names while they are small."""
    named = names.groupBy("cluster_id").agg(F.max("cluster_name").alias("cluster_name"))
    return rows.join(named, "cluster_id", "left").withColumn("cluster_name", F.coalesce("cluster_name", "cluster_id"))


def cluster_species_report(obs: DataFrame, names: DataFrame) -> DataFrame:
    # aggregate first: the join then sees one row per cluster and species
    counted = obs.groupBy("cluster_id", "top_label").agg(F.count("*").alias("observation_count"), mean("top_confidence").alias("avg_confidence"), F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"))
    return enrich_cluster_names(counted, names).orderBy(F.desc("observation_count"), "cluster_id", "top_label")


def cluster_species_summary(obs: DataFrame) -> DataFrame:
    return obs.agg(F.countDistinct("cluster_id").alias("clusters"), F.countDistinct("top_label").alias("species"), F.count("*").alias("observations"))


def cluster_temporal(obs: DataFrame, names: DataFrame) -> DataFrame:
    counted = obs.groupBy("cluster_id", F.to_date("timestamp").alias("date"), F.hour("timestamp").alias("hour")).agg(F.count("*").alias("observation_count"), distinct("top_label").alias("unique_species"))
    return enrich_cluster_names(counted, names).orderBy("cluster_id", "date", "hour")


def cluster_temporal_summary(obs: DataFrame) -> DataFrame:
    return obs.agg(F.min(F.to_date("timestamp")).alias("first_date"), F.max(F.to_date("timestamp")).alias("last_date"), F.count("*").alias("observations"), F.countDistinct("cluster_id").alias("clusters"))


def _modes(obs: DataFrame, value: Column, name: str) -> DataFrame:
    """All values of the largest count per cluster, ascending, as text."""
    counted = obs.groupBy("cluster_id", value.alias("v")).agg(F.count("*").alias("n"))
    top = counted.withColumn("best", F.max("n").over(Window.partitionBy("cluster_id"))).filter("n = best")
    return top.groupBy("cluster_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("v")), lambda x: x.cast("string")), ",").alias(name))


def cluster_activity(obs: DataFrame, names: DataFrame) -> DataFrame:
    base = obs.groupBy("cluster_id").agg(F.count("*").alias("total_observations"), distinct("top_label").alias("unique_species"), F.min("timestamp").alias("first_activity"), F.max("timestamp").alias("last_activity"))
    hours, days = _modes(obs, F.hour("timestamp"), "peak_hours"), _modes(obs, weekday("timestamp"), "peak_weekdays")
    return enrich_cluster_names(base.join(hours, "cluster_id").join(days, "cluster_id"), names)


def cluster_activity_summary(obs: DataFrame, names: DataFrame) -> DataFrame:
    counted = obs.groupBy("cluster_id").agg(F.count("*").alias("n"))
    out = counted.agg(F.count("*").alias("clusters"), F.sum("n").alias("observations"), F.max_by("cluster_id", F.struct(F.col("n"), F.col("cluster_id"))).alias("cluster_id"))
    return enrich_cluster_names(out, names).select("clusters", "observations", F.col("cluster_name").alias("most_active_cluster"))


def cluster_summary(obs: DataFrame, names: DataFrame) -> DataFrame:
    counted = obs.groupBy("cluster_id").agg(F.count("*").alias("n")).join(names.select("cluster_id", F.lit(True).alias("named")).distinct(), "cluster_id", "left")
    return counted.agg(F.sum("n").alias("total_observations"), F.count("*").alias("clusters"), count_true("named").alias("named_clusters"), count_true(F.col("named").isNull()).alias("unnamed_clusters"))


def cluster_report(obs: DataFrame, names: DataFrame) -> DataFrame:
    """Observations per cluster with its name and its share of all."""
    counted = obs.groupBy("cluster_id").agg(F.count("*").alias("observation_count"), distinct("top_label").alias("unique_species"))
    total = obs.agg(F.count("*").alias("total"))
    return enrich_cluster_names(counted, names).join(F.broadcast(total)).withColumn("share_percent", percent(F.col("observation_count"), F.col("total"))).drop("total")


def value_counts(obs: DataFrame) -> DataFrame:
    return obs.groupBy("top_label").agg(F.count("*").alias("n"), F.min("gps_latitude").alias("lat_min"), F.max("gps_latitude").alias("lat_max"), F.min("gps_longitude").alias("lon_min"), F.max("gps_longitude").alias("lon_max"))


def top_n(obs: DataFrame, key: str, n: int) -> DataFrame:
    """The n keys with most rows, ties to the smaller key."""
    return obs.groupBy(key).agg(F.count("*").alias("observation_count")).orderBy(F.desc("observation_count"), key).limit(n)


def cluster_table(obs: DataFrame, names: DataFrame) -> DataFrame:
    """One row per cluster: centre, points, first and last time, name if any."""
    return (
        with_gps(obs)
        .groupBy("cluster_id")
        .agg(mean("gps_latitude").alias("center_latitude"), mean("gps_longitude").alias("center_longitude"), F.count("*").alias("point_count"), F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"))
        .join(names.groupBy("cluster_id").agg(F.max("cluster_name").alias("cluster_name")), "cluster_id", "left")
        .withColumn("is_named", F.col("cluster_name").isNotNull())
    )


def cluster_statistics(clusters: DataFrame) -> DataFrame:
    return clusters.agg(
        F.count("*").alias("total_clusters"), count_true("is_named").alias("named_clusters"), count_true(~F.col("is_named")).alias("unknown_clusters"), F.coalesce(F.sum("point_count"), F.lit(0)).alias("total_assignments"), F.round(F.avg("point_count"), 2).alias("avg_points_per_cluster")
    ).withColumn("naming_rate", percent(F.col("named_clusters"), F.col("total_clusters")))


def cluster_analytics(clusters: DataFrame) -> DataFrame:
    return clusters.agg(F.count("*").alias("total_clusters"), F.count("cluster_name").alias("named_clusters"), count_true(F.col("cluster_name").isNull()).alias("unnamed_clusters"), F.sum("point_count").alias("total_points"), mean("point_count").alias("avg_points"))


def cluster_activity_patterns(clusters: DataFrame, top: int = 5) -> DataFrame:
    """The most active clusters beside the totals over all of them."""
    totals = clusters.agg(F.count("*").alias("total_clusters"), F.sum("point_count").alias("total_points"), mean("point_count").alias("avg_points"), percent(count_true("is_named"), F.count("*")).alias("naming_rate"))
    best = clusters.select("cluster_id", "point_count").orderBy(F.desc("point_count"), "cluster_id").limit(top)
    return best.join(F.broadcast(totals))


def cluster_temporal_span(clusters: DataFrame) -> DataFrame:
    seconds = seconds_between(F.col("first_seen"), F.col("last_seen"))
    return clusters.select("cluster_id", "first_seen", "last_seen", F.floor(seconds / 86400).alias("span_days"), F.round(seconds / 3600, 6).alias("span_hours"))


def cluster_coverage(obs: DataFrame, clusters: DataFrame) -> DataFrame:
    """Rows with a place, rows assigned to a cluster, and rates."""
    there = F.col("gps_latitude").isNotNull() & F.col("gps_longitude").isNotNull()
    rows = obs.agg(F.count("*").alias("total_observations"), count_true(there).alias("gps_observations"))
    assigned = clusters.agg(F.coalesce(F.sum("point_count"), F.lit(0)).alias("assignments"), mean("point_count").alias("avg_points"))
    return rows.join(F.broadcast(assigned)).withColumn("gps_percent", percent(F.col("gps_observations"), F.col("total_observations"))).withColumn("assignment_percent", percent(F.col("assignments"), F.col("gps_observations")))


def species_by_cluster_profile(obs: DataFrame) -> DataFrame:
    """Diversity, dominant species (ties to the smaller name) and activity tercile of each cluster, 1 the least active."""
    counted = obs.filter("top_label IS NOT NULL").groupBy("cluster_id", "top_label").agg(F.count("*").alias("n"))
    per = counted.groupBy("cluster_id").agg(F.count("*").alias("diversity"), F.sum("n").alias("observations"), F.min_by("top_label", F.struct(-F.col("n"), F.col("top_label"))).alias("dominant_species"))
    ranked = numbered(per, F.asc("observations"), F.asc("cluster_id"))
    # the first rows % 3 terciles have one row more
    sized = ranked.join(F.broadcast(ranked.agg(F.max("n").alias("__rows"))))
    share, more = F.expr("__rows div 3"), F.col("__rows") % 3
    long = more * (share + 1)
    tercile = F.when(F.col("n") <= long, F.floor((F.col("n") - 1) / (share + 1)) + 1).otherwise(more + F.floor((F.col("n") - 1 - long) / F.greatest(share, F.lit(1))) + 1)
    return sized.withColumn("activity", tercile.cast("int")).drop("n", "__rows")


def cluster_aware_report(obs: DataFrame, clusters: DataFrame) -> DataFrame:
    """Profile, span and name of each cluster in one table."""
    spans = cluster_temporal_span(clusters).select("cluster_id", "span_days", "span_hours")
    return species_by_cluster_profile(obs).join(spans, "cluster_id", "left").join(clusters.select("cluster_id", "cluster_name", "point_count"), "cluster_id", "left")


def cluster_means(obs: DataFrame) -> DataFrame:
    return with_gps(obs).groupBy("cluster_id").agg(mean("gps_latitude").alias("latitude"), mean("gps_longitude").alias("longitude"), F.count("*").alias("point_count"))


def cluster_lookup_stats(names: DataFrame, obs: DataFrame) -> DataFrame:
    named = names.agg(F.count("*").alias("names"), count_true(F.col("cluster_name").isNotNull() & (F.col("cluster_name") != "")).alias("named"))
    return named.join(F.broadcast(cluster_means(obs).agg(F.count("*").alias("means"), F.sum("point_count").alias("points"))))


# --- contract, store and run summaries ---------------------------------------------------------------------------------


def species_camera_breakdown(obs: DataFrame) -> DataFrame:
    """Counts per species and per camera in one table; missing names are ``unknown``."""
    named = obs.select(F.coalesce("top_label", F.lit("unknown")).alias("species"), F.coalesce("camera_id", F.lit("unknown")).alias("camera"))
    both = named.select(F.explode(F.array(F.struct(F.lit("species").alias("kind"), F.col("species").alias("name")), F.struct(F.lit("camera").alias("kind"), F.col("camera").alias("name")))).alias("x"))
    return both.groupBy("x.kind", "x.name").agg(F.count("*").alias("n"))


def detection_run_summary(manifest: DataFrame, least: float = 0.5) -> DataFrame:
    per = manifest.groupBy("source_path").agg(count_true(F.col("det_score") >= least).alias("n"))
    return per.agg(F.count("*").alias("files"), count_true(F.col("n") > 0).alias("files_with_detections"), F.sum("n").alias("detections")).withColumn("detection_rate", percent(F.col("files_with_detections"), F.col("files")))


def db_summary_stats(obs: DataFrame) -> DataFrame:
    return obs.groupBy("camera_id").agg(F.count("*").alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))


def converter_summary(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("total"), count_true("observation_any").alias("with_observation"), count_true(F.col("detection_count") > 2).alias("needs_review"), F.countDistinct("camera_id").alias("cameras"))


def species_collect(obs: DataFrame) -> DataFrame:
    """Images, species list and sum of confidences per camera."""
    return obs.filter("top_label IS NOT NULL").groupBy("camera_id").agg(F.count("*").alias("image_count"), F.array_join(F.sort_array(F.collect_set("top_label")), ",").alias("species"), mean("top_confidence").alias("avg_confidence"))


def pipeline_status(**stages: DataFrame) -> DataFrame:
    """Rows of each stage's table and whether it has any."""
    out = None
    for name, df in stages.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("stage"), F.col("n"), (F.col("n") > 0).alias("done"))
        out = row if out is None else out.unionByName(row)
    return out


def detections_contract_stats(detections: DataFrame) -> DataFrame:
    return detections.agg(F.count("*").alias("total"), F.countDistinct("event_id").alias("events"), F.countDistinct("camera_id").alias("cameras"), F.countDistinct("label").alias("labels"), mean("confidence").alias("avg_confidence"), F.min("confidence").alias("min_confidence"), F.max("confidence").alias("max_confidence"))


def events_contract_stats(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("total_events"), F.sum("detection_count").alias("detections"), F.countDistinct("camera_id").alias("cameras"))


def camera_contract_stats(mappings: DataFrame, at: Column) -> DataFrame:
    valid = (F.col("effective_from") <= at) & (F.col("effective_to").isNull() | (F.col("effective_to") >= at))
    return mappings.agg(F.count("*").alias("total"), F.countDistinct(F.when(valid, F.col("camera_id"))).alias("active_cameras"))


def top_label_of_observation(detections: DataFrame) -> DataFrame:
    """Best detection of each event: highest confidence, ties to the first id. One aggregate, no sort, no array."""
    best = F.min_by(F.struct("label", "confidence"), F.struct(-F.col("confidence"), F.col("detection_id"), F.col("label")))
    return detections.filter("confidence IS NOT NULL").groupBy("event_id").agg(best.alias("b")).select("event_id", F.col("b.label").alias("top_label"), F.col("b.confidence").alias("top_confidence"))


def timestamp_fix_summary(rows: DataFrame) -> DataFrame:
    """rows(file_type, ok): totals and success rate per type and over all."""
    return rows.rollup("file_type").agg(F.count("*").alias("total"), count_true("ok").alias("fixed"), count_true(~F.col("ok")).alias("failed"), F.grouping("file_type").alias("over_all")).withColumn("success_percent", percent(F.col("fixed"), F.col("total"))).withColumn("file_type", F.when(F.col("over_all") == 1, "all").otherwise(F.col("file_type"))).drop("over_all")


def instance_cost_report(usage: DataFrame, prices: DataFrame, spot: float = 0.03, on_demand: float = 0.1) -> DataFrame:
    """usage(instance_type, hours), prices(instance_type, spot, on_demand); unlisted types cost the defaults."""
    priced = usage.groupBy("instance_type").agg(F.sum("hours").alias("hours")).join(prices, "instance_type", "left")
    return priced.select(
        "instance_type",
        F.round("hours", 6).alias("hours"),
        F.round(F.col("hours") * F.coalesce("spot", F.lit(spot)), 6).alias("cost"),
        F.round(F.col("hours") * F.coalesce("on_demand", F.lit(on_demand)), 6).alias("on_demand_cost"),
        F.round(F.col("hours") * (F.coalesce("on_demand", F.lit(on_demand)) - F.coalesce("spot", F.lit(spot))), 6).alias("savings"),
    )


def job_cost_report(jobs: DataFrame, spot: float = 0.03, on_demand: float = 0.1) -> DataFrame:
    """jobs(status, started, ended): success rate, span in hours, cost on spot and on demand, savings."""
    out = jobs.agg(F.count("*").alias("jobs"), count_true(F.col("status") == "SUCCEEDED").alias("succeeded"), (seconds_between(F.min("started"), F.max("ended")) / 3600).alias("h"))
    hours = F.col("h")
    return out.select("jobs", "succeeded", percent(F.col("succeeded"), F.col("jobs")).alias("success_percent"), F.round(hours, 6).alias("span_hours"), F.round(hours * spot, 6).alias("spot_cost"), F.round(hours * on_demand, 6).alias("on_demand_cost"), F.round(hours * on_demand - hours * spot, 6).alias("savings"))


def run_report(obs: DataFrame, cost_per_row: float = 0.001) -> DataFrame:
    """Run time, cost and share of rows not sent to review, per camera, best three first."""
    per = obs.groupBy("camera_id").agg(F.count("*").alias("n"), percent(count_true(~F.col("needs_review")), F.count("*")).alias("auto_percent"), seconds_between(F.min("timestamp"), F.max("timestamp")).alias("s"))
    from tracklore.functions.scalars import format_duration

    return per.orderBy(F.desc("n"), "camera_id").limit(3).select("camera_id", "n", "auto_percent", F.round(F.col("n") * cost_per_row, 6).alias("cost"), format_duration(F.col("s")).alias("runtime"))
