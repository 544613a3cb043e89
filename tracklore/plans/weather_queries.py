"""Weather queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklore.operators import reports as r
from tracklore.operators import weather as w
from tracklore.plans.join_queries import NEAREST, READINGS, _nearest, _readings
from tracklore.plans.registry import query

DAY = "concat('2024-01-', lpad(cast(id % 30 + 1 AS string), 2, '0'))"
HOUR = "concat(lpad(cast(id % 24 AS string), 2, '0'), ':00:00')"
AT = "cast('2024-01-01 00:00:00' AS timestamp) + to_days(cast(id % 30 AS int)) + to_hours(cast(id % 24 AS int))"
#: Responses of the other providers, made from the same ids by Spark's JSON writer.
BODIES = {
    "accu": f"to_json(array(named_struct('DateTime', concat({DAY}, 'T', {HOUR}, 'Z'), 'Temperature', named_struct('Metric', named_struct('Value', cast(id % 30 - 10 AS double))), 'RelativeHumidity', cast(id % 100 AS double), 'CloudCover', cast(id % 101 AS double))))",
    "visualcrossing": f"to_json(named_struct('days', array(named_struct('datetime', {DAY}, 'hours', array(named_struct('datetime', {HOUR}, 'temp', cast(id % 30 - 10 AS double), 'winddir', cast(id % 360 AS double), 'precip', CASE WHEN id % 4 > 0 THEN cast(id % 5 AS double) END))))))",
    "owm": f"to_json(named_struct('current', named_struct('dt', unix_timestamp(concat({DAY}, ' ', {HOUR})), 'temp', cast(id % 30 - 10 AS double), 'clouds', cast(id % 101 AS double), 'rain', CASE WHEN id % 4 > 0 THEN named_struct('1h', cast(id % 5 AS double)) END)))",
}


def raw(df, provider):
    return df if provider == "metno" else df.select("id", F.expr(BODIES[provider]).alias("body"))


IDS = "(SELECT o_orderkey AS id FROM orders)"
TEMP, RAIN = "cast(id % 30 - 10 AS double)", "CASE WHEN id % 4 > 0 THEN cast(id % 5 AS double) ELSE cast(0 AS double) END"
NONE = "cast(NULL AS double)"


def expected(provider: str, **f: str) -> str:
    names = ("temperature", "humidity", "precipitation", "wind_speed", "wind_direction", "cloud_cover")
    return f"SELECT id, {AT} AS timestamp, " + ", ".join(f"{f.get(n, NONE)} AS {n}" for n in names) + f", '{provider}' AS provider FROM {IDS}"


EXPECT = {
    "metno": expected("metno", temperature=TEMP, precipitation=RAIN, wind_direction="cast(id % 360 AS double)", cloud_cover="cast(id % 101 AS double)"),
    "accu": expected("accu", temperature=TEMP, humidity="cast(id % 100 AS double)", precipitation="cast(0 AS double)", cloud_cover="cast(id % 101 AS double)"),
    "visualcrossing": expected("visualcrossing", temperature=TEMP, precipitation=RAIN, wind_direction="cast(id % 360 AS double)"),
    "owm": expected("owm", temperature=TEMP, precipitation=RAIN, cloud_cover="cast(id % 101 AS double)"),
}
for provider in w.PARSERS:
    query(f"parse_weather_{provider}", "weather_json", EXPECT[provider])(lambda d, p=provider: w.PARSERS[p](raw(d, p)))
METNO_SQL = f"""SELECT id, strptime(json_extract_string(body, '$.properties.timeseries[0].time'), '%Y-%m-%dT%H:%M:%SZ') AS timestamp, cast(json_extract(body, '$.properties.timeseries[0].data.instant.details.air_temperature') AS double) AS temperature, {NONE} AS humidity,
 coalesce(cast(json_extract(body, '$.properties.timeseries[0].data.instant.details.precipitation_amount') AS double), 0) AS precipitation, {NONE} AS wind_speed, cast(json_extract(body, '$.properties.timeseries[0].data.instant.details.wind_from_direction') AS double) AS wind_direction,
 cast(json_extract(body, '$.properties.timeseries[0].data.instant.details.cloud_area_fraction') AS double) AS cloud_cover, 'metno' AS provider FROM weather_json"""
query("scan_weather_raw_json", "weather_json", METNO_SQL)(w.parse_metno)
ALL = " UNION ALL ".join(EXPECT.values())


def _unified(d):
    return w.unified(**{p: raw(d, p) for p in w.PARSERS})


query("weather_unified", "weather_json", ALL)(_unified)
query("weather_stats", "weather_json", f"SELECT provider, count(*) AS n, min(timestamp) AS first, max(timestamp) AS last FROM ({ALL}) GROUP BY 1")(lambda d: w.stats(_unified(d)))
query("observation_weather_stats", "observations weather", "SELECT count(*) AS total, min(readings.at) AS first, max(readings.at) AS last, count(*) FILTER (cluster_id IN (SELECT cluster_id FROM observations WHERE camera_id IS NOT NULL)) AS with_camera FROM readings", more=READINGS)(
    lambda o, x: _readings(x).join(o.filter("camera_id IS NOT NULL").select("cluster_id", F.lit(True).alias("c")).distinct(), "cluster_id", "left").agg(F.count("*").alias("total"), F.min("at").alias("first"), F.max("at").alias("last"), F.count("c").alias("with_camera"))
)
CARDINAL = "(['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'])[cast(floor((wind_dir_deg + 22.5) / 45) AS int) % 8 + 1]"
CODE = "CASE WHEN precip_mm > 0 THEN 'rain' WHEN cloud_pc{0} > 0.8 THEN 'cloudy' WHEN cloud_pc{0} > 0.3 THEN 'partly_cloudy' ELSE 'clear' END"
query("weather_fields", "weather", f"SELECT cluster_id, wid, hour_offset, temp_c AS weather_temperature, wind_dir_deg AS weather_wind_direction, coalesce(precip_mm, 0) AS weather_precipitation, cloud_pc AS weather_cloud_cover, {CODE.format('')} AS weather_condition, {CODE.format(' / 100')} AS weather_condition_pct, {CARDINAL} AS weather_wind FROM weather")(w.fields)
query("weather_prefix_columns", "weather", "SELECT wid, temp_c AS weather_temperature, wind_dir_deg AS weather_wind_direction FROM weather")(lambda x: w.fields(x).select("wid", "weather_temperature", "weather_wind_direction"))
query("condition_code", "weather", f"SELECT {CODE.format('')} AS code, {CODE.format(' / 100')} AS code_pct, count(*) AS n FROM weather GROUP BY 1, 2")(
    lambda x: x.groupBy(w.condition_code(F.col("precip_mm"), F.col("cloud_pc")).alias("code"), w.condition_code_pct(F.col("precip_mm"), F.col("cloud_pc")).alias("code_pct")).agg(F.count("*").alias("n"))
)
query("wind_cardinal", "weather", f"SELECT {CARDINAL} AS wind, count(*) AS n FROM weather GROUP BY 1")(lambda x: x.groupBy(w.wind_cardinal(F.col("wind_dir_deg")).alias("wind")).agg(F.count("*").alias("n")))
KEY = "printf('%.3f', round_even(gps_latitude, 3)) || '_' || printf('%.3f', round_even(gps_longitude, 3))"
query("weather_cell_key", "observations", f"SELECT {KEY} AS cell, date_trunc('hour', timestamp) AS hour, count(*) AS n FROM observations WHERE gps_latitude IS NOT NULL GROUP BY 1, 2")(
    lambda o: r.with_gps(o).groupBy(w.cell_key(F.col("gps_latitude"), F.col("gps_longitude")).alias("cell"), F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias("n"))
)
query("parse_cache_key", "observations", f"SELECT observation_id, try_cast(split_part(k, '_', 1) AS double) AS lat, try_cast(nullif(split_part(k, '_', 2), '') AS double) AS lon FROM (SELECT observation_id, CASE WHEN seq % 10 = 0 THEN 'nokey' ELSE {KEY} END AS k FROM observations WHERE gps_latitude IS NOT NULL)")(
    lambda o: r.with_gps(o).select("observation_id", w.parse_cell_key(F.when(F.col("seq") % 10 == 0, "nokey").otherwise(w.cell_key(F.col("gps_latitude"), F.col("gps_longitude")))).alias("k")).select("observation_id", "k.lat", "k.lon")
)
ID = f"concat_ws('_', 'weather', strftime({AT.replace('id %', 'wid %')}, '%Y-%m-%d %H:%M:%S'), printf('%.3f', cast(wid % 5 AS double)), printf('%.3f', cast(wid % 7 AS double)))"
query("weather_row_id", "weather", f"SELECT row_id, wid, temp_c FROM (SELECT {ID} AS row_id, wid, temp_c FROM weather) QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY wid DESC) = 1")(
    lambda x: w.keep_last(x.select(w.row_id(F.expr("cast('2024-01-01 00:00:00' AS timestamp_ntz) + make_dt_interval(cast(wid % 30 AS int), cast(wid % 24 AS int))"), (F.col("wid") % 5).cast("double"), (F.col("wid") % 7).cast("double")).alias("row_id"), "wid", "temp_c"), "row_id", "wid")
)


def _enriched(o, x):
    """Weather of observations with a place and time; the others pass with nulls."""
    near = _nearest(r.with_gps(o), x).select("observation_id", "wid", "temp_c")
    return o.select("observation_id", "camera_id").join(near, "observation_id", "left")


MET = f"met AS (SELECT observation_id, b.w AS wid, b.t AS temp_c FROM ({NEAREST}) n WHERE observation_id IN (SELECT observation_id FROM observations WHERE gps_latitude IS NOT NULL AND gps_longitude IS NOT NULL))"
query("enrich_observations_weather", "observations weather", "SELECT o.observation_id, o.camera_id, m.wid, m.temp_c FROM observations o LEFT JOIN met m ON o.observation_id = m.observation_id", more=f"{READINGS}, {MET}")(_enriched)
query("enrichment_outcome_counts", "observations weather", "SELECT CASE WHEN NOT o.needs_review THEN 'already' WHEN m.wid IS NULL THEN 'failed' ELSE 'successful' END AS status, count(*) AS n FROM observations o LEFT JOIN met m ON o.observation_id = m.observation_id GROUP BY 1", more=f"{READINGS}, {MET}")(
    lambda o, x: _enriched(o, x).join(o.select("observation_id", "needs_review"), "observation_id").groupBy(F.when(~F.col("needs_review"), "already").when(F.col("wid").isNull(), "failed").otherwise("successful").alias("status")).agg(F.count("*").alias("n"))
)
query("weather_for_observation", "observations weather", "SELECT observation_id, wid, temp_c FROM met WHERE observation_id = 'obs_17'", more=f"{READINGS}, {MET}")(lambda o, x: _enriched(o.filter("observation_id = 'obs_17'"), x).filter("wid IS NOT NULL").drop("camera_id"))
query("hourly_weather", "observations weather", f"SELECT n.observation_id, date_trunc('hour', n.timestamp) AS hour, b.w AS wid, 'met' AS met_source FROM ({NEAREST}) n", more=READINGS)(
    lambda o, x: _nearest(o, x).select("observation_id", F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("hour"), "wid", F.lit("met").alias("met_source"))
)
MEANS = "means AS (SELECT cluster_id, round(avg(gps_latitude), 9) AS latitude, round(avg(gps_longitude), 9) AS longitude, count(*) AS point_count FROM observations WHERE gps_latitude IS NOT NULL AND gps_longitude IS NOT NULL GROUP BY 1)"
query("cluster_weather_request", "observations", "SELECT cluster_id, latitude, longitude, cast(day AS date) AS day FROM means, (SELECT unnest(range(timestamp '2024-01-08', timestamp '2024-01-16', INTERVAL 1 DAY)) AS day)", more=MEANS)(lambda o: w.requests(r.cluster_means(o), F.expr("date'2024-01-15'")))
query("cluster_enrichment_outcome", "observations weather", "SELECT m.cluster_id, CASE WHEN count(r.wid) > 0 THEN 'ok' ELSE 'failed' END AS status, CASE WHEN count(r.wid) = 0 THEN 'no weather' END AS error FROM means m LEFT JOIN readings r ON m.cluster_id = r.cluster_id AND r.at >= cast('2024-01-30 23:00:00' AS timestamp) GROUP BY 1", more=f"{READINGS}, {MEANS}")(
    lambda o, x: r.cluster_means(o).select("cluster_id").join(x.filter("hour_offset >= 719").groupBy("cluster_id").agg(F.count("*").alias("n")), "cluster_id", "left").select("cluster_id", F.when(F.col("n") > 0, "ok").otherwise("failed").alias("status"), F.when(F.col("n").isNull(), "no weather").alias("error"))
)
CUT = "cast('2024-01-15 12:00:00' AS timestamp)"


def _aged(x, hours=24):
    return w.expiry(_readings(x), "at", hours)


query("scan_expired_cutoff", "weather", f"SELECT cluster_id, wid, readings.at FROM readings WHERE readings.at + INTERVAL 24 HOUR > {CUT}", more=READINGS)(lambda x: w.fresh(_aged(x), F.expr("timestamp_ntz'2024-01-15 12:00:00'")).select("cluster_id", "wid", "at"))
query("expire_cache", "weather", f"SELECT count(*) FILTER (readings.at + INTERVAL 72 HOUR > {CUT}) AS kept, count(*) FILTER (NOT readings.at + INTERVAL 72 HOUR > {CUT}) AS dropped FROM readings", more=READINGS)(
    lambda x: _aged(x, 72).agg(F.count_if(F.expr("expires_at > timestamp_ntz'2024-01-15 12:00:00'")).alias("kept"), F.count_if(F.expr("NOT expires_at > timestamp_ntz'2024-01-15 12:00:00'")).alias("dropped"))
)
query("cache_stats", "weather", f"SELECT count(*) AS entries, count(*) FILTER (readings.at + INTERVAL 6 HOUR > {CUT}) AS valid, count(*) FILTER (NOT readings.at + INTERVAL 6 HOUR > {CUT}) AS expired, cast(sum(length(cluster_id)) AS bigint) AS bytes FROM readings", more=READINGS)(
    lambda x: w.cache_stats(_aged(x, 6), F.expr("timestamp_ntz'2024-01-15 12:00:00'"), F.length("cluster_id"))
)
