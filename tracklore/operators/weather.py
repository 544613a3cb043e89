"""Weather: stored provider responses to rows, derived fields, cells and expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklore.operators.joins import last_wins
from tracklore.operators.reports import count_true

METNO = "properties struct<timeseries:array<struct<time:string,data:struct<instant:struct<details:struct<air_temperature:double,relative_humidity:double,wind_speed:double,wind_from_direction:double,air_pressure_at_sea_level:double,cloud_area_fraction:double,precipitation_amount:double,dew_point_temperature:double,wind_speed_of_gust:double>>>>>>"
ACCU = "array<struct<DateTime:string,Temperature:struct<Metric:struct<Value:double>>,RelativeHumidity:double,Wind:struct<Speed:struct<Metric:struct<Value:double>>,Direction:struct<Degrees:double>>,CloudCover:double>>"
VISUAL = "days array<struct<datetime:string,hours:array<struct<datetime:string,temp:double,humidity:double,windspeed:double,winddir:double,cloudcover:double,precip:double>>>>"
OWM = "current struct<dt:bigint,temp:double,humidity:double,wind_speed:double,wind_deg:double,clouds:double,rain:struct<`1h`:double>>"


def _time(text: Column) -> Column:
    return F.try_to_timestamp(F.regexp_replace(text, "Z$", "+00:00")).cast("timestamp_ntz")


def _unified(df: DataFrame, provider: str, time: Column, **fields: Column) -> DataFrame:
    names = ("temperature", "humidity", "precipitation", "wind_speed", "wind_direction", "cloud_cover")
    return df.select("id", time.alias("timestamp"), *[fields.get(n, F.lit(None)).cast("double").alias(n) for n in names], F.lit(provider).alias("provider"))


def parse_metno(raw: DataFrame) -> DataFrame:
    """raw(id, body): a row per entry of properties.timeseries."""
    d = raw.select("id", F.explode(F.from_json("body", METNO)["properties"]["timeseries"]).alias("e")).select("id", F.col("e.time").alias("time"), F.col("e.data.instant.details").alias("d"))
    c = F.col
    return _unified(d, "metno", _time(c("time")), temperature=c("d.air_temperature"), humidity=c("d.relative_humidity"), precipitation=F.coalesce("d.precipitation_amount", F.lit(0.0)), wind_speed=c("d.wind_speed"), wind_direction=c("d.wind_from_direction"), cloud_cover=c("d.cloud_area_fraction"))


def parse_accu(raw: DataFrame) -> DataFrame:
    d = raw.select("id", F.explode(F.from_json("body", ACCU)).alias("e"))
    c = F.col
    return _unified(d, "accu", _time(c("e.DateTime")), temperature=c("e.Temperature.Metric.Value"), humidity=c("e.RelativeHumidity"), precipitation=F.lit(0.0), wind_speed=c("e.Wind.Speed.Metric.Value"), wind_direction=c("e.Wind.Direction.Degrees"), cloud_cover=c("e.CloudCover"))


def parse_visualcrossing(raw: DataFrame) -> DataFrame:
    days = raw.select("id", F.explode(F.from_json("body", VISUAL)["days"]).alias("d"))
    h = days.select("id", F.col("d.datetime").alias("day"), F.explode("d.hours").alias("h"))
    c = F.col
    return _unified(h, "visualcrossing", _time(F.concat(c("day"), F.lit("T"), c("h.datetime"), F.lit("Z"))), temperature=c("h.temp"), humidity=c("h.humidity"), precipitation=F.coalesce("h.precip", F.lit(0.0)), wind_speed=c("h.windspeed"), wind_direction=c("h.winddir"), cloud_cover=c("h.cloudcover"))


def parse_owm(raw: DataFrame) -> DataFrame:
    d = raw.select("id", F.from_json("body", OWM)["current"].alias("d")).filter("d IS NOT NULL")
    c = F.col
    return _unified(d, "owm", F.timestamp_seconds(c("d.dt")).cast("timestamp_ntz"), temperature=c("d.temp"), humidity=c("d.humidity"), precipitation=F.coalesce(c("d.rain")["1h"], F.lit(0.0)), wind_speed=c("d.wind_speed"), wind_direction=c("d.wind_deg"), cloud_cover=c("d.clouds"))


PARSERS = {"metno": parse_metno, "accu": parse_accu, "visualcrossing": parse_visualcrossing, "owm": parse_owm}


def unified(**raw: DataFrame) -> DataFrame:
    """All providers' responses under one schema."""
    out = None
    for provider, df in raw.items():
        rows = PARSERS[provider](df)
        out = rows if out is None else out.unionByName(rows)
    return out


def condition_code(precipitation: Column, cloud: Column) -> Column:
    """Rain, cloudy, partly cloudy or clear; missing counts as 0. The cloud bounds are shares, as the feed's consumers use them."""
    p, c = F.coalesce(precipitation, F.lit(0.0)), F.coalesce(cloud, F.lit(0.0))
    return F.when(p > 0, "rain").when(c > 0.8, "cloudy").when(c > 0.3, "partly_cloudy").otherwise("clear")


def condition_code_pct(precipitation: Column, cloud: Column) -> Column:
    """The same for clouds in percent."""
    return condition_code(precipitation, cloud / 100)


def wind_cardinal(degrees: Column) -> Column:
    names = F.array(*[F.lit(x) for x in ("N", "NE", "E", "SE", "S", "SW", "W", "NW")])
    return F.when(degrees.isNotNull(), F.element_at(names, F.floor((degrees + 22.5) / 45).cast("int") % 8 + 1))


def fields(rows: DataFrame) -> DataFrame:
    """The prefixed flat columns of a weather row."""
    return rows.select(
        *[c for c in rows.columns if c not in ("temp_c", "wind_dir_deg", "precip_mm", "cloud_pc")],
        F.col("temp_c").alias("weather_temperature"),
        F.col("wind_dir_deg").alias("weather_wind_direction"),
        F.coalesce("precip_mm", F.lit(0.0)).alias("weather_precipitation"),
        F.col("cloud_pc").alias("weather_cloud_cover"),
        condition_code(F.col("precip_mm"), F.col("cloud_pc")).alias("weather_condition"),
        condition_code_pct(F.col("precip_mm"), F.col("cloud_pc")).alias("weather_condition_pct"),
        wind_cardinal(F.col("wind_dir_deg")).alias("weather_wind"),
    )


def cell_key(lat: Column, lon: Column) -> Column:
    return F.concat(F.format_string("%.3f", F.bround(lat, 3)), F.lit("_"), F.format_string("%.3f", F.bround(lon, 3)))


def parse_cell_key(key: Column) -> Column:
    """Struct of lat and lon; nulls where the text is no key."""
    parts = F.split(key, "_", 2)
    return F.struct(F.try_element_at(parts, F.lit(1)).try_cast("double").alias("lat"), F.try_element_at(parts, F.lit(2)).try_cast("double").alias("lon"))


def row_id(ts: Column, lat: Column, lon: Column) -> Column:
    return F.concat_ws("_", F.lit("weather"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.format_string("%.3f", lat), F.format_string("%.3f", lon))


def keep_last(rows: DataFrame, key: str, seq: str) -> DataFrame:
    return last_wins(rows, key, seq)


def requests(clusters: DataFrame, last_day: Column, days: int = 7) -> DataFrame:
    """A row per cluster and day of the span that ends at last_day."""
    return clusters.select("cluster_id", "latitude", "longitude", F.explode(F.sequence(F.date_sub(last_day, days), last_day)).alias("day"))


def expiry(rows: DataFrame, written: str, hours: float) -> DataFrame:
    return rows.withColumn("expires_at", F.col(written) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(hours * 3600).cast("decimal(18,6)")))


def fresh(rows: DataFrame, as_of: Column) -> DataFrame:
    return rows.filter(F.col("expires_at") > as_of)


def cache_stats(rows: DataFrame, as_of: Column, size: Column) -> DataFrame:
    valid = F.col("expires_at") > as_of
    return rows.agg(F.count("*").alias("entries"), count_true(valid).alias("valid"), count_true(~valid).alias("expired"), F.sum(size).alias("bytes"))


def stats(rows: DataFrame) -> DataFrame:
    return rows.groupBy("provider").agg(F.count("*").alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
