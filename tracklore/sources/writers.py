"""Writers. Each partition writes its own file; only small reports are brought into one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklore.operators.reports import enrich_cluster_names


#: Text formats keep microseconds.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).options(**TIMES).csv(path)


def by_format(df: DataFrame, path: str, kind: str) -> None:
    if kind not in ("csv", "parquet", "json"):
        raise ValueError(f"unsupported format: {kind}")
    df.write.mode("overwrite").options(**({"header": True} if kind == "csv" else {}), **({} if kind == "parquet" else TIMES)).format(kind).save(path)


def partitioned_by_day(df: DataFrame, path: str, ts: str = "timestamp") -> None:
    """One folder per day; rows are brought together by day first, so that a day has few files."""
    df.withColumn("dt", F.to_date(ts)).repartition("dt").write.mode("overwrite").partitionBy("dt").parquet(path)


def iso_times(df: DataFrame) -> DataFrame:
    kinds = {"timestamp", "timestamp_ntz"}
    return df.select(*[F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(c) if t in kinds else F.col(c) for c, t in df.dtypes])


def json_lines(df: DataFrame, path: str) -> None:
    iso_times(df).write.mode("overwrite").json(path)


def flatten_nested(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs become JSON text, so that any table format holds them."""
    return df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])


def cluster_means_table(means: DataFrame, names: DataFrame) -> DataFrame:
    return enrich_cluster_names(means, names).select("cluster_id", "cluster_name", "latitude", "longitude", "point_count").orderBy(F.desc("point_count"), "cluster_id")


def geojson_feature(ring: Column, cluster_id: Column, area: Column, perimeter: Column) -> Column:
    """A polygon feature: longitude first, ring closed."""
    point = lambda p: F.array(p["lon"], p["lat"])
    closed = F.concat(F.transform(ring, point), F.array(point(F.element_at(ring, 1))))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Polygon").alias("type"), F.array(closed).alias("coordinates")).alias("geometry"), F.struct(cluster_id.alias("cluster_id"), area.alias("area_m2"), perimeter.alias("perimeter_m")).alias("properties")))


def kml_placemark(ring: Column, name: Column) -> Column:
    points = F.array_join(F.transform(ring, lambda p: F.concat_ws(",", p["lon"].cast("string"), p["lat"].cast("string"), F.lit("0"))), " ")
    safe = F.replace(F.replace(F.replace(name, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.concat(F.lit("<Placemark><name>"), safe, F.lit("</name><Polygon><outerBoundaryIs><LinearRing><coordinates>"), points, F.lit("</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark>"))


def names_as_json(names: DataFrame) -> DataFrame:
    """One row with a map of id to name; for the small name dimension."""
    return names.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("cluster_id", "cluster_name"))))).alias("names"))


def names_from_json(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(F.explode(F.from_json(column, "map<string,string>")).alias("cluster_id", "cluster_name"))


def checksum(rows: DataFrame) -> DataFrame:
    """Number of rows and an order-free checksum over their JSON."""
    digest = F.conv(F.substring(F.sha2(F.to_json(F.struct(*sorted(rows.columns))), 256), 1, 12), 16, 10).cast("decimal(38,0)")
    return rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(digest), F.lit(0)).cast("string").alias("checksum"))
