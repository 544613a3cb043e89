"""Readers. Schemas are given, so no file is read to infer them, and bad lines are set apart rather than failing a job."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklore.functions.scalars import extension, media_type
from tracklore.operators.joins import last_wins

#: Bytes of a file that are hashed at a time.
PIECE = 4_000_000


def observations(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet; filters and column choice on the result reach the scan."""
    return spark.read.schema(schema).parquet(path)


def by_extension(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Reader by suffix: .parquet, .csv (with a header) or .json (a line each)."""
    for suffix, kind in ((".parquet", "parquet"), (".csv", "csv"), (".json", "json"), (".jsonl", "json")):
        if path.rstrip("/").endswith(suffix):
            return spark.read.schema(schema).options(**({"header": True} if kind == "csv" else {})).format(kind).load(path)
    raise ValueError(f"unsupported file format: {path}")


def from_pandas(spark: SparkSession, frame, schema: str | None = None) -> DataFrame:
    return spark.createDataFrame(frame, schema)


def records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON list of records, or a small YAML file with a list under ``observations``."""
    if path.endswith((".yaml", ".yml")):
        import yaml  # only where such a file is used; it is small configuration, read by the driver

        text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
        rows = [{k: str(v) if v is not None else None for k, v in r.items()} for r in yaml.safe_load(text)["observations"]]
        names = [f.name for f in T.StructType.fromDDL(schema)]
        plain = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], T.StructType([T.StructField(n, T.StringType()) for n in names]))
        return plain.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)])
    return spark.read.schema(schema).option("multiLine", True).json(path)


def json_lines(spark: SparkSession, path: str, schema: str, missing_ok: bool = True) -> DataFrame:
    """Line JSON; lines that can't be read are left out, and a missing path is an empty table."""
    full = T.StructType.fromDDL(schema)
    with_bad = T.StructType([*full.fields, T.StructField("_corrupt_record", T.StringType())])
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if missing_ok and not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop):
        return spark.createDataFrame([], full)
    return spark.read.schema(with_bad).option("mode", "PERMISSIVE").json(path).filter("_corrupt_record IS NULL").drop("_corrupt_record")


def time_corrections(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Clock corrections by camera; of a camera's rows the last of the file counts. Commas beyond the last column are dropped."""
    names = [f.name for f in T.StructType.fromDDL(schema)]
    rows = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    placed = rows.select("*", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("__at"))
    return last_wins(placed, "camera_id", "__at").select(*names)


def _open(path: str):
    """A stream over a file's bytes: local ones by name, others through the file system of their scheme."""
    if path.startswith("file:"):
        return open("/" + path[len("file:") :].lstrip("/"), "rb")
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_stream(name)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for files in batches:
        found = []
        for path in files["path"]:
            digest = hashlib.sha256()
            with _open(path) as stream:
                while piece := stream.read(PIECE):
                    digest.update(piece)
            found.append(digest.hexdigest())
        yield files.assign(sha256=found)


def file_inventory(spark: SparkSession, path: str, suffixes: Iterable[str] = (), most_depth: int | None = None) -> DataFrame:
    """Path, size, time, content hash and kind of all files below a path that are not empty (Spark's file sources pass over those).

    Files are listed without their content, those not asked for are dropped, and the others are hashed in pieces by the tasks they are
    dealt to, so a file may have any size and costs a task PIECE bytes of memory.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    out = files.select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"), extension(F.col("path")).alias("extension"), media_type(F.col("path")).alias("media_type"))
    if suffixes:
        out = out.filter(F.col("extension").isin(*[x.lower() for x in suffixes]))
    if most_depth is not None:
        base = len(path.rstrip("/").split("/"))
        out = out.filter(F.size(F.split(F.regexp_replace("path", "^[a-z0-9]+:/*", "/"), "/")) - base <= most_depth)
    # a fixed number of parts: the list is small, the files need not be
    dealt = out.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    return dealt.mapInPandas(_digests, T.StructType([*out.schema.fields, T.StructField("sha256", T.StringType())]))


def find_files(spark: SparkSession, path: str, pattern: str, recursive: bool = True) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return (reader.option("recursiveFileLookup", True) if recursive else reader).load(path).select("path", F.col("length").alias("size_bytes"))
