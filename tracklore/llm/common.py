"""Helpers shared by the text operators: tables, the shared folder, Arrow batches and held-out folds."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts of about so many bytes are handled together inside a task.
CHUNK_CHARS = 2_000_000

ROWS_PER_BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2_000

_own_folder: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or, in local mode only, a temporary one where that is unset."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or _own_folder.get(context.applicationId)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _own_folder[context.applicationId] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        context.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it again: the lineage is cut and survives a lost executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Id tables of up to so many rows (8 bytes each) are broadcast to filter a wider table.
MOST_BROADCAST_IDS = 1_000_000


def filter_by_ids(df: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """left_semi or left_anti join of df with ids(key), a stored table of distinct ids.

    The ids are counted first: while they are few, they are broadcast and df stays where it lies; a larger table is joined by
    shuffle, with the same result.
    """
    few = ids.count() <= MOST_BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, key, how)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def map_chunks(df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str, text: str | None = "text") -> DataFrame:
    """mapInArrow, with batches cut so that each holds about CHUNK_CHARS bytes of text (a longer text stands alone).

    A batch of texts is held once by the JVM and once by Python for every running task. Spark takes the rows of a batch from
    the session when a plan runs, so where the session has Spark's own default of 10,000 it is lowered there, for the session;
    a number that the caller has set is left alone. No result depends on it.
    """
    conf = df.sparkSession.conf
    if text is not None and conf.get(ROWS_PER_BATCH) == "10000":
        conf.set(ROWS_PER_BATCH, BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if text is None:
                yield from work(batch)
                continue
            at = 0
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
            while at < batch.num_rows:
                end, total = at, 0
                while end < batch.num_rows and (end == at or total + sizes[end] <= CHUNK_CHARS):
                    total += sizes[end]
                    end += 1
                yield from work(batch.slice(at, end - at))
                at = end
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
