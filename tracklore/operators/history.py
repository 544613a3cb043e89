"""What earlier runs have done, by key, kept so that a new run need not shuffle it.

The keys lie in a table bucketed by key under a folder of its own. A run's rows are dealt to the same buckets and meet each bucket
where it is stored: the history, which grows with every run, is read but never exchanged.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class History:
    """Keys of rows that are done. The bucket count is fixed when the folder is new, and has to be the same later."""

    spark: SparkSession
    path: str
    key: str
    kind: str = "string"
    buckets: int = 200

    def __post_init__(self) -> None:
        self.name = f"history_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (`{self.key}` {self.kind}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def keys(self) -> DataFrame:
        return self.spark.table(self.name)

    def remember(self, rows: DataFrame) -> None:
        """Add the rows' keys, a file for each bucket; keys that are there already do no harm."""
        own = rows.select(F.col(self.key).cast(self.kind).alias(self.key)).filter(F.col(self.key).isNotNull()).distinct()
        own.repartition(self.buckets, self.key).sortWithinPartitions(self.key).write.mode("append").insertInto(self.name)

    def not_yet(self, rows: DataFrame) -> DataFrame:
        """Rows whose key is not in the history; a null key never is."""
        return rows.join(self.keys(), self.key, "left_anti")

    def counts(self, rows: DataFrame) -> DataFrame:
        """How many rows were done before and how many were not."""
        marked = rows.join(self.keys().distinct().withColumn("__there", F.lit(True)), self.key, "left")
        return marked.agg(F.count("__there").alias("already"), F.count(F.when(F.col("__there").isNull(), 1)).alias("pending"))
