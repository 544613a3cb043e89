"""Graphs in rounds: connected components by least label, and the first free nodes in order."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that executors share: spark.checkpoint.dir, or, in local mode only, a temporary one where that is unset."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        context.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage through a table in the shared folder."""
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, *order: Column, name: str = "n") -> DataFrame:
    """Rows with their number, from 1, in the given order over the whole table.

    Rows are sorted in ranges, each range by a task of its own, and stored; a range's numbers start after the rows of the ranges
    before it, a sum over one row a range.
    """
    ranged = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    ranges = ranged.groupBy(part.alias("__part")).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ranges.select("__part", (before - F.col("__first")).alias("__shift"))
    # one row for each range, of which there are as many as shuffle partitions
    return ranged.join(F.broadcast(starts), part == F.col("__part")).withColumn(name, F.col("__at") + F.col("__shift") + 1).drop("__at", "__part", "__shift")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes(node), edges(a, b): (node, label), the label being the least node of its component.

    Each round takes the least label among neighbours, then jumps to that label's own label, so rounds grow with the
    logarithm of a chain's length.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = stored(nodes.select("node", F.col("node").alias("label")))
    while True:
        near = both.join(labels, F.col("a") == F.col("node")).groupBy("b").agg(F.min("label").alias("m"))
        hooked = labels.join(near, F.col("node") == F.col("b"), "left").select("node", F.least("label", F.coalesce("m", "label")).alias("label"))
        up = hooked.select(F.col("node").alias("__n"), F.col("label").alias("__l"))
        jumped = stored(hooked.join(up, F.col("label") == F.col("__n")).select("node", F.least("label", "__l").alias("label"), F.col("label").alias("hooked")))
        changed = jumped.join(labels.withColumnRenamed("label", "old"), "node").filter("label <> old").isEmpty()
        labels = jumped.select("node", "label")
        if changed:
            return labels


def first_free(edges: DataFrame) -> DataFrame:
    """edges(a, b), a < b: (node, free) of all nodes; in order of node, one is free unless a free one before it is joined to it.

    Each round settles the nodes that no open one comes before, and with them every chain of nodes of which each has one open
    node before it: they are free and taken in turn, so jumps that double in length tell which. A free node takes those after
    it. A chain of any length is one round; what is left grows by how often nodes with several open ones before them follow
    one another.
    """
    open_edges = stored(edges.select("a", "b").distinct())
    done = None
    every = open_edges.select(F.col("a").alias("node")).union(open_edges.select("b")).distinct()
    left = stored(every)
    while True:
        before = open_edges.groupBy(F.col("b").alias("node")).agg(F.count("*").alias("n"), F.min("a").alias("up"))
        heads = left.join(before, "node", "left_anti")
        chain = stored(before.filter("n = 1").select("node", "up", F.lit(1).alias("steps")))
        while True:
            ahead = chain.select(F.col("node").alias("up"), F.col("up").alias("__up"), F.col("steps").alias("__steps"))
            wider = stored(chain.join(ahead, "up", "left").select("node", F.coalesce("__up", "up").alias("up"), (F.col("steps") + F.coalesce("__steps", F.lit(0))).alias("steps"), F.col("__up").isNotNull().alias("moved")))
            chain = wider.drop("moved")
            if wider.filter("moved").isEmpty():
                break
        settled = heads.select("node", F.lit(True).alias("free")).union(chain.join(heads.withColumnRenamed("node", "up"), "up", "left_semi").select("node", F.col("steps") % 2 == 0))
        settled = stored(settled)
        taken = open_edges.join(settled.filter("free").select(F.col("node").alias("a")), "a", "left_semi").select(F.col("b").alias("node")).distinct()
        settled = stored(settled.union(taken.join(settled, "node", "left_anti").select("node", F.lit(False).alias("free"))))
        done = settled if done is None else stored(done.union(settled))
        left = stored(left.join(settled, "node", "left_anti"))
        if left.isEmpty():
            return done
        gone = settled.select("node")
        open_edges = stored(open_edges.join(gone.withColumnRenamed("node", "a"), "a", "left_anti").join(gone.withColumnRenamed("node", "b"), "b", "left_anti"))
