"""Mixing sources to target weights by entropy balancing.

Each source gets a target number of words. Among all ways to weigh the words of the corpus that meet the targets, entropy
balancing takes the one nearest to uniform weights: its dual is convex and smooth, Newton's method solves it from
multipliers of zero, and each document's rate is the exponential of the sum of its groups' multipliers, held at ``cap``.
Sources are one grouping; further groupings with targets of their own may be balanced at once. Each Newton step reads the
words reached and their curvature, which Spark sums over cells (one row per combination of groups).

Rates become whole copies: a document gets floor(rate) copies, and one more if its number in [0, 1) lies low enough. The bound is set
per source and size class from a histogram, largest texts first, each class making good what the last one missed, so
that a source's words come within about one small document of its target, without sorting any source.

The number of a row is hashed from its doc_id and text. Rows of a source that agree in both share their hash u, and are c in number; they have
the numbers (u + j) / c for j from 0 to c - 1, spread evenly, so that a repeated row rises and falls with nothing but itself,
and how many of the c get one more copy is a formula.

Defined cases: a null source is a source of its own, last in order; null or empty texts have size 0 and take 0 words;
repeated rows differ by at most one copy; null and repeated doc_ids are mixed like others; an empty table gives an empty table.
Extra columns are not read by ``mix`` and are carried along by ``mixed_documents``, whose number of the copy is named
``copy``, with underscores before it while the table has such a column.

Scale: texts are read where they lie. A row of numbers per document, and sums per source, cell and histogram bucket, are shuffled. The driver
holds one row per source, of which more than ``MAX_SOURCES`` are refused with an error; the plan by source and size class
is a stored table, broadcast while it has at most ``MOST_BROADCAST`` rows and joined by shuffle beyond, with the same result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracklore.llm.common import materialise, table

MAX_SOURCES = 100_000
#: Rows of the plan (about 60 bytes each) up to which it is broadcast.
MOST_BROADCAST = 200_000
CAP = 3.0
#: Histogram buckets over the hashed numbers.
BUCKETS = 1024

#: Words of a text.
SIZE = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SIZE)), F.lit(0)).cast("long")


def key_of(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), doc_id.isNull(), F.coalesce(text, F.lit("")), F.lit("mix"))


def number_of(key: Column, place: Column, n: Column) -> Column:
    """A number in [0, 1), the same in each run: of the place-th of n rows of a key."""
    return (F.shiftrightunsigned(key, 11).cast("double") * F.lit(2.0**-53) + place) / n


def below(key: Column, n: Column, end: Column) -> Column:
    """How many of the n rows of a key have a number under end."""
    u = F.shiftrightunsigned(key, 11).cast("double") * F.lit(2.0**-53)
    return F.least(F.greatest(F.ceil(end * n - u).cast("long"), F.lit(0).cast("long")), n)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = CAP) -> DataFrame:
    """source, source_size, target. Weights repeat over the sources in code point order, null last."""
    spark = sizes.sparkSession
    found = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r[0] is None, (r[0] or "").encode()))
    size = np.array([r[1] for r in found], np.float64)
    weight = np.array([weights[i % len(weights)] for i in range(len(found))])
    target = np.zeros(len(found))
    free = np.ones(len(found), bool)
    left = size.sum()
    while free.any():
        target[free] = left * weight[free] / weight[free].sum()
        above = free & (target > cap * size)
        if not above.any():
            break
        target[above] = cap * size[above]
        left -= target[above].sum()
        free &= ~above
    return spark.createDataFrame([(r[0], int(r[1]), float(t)) for r, t in zip(found, target, strict=True)], "source string, source_size long, target double")


@dataclass
class Balance:
    """Multipliers [(group, multiplier)] by grouping, and how they were found."""

    multipliers: dict[str, list[tuple]]
    steps: int
    #: Largest gap to a target, as a share of it, when the steps ended.
    gap: float


def balance(sizes: DataFrame, targets: dict[str, DataFrame], cap: float = CAP, most_steps: int = 200, near: float = 1e-9) -> Balance:
    """Multipliers of each grouping. targets: by column, a table (column, target) of words wanted; sizes has the columns and size.

    Solves min sum(size * r * log r) under the targets, r <= cap, by Newton steps on the dual, each cut to 2 in the multiplier.
    """
    columns = list(targets)
    cells = materialise(sizes.groupBy(*columns).agg(F.sum("size").cast("double").alias("mass")).filter("mass > 0"))
    kinds = dict(cells.dtypes)
    wanted = {c: {r[0]: r[1] for r in targets[c].collect()} for c in columns}
    own = {c: {r[0]: r[1] for r in cells.groupBy(c).agg(F.sum("mass")).collect()} for c in columns}
    index = {(c, g): i for i, (c, g) in enumerate((c, g) for c in columns for g in own[c])}
    want = np.array([wanted[c].get(g, 0.0) for c, g in index])
    have = np.array([own[c][g] for c, g in index])
    #: A target of 0 words asks for a rate of 0: a very small one stands for it.
    want = np.maximum(want, 1e-9 * have)
    multiplier = np.zeros(len(index))
    spark = sizes.sparkSession
    # the groupings of one column each, and of each pair of columns for the curvature
    sets = [(c,) for c in columns] + [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    steps, gap = 0, np.zeros(0)
    while len(index):
        held = cells
        for c in columns:
            now = spark.createDataFrame([(g, float(multiplier[i])) for (k, g), i in index.items() if k == c], f"__group {kinds[c]}, `__m_{c}` double")
            held = held.join(F.broadcast(now), F.col(c).eqNullSafe(F.col("__group"))).drop("__group")
        rate = F.exp(sum((F.col(f"__m_{c}") for c in columns), F.lit(0.0)))
        held = held.withColumn("__r", F.least(rate, F.lit(cap)) * F.col("mass")).withColumn("__free", F.when(rate < cap, rate * F.col("mass")).otherwise(0.0))
        sums = held.groupingSets([[F.col(c) for c in one] for one in sets], *columns).agg(F.sum("__r").alias("r"), F.sum("__free").alias("free"), *[F.grouping(c).alias(f"__g_{c}") for c in columns]).collect()
        reached = np.zeros(len(index))
        curve = np.zeros((len(index), len(index))) if len(columns) > 1 else np.zeros(len(index))
        for row in sums:
            at = [index[c, row[c]] for c in columns if row[f"__g_{c}"] == 0]
            if len(at) == 1:
                reached[at[0]] = row["r"]
                curve[(at[0],) * curve.ndim] = row["free"]
            else:
                curve[at[0], at[1]] = curve[at[1], at[0]] = row["free"]
        gap = np.abs(want - reached) / np.maximum(want, 1)
        if (gap <= near).all() or steps == most_steps:
            break
        if len(columns) > 1:
            step = np.linalg.lstsq(curve + 1e-9 * np.diag(have), want - reached, rcond=None)[0]
        else:
            # a group held at the cap has no curvature: back to just below it
            step = np.where(curve > 0, (want - reached) / np.maximum(curve, 1e-300), np.where(want < reached, -0.5, 0.5))
        multiplier += np.clip(step, -2.0, 2.0)
        steps += 1
    return Balance({c: [(g, float(multiplier[i])) for (k, g), i in index.items() if k == c] for c in columns}, steps, float(gap.max(initial=0.0)))


def size_class(size: Column) -> Column:
    return F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))).cast("int")


def bucket_of(number: Column, rate: Column) -> Column:
    """Place of a document among those that may get one more copy: 0 is first."""
    return F.floor((number - (rate - F.floor(rate)) + 1) * F.lit(BUCKETS / 2)).cast("int")


def number_under(bucket: Column, rate: Column) -> Column:
    """Numbers under this lie in buckets before the given one."""
    return bucket * F.lit(2.0 / BUCKETS) + (rate - F.floor(rate)) - 1


#: Up to so many rows of a key are put into the histogram one by one, more of them bucket by bucket.
FEW_ROWS = 64


def _pieces() -> Column:
    """Buckets of a key's rows, and how many of them lie in each."""
    one_by_one = F.transform(F.sequence(F.lit(0).cast("long"), F.least("n", F.lit(FEW_ROWS)) - 1), lambda j: F.struct(bucket_of(number_of(F.col("key"), j, F.col("n")), F.col("rate")).alias("bucket"), F.lit(1).cast("long").alias("rows")))
    ends = F.sequence(bucket_of(F.lit(0.0), F.col("rate")), bucket_of(F.lit(1.0), F.col("rate")))
    inside = lambda b: below(F.col("key"), F.col("n"), number_under(b + 1, F.col("rate"))) - below(F.col("key"), F.col("n"), number_under(b, F.col("rate")))
    by_bucket = F.transform(ends, lambda b: F.struct(b.alias("bucket"), inside(b).alias("rows")))
    return F.when(F.col("n") <= FEW_ROWS, one_by_one).otherwise(by_bucket)


def _bounds(rows: pd.DataFrame) -> pd.DataFrame:
    """Per size class of one source: the bucket below which documents get one more copy."""
    out, carry = [], 0.0
    for size, part in rows.sort_values(["class", "bucket"], ascending=[False, True]).groupby("class", sort=False):
        carry += float(part["due"].sum())
        reach = np.concatenate([[0.0], np.cumsum(part["words"].to_numpy(np.float64))])
        k = int(np.argmin(np.abs(reach - carry)))
        carry -= reach[k]
        out.append((int(part["bucket"].iloc[k]) if k < len(part) else 1 << 30, int(size)))
    return pd.DataFrame({"source": rows["source"].iloc[0], "class": [c for _, c in out], "bound": [b for b, _ in out]})


def plan_mix(sizes: DataFrame, cap: float = CAP) -> DataFrame:
    """source, class, source_size, target, rate, bound: all that turns a document's size and number into copies; a stored table
    with a row for every size class that a source has."""
    spark = sizes.sparkSession
    words = sizes.withColumn("size", F.col("size") * F.col("n"))
    found = source_targets(words, cap=cap)
    rates = {g: min(cap, math.exp(m)) for g, m in balance(words, {"source": found.select("source", "target")}, cap).multipliers["source"]}
    plan = spark.createDataFrame([(r["source"], r["source_size"], r["target"], rates.get(r["source"], 0.0)) for r in found.collect()], "source string, source_size long, target double, rate double")
    classed = sizes.withColumn("class", size_class(F.col("size")))
    named = plan.select(F.col("source").alias("__source"), "rate")
    # one row per source: at most MAX_SOURCES are broadcast
    placed = classed.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("__source"))).filter((F.col("size") > 0) & (F.col("rate") < cap))
    dealt = placed.select("source", "class", "size", "rate", F.inline(_pieces())).filter("rows > 0").withColumn("size", F.col("size") * F.col("rows"))
    histogram = dealt.groupBy("source", "class", "bucket").agg(F.sum("size").cast("double").alias("words"), F.sum(F.col("size") * (F.col("rate") - F.floor("rate"))).alias("due"))
    bounds = histogram.groupBy("source").applyInPandas(_bounds, "source string, class int, bound int")
    every = classed.select("source", "class").distinct()
    full = every.join(F.broadcast(plan.withColumnRenamed("source", "__source")), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    bounds = bounds.select(F.col("source").alias("__source"), F.col("class").alias("__class"), "bound")
    return materialise(full.join(bounds, F.col("source").eqNullSafe(F.col("__source")) & (F.col("class") == F.col("__class")), "left").drop("__source", "__class"))


def copies(size: Column, number: Column, rate: Column, bound: Column, cap: float = CAP) -> Column:
    more = (rate < cap) & (bucket_of(number, rate) < bound)
    return F.when(size > 0, F.floor(rate).cast("int") + F.coalesce(more, F.lit(False)).cast("int")).otherwise(F.when(rate >= 1, 1).otherwise(0))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, key and n, the number of rows that are alike; stored."""
    rows = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), size_of(F.col("text")).alias("size"), key_of(F.col("doc_id"), F.col("text")).alias("key"))
    return materialise(rows.groupBy("source", "key", "size", "doc_id").agg(F.count("*").alias("n")))


def _joined(docs: DataFrame, plan: DataFrame, source: str, size: str, most: int) -> DataFrame:
    """Adds the plan's columns; the plan has one row per source and size class."""
    named = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    on = F.col(source).cast("string").eqNullSafe(F.col("__source")) & (F.col("__class") == size_class(F.col(size)))
    return docs.join(F.broadcast(named) if plan.count() <= most else named.hint("shuffle_hash"), on, "left")


#: Rows that are alike are given out in groups of so many.
SPREAD = 10_000


def mix(docs: DataFrame, cap: float = CAP, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies of each document. docs(doc_id, text, source)."""
    sizes = measured(docs)
    # rows that are alike come from one row of the table, in groups that are dealt out before they become rows
    groups = sizes.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {SPREAD}"))))
    if not sizes.filter(F.col("n") > SPREAD).isEmpty():
        groups = groups.repartition(docs.sparkSession.sparkContext.defaultParallelism * 4, "key", "group")
    rows = groups.withColumn("place", F.explode(F.sequence(F.col("group") * SPREAD, F.least((F.col("group") + 1) * SPREAD, F.col("n")) - 1)))
    out = _joined(rows, plan_mix(sizes, cap), "source", "size", most_broadcast)
    number = number_of(F.col("key"), F.col("place"), F.col("n"))
    return out.select("doc_id", "source", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.col("__rate").alias("rate"), copies(F.col("size"), number, F.col("__rate"), F.col("__bound"), cap).alias("copies"))


def _places(docs: DataFrame, alike: DataFrame) -> DataFrame:
    """The rows of docs that others are alike to, with __place and __n. Rows are numbered as they are stored; counts by stored
    part and key give each row its place, so many rows of one key are many groups."""
    own = materialise(docs.join(F.broadcast(alike) if alike.count() <= MOST_BROADCAST else alike, (F.col("__key") == F.col("__k")) & F.col("source").cast("string").eqNullSafe(F.col("__s"))).drop("__k", "__s").withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    narrow = own.select("__at", part.alias("__part"), "__key", F.col("source").cast("string").alias("__s"))
    parts = narrow.groupBy("__s", "__key", "__part").agg(F.count("*").alias("__c"))
    before = Window.partitionBy("__s", "__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("__s").alias("__ps"), F.col("__key").alias("__pk"), F.col("__part").alias("__pp"), F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__first"))
    inside = narrow.withColumn("__i", F.row_number().over(Window.partitionBy("__s", "__key", "__part").orderBy("__at")) - 1)
    placed = inside.join(parts, F.col("__s").eqNullSafe(F.col("__ps")) & (F.col("__key") == F.col("__pk")) & (F.col("__part") == F.col("__pp")))
    return own.join(placed.select("__at", (F.col("__first") + F.col("__i")).alias("__place")), "__at").drop("__at")


def mixed_documents(docs: DataFrame, cap: float = CAP, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """The mix itself: each document as often as it has copies, with a column ``copy`` from 1. Texts are not shuffled while the
    plan is small, but for those of rows that others are alike to."""
    sizes = measured(docs)
    keyed = docs.withColumn("__key", key_of(F.col("doc_id"), F.col("text")))
    alike = materialise(sizes.filter("n > 1").select(F.col("key").alias("__k"), F.col("source").alias("__s"), F.col("n").alias("__n")))
    sized = keyed.withColumn("__n", F.lit(1).cast("long")).withColumn("__place", F.lit(0).cast("long"))
    few = alike.count()
    if few:
        own = alike.select("__k", "__s")
        alone = keyed.join(F.broadcast(own) if few <= MOST_BROADCAST else own, (F.col("__key") == F.col("__k")) & F.col("source").cast("string").eqNullSafe(F.col("__s")), "left_anti")
        sized = alone.withColumn("__n", F.lit(1).cast("long")).withColumn("__place", F.lit(0).cast("long")).unionByName(_places(keyed, alike))
    sized = sized.withColumn("__size", size_of(F.col("text")))
    out = _joined(sized, plan_mix(sizes, cap), "source", "__size", most_broadcast)
    number = number_of(F.col("__key"), F.col("__place"), F.col("__n"))
    out = out.withColumn("__copies", copies(F.col("__size"), number, F.col("__rate"), F.col("__bound"), cap))
    name = "copy"
    while name in docs.columns:
        name = f"_{name}"
    return out.filter("__copies > 0").select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias(name))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
