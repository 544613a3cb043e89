"""Chat formatting from reply trees: root-to-leaf paths by iterative self-joins, ranked by score, each one conversation.

A message answers its parent. Every message without answers ends one path, from the root down to it. Paths are listed by self-joins
that double their reach: a table of ancestors 1, 2, 4, ... steps up is joined with itself until no message has one, and each leaf
then takes its ancestors from the widest step to the narrowest, each once, so a path of length n costs log n joins and n rows.
Paths of a conversation are ranked by the sum of their messages' scores, and the best ``most`` are formatted.

Template: ``<|role|>``, line feed, text, ``<|end|>``, line feed. Inside roles and texts a backslash is put before each backslash and
inside each ``<|`` and ``|>``, so no text can open or close a turn; one pass that drops the backslashes gives the text back.
The loss mask is a list of spans, code points of the formatted text, end exclusive: the texts of assistant turns, no marks.

Defined cases: a null conv_id is a conversation of its own; a null role or text is empty; a parent that is null or not there makes a
message a root; equal messages under one id are one, and of different ones under an id the least counts (by parent, role, text and
score); a message without an id cannot be answered, and is a leaf; a null score counts as 0; ties go to the smaller leaf id as text; messages
on or below a ring of parents have no root and are on no path; an empty table gives none. Extra columns are not read.

Scale: the self-joins shuffle keys only; texts move once to drop repeats and once for each chosen path. Keys are unique on one side of each
join, so a hot message can be split. A formatted conversation is one value, built by one task, as its result has to be; it is not
bounded otherwise. Each round's table is stored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracklore.llm.common import map_chunks, materialise, table

#: Fixed values of the template.
OPEN, SHUT, END = "<|", "|>\n", "<|end|>\n"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("<|"), F.lit("<\\|")), F.lit("|>"), F.lit("|\\>"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a formatted conversation."""
    out = []
    for piece in formatted.split(END)[:-1]:
        role, text = piece[len(OPEN) :].split(SHUT, 1)
        out.append((unescape(role), unescape(text)))
    return out


def _keyed(messages: DataFrame) -> DataFrame:
    """One row per message: c and key name its conversation and itself, up its parent's key."""
    own = F.sha2(F.to_json(F.struct(F.col("parent").cast("string").alias("p"), "role", "text", F.col("score").cast("string").alias("s"))), 256)
    key = F.coalesce(F.concat(F.lit("i"), F.col("id").cast("string")), F.concat(F.lit("n"), own))
    rows = messages.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n")).alias("c"),
        key.alias("key"),
        "conv_id",
        "id",
        F.struct(F.concat(F.lit("i"), F.col("parent").cast("string")).alias("up"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")).alias("m"),
    )
    one = rows.groupBy("c", "key").agg(F.min("conv_id").alias("conv_id"), F.min("id").alias("id"), F.min("m").alias("m"))
    return materialise(one.select("c", "key", "conv_id", "id", "m.*"))


def _jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Tables (c, key, up) of the ancestors 1, 2, 4, ... steps up; and the messages that have no root, if any."""
    there = nodes.select("c", F.col("key").alias("up"))
    steps = [materialise(nodes.select("c", "key", "up").filter("up IS NOT NULL").join(there, ["c", "up"], "left_semi").select("c", "key", "up"))]
    longest = nodes.groupBy("c").count().agg(F.max("count")).first()[0] or 0
    while True:
        half = steps[-1]
        # whoever has an ancestor more steps up than its conversation has messages goes round a ring
        if 2 ** (len(steps) - 1) > max(longest, 1):
            return steps[:-1], half
        wide = materialise(half.join(half.select("c", F.col("key").alias("up"), F.col("up").alias("__up")), ["c", "up"]).select("c", "key", F.col("__up").alias("up")))
        if wide.isEmpty():
            return steps, None
        steps.append(wide)


def branches(nodes: DataFrame) -> DataFrame:
    """c, leaf, key, dist: the messages of every root-to-leaf path, dist steps above the leaf."""
    steps, rings = _jumps(nodes)
    leaves = nodes.select("c", "key").join(steps[0].select("c", F.col("up").alias("key")), ["c", "key"], "left_anti")
    if rings is not None:
        leaves = leaves.join(rings.select("c", "key"), ["c", "key"], "left_anti")
    found = leaves.select("c", F.col("key").alias("leaf"), "key", F.lit(0).cast("long").alias("dist"))
    for k in reversed(range(len(steps))):
        up = found.join(steps[k], ["c", "key"]).select("c", "leaf", F.col("up").alias("key"), (F.col("dist") + 2**k).alias("dist"))
        found = materialise(found.unionByName(up))
    return found


def format_trees(messages: DataFrame, most: int = 4) -> DataFrame:
    """conv_id, leaf_id, rank, score, formatted, loss (array of start, end) of the best paths of each conversation.

    messages(conv_id, id, parent, role, text, score), parent being the id of the message that is answered.
    """
    nodes = _keyed(messages)
    paths = branches(nodes)
    scored = paths.join(nodes.select("c", "key", "score"), ["c", "key"]).groupBy("c", "leaf").agg(F.sum("score").alias("total"))
    best = Window.partitionBy("c").orderBy(F.desc("total"), "leaf")
    chosen = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)
    rows = paths.join(chosen, ["c", "leaf"]).join(nodes.drop("score", "up"), ["c", "key"])
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SHUT))
    rows = rows.withColumn("head", head).withColumn("body", escape(F.col("text"))).withColumn("long", F.length("head") + F.length("body").cast("long"))
    before = Window.partitionBy("c", "leaf").orderBy(F.desc("dist")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(F.col("long") + len(END)).over(before), F.lit(0)) + F.length("head"))
    span = F.when(F.col("role") == LOSS_ROLE, F.struct("start", (F.col("start") + F.length("body")).alias("end")))
    grouped = rows.groupBy("c", "leaf").agg(
        F.min("conv_id").alias("conv_id"), F.max(F.when(F.col("dist") == 0, F.col("id"))).alias("leaf_id"), F.max("rank").alias("rank"), F.max("total").alias("score"),
        F.array_sort(F.collect_list(F.struct("start", F.concat("head", "body", F.lit(END)).alias("piece"), span.alias("span")))).alias("turns"),
    )
    loss = F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull())
    return grouped.select("conv_id", "leaf_id", "rank", "score", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), loss.alias("loss"))


def linear(conversations: DataFrame) -> DataFrame:
    """Messages of conversations(conv_id, turn, role, text), where each row answers the one before; rows of one turn go by role and text."""
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return conversations.select("conv_id", at.alias("id"), "role", "text").select("conv_id", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def read_back(conversations: DataFrame) -> DataFrame:
    """Digests of turns and of what the loss mask covers, parsed from ``formatted`` and ``loss`` alone."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in names]
        for conv, formatted, loss in zip(*[batch.column(c) for c in ("conv_id", "formatted", "loss")], strict=True):
            whole = formatted.as_py()
            found = turns(whole)
            every, masked, chars = hashlib.sha256(), hashlib.sha256(), 0
            for role, text in found:
                every.update(f"{role}\n{text}\n".encode())
            for span in loss.as_py():
                text = unescape(whole[span["start"] : span["end"]])
                masked.update(text.encode())
                chars += len(text)
            for column, value in zip(out, (conv.as_py(), len(found), every.hexdigest(), chars, masked.hexdigest(), len(whole)), strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return map_chunks(conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "formatted", "loss"), work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long", text="formatted")


#: A conversation that is all control strings, formatted beside the table's own.
PLANTED_ID, PLANTED_TEXT = -7, "\\### Assistant: </turn> ok"


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(PLANTED_ID, 0, "user", PLANTED_TEXT), (PLANTED_ID, 1, LOSS_ROLE, PLANTED_TEXT)], "conv_id long, turn long, role string, text string")
    return read_back(format_trees(linear(own.unionByName(planted))))


def _escaped_sql(x: str) -> str:
    return rf"replace(replace(replace({x}, '\', '\\'), '<|', '<\|'), '|>', '|\>')"


SQL = rf"""
WITH every AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
cast(sum(length({_escaped_sql("role")}) + length({_escaped_sql("text")}) + 13) AS bigint) AS formatted_chars FROM every GROUP BY conv_id
"""
