"""Merkle manifest of a document table: checkpoints every few levels, everything between made again when a proof needs it.

Each row is a leaf, the digest of its five fields. Per source, leaves in order of doc_id form a tree of runs of ``WIDTH`` nodes;
the subroots of the sources, in order of their names, form one more tree, whose root stands for the table. Of each tree only
every ``STEP``-th level is stored. A proof, the siblings on the way from a leaf to the root, is extracted block by block: the
``WIDTH ** STEP`` stored nodes below a stored node are an aligned subtree, whose interior nodes are made again from them, lend
their digests to the proofs and are gone. The part of a proof above a block is that of the block's own node, so it is made
once, not once a leaf.

Defined cases: a null field is ``-``; a null source is a source of its own, first in order; null doc_ids come first in
their source; rows that share a doc_id stand in order of their leaves, and repeated rows are leaves of their own, with equal
digests, so that it does not matter which is which; a table of one row has that leaf as its root; an empty table has no
root and gives no rows. Empty and very long texts are hashed whole. Extra columns are not read.

Scale: texts are hashed where they lie and not shuffled. Leaves are sorted once, by ranges of source, doc_id and leaf, with equal
rows split over ranges, so neither a hot source nor a hot row is one task; places inside a source come from counts of
its ranges. A block is at most 81 nodes, whatever the source. The driver holds no node; it asks each level whether a tree
still grows. The table of ranges is broadcast up to ``MOST_RANGES`` rows and joined by shuffle beyond. A run that is lost is
made again from stored tables.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracklore.llm.common import shared_folder, table

WIDTH = 3
#: Levels from one stored level to the next.
STEP = 4
SPAN = WIDTH**STEP
#: Ranges of the sorted leaves (about 60 bytes each) up to which they are broadcast.
MOST_RANGES = 200_000

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_of(*fields: Column) -> Column:
    """Hex digest of a row's fields, each with its length in bytes before it."""
    parts = []
    for f in fields:
        value = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def fold_up(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda own, s: F.sha2(F.concat(s["left"], own, s["right"]), 256))


def _hex(node: Column) -> Column:
    return F.lower(F.hex(node))


@dataclass
class Manifest:
    """Stored levels of the trees of sources and of the tree over them. A level has (tree, pos, size, node), size being the number
    of nodes on that level of the tree; the lowest one has the rows' doc_id and carried columns too."""

    levels: list[DataFrame]
    sources: DataFrame
    root_levels: list[DataFrame]

    def root(self) -> DataFrame:
        """One row, root; none for an empty table."""
        return self.root_levels[-1].filter("size = 1").select(_hex(F.col("node")).alias("root"))


def _save(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _placed(rows: DataFrame, order: list[str], path: str) -> tuple[DataFrame, DataFrame]:
    """rows(group, ...) with their place (pos) in their group in the given order, and the group's size; and group, size alone.

    Equal rows are told apart by a number, so that ranges can split them. The sorted rows are stored, since their
    numbers hold for one run of the sort only.
    """
    numbered = rows.withColumn("__row", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange("group", *order, "__row").sortWithinPartitions("group", *order, "__row").drop("__row")
    ranked = _save(ranged.withColumn("__at", F.monotonically_increasing_id()), f"{path}/ranked")
    ranges = ranked.groupBy("group", F.shiftright("__at", 33).alias("__part")).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    own = Window.partitionBy("group")
    before = F.coalesce(F.sum("__n").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = _save(ranges.select(F.col("group").alias("__group"), F.col("__part"), (before - F.col("__first")).alias("__shift"), F.sum("__n").over(own).alias("size")), f"{path}/ranges")
    on = F.col("group").eqNullSafe(F.col("__group")) & (F.shiftright("__at", 33) == F.col("__part"))
    placed = ranked.join(F.broadcast(ranges) if ranges.count() <= MOST_RANGES else ranges, on)
    placed = placed.withColumn("pos", F.col("__at") + F.col("__shift")).drop("__at", "__part", "__group", "__shift")
    return placed, ranges.groupBy(F.col("__group").alias("group")).agg(F.max("size").alias("size"))


def _rise(size: Column) -> Column:
    """How many levels a block of a level of so many nodes goes up: STEP, or fewer where that leads to the top."""
    up = F.lit(STEP)
    for k in reversed(range(STEP)):
        up = F.when(size <= WIDTH**k, k).otherwise(up)
    return up


def _parent(nodes: str):
    return lambda run: F.sha2(F.array_join(F.slice(nodes, run * WIDTH + 1, WIDTH), ""), 256)


def _blocks(level: DataFrame, payload: tuple[str, ...] = ()) -> DataFrame:
    """A row for each aligned subtree: tree, block, size, rise, members in order of pos, and nodes0 to nodes4, its levels as hex."""
    grouped = level.filter("size > 1").groupBy("tree", "size", F.expr(f"pos div {SPAN}").alias("block"))
    found = grouped.agg(F.array_sort(F.collect_list(F.struct("pos", "node", *payload))).alias("members"))
    found = found.withColumn("rise", _rise(F.col("size"))).withColumn("nodes0", F.transform("members", lambda m: _hex(m["node"])))
    for k in range(STEP):
        runs = F.sequence(F.lit(0), F.expr(f"cast((size(nodes{k}) - 1) div {WIDTH} as int)"))
        found = found.withColumn(f"nodes{k + 1}", F.when(F.col("rise") > k, F.transform(runs, _parent(f"nodes{k}"))))
    return found


def _climb(lowest: DataFrame, path: str) -> list[DataFrame]:
    """The stored levels of all trees, the lowest first, until no tree has more than one node."""
    levels = [lowest]
    while not levels[-1].filter("size > 1").isEmpty():
        top = F.coalesce(*[F.col(f"nodes{k}") for k in range(STEP, 0, -1)])[0]
        up = _blocks(levels[-1]).select("tree", F.col("block").alias("pos"), F.expr(f"(size + {SPAN - 1}) div {SPAN}").alias("size"), F.unhex(top).alias("node"))
        levels.append(_save(up, f"{path}/level{STEP * len(levels)}"))
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """tree and node, the top of each tree."""
    found = levels[0].filter("size = 1").select("tree", "node")
    for level in levels[1:]:
        found = found.unionByName(level.filter("size = 1").select("tree", "node"))
    return found


def build(docs: DataFrame, carry: dict[str, Column] | None = None, path: str | None = None) -> Manifest:
    """The manifest of docs(doc_id, source, lang, n_chars, text), stored under path (a new one in the shared folder if not given).
    carry: further columns, computed from docs, that go along with the leaves."""
    path = path or f"{shared_folder(docs.sparkSession)}/merkle/{uuid.uuid4().hex}"
    own = leaf_of(*[F.col(c) for c in FIELDS])
    rows = docs.select(F.col("source").cast("string").alias("group"), F.unhex(own).alias("node"), "doc_id", *[c.alias(k) for k, c in (carry or {}).items()])
    # stored first, so that the sample that finds the ranges does not hash the texts again
    placed, sizes = _placed(_save(rows, f"{path}/leaves"), ["doc_id", "node"], path)
    names, _ = _placed(sizes.select(F.lit(0).alias("group"), F.col("group").alias("source")), ["source"], f"{path}/sources")
    names = _save(names.select("source", F.col("pos").alias("tree")), f"{path}/names")
    on = F.col("group").eqNullSafe(F.col("source"))
    few = names.count() <= MOST_RANGES
    lowest = _save(placed.join(F.broadcast(names) if few else names, on).drop("group", "source"), f"{path}/level0")
    levels = _climb(lowest, path)
    tops = _save(_tops(levels), f"{path}/subroots")
    return Manifest(levels, names, _climb(_subroots(tops, names), f"{path}/root"))


def load(spark: SparkSession, path: str) -> Manifest:
    """The manifest that build stored under path."""

    def levels(lowest: DataFrame, folder: str) -> list[DataFrame]:
        found, size = [lowest], lowest.agg(F.max("size")).first()[0] or 0
        while size > 1:
            size = -(-size // SPAN)
            found.append(spark.read.parquet(f"{folder}/level{STEP * len(found)}"))
        return found

    names = spark.read.parquet(f"{path}/names")
    return Manifest(levels(spark.read.parquet(f"{path}/level0"), path), names, levels(_subroots(spark.read.parquet(f"{path}/subroots"), names), f"{path}/root"))


def _subroots(tops: DataFrame, names: DataFrame) -> DataFrame:
    """The lowest level of the tree over the sources."""
    return tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(names.count()).alias("size"), "node")


def _descend(levels: list[DataFrame], tops: DataFrame, payload: tuple[str, ...]) -> DataFrame:
    """pos, node, payload and proof of all lowest nodes. tops(tree, above, ...): the proof of each tree's top, and columns to hand on."""
    handed = [c for c in tops.columns if c not in ("tree", "above")]
    above = None
    for k in reversed(range(len(levels))):
        more = payload if k == 0 else ()
        keep = ["tree", "pos", "node", *more]
        found = levels[k].filter("size = 1").select(keep).join(tops, "tree").withColumnRenamed("above", "proof")
        if above is not None:
            inside = F.transform(F.sequence(F.lit(0), F.size("members") - 1), _member(("pos", "node", *more)))
            high = above.select("tree", F.col("pos").alias("block"), F.col("proof").alias("above"), *handed)
            open_ = _blocks(levels[k], more).join(high, ["tree", "block"]).select("tree", "above", *handed, F.inline(inside))
            found = found.select(*keep, "proof", *handed).unionByName(open_.select(*keep, F.concat("steps", "above").alias("proof"), *handed))
        above = found
    return above


def _member(fields: tuple[str, ...]):
    return lambda i: F.struct(*[F.col("members")[i][c].alias(c) for c in fields], _inner(i).alias("steps"))


def _inner(i: Column) -> Column:
    """The proof of a block's i-th member up to the block's own node."""
    steps = []
    for k in range(STEP):
        at = F.floor(i / WIDTH**k).cast("int")
        own = at % WIDTH
        first = at - own + 1
        left = F.array_join(F.slice(f"nodes{k}", first, own), "")
        right = F.array_join(F.slice(f"nodes{k}", first + own + 1, WIDTH - 1 - own), "")
        steps.append(F.struct(left.alias("left"), right.alias("right")))
    return F.slice(F.array(*steps), F.lit(1), F.col("rise"))


def proofs(manifest: Manifest, carried: tuple[str, ...] = (), wanted: DataFrame | None = None) -> DataFrame:
    """doc_id, carried columns, leaf, subroot, root and proof of each leaf: array of (left, right), the siblings' digests of each level.

    wanted(doc_id): proofs of those rows alone; only the blocks on their ways are opened.
    """
    levels = manifest.levels
    if wanted is not None:
        levels, keys = list(levels), wanted.select("doc_id").distinct()
        way = levels[0].join(keys, "doc_id", "left_semi").select("tree", F.expr(f"pos div {SPAN}").alias("block")).distinct()
        for k in range(len(levels)):
            levels[k] = levels[k].withColumn("block", F.expr(f"pos div {SPAN}")).join(way, ["tree", "block"], "left_semi").drop("block")
            way = way.select("tree", F.expr(f"block div {SPAN}").alias("block")).distinct()
    none = F.array().cast("array<struct<left:string,right:string>>")
    start = manifest.root_levels[-1].filter("size = 1").select("tree", none.alias("above"), _hex(F.col("node")).alias("root"))
    over = _descend(manifest.root_levels, start, ()).select(F.col("pos").alias("tree"), F.col("proof").alias("above"), _hex(F.col("node")).alias("subroot"), "root")
    found = _descend(levels, over, ("doc_id", *carried))
    if wanted is not None:
        found = found.join(keys, "doc_id", "left_semi")
    return found.select("doc_id", *carried, _hex(F.col("node")).alias("leaf"), "subroot", "root", "proof")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, folded again from a leaf that was tampered with for every other id."""
    docs = table(spark, sf_dir, "documents")
    bare = F.replace("text", F.lit("\n"), F.lit(""))
    tampered = leaf_of(*[F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, bare).otherwise(F.col("text")) if c == "text" else F.col(c) for c in FIELDS])
    found = proofs(build(docs, {"seen": F.unhex(tampered)}), ("seen",)).withColumn("folded_root", fold_up(_hex(F.col("seen")), F.col("proof")))
    siblings = F.sha2(F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    return found.select("doc_id", "leaf", "subroot", "root", siblings.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sized(value: str) -> str:
    return f"coalesce(concat(strlen(cast({value} AS varchar)), ':', cast({value} AS varchar)), '-')"


def _leaf_sql(text: str) -> str:
    return f"sha256(concat({', '.join(_sized(x) for x in ('doc_id', 'source', 'lang', 'n_chars', text))}))"


#: Trees are lists of digests here, level by level; crc32 is written out bit by bit.
_CRC = "xor(4294967295, list_reduce([4294967295]::BIGINT[] || list_transform(string_split(cast(doc_id AS varchar), ''), lambda x: ascii(x)::BIGINT), lambda c, b: list_reduce([xor(c, b)] || range(8)::BIGINT[], lambda k, i: xor(k >> 1, CASE WHEN k & 1 = 1 THEN 3988292384 ELSE 0 END))))"
_UP = "list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1 : i + 3], '')))"
_LEFT, _RIGHT = "nodes[idx - idx % 3 + 1 : idx]", "nodes[idx + 2 : idx - idx % 3 + 3]"
SQL = f"""
WITH RECURSIVE rows AS (SELECT doc_id, source, {_leaf_sql("text")} AS leaf, {_leaf_sql(f"CASE WHEN {_CRC} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS seen FROM documents),
placed AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows),
trees(tree, lvl, nodes) AS (SELECT tree, 0, list(leaf ORDER BY pos) FROM placed GROUP BY tree UNION ALL SELECT tree, lvl + 1, {_UP} FROM trees WHERE len(nodes) > 1),
subroots AS (SELECT tree, nodes[1] AS subroot FROM trees WHERE len(nodes) = 1),
top(lvl, nodes) AS (SELECT 0, list(subroot ORDER BY tree) FROM subroots UNION ALL SELECT lvl + 1, {_UP} FROM top WHERE len(nodes) > 1),
steps AS (
 SELECT p.tree, p.pos, lvl, array_to_string({_LEFT}, '') AS l, array_to_string({_RIGHT}, '') AS r FROM (SELECT tree, pos, lvl, nodes, cast(pos // power(3, lvl)::BIGINT AS bigint) AS idx FROM placed JOIN trees USING (tree) WHERE len(nodes) > 1) p
 UNION ALL SELECT tree, pos, 1000 + lvl, array_to_string({_LEFT}, ''), array_to_string({_RIGHT}, '') FROM (SELECT tree, pos, lvl, nodes, cast(tree // power(3, lvl)::BIGINT AS bigint) AS idx FROM placed, top WHERE len(nodes) > 1)),
proofs AS (SELECT tree, pos, string_agg(concat(l, r), '' ORDER BY lvl) AS proof, list(concat(l, '|', r) ORDER BY lvl) AS pairs FROM steps GROUP BY tree, pos),
folded AS (SELECT p.*, subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
 list_reduce([seen] || coalesce(pairs, []), lambda own, s: sha256(concat(split_part(s, '|', 1), own, split_part(s, '|', 2)))) AS folded_root
 FROM placed p JOIN subroots USING (tree) LEFT JOIN proofs q ON p.tree = q.tree AND p.pos = q.pos)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
