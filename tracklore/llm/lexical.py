"""Ranked lexical search: every item's best documents, scored once for each class of documents that look alike to the items.

Only words that some item has can score. A document is therefore its bag: how often it has each word of the item vocabulary,
and m, which stands for its length. Documents of equal bag and m have equal scores for every item. They are grouped by a
hash of both and told apart by the bags themselves, each class keeps its ``k`` least doc_ids, and items are scored against
classes. A class's score counts for its members in ascending order of doc_id.

Score of a document for an item: over the item's words, repeats included, the sum of w * ((10^9 * tf) div (1000 * tf + 8 * m)), with
w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 25 + (75 * n * N) div L; N counts documents with words, L their words, n
those of one document, df the documents that have the word, tf its occurrences in the document.

Defined cases: null and empty texts have no words, are not counted and never found; repeated documents are documents of
their own; among equal scores a null doc_id comes last; repeated items are one item, different texts under one item_id are items
of their own; an item without scoring documents gives no row; empty tables give none. Very long texts are counted in
pieces, whole. Extra columns are not read.

Scale: texts are read where they lie, once for each part of the items, and become bags, which are stored. Of a class at most k rows
of a map task are shuffled. Scoring keeps k documents of each item and task. Items go to the tasks in parts of at most
``max_item_bytes`` of text (a longer item is a part alone), so memory does not grow with them; all parts are run, with the same
result as one. The driver holds one part's words and their document counts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracklore.llm.common import map_chunks, materialise, table
from tracklore.llm.decontaminate import WORD_BYTES, words

#: Bytes of item text that go to the tasks at a time.
MAX_ITEM_BYTES = 4_000_000
#: Bytes of a text that are split into words at a time.
PIECE = 1_000_000
#: Bytes of bags that are scored at a time.
BLOCK = 8_000_000


def count_words(text: str | None, known: dict[bytes, int]) -> tuple[int, dict[int, int]]:
    """The number of words of a text, and how often it has each known one."""
    raw = (text or "").encode().lower().translate(WORD_BYTES)
    n, found, at = 0, Counter(), 0
    while at < len(raw):
        end = len(raw) if at + PIECE >= len(raw) else raw.find(b" ", at + PIECE)
        piece = raw[at : end if end >= 0 else len(raw)].split()
        at = end if end >= 0 else len(raw)
        n += len(piece)
        for word, count in Counter(piece).items():
            if (k := known.get(word)) is not None:
                found[k] += count
    return n, found


class Items:
    """Items of one part: number, id and word counts of each, over a vocabulary of their own."""

    def __init__(self, rows: list[tuple[int, int | None, str | None]]):
        counted = [(number, item_id, Counter(words(text))) for number, item_id, text in rows]
        self.known = {w: k for k, w in enumerate(sorted({w for _, _, c in counted for w in c}))}
        self.items = [(number, item_id, [(self.known[w], n) for w, n in c.items()]) for number, item_id, c in counted]


def _bags(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """doc_id, n and bag of each document with words: bag is pairs of (word, count) as little-endian int32, in order of word."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, sizes, bags = [], [], []
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            n, found = count_words(text.as_py(), known)
            if n:
                ids.append(doc_id.as_py())
                sizes.append(n)
                bags.append(np.array(sorted(found.items()), "<i4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], ["doc_id", "n", "bag"])

    return map_chunks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, "doc_id long, n long, bag binary")


def _document_counts(bags: DataFrame, size: int) -> np.ndarray:
    """In how many documents each word of the vocabulary is; tasks hand on their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4")[::2], minlength=size)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there])], ["word", "n"])

    out = np.zeros(size, np.int64)
    for word, n in bags.select("bag").filter("length(bag) > 0").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n")).collect():
        out[word] = n
    return out


def _classes(bags: DataFrame, documents: int, total: int, k: int) -> DataFrame:
    """m, bag and ids, the k least doc_ids, of each class of equal m and bag."""
    m = F.expr(f"25 + (cast(75 as decimal(38, 0)) * n * {documents}L) div {total}L").alias("m")
    hashed = bags.filter("length(bag) > 0").select("doc_id", m, "bag").withColumn("h", F.xxhash64("m", "bag"))
    least = Window.partitionBy("h", "m", "bag").orderBy(F.asc_nulls_last("doc_id"))
    kept = hashed.withColumn("place", F.row_number().over(least)).filter(F.col("place") <= k)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("place", "doc_id"))), lambda x: x["doc_id"])
    return kept.groupBy("h", "m", "bag").agg(ids.alias("ids")).select("m", "bag", "ids")


def _block_scores(items: Items, weight: np.ndarray, m: np.ndarray, bags: list[bytes]) -> Iterator[np.ndarray]:
    """For each item, the scores of all classes of a block."""
    pairs = np.frombuffer(b"".join(bags), "<i4").reshape(-1, 2)
    owner = np.repeat(np.arange(len(bags)), [len(b) // 8 for b in bags])
    order = np.argsort(pairs[:, 0], kind="stable")
    word, tf, owner = pairs[order, 0], pairs[order, 1].astype(np.int64), owner[order]
    gain = weight[word] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
    start = np.searchsorted(word, np.arange(len(weight) + 1))
    for _, _, terms in items.items:
        score = np.zeros(len(bags), np.int64)
        for t, n in terms:
            a, b = start[t], start[t + 1]
            score[owner[a:b]] += n * gain[a:b]  # a class has a word once
        yield score


def _best(items: Items, weight: np.ndarray, k: int):
    """Over classes: the k best documents of each item in what a task sees."""

    def merge(best: list[list], m: list[int], bags: list[bytes], ids: list[list]) -> None:
        first = np.array([np.iinfo(np.int64).max if i[0] is None else i[0] for i in ids], np.int64)
        for i, score in enumerate(_block_scores(items, weight, np.array(m, np.int64), bags)):
            own = best[i]
            at = np.flatnonzero(score >= max(1, -own[-1][0] if len(own) == k else 1))
            if len(at) > k:
                at = at[np.lexsort((first[at], -score[at]))[:k]]
            if len(at):
                own += [(-int(score[c]), d is None, d or 0) for c in at for d in ids[c]]
                own.sort()
                del own[k:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in items.items]
        m, bags, ids, size = [], [], [], 0
        for batch in batches:
            for x, bag, own in zip(batch.column("m").to_pylist(), batch.column("bag").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if bags and size + len(bag) > BLOCK:
                    merge(best, m, bags, ids)
                    m, bags, ids, size = [], [], [], 0
                m.append(x)
                bags.append(bag)
                ids.append(own)
                size += len(bag)
        if bags:
            merge(best, m, bags, ids)
        out = [(number, item_id, None if null else d, -score) for (number, item_id, _), own in zip(items.items, best, strict=True) for score, null, d in own]
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "item_id", "doc_id", "score"])

    return run


def _parts(items: DataFrame, max_item_bytes: int) -> list[DataFrame]:
    """The distinct items (item, item_id, text), dealt by hash so that no part of several items has more bytes."""
    rows = materialise(items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct().withColumn("item", F.monotonically_increasing_id()))
    n = 1
    while True:
        part = F.pmod(F.xxhash64("item"), F.lit(n))
        if rows.groupBy(part).agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).filter(f"bytes > {max_item_bytes} and n > 1").isEmpty():
            return [rows.filter(part == i).select("item", "item_id", "text") for i in range(n)]
        n *= 2


def rank(docs: DataFrame, items: DataFrame, k: int = 10, max_item_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item. docs(doc_id, text), items(item_id, text)."""
    spark = docs.sparkSession
    schema = "item long, item_id long, doc_id long, score long"
    found = spark.createDataFrame([], schema)
    for part in _parts(items, max_item_bytes):
        own = Items([tuple(r) for r in part.collect()])
        bags = materialise(_bags(docs, own.known))
        documents, total = bags.agg(F.count("*"), F.sum("n")).first()
        if not documents or not own.known:
            continue
        counts = _document_counts(bags, len(own.known))
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in counts], np.int64)
        found = found.unionByName(_classes(bags, documents, total, k).mapInArrow(_best(own, weight, k), schema))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
corpus AS (SELECT count(*) AS n_docs, cast(sum(len(words)) AS bigint) AS n_words FROM d WHERE len(words) > 0),
tfs AS (SELECT r, any_value(doc_id) AS doc_id, any_value(25 + (75 * n * n_docs) // n_words) AS m, word, count(*) AS tf FROM (SELECT r, doc_id, len(words) AS n, unnest(words) AS word FROM d), corpus GROUP BY r, word),
weights AS (SELECT word, cast(floor(1000e0 * ln(cast(2 * any_value(n_docs) + 2 AS double) / cast(2 * count(*) + 1 AS double))) AS bigint) AS w FROM tfs, corpus GROUP BY word),
items AS (SELECT row_number() OVER () AS item, item_id, {_WORDS} AS words FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT item, any_value(item_id) AS item_id, word, count(*) AS times FROM (SELECT item, item_id, unnest(words) AS word FROM items) GROUP BY item, word),
scores AS (SELECT item, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS bigint) AS score FROM asked JOIN tfs USING (word) JOIN weights USING (word) GROUP BY item, r),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, cast(rank AS int) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
