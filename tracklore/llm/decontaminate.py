"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, run once over each text.

Words are runs of digits, letters and non-ASCII characters after A-Z are lower-cased. A test item gives one window
for each run of ``window`` consecutive words; an item with fewer words (but not none) is one window. A document word is hit when it
lies inside any occurrence of any window.

Defined cases: null or empty text has no words, so no hits; repeated rows each get a row of their own; a null doc_id or
item_id stays null (a null item_id still marks words but is not named in ``items``); an empty item table hits nothing.
Extra columns of either table are not read.

Scale: documents are scanned where they lie, with no shuffle. The items are broadcast only while their text is at most
``max_item_chars``, which bounds a worker's automaton; a larger item table is read in parts of at most that size (a single longer item is a part), each with
an automaton and a pass of its own, and what the parts find is merged by the text's SHA-256, which alone decides: by a
shuffle of digests, word positions and items. Both ways give the same rows.
"""

from __future__ import annotations

import functools
import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklore.llm.common import filter_by_ids, map_chunks, materialise

#: Byte to byte: word bytes stay, all others become a space.
WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

#: Characters of items that go into one automaton. Each word begins a window of its own, a path of some 65 nodes, and an automaton
#: takes about 420 bytes a character: 250 MB for every Python worker at this bound.
MAX_ITEM_CHARS = 600_000

HITS = "doc_id long, n_words long, hit_words array<int>, items array<long>, spans array<struct<start:int,end:int>>"


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; bytes.lower changes A-Z only."""
    return (text or "").encode().lower().translate(WORD_BYTES).split()


def windows(text: str | None, size: int) -> list[tuple[bytes, int]]:
    """Each window with its number of words."""
    w = words(text)
    if not w:
        return []
    if len(w) <= size:
        return [(b" ".join(w), len(w))]
    return [(b" ".join(w[i : i + size]), size) for i in range(len(w) - size + 1)]


def stretches(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Code point offsets of the runs of hit words."""
    at = [m.span() for m in WORD.finditer(text)]
    return [(at[run[0]][0], at[run[-1]][1]) for run in np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)]


class Scanner:
    """The automaton; keys are window bytes as Latin-1 text between spaces, so matches start and end at word ends."""

    def __init__(self, items: list[tuple[int | None, str | None]], size: int):
        found: dict[bytes, tuple[int, set[int]]] = {}
        for item_id, text in items:
            for key, n in windows(text, size):
                entry = found.setdefault(key, (n, set()))
                if item_id is not None:
                    entry[1].add(item_id)
        self.entries = list(found.values())
        self.automaton = None
        if found:
            self.automaton = ahocorasick.Automaton()
            for k, key in enumerate(found):
                self.automaton.add_word(f" {key.decode('latin-1')} ", k)
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[int], list[int], list[tuple[int, int]]]:
        """Number of words, positions of hit words, items found, and hit stretches as code point offsets."""
        w = words(text)
        if not w or self.automaton is None:
            return len(w), [], [], []
        line = b" " + b" ".join(w) + b" "
        matches = list(self.automaton.iter(line.decode("latin-1")))
        if not matches:
            return len(w), [], [], []
        spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        change = np.zeros(len(w) + 1, np.int64)
        items: set[int] = set()
        for end, k in matches:
            n, ids = self.entries[k]
            last = int(np.searchsorted(spaces, end))
            change[last - n] += 1
            change[last] -= 1
            items |= ids
        hit = np.flatnonzero(np.cumsum(change[:-1]) > 0)
        return len(w), hit.tolist(), sorted(items), stretches(text, hit)


@functools.lru_cache(maxsize=2)
def _scanner(items: tuple, size: int) -> Scanner:
    return Scanner(list(items), size)


def _usable(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """item_id and text of the items with a text, and the number of their characters."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).filter(F.col("text").isNotNull())
    return items, items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]


def _parts(items: DataFrame, max_item_chars: int):
    """The items in lists of at most max_item_chars characters; a longer item is alone. One partition at a time comes here."""
    part, size = [], 0
    for r in items.toLocalIterator():
        if part and size + len(r["text"]) > max_item_chars:
            yield part
            part, size = [], 0
        part.append((r["item_id"], r["text"]))
        size += len(r["text"])
    if part:
        yield part


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _scan_part(docs: DataFrame, items: list[tuple], window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(tuple(items))

    def work(batch: pa.RecordBatch):
        scanner = _scanner(shared.value, window)
        rows = [scanner.scan(x) for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                pa.array([[{"start": s, "end": e} for s, e in r[3]] for r in rows], _SPANS),
            ],
            names=["doc_id", "n_words", "hit_words", "items", "spans"],
        )

    return map_chunks(docs.select("doc_id", "text"), work, HITS)


def _hits_of_part(docs: DataFrame, items: list[tuple], window: int) -> DataFrame:
    """key (SHA-256 of the text), hit_words and items of the distinct texts of docs with a hit."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(items))

    def work(batch: pa.RecordBatch):
        scanner = _scanner(shared.value, window)
        texts = batch.column("text").to_pylist()
        found = [(hashlib.sha256(t.encode()).digest(), *scanner.scan(t)[1:3]) for t in texts if t]
        found = [f for f in found if f[1]]
        yield pa.RecordBatch.from_arrays([pa.array([f[j] for f in found], t) for j, t in enumerate((pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())))], names=["key", "hit_words", "items"])

    return map_chunks(docs.select("text"), work, "key binary, hit_words array<int>, items array<long>").dropDuplicates(["key"])


def _hits_of_parts(docs: DataFrame, items: DataFrame, window: int, max_item_chars: int) -> DataFrame:
    """key, hit_words and items of each text with a hit in any part, merged over the parts."""
    found = None
    for part in _parts(items, max_item_chars):
        hits = materialise(_hits_of_part(docs, part, window))
        found = hits if found is None else found.unionByName(hits)
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return materialise(found.groupBy("key").agg(union("hit_words"), union("items")))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_item_chars: int = MAX_ITEM_CHARS) -> DataFrame:
    """Per document: number of words, positions of hit words, ids of the items found and hit stretches of the text.

    docs(doc_id, text), benchmark(item_id, text). See the module for the cases.
    """
    items, total = _usable(benchmark)
    if total <= max_item_chars:
        return _scan_part(docs, [(r[0], r[1]) for r in items.collect()], window)
    hits = _hits_of_parts(docs, items, window, max_item_chars)
    joined = docs.select("doc_id", "text", F.unhex(F.sha2("text", 256)).alias("key")).join(hits, "key", "left")

    def work(batch: pa.RecordBatch):
        texts, hit = batch.column("text").to_pylist(), batch.column("hit_words").to_pylist()
        spans = [[{"start": s, "end": e} for s, e in stretches(t, np.array(h))] if h else [] for t, h in zip(texts, hit, strict=True)]
        found = batch.column("items").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array([len(words(t)) for t in texts], pa.int64()),
                pa.array([h or [] for h in hit], pa.list_(pa.int32())),
                pa.array([f or [] for f in found], pa.list_(pa.int64())),
                pa.array(spans, _SPANS),
            ],
            names=["doc_id", "n_words", "hit_words", "items", "spans"],
        )

    return map_chunks(joined.select("doc_id", "text", "hit_words", "items"), work, HITS)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_item_chars: int = MAX_ITEM_CHARS) -> DataFrame:
    """The documents without any hit word, with all their columns: each row is judged by its own text, whatever its doc_id.

    Each text is tested where it lies (one pass, no join); over max_item_chars one pass a part, and an anti join by the
    text's SHA-256.
    """
    items, total = _usable(benchmark)
    if total > max_item_chars:
        gone = _hits_of_parts(docs, items, window, max_item_chars).select(F.col("key").alias("__text_key"))
        return filter_by_ids(docs.withColumn("__text_key", F.unhex(F.sha2("text", 256))), gone, "__text_key", "left_anti").select(*docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(tuple((r[0], r[1]) for r in items.collect()))

    def work(batch: pa.RecordBatch):
        scanner = _scanner(shared.value, window)
        yield batch.filter(pa.array([not scanner.scan(x)[1] for x in batch.column("text").to_pylist()], pa.bool_()))

    return map_chunks(docs, work, docs.schema)


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    from tracklore.llm.common import table

    hits = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def _words_sql(table: str, key: str) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}"


SQL = f"""
WITH d AS ({_words_sql("documents", "doc_id")}),
b AS ({_words_sql("benchmark", "item_id")}),
windows AS (
 SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS s
 FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
places AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT p.doc_id, p.i, p.n, item_id FROM places p JOIN windows x ON p.s = x.s AND p.n = x.n),
counts AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(cast(item_id AS varchar), ',' ORDER BY cast(item_id AS varchar)) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN counts c ON d.doc_id = c.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id
"""
