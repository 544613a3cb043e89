"""Near-duplicates by BagMinHash over multisets of word shingles.

A text is the multiset of its runs of five words (white space splits, A-Z lower-cased); a text of one to four words is
one shingle. Two texts are linked when their multisets overlap by 0.8 or more (sum of the smaller counts over sum of the
larger); classes are the connected components of the links, named by their least doc_id.

Signatures: each shingle carries Poisson processes over time, one per dyadic interval of its weight ([0,1), [1,2), [2,4)
...), with rate (registers x interval length). A point has a time, a register and a place in its interval, and counts
when the place lies below the shingle's count. A register keeps its first time, so two texts agree in a register with a
chance of exactly their weighted Jaccard similarity, and only points before a horizon that depends on the total weight
need be drawn: about ten per register, however long the text.

Links: equal texts are collapsed first. Signatures are cut into bands; the members of a bucket are compared with its most
central member, verified on their whole multisets, and merged. Large buckets that still hold several classes are gone
through again with ``HUBS`` other central members each, while that merges a good share of their classes. Then what lies in
one bucket but still in different classes is compared as well: all such pairs in buckets of up to ``SMALL`` members; in
larger ones the members outside the bucket's largest class against all its members, or, where there are more than SMALL of
those, by an exact join of all such texts on their rarest shingles (prefix and position filters), whose pairs are verified
in the same way. So every pair of one bucket is compared or excluded by a bound; no bucket is cut. A pair at 0.8 shares a
band with a chance of 0.99997. Only pairs across classes that may still reach 0.8 leave the exact join; in a family of
texts that are all a little less than 0.8 alike their number grows with the square of the family.

Defined cases: null and empty texts, and texts of white space only, are alone in their class; a null doc_id has a null
class; rows that repeat a doc_id share its class, and where their texts differ they join both classes; empty tables give
empty results. Extra columns are not read by ``near_duplicate_classes`` and are kept by ``drop_near_duplicates``.

Scale: one Python pass over the texts; after it only ids, signatures (160 bytes a text) and the texts of candidate pairs
are shuffled. Copies of one text are combined in their task, and find their class by broadcast where they are many; the
texts of a hub are dealt out; other joins are such as Spark can split where a key is hot. Broadcast are tables of at most
MOST_BROADCAST_IDS ids, the at most MOST_HOT hot keys of a join, and the SLOTS counts of the exact join; nothing else is collected.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracklore.llm.common import filter_by_ids, map_chunks, materialise, table

SHINGLE = 5
REGISTERS = 80
ROWS = 4
BANDS = REGISTERS // ROWS
THRESHOLD = (4, 5)
SMALL = 24
#: Slots by which the exact join counts shingles, for their order only (8 bytes each, broadcast).
SLOTS = 1 << 21
#: Slots in a row of a task's counts.
SLOT_BLOCK = 1 << 13
#: Parts that the texts of one common shingle are dealt into by the exact join.
SALTS = 16
#: Members of a large mixed bucket that its other members are compared with in one further round.
HUBS = 4
#: A further round follows while one merges at least this share of the classes that large mixed buckets hold.
GOOD_SHARE = 0.1
#: Pairs of one hot text that are verified together, and rows of a key below which it is never hot.
DEALT = 512
#: A key is hot with more than one in so many rows, so there are at most so many hot keys.
MOST_HOT = 10_000
#: Signature agreement under which a pair at the threshold is all but impossible (5.6 standard deviations).
LEAST_AGREEMENT = 0.55

_MASK44 = np.uint64((1 << 44) - 1)
_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()


def word_lists(texts: list[str | None]) -> list[list[bytes]]:
    return [(t or "").encode().lower().split() for t in texts]


def shingles(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of every word list, and the list it belongs to."""
    sizes = np.array([len(x) for x in lists], np.int64)
    get = _hashes.__getitem__
    w = np.fromiter((get(x) for one in lists for x in one), np.uint64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(lists)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(w))
    with np.errstate(over="ignore"):
        total = np.zeros(len(w), np.uint64)
        for j in range(SHINGLE):
            total[: len(w) - j] += w[j:] * _P[j] if j else w * _P[0]
        whole = left >= SHINGLE
        h, at = _mix(total[whole]), owner[whole]
        short = [i for i in np.flatnonzero((sizes > 0) & (sizes < SHINGLE))]
        if short:
            h = np.concatenate([h, np.array([xxhash.xxh64_intdigest(b" ".join(lists[i]), seed=1) for i in short], np.uint64)])
            at = np.concatenate([at, np.array(short)])
    return h, at


def signatures(lists: list[list[bytes]], registers: int = REGISTERS) -> np.ndarray:
    """One row of register times per word list; a list without words has infinite times."""
    out = np.full((len(lists), registers), np.inf)
    h, at = shingles(lists)
    if not len(h):
        return out
    with np.errstate(over="ignore"):
        keys, counts = np.unique((at.astype(np.uint64) << np.uint64(44)) | (h & _MASK44), return_counts=True)
    doc = (keys >> np.uint64(44)).astype(np.int64)
    element = keys & _MASK44
    weight = np.bincount(doc, counts, len(lists))
    # one process per dyadic interval that a count reaches into
    level = [np.zeros(len(keys), np.int64)]
    row = [np.arange(len(keys))]
    j = 1
    while (more := np.flatnonzero(counts > 2 ** (j - 1))).size:
        row.append(more)
        level.append(np.full(more.size, j))
        j += 1
    row, level = np.concatenate(row), np.concatenate(level)
    doc, element, counts = doc[row], element[row], counts[row]
    low = np.where(level == 0, 0, 2.0 ** (level - 1))
    length = np.where(level == 0, 1.0, low)
    seed = _mix(element * _P[0] + level.astype(np.uint64) * _P[1])
    horizon = (np.log(registers) + 5) / np.maximum(weight, 1)
    todo = np.arange(len(doc))
    start = np.zeros(len(doc))
    step = np.zeros(len(doc), np.uint64)
    flat = out.reshape(-1)
    while todo.size:
        late = []
        while todo.size:
            with np.errstate(over="ignore"):
                a = _mix(seed[todo] + (step[todo] + np.uint64(1)) * _P[2])
                b = _mix(a + _P[3])
            t = start[todo] - np.log(((a >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (registers * length[todo])
            ok = t <= horizon[doc[todo]]
            late.append(todo[~ok])
            todo, t, b = todo[ok], t[ok], b[ok]
            start[todo] = t
            step[todo] += np.uint64(1)
            place = low[todo] + length[todo] * ((b >> np.uint64(32)).astype(np.float64) * 2.0**-32)
            counted = place < counts[todo]
            register = ((b & np.uint64(0xFFFFFFFF)) * np.uint64(registers)) >> np.uint64(32)
            np.minimum.at(flat, doc[todo[counted]] * registers + register[counted].astype(np.int64), t[counted])
        # texts with an empty register go on from where they stopped, to a later horizon
        open_docs = np.zeros(len(lists), bool)
        open_docs[np.isinf(out).any(1) & (weight > 0)] = True
        todo = np.concatenate(late)
        todo = todo[open_docs[doc[todo]]]
        horizon = horizon * 2
    return out


def codes(times: np.ndarray) -> np.ndarray:
    """16-bit register codes: equal times have equal codes."""
    return (_mix(times.view(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def band_keys(times: np.ndarray) -> np.ndarray:
    """BANDS 64-bit keys per row."""
    bits = _mix(times.view(np.uint64)).reshape(len(times), BANDS, ROWS)
    with np.errstate(over="ignore"):
        key = np.arange(BANDS, dtype=np.uint64)[None, :] * _P[4]
        for j in range(ROWS):
            key = _mix(key + bits[:, :, j] * _P[j])
    return key.view(np.int64)


def overlap(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sum of smaller and of larger counts of two sorted-unique multisets given as shingle hashes with repeats."""
    ka, ca = np.unique(a, return_counts=True)
    kb, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[ia], cb[ib]).sum())
    return both, len(a) + len(b) - both


def _sketch(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the words, band keys and register codes of every text that has words."""

    def work(batch: pa.RecordBatch):
        ids = batch.column("doc_id").to_pylist()
        lists = word_lists(batch.column("text").to_pylist())
        keep = [i for i, x in enumerate(lists) if x]
        lists = [lists[i] for i in keep]
        times = signatures(lists)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([ids[i] for i in keep], pa.int64()),
                pa.array([hashlib.blake2b(b" ".join(x), digest_size=16).digest() for x in lists], pa.binary()),
                pa.array(list(band_keys(times)), pa.list_(pa.int64())),
                pa.array([x.tobytes() for x in codes(times)], pa.binary()),
            ],
            names=["doc_id", "digest", "bands", "codes"],
        )

    return map_chunks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL"), work, "doc_id long, digest binary, bands array<long>, codes binary")


def _meet(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """rows joined with groups(key, n, ...), both stored; one row a key, n being the number of rows that it meets.

    Rows of hot keys stay where they lie and get their group by broadcast, of at most MOST_HOT rows; no key that is shuffled
    holds more than one in MOST_HOT of the rows, or DEALT rows.
    """
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = groups.filter(F.col("n") > max(DEALT, total // MOST_HOT))
    if hot.isEmpty():
        return rows.join(groups, key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(groups, key)
    return rest.unionByName(rows.join(F.broadcast(hot), key))


def _agree(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) whose register codes agree often enough to be worth verifying."""
    side = lambda n: sketches.select(F.col("doc_id").alias(n), F.col("codes").alias(f"codes_{n}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("codes_a", "codes_b"))
                batch = batch.filter(pa.array((x == y).mean(1) >= LEAST_AGREEMENT, pa.bool_()))
            yield batch.select(["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct()


def _verify(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose whole multisets overlap enough. Only texts of pairs are shuffled.

    The pairs of a text that is in many are dealt into groups of about DEALT, each of which gets the text once.
    """
    pairs = materialise(pairs)
    ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    texts = filter_by_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids, "doc_id", "left_semi")
    groups = materialise(pairs.groupBy("a").agg(F.count("*").alias("n")).withColumn("groups", F.floor(F.col("n") / DEALT) + 1))
    dealt = _meet(pairs, groups, "a").withColumn("deal", F.pmod(F.xxhash64("b"), F.col("groups"))).drop("groups", "n")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")).join(groups.drop("n"), "a").withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))).drop("groups")
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = dealt.join(right, "b").join(left, ["a", "deal"]).select("a", "b", "text_a", "text_b")

    def run(batches):
        last, left = None, np.zeros(0, np.uint64)
        for batch in batches:
            keep = []
            for a, i in zip(batch.column("text_a").to_pylist(), range(batch.num_rows), strict=True):
                if a != last:  # by text: an id may have several
                    left, last = shingles(word_lists([a]))[0], a
                small, large = overlap(left, shingles(word_lists([batch.column("text_b")[i].as_py()]))[0])
                keep.append(small * THRESHOLD[1] >= large * THRESHOLD[0])
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and label (the least node of its component) for each node of the links (a, b).

    Alternating large and small stars: each round joins and takes minima by node, written to the shared folder, until a
    round changes nothing.
    """
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    seen = None
    while True:
        state = tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
        if state[0] == 0 or state == seen:
            break
        seen = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
        edges = materialise(small.filter("u <> v").distinct())
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _cross_pairs(members: DataFrame) -> DataFrame:
    """members (bucket, rep, label, n): pairs of one bucket in different classes, for buckets of at most SMALL members."""
    grouped = members.filter(F.col("n") <= SMALL).groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("rep", "label"))).alias("m"), F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y")
    pair = F.flatten(F.transform("m", lambda p: F.transform(F.filter("m", lambda q: (q["rep"] > p["rep"]) & (q["label"] != p["label"])), lambda q: F.struct(p["rep"].alias("a"), q["rep"].alias("b")))))
    return grouped.select(F.explode(pair).alias("p")).select("p.a", "p.b")


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each text's multiset of shingles as a set: a token is a shingle with its occurrence in the text. Tokens, and their text."""
    h, at = shingles(word_lists(texts))
    order = np.lexsort((h, at))
    h, at = h[order], at[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (at[1:] != at[:-1])
    starts = np.flatnonzero(first)
    occurrence = (np.arange(len(h)) - np.repeat(starts, np.diff(np.append(starts, len(h))))).astype(np.uint64)
    with np.errstate(over="ignore"):
        return _mix(h + occurrence * _P[2]), at


def _slot_counts(texts: DataFrame) -> np.ndarray:
    """How many tokens of texts(label, text) fall into each of SLOTS slots by their hash; 0 where all are of one class.

    A task counts all of its texts before it hands on anything: a row for each block of slots, with those of them that it met.
    """
    names = ["slots", "n", "lo", "hi"]

    def run(batches):
        n, lo, hi = np.zeros(SLOTS, np.int64), np.full(SLOTS, np.iinfo(np.int64).max), np.full(SLOTS, np.iinfo(np.int64).min)
        for batch in batches:
            labels = np.asarray(batch.column("label"), np.int64)
            for k in range(0, batch.num_rows, 200):
                token, at = _tokens(batch.column("text").slice(k, 200).to_pylist())
                slot = (token % np.uint64(SLOTS)).astype(np.int64)
                n += np.bincount(slot, minlength=SLOTS)
                np.minimum.at(lo, slot, labels[k + at])
                np.maximum.at(hi, slot, labels[k + at])
        there = np.flatnonzero(n)
        ends = np.flatnonzero(np.diff(there // SLOT_BLOCK, append=-1)) + 1
        lists = [pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(x, pa.int64())) for x in (there, n[there], lo[there], hi[there])]
        yield pa.RecordBatch.from_arrays([pa.array(there[ends - 1] // SLOT_BLOCK if len(there) else there), *(lists if len(there) else [x.slice(0, 0) for x in lists])], names=["block", *names])

    def add(rows: pa.Table) -> pa.Table:
        slots, n, lo, hi = (np.concatenate([np.zeros(0, np.int64), *rows.column(c).to_numpy()]) for c in names)
        order = np.argsort(slots, kind="stable")
        first = np.flatnonzero(np.diff(slots[order], prepend=-1))
        n, lo, hi = np.add.reduceat(n[order], first), np.minimum.reduceat(lo[order], first), np.maximum.reduceat(hi[order], first)
        mixed = lo < hi
        return pa.table({"slots": pa.array([slots[order][first][mixed]], pa.list_(pa.int64())), "n": pa.array([n[mixed]], pa.list_(pa.int64()))})

    counted = texts.select("label", "text").mapInArrow(run, "block long, slots array<long>, n array<long>, lo array<long>, hi array<long>")
    out = np.zeros(SLOTS, np.int64)
    for r in counted.groupBy("block").applyInArrow(add, "slots array<long>, n array<long>").toArrow().to_batches():
        out[np.asarray(r.column("slots").flatten(), np.int64)] = np.asarray(r.column("n").flatten(), np.int64)
    return out


def _prefixes(texts: DataFrame) -> DataFrame:
    """token, rep, label, n, rest, f: the rarest tokens of each text of texts(rep, label, text), enough that two texts of
    different classes which overlap by the threshold have their first common one among them.

    All tokens are put in one order, by the count f of their slot, which is at least their own number of texts; first those
    whose slot only one class has, which no pair across classes has in common. Of n tokens at least 4/5 n must be common, so
    the first n - 4/5 n + 1 cannot all be missing in the other text. rest is the number of tokens from this one on.
    """
    counts = texts.sparkSession.sparkContext.broadcast(_slot_counts(texts))

    def work(batch: pa.RecordBatch):
        token, at = _tokens(batch.column("text").to_pylist())
        f = counts.value[(token % np.uint64(SLOTS)).astype(np.int64)]
        order = np.lexsort((token, f, at))
        token, at, f = token[order], at[order], f[order]
        n = np.bincount(at, minlength=batch.num_rows)
        place = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        n = n[at]
        keep = (f > 0) & (place < n - -(-4 * n // 5) + 1)
        owner = pa.array(at[keep])
        yield pa.RecordBatch.from_arrays([pa.array(token[keep].view(np.int64)), *(batch.column(c).take(owner) for c in ("rep", "label")), *(pa.array(x[keep]) for x in (n, n - place, f))], names=["token", "rep", "label", "n", "rest", "f"])

    return map_chunks(texts.select("rep", "label", "text"), work, "token long, rep long, label long, n long, rest long, f long")


def _exact_pairs(texts: DataFrame) -> DataFrame:
    """Pairs across classes of texts(rep, label, text), among them every pair that overlaps by the threshold.

    At the first common token of a pair no more than the smaller rest can be common, which must be 4/9 of both sizes. Tokens
    of many texts are salted: one side is dealt out, the other copied.
    """
    prefix = materialise(_prefixes(texts))
    hot = F.col("f") > SMALL
    left = prefix.withColumn("salt", F.when(hot, F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")).otherwise(0)).select("token", "salt", *[F.col(c).alias(f"{c}_a") for c in ("rep", "label", "n", "rest")])
    right = prefix.withColumn("salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).select("token", "salt", *[F.col(c).alias(f"{c}_b") for c in ("rep", "label", "n", "rest")])
    enough = F.least("rest_a", "rest_b") * (THRESHOLD[0] + THRESHOLD[1]) >= (F.col("n_a") + F.col("n_b")) * THRESHOLD[0]
    both = left.join(right, ["token", "salt"]).filter((F.col("rep_a") < F.col("rep_b")) & (F.col("label_a") != F.col("label_b")) & enough)
    return both.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()


def _main_classes(members: DataFrame) -> DataFrame:
    """bucket, main and rest of each large bucket with more than one class: its largest class, and the members outside it."""
    per = members.filter(F.col("n") > SMALL).groupBy("bucket", "label").agg(F.count("*").alias("k"))
    return per.groupBy("bucket").agg(F.max_by("label", F.struct("k", "label")).alias("main"), (F.sum("k") - F.max("k")).alias("rest")).filter("rest > 0")


def _hub_pairs(members: DataFrame, main: DataFrame, seed: int) -> DataFrame:
    """Pairs across classes of HUBS central members, as a, of each bucket of main with its other members. members has weight."""
    mixed = members.join(main.select("bucket"), "bucket", "left_semi")
    part = F.pmod(F.xxhash64("rep", F.lit(seed)), F.lit(HUBS))
    hubs = mixed.groupBy("bucket", part.alias("part")).agg(F.max_by(F.struct("rep", "label"), F.struct(F.col("weight"), -F.col("rep"))).alias("hub"))
    both = mixed.join(hubs.select("bucket", "hub"), "bucket").filter("label <> hub.label")
    return both.select(F.col("hub.rep").alias("a"), F.col("rep").alias("b")).distinct()


def _large_pairs(members: DataFrame, main: DataFrame) -> DataFrame:
    """Pairs across classes in large buckets with few members outside the main class: those, as a, against all others."""
    large = members.filter(F.col("n") > SMALL).join(main.filter(F.col("rest") <= SMALL).select("bucket", "main"), "bucket")
    outside = large.filter("label <> main").select("bucket", F.col("rep").alias("a"), F.col("label").alias("la"))
    # two members outside are one pair
    return large.join(outside, "bucket").filter("label <> la AND (label = main OR a < rep)").select("a", F.col("rep").alias("b"))


def _wide_pairs(members: DataFrame, main: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs across classes of all texts in large buckets with many members outside the main class, by the exact join."""
    wide = materialise(members.join(main.filter(F.col("rest") > SMALL).select("bucket"), "bucket", "left_semi").select(F.col("rep").alias("doc_id"), "label").distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = filter_by_ids(texts, materialise(wide.select("doc_id")), "doc_id", "left_semi").join(wide, "doc_id")
    # a repeated doc_id brings all its texts, each once
    texts = texts.select(F.col("doc_id").alias("rep"), "label", F.sha2("text", 256).alias("key"), "text").dropDuplicates(["rep", "key"])
    return _exact_pairs(materialise(texts.drop("key")))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels(node, label) after the links (a, b) between nodes, which may be new, have joined classes."""
    lifted = links
    for side in ("a", "b"):
        lifted = lifted.join(labels.withColumnRenamed("node", side), side, "left").withColumn(side, F.coalesce("label", side)).drop("label")
    merged = components(lifted.select("a", "b")).select(F.col("node").alias("label"), F.col("label").alias("final"))
    named = labels.join(merged, "label", "left").select("node", F.coalesce("final", "label").alias("label"))
    more = merged.join(labels.select(F.col("node").alias("label")), "label", "left_anti").select(F.col("label").alias("node"), F.col("final").alias("label"))
    return materialise(named.unionByName(more))


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """doc_id and class_id for each row of docs(doc_id, text)."""
    sketches = materialise(_sketch(docs))
    # equal texts have equal sketches, so each task combines its own copies before anything is shuffled
    groups = materialise(sketches.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.first("bands").alias("bands"), F.first("codes").alias("codes")))
    owners = materialise(_meet(sketches.select("doc_id", "digest"), groups.select("digest", "rep", "n"), "digest").select("doc_id", "rep"))
    members = owners.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("rep2"))
    # a doc_id that is the least of several texts keeps a sketch of each, so that links of any of them are its links
    unique = groups.select(F.col("rep").alias("doc_id"), "bands", "codes")
    in_bucket = unique.select(F.col("doc_id").alias("rep"), F.explode("bands").alias("bucket")).distinct()
    shared = in_bucket.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    # a text's weight is the number of neighbours it meets over its at most BANDS buckets
    buckets = materialise(in_bucket.join(shared, "bucket").withColumn("weight", F.sum("n").over(Window.partitionBy("rep"))))
    hubs = buckets.groupBy("bucket").agg(F.max_by("rep", F.struct(F.col("weight"), -F.col("rep"))).alias("hub"))
    stars = buckets.join(hubs, "bucket").filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL")
    first = materialise(_verify(_agree(stars, unique), texts))
    same_id = members.filter("rep <> rep2").select("doc_id", F.col("rep").alias("a")).join(owners.withColumnRenamed("rep", "b"), "doc_id").select("a", "b")
    labels = materialise(components(first.unionByName(same_id)))
    tag = lambda rows: rows.drop("label").join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    large = buckets.filter(F.col("n") > SMALL)
    seed = 0
    while True:
        tagged = materialise(tag(large))
        main = materialise(_main_classes(tagged))
        wide = main.filter(F.col("rest") > SMALL)
        large = tagged.join(wide.select("bucket"), "bucket", "left_semi")
        classes = large.select("label").distinct().count()
        if classes == 0:
            break
        found = materialise(_verify(_agree(_hub_pairs(tagged, wide, seed), unique), texts))
        labels = _merged(labels, found)
        seed += 1
        if classes - tag(large).select("label").distinct().count() < GOOD_SHARE * classes:
            break
    tagged = materialise(tag(buckets))
    main = materialise(_main_classes(tagged))
    rest = _agree(_cross_pairs(tagged).unionByName(_large_pairs(tagged, main)).distinct(), unique)
    if not main.filter(F.col("rest") > SMALL).isEmpty():
        rest = rest.unionByName(_wide_pairs(tagged, main, texts)).distinct()
    named = _merged(labels, materialise(_verify(rest, texts)))
    classes = members.join(named.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("label", "rep").alias("class_id"))
    # rows of a repeated doc_id meet one class row; those of a null one have none to meet
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    told = ids.filter("doc_id IS NOT NULL").join(classes, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    return told.unionByName(ids.filter("doc_id IS NULL").withColumn("class_id", F.lit(None).cast("long")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the least doc_id, with all columns; rows with null doc_id all stay.

    Of several rows with that doc_id the one whose columns, written as JSON, have the least SHA-256 stays.
    """
    classes = materialise(near_duplicate_classes(docs))
    gone = materialise(classes.filter("doc_id <> class_id").select("doc_id").distinct())
    kept = filter_by_ids(docs, gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = classes.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = kept.join(repeated, "doc_id", "left_semi").groupBy(F.col("doc_id").alias("__id")).agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias("__row")).select("__row.*")
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"))
