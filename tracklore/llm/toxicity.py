"""Toxicity: a word classifier regularised by counterfactuals.

A text is the set of its words (A-Z lower-cased, split at anything but letters, digits and apostrophes) and of their
beginnings of 4 to 6 bytes, which stand for inflected and compound forms not seen in training. Training picks terms
 whose link with the label is beyond chance, and fits a logistic model whose loss adds, for each labelled
sentence that names a group of people, the squared change of its score when the group term is swapped for another of its
family: the words and beginnings that leave the sentence and those that come in. Group terms and their beginnings are
always candidates, so that the penalty, not their absence, keeps their weights alike: a neutral mention must not raise
a score.

Training reads a bounded sample of labelled rows (``max_rows``, smallest hash of the id first); their distinct words are
counted by Spark, and at most ``max_words`` terms that ``least`` sampled texts hold, and whose share among toxic texts is
``z`` standard errors off, become weights beside the group terms. Every text is scored whole where it lies.

Defined cases: as in the quality classifier (null and empty texts have no words and score the base rate; unusable labels
are left out; of several texts under one labelled doc_id the one with the least SHA-256 is learnt; one class or no label
gives the smoothed share; repeated rows score alike; very long texts are read whole; extra columns are not read).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklore.llm.common import fold, map_chunks, materialise, table
from tracklore.llm.quality import labelled_sample, labelled_texts

# Families of group terms that may stand for one another.
FAMILIES = (
    ("he", "she", "they"),
    ("him", "her", "them"),
    ("his", "hers", "theirs"),
    ("man", "woman", "person"),
    ("men", "women", "people"),
    ("boy", "girl", "child"),
    ("boys", "girls", "children"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("blacks", "whites", "asians", "latinos", "arabs", "africans", "europeans"),
    ("gay", "lesbian", "straight", "bisexual", "trans", "queer"),
    ("gays", "lesbians", "straights", "bisexuals", "queers"),
    ("old", "young", "elderly", "teenage"),
    ("deaf", "blind", "disabled", "autistic"),
    ("immigrant", "refugee", "native", "foreign"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("el", "ella"),
    ("il", "elle"),
    ("er", "sie"),
)
FAMILY_OF = {w.encode(): [v.encode() for v in family if v != w] for family in FAMILIES for w in family}

#: Byte to byte: letters, digits, apostrophe and non-ASCII bytes stay, all others become a space.
TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() or b == 0x27 else 0x20 for b in range(256))


#: Stands for all texts in the word counts.
ALL = b" "
#: Lengths in bytes of the beginnings of longer words that count as terms of their own, marked by a star.
BEGINNINGS = (4, 5, 6)


def words_of(text: str | None) -> set[bytes]:
    return set((text or "").encode().lower().translate(TERM_BYTES).split())


def with_beginnings(words: set[bytes]) -> set[bytes]:
    found = set(words)
    for n in BEGINNINGS:
        found |= {w[:n] + b"*" for w in words if len(w) > n}
    return found


def terms(text: str | None) -> set[bytes]:
    return with_beginnings(words_of(text))


def swap_changes(text: str | None, index: dict[bytes, int]) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """For each group term of the text and each other term of its family: the places of the terms that leave the text and of
    those that come in when every mention of the one becomes the other."""
    words = words_of(text)
    named = words & FAMILY_OF.keys()
    if not named:
        return []
    now = with_beginnings(words)
    out = []
    for w in sorted(named):
        rest = words - {w}
        for other in FAMILY_OF[w]:
            then = with_beginnings(rest | {other})
            out.append((tuple(sorted(index[t] for t in (now - then) & index.keys())), tuple(sorted(index[t] for t in (then - now) & index.keys()))))
    return out


@dataclass
class WordModel:
    base: float
    weights: dict[bytes, float]

    def score(self, texts: list[str | None]) -> np.ndarray:
        known = self.weights.keys()
        return 1 / (1 + np.exp(-np.array([np.clip(self.base + sum(self.weights[w] for w in known & terms(t)), -30, 30) for t in texts], np.float64)))


def choose(df: np.ndarray, pos: np.ndarray, n: int, n_pos: int, least: int, z: float, max_words: int) -> np.ndarray:
    """Positions of words whose share among label-1 texts is over z standard errors off the rest."""
    rate = df / n
    expected = n_pos * rate
    spread = np.sqrt(np.maximum(n_pos * rate * (1 - rate) * (1 - n_pos / n), 1e-9))
    score = np.abs(pos - expected) / spread
    order = np.argsort(-score, kind="stable")
    return order[(score[order] > z) & (df[order] >= least)][:max_words]


def fit(x: np.ndarray, y: np.ndarray, changes: np.ndarray, swap_weight: float, ridge: float, steps: int = 60) -> tuple[float, np.ndarray]:
    """Newton steps on the logistic loss + ridge + swap_weight * mean squared score change. changes: a row per swap."""
    n, d = x.shape
    w = np.zeros(d + 1)
    w[0] = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    prior = np.diag(np.r_[1e-6, np.full(d, ridge)])
    if len(changes):
        c = np.column_stack([np.zeros(len(changes)), changes])
        prior = prior + swap_weight * n / len(changes) * (c.T @ c)
    for _ in range(steps):
        curve, slope = prior + 1e-9 * np.eye(d + 1), -prior @ w
        for at in range(0, n, 1000):  # a few rows at a time in double precision
            a = np.column_stack([np.ones(min(1000, n - at)), x[at : at + 1000]])
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            curve += a.T @ (a * (p * (1 - p))[:, None])
            slope += a.T @ (y[at : at + 1000] - p)
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), w[1:]


def train(docs: DataFrame, labels: DataFrame, target: str = "toxic", keep=None, max_rows: int = 20_000, max_words: int = 600, least: int = 4, z: float = 5.0, swap_weight: float = 1.0, ridge: float = 0.5) -> WordModel:
    """Fit on at most max_rows labelled documents.

    Word counts are summed by Spark; the driver gets the counts of words that at least ``least`` sampled texts hold,
    then, per sampled text, the chosen words and the group terms only, and the number of each distinct change by a swap.
    """
    keep = F.lit(True) if keep is None else keep
    sample = labelled_texts(docs, labelled_sample(labels, target, keep, max_rows))
    # one text an id: at most max_rows are learnt from, and shuffled
    sample = materialise(sample.groupBy("doc_id").agg(F.min("y").alias("y"), F.min_by("text", F.sha2("text", 256)).alias("text")))

    def split(batch: pa.RecordBatch):
        ys = batch.column("y").to_pylist()
        counts: dict[bytes, list[int]] = {}
        for y, t in zip(ys, batch.column("text").to_pylist(), strict=True):
            for w in terms(t):
                c = counts.setdefault(w, [0, 0])
                c[0] += 1
                c[1] += y
        counts[ALL] = [len(ys), sum(ys)]
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array([v[0] for v in counts.values()], pa.int64()), pa.array([v[1] for v in counts.values()], pa.int64())], names=["word", "df", "pos"])

    counted = map_chunks(sample, split, "word binary, df long, pos long").groupBy("word").agg(F.sum("df").alias("df"), F.sum("pos").alias("pos"))
    # the sample is bounded, and a word must be far from its expected share to be sent
    counted = materialise(counted.filter((F.col("df") >= least) | (F.col("word") == F.lit(ALL))))
    totals = counted.filter(F.col("word") == F.lit(ALL)).first()
    n, n_pos = (totals["df"], totals["pos"]) if totals else (0, 0)
    base = float(np.log((n_pos + 0.5) / (n - n_pos + 0.5)))
    expected = F.col("df") * (n_pos / max(n, 1))
    far = F.abs(F.col("pos") - expected) > z * F.sqrt(F.greatest(expected * (1 - n_pos / max(n, 1)) * (1 - F.col("df") / max(n, 1)), F.lit(1e-9)))
    rows = sorted((bytes(r["word"]), r["df"], r["pos"]) for r in counted.filter(far & (F.col("word") != F.lit(ALL))).collect())
    if n_pos in (0, n) or not rows:
        return WordModel(base, {})
    chosen = [rows[i][0] for i in choose(np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], float), n, n_pos, least, z, max_words)]
    vocabulary = sorted(set(chosen) | with_beginnings(set(FAMILY_OF)))
    index = {w: i for i, w in enumerate(vocabulary)}

    def present(batch: pa.RecordBatch):
        texts = batch.column("text").to_pylist()
        hits = [sorted(index[w] for w in index.keys() & terms(t)) for t in texts]
        swaps = [[{"gone": g, "come": c} for g, c in swap_changes(t, index)] for t in texts]
        places = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(hits, places), pa.array(swaps, pa.list_(pa.struct([("gone", places), ("come", places)])))], names=["doc_id", "y", "hits", "swaps"])

    # equal swaps of one text and another are counted by Spark
    seen = materialise(map_chunks(sample, present, "doc_id long, y int, hits array<int>, swaps array<struct<gone:array<int>,come:array<int>>>"))
    got = sorted(seen.select("doc_id", "y", "hits").collect(), key=lambda r: (r["doc_id"], r["hits"]))
    x = np.zeros((len(got), len(vocabulary)), np.uint8)
    for i, r in enumerate(got):
        x[i, r["hits"]] = 1
    counted = seen.select(F.explode("swaps").alias("s")).groupBy("s.gone", "s.come").count().collect()
    changes = {(tuple(r["gone"]), tuple(r["come"])): r["count"] for r in counted}
    # equal swaps add up: one row per distinct change, scaled by the root of its share
    swaps = np.zeros((len(changes), len(vocabulary)))
    for row, ((gone, come), times) in zip(swaps, sorted(changes.items()), strict=True):
        row[list(gone)] = -1
        row[list(come)] = 1
        row *= np.sqrt(times / sum(changes.values()) * len(changes))
    b, w = fit(x, np.array([r["y"] for r in got], float), swaps, swap_weight, ridge)
    return WordModel(b, {v: float(w[i]) for v, i in index.items() if abs(w[i]) > 1e-6})


def score_texts(docs: DataFrame, model: WordModel) -> DataFrame:
    """doc_id and score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(shared.value.score(batch.column("text").to_pylist()), pa.float64())], names=["doc_id", "score"])

    return map_chunks(docs.select("doc_id", "text"), work, "doc_id long, score double")


#: Rows of this fold are held out from training.
HELD_OUT = (3, 1)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), keep=fold(F.col("doc_id"), HELD_OUT[0]) != HELD_OUT[1])
    return score_texts(docs, model).select("doc_id", (fold(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
