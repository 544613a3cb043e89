"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a short vector of shape figures. Every figure is cut into bins, and cyclic boosting adds a shallow
tree to one figure's lookup table at a time; afterwards the strongest pairs of figures get two-way tables boosted in
the same way. A score is the sum of one bin value per figure and pair, through the logistic function.

Training reads a bounded sample of labelled rows (``max_rows``, those with the smallest hash of their id), since the
tables hold a few thousand values only; every text is scored whole, where it lies, without a shuffle.

Defined cases: null and empty texts have the figures of an empty text and get a score; labels that are null, name no
document or are not 0 or 1 are left out; of several labels for a document the largest counts, and of several texts under one
labelled doc_id the one with the least figures is learnt; with no usable label, or one class only, the score is the
smoothed share of label 1. Repeated rows are scored alike; null doc_id rows are scored, and never trained on. Very long
texts are read whole. Extra columns are not read by ``score_texts`` and are kept by ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklore.llm.common import fold, map_chunks, table

FIGURES = (
    "log_chars", "log_words", "word_length", "upper", "digit", "space", "newline", "stop", "comma", "bang", "pipe", "symbol",
    "other_mark", "high_byte", "distinct_words", "top_word", "distinct_lines", "line_length", "longest_word", "quote",
)


def _mask(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


#: Columns: byte classes whose share of the text is a figure.
CLASSES = np.stack(
    [_mask(bytes(range(65, 91))), _mask(b"0123456789"), _mask(b" \t"), _mask(b"\n"), _mask(b"."), _mask(b","), _mask(b"!?"), _mask(b"|"), _mask(b"*$#%&=<>{}[]\\^~_@"), _mask(b"-:;/+()"), _mask(bytes(range(128, 256))), _mask(b"\"'")],
    axis=1,
)


def figures(text: str | None) -> list[float]:
    """The figures of one text, in the order of FIGURES."""
    raw = (text or "").encode()
    n = len(raw)
    words = raw.split()
    lines = raw.split(b"\n")
    share = (np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ CLASSES) / max(n, 1)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    k = max(len(words), 1)
    upper, digit, space, newline, stop, comma, bang, pipe, symbol, mark, high, quote = share.tolist()
    return [
        np.log1p(n), np.log1p(len(words)), (n - len(lines)) / k, upper, digit, space, newline, stop, comma, bang, pipe, symbol, mark, high,
        len(counts) / k, max(counts.values(), default=0) / k, len(set(lines)) / len(lines), np.log1p(n / len(lines)), np.log1p(max(map(len, words), default=0)), quote,
    ]


def figure_matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([figures(t) for t in texts], np.float64).reshape(len(texts), len(FIGURES))


@dataclass
class AdditiveModel:
    """Bin edges, one table per figure and one per chosen pair."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1) if self.edges else np.zeros((len(x), 0), int)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        b = self.bins(x)
        for j, t in enumerate(self.tables):
            total += t[b[:, j]]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[_coarse(b[:, i], self.edges[i]), _coarse(b[:, j], self.edges[j])]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


#: Cells of a pair's table along each figure.
COARSE = 6


def _coarse(b: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return b * COARSE // (len(edges) + 1)


def _leaf(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, float]:
    return g.sum() / (h.sum() + penalty), g.sum() ** 2 / (h.sum() + penalty)


def _tree(g: np.ndarray, h: np.ndarray, depth: int, penalty: float, least: float) -> np.ndarray:
    """Values per bin of a tree of that depth, fitted to gradient and curvature sums per bin."""
    value, gain = _leaf(g, h, penalty)
    out = np.full(len(g), value)
    if depth == 0 or len(g) < 2:
        return out
    lg, lh = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    rg, rh = g.sum() - lg, h.sum() - lh
    split = np.where((lh >= least) & (rh >= least), lg**2 / (lh + penalty) + rg**2 / (rh + penalty), -np.inf)
    k = int(np.argmax(split))
    if split[k] > gain + 1e-9:
        out = np.concatenate([_tree(g[: k + 1], h[: k + 1], depth - 1, penalty, least), _tree(g[k + 1 :], h[k + 1 :], depth - 1, penalty, least)])
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, pair_rounds: int = 20, n_pairs: int = 6, n_bins: int = 24, rate: float = 0.15, penalty: float = 2.0) -> AdditiveModel:
    """Boost the tables. x: a row per text; y: 0 or 1."""
    model = AdditiveModel(base=float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))) if len(y) else 0.0)
    if not len(y) or y.min() == y.max():
        return model
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, n_bins + 1)[1:-1])) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    b = model.bins(x)
    total = np.full(len(y), model.base)
    for _ in range(rounds):
        for j, t in enumerate(model.tables):
            p = 1 / (1 + np.exp(-total))
            g, h = (np.bincount(b[:, j], v, len(t)) for v in (y - p, p * (1 - p)))
            step = rate * _tree(g, h, 2, penalty, 0.5)
            t += step
            total += step[b[:, j]]
    p = 1 / (1 + np.exp(-total))
    cells = np.stack([_coarse(b[:, j], e) for j, e in enumerate(model.edges)], axis=1)
    ranked = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            g, h = (np.bincount(cells[:, i] * COARSE + cells[:, j], v, COARSE * COARSE) for v in (y - p, p * (1 - p)))
            ranked.append((-(g**2 / (h + penalty)).sum(), i, j))
    model.pairs = [(i, j) for _, i, j in sorted(ranked)[:n_pairs]]
    model.pair_tables = [np.zeros((COARSE, COARSE)) for _ in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
            p = 1 / (1 + np.exp(-total))
            cell = cells[:, i] * COARSE + cells[:, j]
            g, h = (np.bincount(cell, v, COARSE * COARSE) for v in (y - p, p * (1 - p)))
            step = (rate * _pair_tree(g.reshape(COARSE, COARSE), h.reshape(COARSE, COARSE), penalty)).ravel()
            t += step.reshape(COARSE, COARSE)
            total += step[cell]
    return model


def _pair_tree(g: np.ndarray, h: np.ndarray, penalty: float) -> np.ndarray:
    """A tree that cuts one figure, then the other on either side: four leaves at most."""
    best, out = -np.inf, np.zeros_like(g)
    for turned in (False, True):
        a, c = (g.T, h.T) if turned else (g, h)
        for k in range(1, COARSE):
            value = np.empty_like(a)
            gain = 0.0
            for rows in (slice(None, k), slice(k, None)):
                column = _tree(a[rows].sum(0), c[rows].sum(0), 1, penalty, 0.5)
                value[rows] = column
                gain += (2 * column * a[rows].sum(0) - column**2 * (c[rows].sum(0) + penalty / COARSE)).sum()
            if gain > best:
                best, out = gain, value.T if turned else value
    return out


def labelled_sample(labels: DataFrame, target: str, keep, max_rows: int) -> DataFrame:
    """At most max_rows labelled ids (smallest hash first), one row each."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("y")).filter("doc_id IS NOT NULL AND y IN (0, 1)").filter(keep)
    return usable.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)


def labelled_texts(docs: DataFrame, sample: DataFrame, columns: str = "text") -> DataFrame:
    """The sampled documents with their label; the sample's size is bounded, so it may be broadcast."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), columns).join(F.broadcast(sample), "doc_id")


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", keep=None, max_rows: int = 20_000) -> AdditiveModel:
    """Fit on at most max_rows labelled documents. Their figures (20 numbers a row) come to the driver, never texts."""
    keep = F.lit(True) if keep is None else keep

    def work(batch: pa.RecordBatch):
        x = figure_matrix(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    found = map_chunks(labelled_texts(docs, labelled_sample(labels, target, keep, max_rows)), work, "doc_id long, y int, x array<double>")
    # one row an id, so that at most max_rows come here
    rows = found.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FIGURES))
    return fit(x, np.array([r["y"] for r in rows], np.float64))


def score_texts(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id and score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(shared.value.score(figure_matrix(batch.column("text").to_pylist())), pa.float64())], names=["doc_id", "score"])

    return map_chunks(docs.select("doc_id", "text"), work, "doc_id long, score double")


def keep_good(docs: DataFrame, model: AdditiveModel, threshold: float = 0.3) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns; one pass, no join."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch):
        yield batch.filter(pa.array(shared.value.score(figure_matrix(batch.column("text").to_pylist())) >= threshold, pa.bool_()))

    return map_chunks(docs, work, docs.schema)


#: Rows of this fold are held out from training.
HELD_OUT = (5, 0)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), keep=fold(F.col("doc_id"), HELD_OUT[0]) != HELD_OUT[1])
    return score_texts(docs, model).select("doc_id", (fold(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
