"""Language-model scoring: a log-bilinear neural model, trained in numpy by noise-contrastive estimation.

Tokens are runs of non-space characters, A-Z lower-cased, and an end token per text. Symbols are the words with a count of
at least ``least_count`` (which rises with the root of the corpus, so symbols, and the model, grow with it), the end, and
classes of all other words by their last bytes. Symbols are dealt into groups, about as many as a group has members. The two
symbols before a token each add a vector; the sum is matched with a vector and bias of every group, and with those of every
member of the token's group, and both are made probabilities by batched matrix products over groups and over members. A
word of a class then has the add-one share of its class, one share being kept for unseen words, so the probabilities of
all tokens sum to one.

Training: word counts over every training text are summed by Spark. Training texts are encoded once and dealt by hash into shards
of about ``SHARD`` tokens. In each of ``ROUNDS`` rounds every shard learns from the common parameters, over all of its tokens
in order of hash, by noise-contrastive estimation of the group and of the member in its group; the parameters are then
averaged, weighted by tokens. Shards, their order and their random numbers depend on the rows alone, so scores do not
depend on how the input is split (but for the rounding of sums).

Defined cases: null and empty texts are one end token; repeated rows are counted and scored each; null ids are in the fold of the empty
text; without training tokens every count is 0. Extra columns are not read.

Scale: two passes over the texts, one over the encoded shards for each round and one to score them. Counts of the ``HEAD`` commonest words, or
of all symbols where these are more, are broadcast with the parameters (``4 * WIDTH`` bytes a symbol); rarer words, about one
token in ten, meet their counts in a shuffle join by word, summed per text first.
"""

from __future__ import annotations

import collections
import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklore.llm.common import fold, map_chunks, materialise, table

CLASSES = 128
DIM = 16
#: Numbers of a symbol: its vectors as last, second last and predicted one, and its bias.
WIDTH = 3 * DIM + 1
HEAD = 100_000
#: Noise groups of a batch, and noise members of each group in it.
NOISE = 16
BATCH = 16_384
#: Rows of a block of one group's tokens in a batch.
HEIGHT = 32
#: Tokens times groups of a tile that is scored at once.
TILE = 32_000_000
#: Rows of scores made at once, so few that they stay in a core's cache.
ROWS = 512
#: Bytes of an array that is freed once, so that the C library keeps freed arrays of up to this size for the next ones.
KEPT = 31 << 20
ROUNDS = 3
SHARD = 2_000_000
HELD_OUT = (7, 2)
#: Columns of an encoded text.
ENCODED = {"places": "binary", "n_tokens": "long", "n_head": "long", "base_head": "double", "in_classes": "double", "tail": "array<struct<word:binary,n:long>>"}
#: Distinct words that a task counts before it hands them on.
FLUSH = 250_000


def least_count(total: int) -> int:
    """Count that makes a word a symbol, in a corpus of so many words."""
    return max(8, math.ceil(math.sqrt(total) / 32))


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def count_words(docs: DataFrame) -> DataFrame:
    """word, class, n over all texts of docs; counted in each task first, at most FLUSH words at a time."""

    def run(batches):
        counts: collections.Counter[bytes] = collections.Counter()

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()

        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(tokens(text))
                if len(counts) > FLUSH:
                    yield from out()
        if counts:
            yield from out()

    counted = docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.select("word", (F.crc32(F.substring("word", -3, 3)) % CLASSES).cast("int").alias("class"), "n")


class Groups:
    """Symbols dealt into groups of about equal count, words in order of spelling. A symbol's place is its rank by group."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        n = len(counts)
        by_word = np.array([*sorted(range(len(words)), key=words.__getitem__), *range(len(words), n)])
        reach = (np.cumsum(counts[by_word]) - counts[by_word] / 2) / counts.sum()
        group = np.minimum((reach * max(1, round(math.sqrt(n)))).astype(np.int64), n - 1)
        self.of_place = np.unique(group, return_inverse=True)[1]
        self.n = int(self.of_place[-1]) + 1
        self.starts = np.searchsorted(self.of_place, np.arange(self.n + 1))
        self.place = np.empty(n, np.int32)
        self.place[by_word] = np.arange(n)
        share = counts[by_word] / counts.sum()
        self.share = np.add.reduceat(share, self.starts[:-1])
        #: share of each place in its group
        self.inside = share / self.share[self.of_place]


class Parameters:
    """near, far: vectors of the last and second last symbol, by place, and the start; member, bias: of the predicted place;
    group, group_bias: of its group."""

    NAMES = ("near", "far", "member", "bias", "group", "group_bias")

    def __init__(self, groups: Groups, seed: int = 11):
        rng, n = np.random.default_rng(seed), len(groups.place)
        draw = lambda rows: rng.normal(0, 0.1, (rows, DIM)).astype(np.float32)
        self.near, self.far, self.member, self.group = draw(n + 1), draw(n + 1), draw(n), draw(groups.n)
        self.bias, self.group_bias = np.log(groups.inside).astype(np.float32), np.log(groups.share).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, x).ravel() for x in self.NAMES])

    def fill(self, flat: np.ndarray) -> int:
        """Take the parameters from the first numbers of flat, and say how many those were."""
        at = 0
        for x in self.NAMES:
            old = getattr(self, x)
            setattr(self, x, np.array(flat[at : at + old.size].reshape(old.shape), np.float32))
            at += old.size
        return at

    def log_probabilities(self, groups: Groups, near: np.ndarray, far: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each target, all given by place."""
        out = np.empty(len(target), np.float64)
        tile = max(1024, TILE // max(groups.n, 1))
        member, group = np.c_[self.member, self.bias], np.c_[self.group, self.group_bias]
        lengths = np.sqrt(np.einsum("ij,ij->i", member, member))
        for at in range(0, len(target), tile):
            # each context, and each target after it, is worked out once in a tile, so equal ones have equal results
            starts = len(self.near)
            pair, of_pair = np.unique(near[at : at + tile].astype(np.int64) * starts + far[at : at + tile], return_inverse=True)
            both, of_both = np.unique(target[at : at + tile].astype(np.int64) * len(pair) + of_pair, return_inverse=True)
            t, x = both // len(pair), both % len(pair)
            a, b = pair // starts, pair % starts
            context = np.ones((len(pair), DIM + 1), np.float32)
            np.add(self.near.take(a, axis=0), self.far.take(b, axis=0), out=context[:, :DIM])
            totals, context = self._log_totals(group, a, b), context.take(x, axis=0)
            log_p = np.einsum("ij,ij->i", context, group.take(groups.of_place.take(t), axis=0), dtype=np.float64) - totals.take(x)
            reach = np.sqrt(np.einsum("ij,ij->i", context, context))
            ends = np.searchsorted(t, groups.starts)
            for k in np.flatnonzero(np.diff(ends)):
                members = slice(groups.starts[k], groups.starts[k + 1])
                for r in range(ends[k], ends[k + 1], ROWS):
                    rows = slice(r, min(r + ROWS, ends[k + 1]))
                    most = reach[rows].max() * lengths[members].max()
                    log_p[rows] += _log_softmax_at(_product(context[rows], member[members].T), t[rows] - members.start, most)
            out[at : at + tile] = log_p.take(of_both)
        return out

    def _log_totals(self, group: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Natural log of the sum over groups of exp(score), for different pairs of symbols. A score is a sum of what the two add,
        so its exp is a product: it is taken once for each different symbol, and each pair is one sum of products."""
        (a, x), (b, y) = (_numbered(at, len(self.near)) for at in (near, far))
        first, second = _product(self.near[a], group[:, :DIM].T), _product(self.far[b], group[:, :DIM].T) + group[:, DIM]
        tops = first.max(1), second.max(1)
        for scores, top in zip((first, second), tops, strict=True):
            scores -= top[:, None]
            np.exp(scores, out=scores)
        total = np.concatenate([np.einsum("ij,ij->i", first.take(x[r : r + ROWS], axis=0), second.take(y[r : r + ROWS], axis=0)) for r in range(0, len(x), ROWS)]).astype(np.float64)
        # two symbols that favour different groups, so that the product is too small for a float: from the scores themselves
        low = np.flatnonzero(total < 1e-25)
        total = np.log(np.maximum(total, 1e-25)) + tops[0].take(x) + tops[1].take(y)
        if len(low):
            scores = (self.near[near[low]] + self.far[far[low]]).astype(np.float64) @ group[:, :DIM].T + group[:, DIM]
            total[low] = np.logaddexp.reduce(scores, axis=1)
        return total


def _log_softmax_at(scores: np.ndarray, at: np.ndarray, most: float) -> np.ndarray:
    """most: a bound of the scores' size; up to 80 their exponentials add up as they are."""
    picked = scores[np.arange(len(at)), at].astype(np.float64)
    top = 0
    if not most <= 80:
        top = scores.max(1)
        scores -= top[:, None]
    np.exp(scores, out=scores)
    return picked - np.log((scores @ np.ones(scores.shape[1], np.float32)).astype(np.float64)) - top


#: Multiplications of one matrix product: so small that the library does not start threads beside Spark's tasks.
SMALL = 200_000


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b, a batch of small products over slices of the rows of a."""
    rows = max(1, SMALL // b.size)
    whole = len(a) // rows * rows
    out = np.empty((len(a), b.shape[1]), np.float32)
    np.matmul(a[:whole].reshape(-1, rows, a.shape[1]), b, out=out[:whole].reshape(-1, rows, b.shape[1]))
    np.matmul(a[whole:], b, out=out[whole:])
    return out


def _keep_memory() -> None:
    """Batches make and free the same arrays again and again; the system would take each back and clear it anew."""
    np.empty(KEPT, np.uint8)


def _sigmoid_of_twice(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-2 * x)), in place."""
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def _step(into: np.ndarray, squares: np.ndarray, rows: np.ndarray, summed: np.ndarray, rate: float) -> None:
    """Adagrad step of some rows, with one scale a row."""
    now = squares.take(rows, axis=0) + np.einsum("ij,ij->i", summed, summed)[:, None] / np.float32(summed.shape[1])
    squares[rows] = now
    into[rows] = into.take(rows, axis=0) + summed * (np.float32(rate) / np.sqrt(now + np.float32(1e-6)))


def _numbered(at: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers of at, all less than below, ascending, and the rank of each of at among them."""
    there = np.zeros(below, bool)
    there[at] = True
    rows = np.flatnonzero(there)
    number = np.empty(below, np.int64)
    number[rows] = np.arange(len(rows))
    return rows, number.take(at)


def _sum_by(at: np.ndarray, values: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers of at, and for each the sum of its rows of values, whose even number of floats is added two by two."""
    rows, number = _numbered(at, below)
    pairs = values.view(np.complex64)
    out = np.zeros(len(rows) * pairs.shape[1], np.complex64)
    np.add.at(out, ((number * pairs.shape[1])[:, None] + np.arange(pairs.shape[1])).ravel(), pairs.ravel())
    return rows, out.view(np.float32).reshape(-1, values.shape[1])


class Trainer:
    """Noise-contrastive estimation; noise is drawn from the shares of groups, and of members in their group, once a batch."""

    def __init__(self, groups: Groups, seed: int = 5, rate: float = 0.1, bias_rate: float = 0.02):
        self.p, self.groups, self.rate, self.bias_rate = Parameters(groups), groups, rate, bias_rate
        self.rng = np.random.default_rng(seed)
        self.squares = {x: np.zeros((len(getattr(self.p, x)), 1), np.float32) for x in Parameters.NAMES}
        self.log_group, self.log_inside = (np.log(NOISE * x).astype(np.float32) for x in (groups.share, groups.inside))
        self.bounds = np.cumsum(groups.share), np.cumsum(groups.inside)
        self.seen = 0

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p.flat(), *(self.squares[x].ravel() for x in Parameters.NAMES)])

    def fill(self, flat: np.ndarray) -> None:
        at = self.p.fill(flat)
        for x, old in self.squares.items():
            self.squares[x] = np.array(flat[at : at + old.size].reshape(old.shape), np.float32)
            at += old.size

    def step(self, near: np.ndarray, far: np.ndarray, target: np.ndarray) -> None:
        """One batch, all given by place."""
        p, groups, n, squares = self.p, self.groups, len(target), self.squares
        symbols = len(groups.place)
        order = np.argsort(target.astype(np.uint16) if symbols <= 65_536 else target, kind="stable")
        near, far, target = near[order], far[order], target[order]
        ends = np.searchsorted(target, groups.starts)
        noise = np.minimum(np.searchsorted(self.bounds[0], self.rng.random(NOISE)), groups.n - 1)
        draws = self.rng.random((groups.n, NOISE)) + np.arange(groups.n)[:, None]
        noises = np.minimum(np.searchsorted(self.bounds[1], draws), groups.starts[1:, None] - 1)
        # a row has its context and a one for the bias; the last row, of zeros, fills blocks up and adds nothing
        context = np.ones((n + 1, DIM + 1), np.float32)
        np.add(p.near.take(near, axis=0), p.far.take(far, axis=0), out=context[:n, :DIM])
        context[n] = 0
        # the rows of a group in blocks of one height, so that all groups are one batch of products
        counts = np.diff(ends)
        blocks = -(-counts // HEIGHT)
        offset = np.cumsum(blocks) - blocks
        of_block = np.repeat(np.arange(groups.n), blocks)
        place = np.arange(n) + np.repeat(offset * HEIGHT - ends[:-1], counts)
        row_at = np.full(len(of_block) * HEIGHT, n)
        row_at[place] = np.arange(n)
        x = context.take(row_at, axis=0).reshape(-1, HEIGHT, DIM + 1)
        # a group is matched with noise members, noise groups and itself, in this order
        against = np.empty((groups.n, DIM + 1, 2 * NOISE + 1), np.float32)
        against[:, :DIM, :NOISE], against[:, DIM, :NOISE] = p.member[noises].transpose(0, 2, 1), (p.bias - self.log_inside)[noises]
        against[:, :DIM, NOISE:-1], against[:, DIM, NOISE:-1] = p.group[noise].T, (p.group_bias - self.log_group)[noise]
        against[:, :DIM, -1], against[:, DIM, -1] = p.group, p.group_bias - self.log_group
        vectors = np.ascontiguousarray(against[:, :DIM].transpose(0, 2, 1))
        against *= 0.5
        # what is too much: all of the noise, and of the group what is missing to one
        over = _sigmoid_of_twice(np.matmul(x, against.take(of_block, axis=0)))
        over[:, :, -1] -= 1
        back = np.matmul(over, vectors.take(of_block, axis=0)).reshape(-1, DIM).take(place, axis=0)
        parts = np.matmul(x.transpose(0, 2, 1), over)
        pulls = np.zeros((groups.n, DIM + 1, 2 * NOISE + 1), np.float32)
        for k in range(blocks.max()):
            more = np.flatnonzero(blocks > k)
            pulls[more] -= parts.take(offset[more] + k, axis=0)
        pulls = np.ascontiguousarray(pulls.transpose(0, 2, 1))
        # the member itself
        context = context[:n]
        own = p.member.take(target, axis=0)
        missing = 1 - _sigmoid_of_twice((np.einsum("ij,ij->i", context[:, :DIM], own) + (p.bias - self.log_inside).take(target)) / 2)
        own *= missing[:, None]
        back = (own - back) / n
        for name, at in (("near", near), ("far", far)):
            into = getattr(p, name)
            _step(into, squares[name], *_sum_by(at, back, len(into)), self.rate)
        there = np.flatnonzero(counts)
        at = np.concatenate([target, noises[there].ravel()])
        pull = np.empty((len(at), DIM), np.float32)
        np.multiply(context[:, :DIM], missing[:, None], out=pull[:n])
        pull[n:] = pulls[there, :NOISE, :DIM].reshape(-1, DIM)
        lift = np.bincount(at, np.concatenate([missing, pulls[there, :NOISE, DIM].ravel()]), symbols)
        at, pull = _sum_by(at, pull, symbols)
        _step(p.member, squares["member"], at, pull / n, self.rate)
        _step(p.bias[:, None], squares["bias"], at, (lift.take(at) / n).astype(np.float32)[:, None], self.bias_rate)
        pull = pulls[:, -1]
        np.add.at(pull, noise, pulls[:, NOISE:-1].sum(0))
        pull = pull / n
        every = np.arange(groups.n)
        _step(p.group, squares["group"], every, pull[:, :DIM], self.rate)
        _step(p.group_bias[:, None], squares["group_bias"], every, pull[:, DIM:], self.bias_rate)
        self.seen += n


def contexts(places: np.ndarray, lengths: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the last symbol, of the second last and of the symbol itself, for the symbols of sequences laid end to end;
    each sequence is preceded by two starts."""
    near, far = np.empty_like(places), np.empty_like(places)
    near[1:], far[2:] = places[:-1], places[:-2]
    first = (np.cumsum(lengths) - lengths)[lengths > 0]
    near[first] = far[first] = start
    second = first[lengths[lengths > 0] > 1] + 1
    far[second] = start
    return near, far, places


class Vocabulary:
    """Counts of the commonest words, which of them are symbols, and per class the count of its tokens and words."""

    def __init__(self, head: list[tuple[bytes, int]], symbols: int, class_tokens: np.ndarray, class_words: np.ndarray, texts: int):
        self.index = {w: i for i, (w, _) in enumerate(head)}
        self.counts = np.array([n for _, n in head], np.int64)
        self.class_tokens, self.class_words, self.texts, self.words = class_tokens, class_words, texts, symbols
        self.total = int(self.counts[:symbols].sum() + class_tokens.sum()) + texts
        self.distinct = int(symbols + class_words.sum()) + (1 if texts else 0)
        counts = np.concatenate([self.counts[:symbols], [texts], class_tokens]).astype(np.float64) + 1
        self.groups = Groups([w for w, _ in head[:symbols]], counts)
        self.start = len(counts)
        #: of places as they are stored
        self.kind = np.uint16 if self.start <= 65_536 else np.int32
        #: class of each word of the head that is no symbol, else -1
        self.head_class = np.array([-1 if i < symbols else class_of(w) for i, (w, _) in enumerate(head)], np.int64)
        symbol = np.where(self.head_class < 0, np.arange(len(head)), symbols + 1 + self.head_class)
        self.place = self.groups.place[symbol] if len(head) else np.zeros(0, np.int32)
        self.end_place = int(self.groups.place[symbols])
        self.class_place = self.groups.place[symbols + 1 :]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """Index of each word in the head (-1: not there), the places with the end, and the words not there with their classes."""
        at = np.fromiter(map(self.index.get, words, itertools.repeat(-1)), np.int64, len(words))
        places = np.empty(len(words) + 1, np.int32)
        places[:-1] = self.place[at] if len(self.place) else 0
        places[-1] = self.end_place
        missing = np.flatnonzero(at < 0)
        rare = [words[i] for i in missing]
        classes = np.array([class_of(w) for w in rare], np.int64)
        places[missing] = self.class_place[classes] if rare else 0
        return at, places, rare, classes


def learn_vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    """The head is every symbol, and every word over a count that at most HEAD words pass, found from a histogram of counts, so
    that tasks send the driver no more than it keeps."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8)
    rows = counts.groupBy(step.alias("b")).agg(F.count("*").alias("k"), F.sum("n").alias("n")).collect()
    least = least_count(sum(r["n"] for r in rows))
    over, bound = 0, None
    for r in sorted(rows, reverse=True):
        if over + r["k"] > HEAD:
            break
        over, bound = over + r["k"], r["b"]
    kept = (F.col("n") >= least) | (step >= bound if bound is not None else F.lit(False))
    top = counts.select("word", "n").filter(kept).toArrow()
    head = sorted(zip(top.column("word").to_pylist(), top.column("n").to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))
    tokens_, words_ = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in counts.filter(F.col("n") < least).groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect():
        tokens_[r["class"]], words_[r["class"]] = r["n"], r["k"]
    return Vocabulary(head, sum(n >= least for _, n in head), tokens_, words_, texts)


def encode_shards(docs: DataFrame, learning, shared, shards: int) -> DataFrame:
    """Every text as its places and what does not depend on the model, written to the shared folder, each shard in one file and in
    order of hash. docs: doc_id, text, key. learnt: whether the row is learnt from."""

    def work(batch: pa.RecordBatch):
        v = shared.value
        log_count = np.log10(v.counts + 1)
        class_log = np.log10(v.class_tokens + v.class_words + 1)
        # share of a word in its class; symbols stand for themselves
        in_class = np.where(v.head_class >= 0, log_count - class_log[np.maximum(v.head_class, 0)], 0.0)
        base_end = math.log10(v.texts + 1)
        rows, tail_words, tail_counts, tail_ends = [], [], [], [0]
        for text in batch.column("text").to_pylist():
            words = tokens(text)
            at, places, rare, classes = v.encode(words)
            known = at[at >= 0] if rare else at
            score_head = float(in_class.take(known).sum() - class_log.take(classes).sum())
            tail = collections.Counter(rare)
            tail_words.extend(tail)
            tail_counts.extend(tail.values())
            tail_ends.append(len(tail_words))
            rows.append((places.astype(v.kind).tobytes(), len(words) + 1, len(known) + (1 if v.texts else 0), float(log_count.take(known).sum()) + base_end, score_head))
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        pairs = pa.StructArray.from_arrays([pa.array(tail_words, pa.binary()), pa.array(tail_counts, pa.int64())], ["word", "n"])
        made.append(pa.ListArray.from_arrays(pa.array(tail_ends, pa.int32()), pairs))
        kept = ["doc_id", "key", "learnt", "hash", "shard"]
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), *made], names=[*kept, *ENCODED])

    dealt = F.xxhash64("doc_id", "text")
    keyed = docs.select("doc_id", "key", "text", learning.alias("learnt"), dealt.alias("hash"), F.pmod(dealt, F.lit(shards)).cast("int").alias("shard"))
    encoded = map_chunks(keyed, work, "doc_id long, key long, learnt boolean, hash long, shard int, " + ", ".join(f"{k} {v}" for k, v in ENCODED.items()))
    return materialise(encoded.repartitionById(shards, "shard").sortWithinPartitions("shard", "hash").drop("hash"))


def most_tasks(shards: int, cores: int) -> int:
    return max(2 * cores, math.isqrt(shards))


def _read(stored: pa.BinaryArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The places of texts laid end to end, and their numbers."""
    parts = stored.to_pylist()
    return np.frombuffer(b"".join(parts), kind).astype(np.int32), np.array([len(x) for x in parts], np.int64) // np.dtype(kind).itemsize


def train(encoded: DataFrame, shared, rounds: int = ROUNDS, shard: int = SHARD) -> Parameters:
    """Rounds of learning in every shard and averaging. encoded: of encode_shards; shared: the broadcast vocabulary."""
    groups = shared.value.groups
    state = Trainer(groups).flat()
    spark = encoded.sparkSession
    # each task hands on one set of parameters, so tasks grow with the machines and with the root of the shards only
    shards = -(-shared.value.total // shard)
    encoded = encoded.filter("learnt").select("shard", "places").coalesce(most_tasks(shards, spark.sparkContext.defaultParallelism))
    for number in range(rounds):
        common = spark.sparkContext.broadcast(state.astype(np.float32))

        def run(batches, number=number, common=common):
            _keep_memory()
            groups, start = shared.value.groups, shared.value.start
            total, weight = np.zeros(len(common.value)), 0
            trainer, shard = None, None
            waiting: list[tuple[np.ndarray, np.ndarray]] = []

            def go():
                near, far, target = contexts(np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting]), start)
                for at in range(0, len(target), BATCH):
                    part = slice(at, at + BATCH)
                    trainer.step(near[part], far[part], target[part])
                waiting.clear()

            def close():
                nonlocal weight, total
                if waiting:
                    go()
                if trainer is not None and trainer.seen:
                    total += trainer.flat().astype(np.float64) * trainer.seen
                    weight += trainer.seen

            for batch in batches:
                numbers = np.asarray(batch.column("shard"))
                for at in range(0, len(numbers), 256):
                    for k in np.unique(numbers[at : at + 256]):
                        if k != shard:
                            close()
                            trainer, shard = Trainer(groups, seed=int(k) * 1000 + number), k
                            trainer.fill(common.value)
                        waiting.append(_read(batch.column("places").slice(at, 256).filter(pa.array(numbers[at : at + 256] == k)), shared.value.kind))
                        if sum(len(w[0]) for w in waiting) > 8 * BATCH:
                            go()
            close()
            if weight:
                rows = -(-len(total) // 1024)
                mean = np.pad(total / weight, (0, rows * 1024 - len(total))).astype(np.float32).reshape(rows, 1024)
                yield pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int32()), pa.array(list(mean), pa.list_(pa.float32())), pa.array([weight] * rows, pa.int64())], names=["row", "values", "weight"])

        def add(rows: pa.Table) -> pa.Table:
            weights = np.asarray(rows.column("weight"), np.float64)
            mean = np.average(np.stack(rows.column("values").to_numpy()), axis=0, weights=weights)
            return pa.table({"row": rows.column("row")[:1], "values": pa.array([mean], pa.list_(pa.float64()))})

        # a part of the parameters from each task meets in one group
        parts = encoded.mapInArrow(run, "row int, values array<float>, weight long")
        got = parts.groupBy("row").applyInArrow(add, "row int, values array<double>").toArrow()
        if not got.num_rows:
            break
        state = np.stack(got.column("values").to_numpy())[np.argsort(np.asarray(got.column("row")))].ravel()[: len(state)]
        common.unpersist()
    out = Parameters(groups)
    out.fill(state)
    return out


def score(docs: DataFrame, learning, rounds: int = ROUNDS, shard: int = SHARD) -> DataFrame:
    """Scores of every row of docs(doc_id, text). learning: a condition on doc_id for the rows to learn from."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    training = texts.filter(learning)
    counts = materialise(count_words(training))
    vocabulary = learn_vocabulary(counts, training.select(F.lit(1)).count())
    shared = spark.sparkContext.broadcast(vocabulary)
    shards = max(1, -(-vocabulary.total // shard))
    encoded = encode_shards(texts.withColumn("key", F.monotonically_increasing_id()), learning, shared, shards)
    model = spark.sparkContext.broadcast(train(encoded, shared, rounds, shard))
    total, distinct = vocabulary.total, vocabulary.distinct

    def work(batch: pa.RecordBatch):
        _keep_memory()
        v = shared.value
        places, lengths = _read(batch.column("places"), v.kind)
        near, far, target = contexts(places, lengths, v.start)
        log_p = model.value.log_probabilities(v.groups, near, far, target)
        sums = np.add.reduceat(log_p, np.cumsum(lengths) - lengths) / math.log(10) if len(log_p) else np.zeros(0)
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("doc_id", "key", "n_tokens", "n_head", "base_head")), pa.array(sums + np.asarray(batch.column("in_classes")))], names=["doc_id", "key", "n_tokens", "n_head", "base_head", "score_head"])

    scored = map_chunks(encoded.select("doc_id", "key", "n_tokens", "n_head", "base_head", "in_classes", "places"), work, "doc_id long, key long, n_tokens long, n_head long, base_head double, score_head double", "places")
    # the head has its counts already; a rare word that no training text holds finds none and counts 0
    tail = encoded.select("key", F.explode("tail").alias("t")).select("key", "t.word", F.col("t.n").alias("tf"))
    met = tail.join(counts.select("word", F.col("n").alias("c")).hint("shuffle_hash"), "word").groupBy("key").agg(F.sum("tf").alias("n_tail"), F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("tail_log"))
    joined = scored.join(met, "key", "left").na.fill(0, ["n_tail", "tail_log"])
    return joined.select(
        "doc_id",
        (~learning).alias("held_out"),
        "n_tokens",
        (F.col("n_head") + F.col("n_tail")).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_head") + F.col("tail_log") - F.col("n_tokens") * math.log10(total + distinct + 1)).alias("base_score"),
        (F.col("score_head") + F.col("tail_log")).alias("score"),
    )


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), HELD_OUT[0]) != HELD_OUT[1])
