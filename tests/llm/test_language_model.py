import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import SF
from tracklore.llm import language_model as m


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    c, total = collections.Counter(), 0
    for i, t in docs:
        if not held[i]:
            w = [*m.tokens(t), None]
            c.update(w)
            total += len(w)
    got = {r["doc_id"]: r for r in m.op7_language_model(spark, SF).collect()}
    for i, t in docs:
        w, r = [*m.tokens(t), None], got[i]
        assert r["base_score"] == pytest.approx(sum(math.log10((c[x] + 1) / (total + len(c) + 1)) for x in w), rel=1e-9)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(w), sum(c[x] > 0 for x in w), total)
    mine = [r for r in got.values() if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in mine) / sum(r["n_tokens"] for r in mine)
    assert gain > 0.05


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    words = [f"w{i}".encode() for i in range(700)]
    groups = m.Groups(words, rng.integers(1, 5000, 700 + 1 + m.CLASSES).astype(float))
    p = m.Parameters(groups)
    p.group_bias, p.bias = (rng.normal(size=x.shape).astype(np.float32) for x in (p.group_bias, p.bias))
    n = len(groups.place)
    assert sorted(groups.place) == list(range(n)) and groups.share.sum() == pytest.approx(1)
    for a, b in ((0, 0), (5, 600), (n, n)):
        log_p = p.log_probabilities(groups, np.full(n, a), np.full(n, b), np.arange(n))
        assert np.exp(log_p).sum() == pytest.approx(1, abs=1e-5)


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(2)
    words = [f"w{i:02d}".encode() for i in range(40)]
    groups = m.Groups(words, np.r_[np.full(40, 1000.0), 1.0, np.ones(m.CLASSES)])
    target = groups.place[np.tile(np.arange(40), 2000)]
    near, far, t = np.r_[0, target[:-1]], np.r_[0, 0, target[:-2]], target
    trainer = m.Trainer(groups)
    before = trainer.p.log_probabilities(groups, near, far, t).mean()
    for _ in range(60):
        k = rng.integers(0, len(t), 4000)
        trainer.step(near[k], far[k], t[k])
    assert trainer.p.log_probabilities(groups, near, far, t).mean() > before + 0.5
    again = m.Trainer(groups)
    again.fill(trainer.flat())
    assert (again.flat() == trainer.flat()).all()


def test_contexts():
    near, far, target = m.contexts(np.array([1, 2, 3, 4, 5, 6]), np.array([1, 3, 2]), 9)
    assert near.tolist() == [9, 9, 2, 3, 9, 5] and far.tolist() == [9, 9, 9, 2, 9, 9] and target.tolist() == [1, 2, 3, 4, 5, 6]


def test_scores_do_not_depend_on_the_layout(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    learning = F.col("doc_id") % 3 != 0
    one, many = ({r["doc_id"]: r["score"] for r in m.score(docs.repartition(n), learning, 2, 20_000).collect()} for n in (1, 9))
    assert one.keys() == many.keys() and all(one[i] == pytest.approx(many[i], rel=1e-4) for i in one)


def test_long_texts_and_many_symbols(spark):
    text = " ".join(f"w{i % 97}" for i in range(120_000))
    docs = spark.createDataFrame([(1, text), (2, "w1 w2 never"), (3, text)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in m.score(docs, F.col("doc_id") < 3).collect()}
    assert got[1]["n_tokens"] == 120_001 and got[1]["score"] == got[3]["score"] > got[1]["base_score"] and got[2]["n_known"] == 4


def test_cases(spark):
    docs = spark.createDataFrame([(1, "a b a", "z"), (2, None, "z"), (3, "", "z"), (None, "b", "z"), (1, "a b a", "z")], "doc_id long, text string, score string")
    got = m.score(docs, F.lit(True) | F.col("doc_id").isNull()).collect()
    assert len(got) == 5 and {r["n_tokens"] for r in got if r["doc_id"] in (2, 3)} == {1} and got[0]["train_tokens"] == 12
    none = m.score(docs, F.col("doc_id").isNull() & F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["base_score"] == 0 and r["train_tokens"] == 0 for r in none)
    assert m.score(docs.filter("false"), F.lit(True)).count() == 0


def test_scores_recomputed_token_by_token(spark, monkeypatch):
    """The model's own parameters, but every probability by plain loops: group among groups, member in its group, word in its class."""
    kept = {}
    train, learn = m.train, m.learn_vocabulary
    monkeypatch.setattr(m, "train", lambda *a: kept.setdefault("p", train(*a)))
    monkeypatch.setattr(m, "learn_vocabulary", lambda *a: kept.setdefault("v", learn(*a)))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r for r in m.score(docs, F.col("doc_id") % 3 != 0).collect()}
    p, v, texts = kept["p"], kept["v"], {r["doc_id"]: r["text"] for r in docs.collect()}
    words = collections.Counter(w for i, t in texts.items() if i % 3 for w in m.tokens(t))
    least = m.least_count(sum(words.values()))
    symbols = [w for w, n in sorted(words.items(), key=lambda x: (-x[1], x[0])) if n >= least]
    number = {w: i for i, w in enumerate(symbols)}
    inside = collections.Counter()
    for w, n in words.items():
        if w not in number:
            inside[m.class_of(w)] += n + 1
    place, of_place = v.groups.place, v.groups.of_place
    members = [[k for k in range(len(place)) if of_place[k] == g] for g in range(v.groups.n)]

    def log_share(scores, k):
        top = max(scores)
        return scores[k] - top - math.log(sum(math.exp(s - top) for s in scores))

    short = sorted(got, key=lambda i: len(texts[i] or ""))[:25]
    assert {i % 3 for i in short} == {0, 1, 2} and symbols
    for i in short:
        near = far = len(place)
        total = 0.0
        for w in [*m.tokens(texts[i]), None]:
            k = place[len(symbols) if w is None else number[w] if w in number else len(symbols) + 1 + m.class_of(w)]
            context = p.near[near].astype(float) + p.far[far]
            g = int(of_place[k])
            total += log_share([float(context @ p.group[x] + p.group_bias[x]) for x in range(v.groups.n)], g)
            total += log_share([float(context @ p.member[x] + p.bias[x]) for x in members[g]], members[g].index(k))
            if w is not None and w not in number:
                total += math.log((words[w] + 1) / (inside[m.class_of(w)] + 1))
            near, far = k, near
        assert got[i]["score"] == pytest.approx(total / math.log(10), rel=1e-4)


def test_each_shard_is_one_file_and_tasks_are_few(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", F.col("doc_id"))
    vocabulary = m.learn_vocabulary(m.count_words(docs), docs.count())
    encoded = m.encode_shards(docs, F.col("doc_id") % 3 != 0, spark.sparkContext.broadcast(vocabulary), 20)
    files = encoded.groupBy(F.input_file_name().alias("file")).agg(F.countDistinct("shard").alias("n")).filter("n > 0").collect()
    assert len(files) == 20 and {r["n"] for r in files} == {1}
    assert [m.most_tasks(n, 6) for n in (1, 59, 3_500)] == [12, 12, 59]


def test_totals_of_symbols_that_favour_different_groups():
    groups = m.Groups([f"w{i:02d}".encode() for i in range(40)], np.r_[np.full(40, 1000.0), 1.0, np.ones(m.CLASSES)])
    p = m.Parameters(groups)
    p.group[:] = 0
    p.group[0, 0], p.group[1, 0] = 1, -1
    p.near[3], p.far[5] = 0, 0
    p.near[3, 0], p.far[5, 0] = 90, -90
    got = p._log_totals(np.c_[p.group, p.group_bias], np.array([3, 3]), np.array([5, 4]))
    plain = [np.logaddexp.reduce(((p.near[3] + p.far[x]) @ p.group.T + p.group_bias).astype(float)) for x in (5, 4)]
    assert got == pytest.approx(plain, rel=1e-5)
