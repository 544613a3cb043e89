import bisect
import collections
import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from tracklore.llm import quality, toxicity

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def measured(spark, df, column):
    rows = df.filter("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").select("score", "predicted", F.col(column).alias("y")).collect()
    good, bad = ([r["score"] for r in rows if r["y"] == y] for y in (1, 0))
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad)), rows


def test_quality_held_out(spark):
    area, rows = measured(spark, quality.op8_quality(spark, SF), "quality")
    assert area > 0.97 and all(r["predicted"] == 1 for r in rows if r["y"] == 1)


def test_toxicity_held_out(spark):
    area, rows = measured(spark, toxicity.op9_toxicity(spark, SF), "toxic")
    assert area > 0.85 and not any(r["predicted"] for r in rows if r["y"] == 0)


def plain_figures(text):
    """The figures, character by character."""
    raw = (text or "").encode()
    words, lines, n = raw.split(), raw.split(b"\n"), len(raw)
    share = lambda chars: sum(b in chars for b in raw) / max(n, 1)
    k = max(len(words), 1)
    most = max(collections.Counter(words).values(), default=0)
    return [
        math.log1p(n), math.log1p(len(words)), (n - len(lines)) / k, share(bytes(range(65, 91))), share(b"0123456789"), share(b" \t"), share(b"\n"), share(b"."), share(b","), share(b"!?"), share(b"|"),
        share(b"*$#%&=<>{}[]\\^~_@"), share(b"-:;/+()"), share(bytes(range(128, 256))), len(set(words)) / k, most / k, len(set(lines)) / len(lines), math.log1p(n / len(lines)),
        math.log1p(max(map(len, words), default=0)), share(b"\"'"),
    ]


def test_quality_query_against_brute_force(spark):
    """Every score is the logistic of the bins' sum, looked up one by one, and every row is there."""
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality.train(docs, labels, keep=quality.fold(F.col("doc_id"), 5) != 0)
    got = {r["doc_id"]: r for r in quality.op8_quality(spark, SMALL).collect()}
    texts = docs.select("doc_id", "text").collect()
    assert got.keys() == {d["doc_id"] for d in texts} and model.pairs
    for d in texts:
        x = plain_figures(d["text"])
        bins = [bisect.bisect_right(list(e), v) for e, v in zip(model.edges, x, strict=True)]
        total = model.base + sum(t[b] for t, b in zip(model.tables, bins, strict=True))
        coarse = [b * quality.COARSE // (len(e) + 1) for b, e in zip(bins, model.edges, strict=True)]
        total += sum(t[coarse[i], coarse[j]] for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
        r = got[d["doc_id"]]
        assert abs(r["score"] - 1 / (1 + math.exp(-max(-30, min(30, total))))) < 1e-6
        assert r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0)


def test_toxicity_query_against_brute_force(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels, keep=quality.fold(F.col("doc_id"), 3) != 1)
    got = {r["doc_id"]: r for r in toxicity.op9_toxicity(spark, SF).collect()}
    assert model.weights
    for d in docs.select("doc_id", "text").collect():
        words = set(re.findall(r"[a-z0-9'\x80-\xff]+", re.sub("[A-Z]", lambda m: m[0].lower(), (d["text"] or "").encode().decode("latin-1"))))
        found = {w.encode("latin-1") for w in words} | {w[:n].encode("latin-1") + b"*" for w in words for n in (4, 5, 6) if len(w) > n}
        total = model.base + sum(w for t, w in model.weights.items() if t in found)
        r = got[d["doc_id"]]
        assert abs(r["score"] - 1 / (1 + math.exp(-max(-30, min(30, total))))) < 1e-9
        assert r["predicted"] == (r["score"] >= 0.7) and r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1)


def test_repeated_ids_and_long_texts(spark):
    """A labelled id with many texts is learnt once; a long text is read to its end."""
    rows = [(i, f"{'bad idiot' if i % 2 else 'kind words'} w{i % 7} " * 3) for i in range(200)]
    labels = spark.createDataFrame([(i, 1 - i % 2, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    many = spark.createDataFrame(rows + [rows[7]] * 300, "doc_id long, text string")
    probe = ["kind " * 100_000 + "idiot", "kind " * 100_000, None]
    assert np.allclose(*(toxicity.train(x, labels).score(probe) for x in (once, many)))
    held = toxicity.train(once, labels).score(probe)
    assert held[0] > held[1]
    assert np.allclose(*(quality.train(x, labels).score(quality.figure_matrix(probe)) for x in (once, many)))


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    p = quality.fit(x, y, rounds=10, pair_rounds=40).score(x)
    assert ((p > 0.5) == y).mean() > 0.85


def test_counterfactuals_even_out_group_terms():
    rng = np.random.default_rng(0)
    x = np.zeros((600, 3))
    x[:200, 0] = x[200:400, 1] = 1  # two group terms; the first is met with insults more often
    x[:, 2] = rng.random(600) < np.where(x[:, 0] == 1, 0.6, 0.1)
    y = ((x[:, 2] == 1) | (rng.random(600) < np.where(x[:, 0] == 1, 0.3, 0.02))).astype(float)
    swaps = np.array([[-1.0, 1.0, 0.0]])
    free, held = (toxicity.fit(x, y, swaps, w, 0.5)[1] for w in (0.0, 10.0))
    assert abs(held[0] - held[1]) < 0.1 * abs(free[0] - free[1]) and held[2] > 2


def test_swaps_move_beginnings_and_even_out_neutral_mentions(spark):
    index = {t: i for i, t in enumerate(sorted(toxicity.terms("muslim hindu hindus muslimah")))}
    at = {i: t for t, i in index.items()}
    moved = {(frozenset(at[i] for i in g), frozenset(at[i] for i in c)) for g, c in toxicity.swap_changes("a muslim", index)}
    assert (frozenset([b"muslim", b"musl*", b"musli*"]), frozenset([b"hindu", b"hind*"])) in moved
    assert all(b"musl*" not in [at[i] for i in g] for g, _ in toxicity.swap_changes("muslim muslimah", index))
    r = np.random.default_rng(3)
    docs, labels = [], []
    for i in range(1200):  # one group is met with insults more often
        group = ["muslims", "hindus", "christians"][i % 3]
        toxic = r.random() < (0.8 if group == "muslims" else 0.1)
        docs.append((i, f"the {group} live here w{r.integers(50)} {'idiot' if toxic and r.random() < 0.7 else 'fine'}"))
        labels.append((i, int(toxic)))
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    free, held = (toxicity.train(docs, labels, swap_weight=w).score(["the muslims live here", "the hindus live here"]) for w in (0.0, 10.0))
    assert free[0] - free[1] > 0.2 and abs(held[0] - held[1]) < 0.05


def test_cases(spark):
    docs = spark.createDataFrame([(1, "fine text", 1), (2, None, 1), (3, "", 1), (None, "x", 1), (4, "bad idiot", 1), (4, "bad idiot", 1)], "doc_id long, text string, y int")
    some = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (9, 1, 1), (3, None, 7), (None, 1, 1), (4, 0, None)], "doc_id long, quality int, toxic int")
    for module, column in ((quality, "quality"), (toxicity, "toxic")):
        for labels in (some, some.filter("false"), some.filter("doc_id = 1")):
            model = module.train(docs, labels, column)
            got = module.score_texts(docs, model).collect()
            assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
        assert module.score_texts(docs.filter("false"), model).count() == 0
    assert quality.keep_good(docs, quality.train(docs, some)).columns == docs.columns
