import collections
import itertools
import random

import numpy as np
import pytest

from tests.compare import SF
from tracklore.llm import near_dedup as n


def brute(docs):
    bags, parent = {}, {}
    for i, t in docs:
        w = (t or "").lower().split()
        parent[i] = i
        if w:
            bags[i] = collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(bags), 2):
        small = sum((bags[a] & bags[b]).values())
        if small * 5 >= 4 * (sum(bags[a].values()) + sum(bags[b].values()) - small):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def test_agreement_is_weighted_jaccard():
    r = random.Random(1)
    vocabulary = [f"w{i}".encode() for i in range(3000)]
    left, right, truth = [], [], []
    for k in range(200):
        a = [r.choice(vocabulary) for _ in range(r.choice([30, 300, 1000]))] * (3 if k % 3 == 0 else 1)
        b = list(a)
        for _ in range(max(1, len(a) * k // 20_000)):
            b[r.randrange(len(b))] = r.choice(vocabulary)
        left.append(a)
        right.append(b)
        small, large = n.overlap(n.shingles([a])[0], n.shingles([b])[0])
        truth.append(small / large)
    same = (n.signatures(left) == n.signatures(right)).mean(1)
    assert abs((same - np.array(truth)).mean()) < 0.01 and np.abs(same - np.array(truth)).max() < 0.25
    assert np.isfinite(n.signatures([[b"a"], [b"b"] * 400])).all()


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs)
    assert {r["doc_id"]: r["class_id"] for r in n.op6_near_dedup(spark, SF).collect()} == want


def test_large_group_of_near_copies_and_cases(spark):
    r = random.Random(2)
    base = [f"w{r.randrange(10_000)}" for _ in range(300)]
    docs = []
    for i in range(90):
        w = list(base)
        for _ in range(i % 9):
            w[r.randrange(300)] = f"x{r.randrange(10_000)}"
        docs.append((i, " ".join(w)))
    chain = docs[8][1].split()
    for i in range(5):  # copies of copies
        for _ in range(5):
            chain[r.randrange(300)] = f"y{r.randrange(10_000)}"
        docs.append((200 + i, " ".join(chain)))
    docs += [(300 + i, " ".join(base)) for i in range(40)] + [(400, None), (401, ""), (402, " \n"), (403, "one two"), (404, "One  two"), (405, "one")]
    want = brute(docs)
    frame = spark.createDataFrame([(*d, 1) for d in docs] + [(None, docs[0][1], 1), (0, docs[0][1], 1)], "doc_id long, text string, label int")
    rows = n.near_duplicate_classes(frame).collect()
    assert {x["doc_id"]: x["class_id"] for x in rows if x["doc_id"] is not None} == want
    assert len(rows) == len(docs) + 2 and [x["class_id"] for x in rows if x["doc_id"] is None] == [None]
    kept = n.drop_near_duplicates(frame).collect()
    assert sorted(x["doc_id"] for x in kept if x["doc_id"] is not None) == sorted(set(want.values())) and len(kept) == len(set(want.values())) + 1
    assert n.near_duplicate_classes(frame.filter("false")).count() == 0 and n.drop_near_duplicates(frame.filter("false")).count() == 0


def test_hot_keys_meet_their_group(spark, monkeypatch):
    monkeypatch.setattr(n, "DEALT", 8)
    monkeypatch.setattr(n, "MOST_HOT", 50)
    keys = [i % 40 for i in range(200)] + [7] * 500 + [11] * 9 + [99]
    rows = n.materialise(spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long"))
    count = collections.Counter(keys)
    groups = n.materialise(spark.createDataFrame([(k, c, -k) for k, c in count.items()], "k long, n long, g long"))
    assert sorted(tuple(r) for r in n._meet(rows, groups, "k").select("k", "i", "n", "g").collect()) == sorted((k, i, count[k], -k) for i, k in enumerate(keys))
    assert n._meet(rows.filter("false"), groups.filter("false"), "k").count() == 0
    # many copies of a text, near copies of it, and two other families
    r = random.Random(3)
    families = [[f"w{r.randrange(10**6)}" for _ in range(120)] for _ in range(3)]
    docs = [(i, " ".join(families[0])) for i in range(60)] + [(1000, "alone in its class"), (1001, "")]
    for f, words in enumerate(families):
        for i in range(40):
            w = list(words)
            w[r.randrange(120)] = f"x{f}_{i}"
            docs.append((100 * (f + 1) + i, " ".join(w)))
    got = n.near_duplicate_classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert len(got) == len(docs) and {x["doc_id"]: x["class_id"] for x in got} == brute(docs)


def test_template_family_with_planted_pairs(spark):
    r = random.Random(5)
    base = [f"b{i}" for i in range(180)]
    fill = lambda k: [f"x{r.randrange(10**9)}" for _ in range(k)]
    docs = [(i, " ".join(base + fill(26))) for i in range(300)]  # 0.77 alike
    for i in range(60):  # texts 300.. are 0.8 to 0.9 alike to one filled template each
        w = docs[i][1].split()
        docs.append((300 + i, " ".join(w[: 180 + 8 + i % 8] + fill(18 - i % 8))))
    want = brute(docs)
    assert 250 < len(set(want.values())) < 350
    got = n.near_duplicate_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {x["doc_id"]: x["class_id"] for x in got} == want


def test_slot_counts(spark):
    rows = [(i % 3, f"a b c d e f g w{i} h i j k l m n o p q") for i in range(50)] + [(7, "only here in this one text of mine ok"), (8, ""), (9, "one two")]
    df = spark.createDataFrame(rows, "label long, text string")
    want, labels = collections.Counter(), collections.defaultdict(set)
    for token, at in zip(*n._tokens([t for _, t in rows]), strict=True):
        want[int(token % np.uint64(n.SLOTS))] += 1
        labels[int(token % np.uint64(n.SLOTS))].add(rows[at][0])
    got = n._slot_counts(df.repartition(4))
    assert {int(k): int(got[k]) for k in np.flatnonzero(got)} == {k: c for k, c in want.items() if len(labels[k]) > 1}
    assert not n._slot_counts(df.filter("false")).any()


def test_links_of_every_text_of_a_repeated_id(spark):
    r = random.Random(7)
    texts = [[f"w{r.randrange(10**6)}" for _ in range(100)] for _ in range(6)]
    near = [" ".join(t[:-3]) for t in texts]
    texts = [" ".join(t) for t in texts]
    docs = [(0, t) for t in texts] + [(10 + i, t) for i, t in enumerate(near)]  # id 0 has six texts, each with a near copy
    got = n.near_duplicate_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {x["doc_id"]: x["class_id"] for x in got} == {i: 0 for i in [0, *range(10, 16)]}


@pytest.mark.parametrize("edges,want", [([(1, 2), (3, 2), (4, 5)], {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}), ([(i, i + 1) for i in range(30)], {i: 0 for i in range(31)}), ([], {})])
def test_components(spark, edges, want):
    assert {r["node"]: r["label"] for r in n.components(spark.createDataFrame(edges, "a long, b long")).collect()} == want
