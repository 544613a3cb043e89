import math
import random
import re
from collections import Counter

from tests.compare import SF, connect, rows
from tracklore.llm import lexical as x

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=10):
    words = lambda t: TERM.findall((t or "").translate(LOWER))
    own = [(d, Counter(w), len(w)) for d, t in docs if (w := words(t))]
    n_docs, n_words = len(own), sum(n for _, _, n in own)
    df = Counter(w for _, c, _ in own for w in c)
    out = []
    for item, text in set(items):
        found = []
        for d, c, n in own:
            m = 25 + 75 * n * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1000000000 * c[w] // (1000 * c[w] + 8 * m)) for w in words(text) if w in c)
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def tables(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "ÉTÉ", "ABC", "abc", "日本", "0"]
    text = lambda n: " ".join(rng.choices(vocabulary, range(66, 0, -1), k=n))
    docs = [(i, text(rng.randrange(1, 30))) for i in range(300)]
    same = text(12)
    docs += [(1000 - i, same) for i in range(50)] + [(2000 + i, " ".join(reversed(same.split())) + " ") for i in range(30)]  # one class of 80
    docs += [(3000 + i, f"{same.split()[0]} unknown{i} other") for i in range(40)]
    docs += [(None, same), (None, "w1 w1"), (7, same), (7, same), (5000, None), (5001, ""), (5002, "-- ; "), (5003, "w3," * 700_000), (5004, "q" * 3_000_000)]
    items = [(i, text(rng.randrange(1, 20))) for i in range(12)] + [(20, "nowhere"), (21, ""), (22, None), (None, "w5 w6"), (3, "w2 w2 w2 ABC"), (3, "w2 w2 w2 ABC"), (23, same)]
    return docs, items, spark.createDataFrame([(*d, i) for i, d in enumerate(docs)], "doc_id long, text string, score long").repartition(5), spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string")


def test_query_equals_sql(spark):
    df = x.op13_lexical(spark, SF)
    got = [tuple(r) for r in df.collect()]
    result = connect().execute(x.SQL)
    assert rows(df.columns, got) == rows([c[0] for c in result.description], result.fetchall())


def test_equals_brute_force(spark, monkeypatch):
    docs, items, d, i = tables(spark)
    want = brute(docs, items)
    assert found(x.rank(d, i)) == want
    # parts of the items, and small blocks inside a task, give the same rows
    monkeypatch.setattr(x, "BLOCK", 200)
    assert found(x.rank(d, i, max_item_bytes=150)) == want
    assert found(x.rank(d, i, k=3)) == brute(docs, items, 3)


def test_classes_keep_their_least_ids(spark):
    docs, items, d, i = tables(spark)
    own = x.Items([(0, 23, items[-1][1])])
    bags = x._bags(d, own.known)
    classes = x._classes(bags, 100, 1000, 10).collect()
    hot = max(classes, key=lambda r: len(r["ids"]))
    assert hot["ids"] == [7, 7, *range(951, 959)]
    assert len({(r["m"], bytes(r["bag"])) for r in classes}) == len(classes)


def test_empty_tables(spark):
    _, _, d, i = tables(spark)
    assert found(x.rank(d.filter("false"), i)) == [] == found(x.rank(d, i.filter("false"))) == found(x.rank(d, i.filter("text = ''")))


def test_long_texts_are_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(x, "PIECE", 7)
    n, got = x.count_words("Abc de, abc " * 50 + "abcdefghijklmnop de", {b"abc": 0, b"de": 1, b"abcdefghijklmnop": 2})
    assert (n, got) == (152, {0: 100, 1: 51, 2: 1})
