import math

import pytest
from pyspark.sql import functions as F

from tests.compare import SF
from tracklore.llm import mixing as m


def filled(sizes, weights, cap=3.0):
    target, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        w = sum(weights[i] for i in free)
        for i in free:
            target[i] = left * weights[i] / w
        above = {i for i in free if target[i] > cap * sizes[i]}
        if not above:
            break
        for i in above:
            target[i] = cap * sizes[i]
        left -= sum(target[i] for i in above)
        free -= above
    return target


def test_query(spark):
    rows = m.op5_mixing(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text"), "doc_id").collect()
    names = sorted({r["source"] for r in rows})
    sizes = [sum(r["size"] for r in rows if r["source"] == s) for s in names]
    want = dict(zip(names, filled(sizes, [1 + i % 3 for i in range(len(names))]), strict=True))
    for s in names:
        own = [r for r in rows if r["source"] == s]
        assert own[0]["source_size"] == sum(r["size"] for r in own) and own[0]["target"] == pytest.approx(want[s])
        small = sorted(r["size"] for r in own)[len(own) // 4]  # ten documents a source here: one small document is the grain
        assert abs(sum(r["taken"] for r in own) - want[s]) <= max(0.02 * want[s], small)
    for r in rows:
        assert r["size"] == len(r["text"].encode().split()) and 0 <= r["taken"] <= 3 * r["size"]
    again = {r["doc_id"]: r["taken"] for r in m.op5_mixing(spark, SF).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_cases(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", "k"), (2, None, "x", "k"), (3, "", None, "k"), (None, "d e", None, "k"), (1, "a b c", "x", "k"), (5, "f " * 400, "y", "k")], "doc_id long, text string, source string, copies string")
    got = m.mix(docs).collect()
    assert len(got) == 6 and all(r["copies"] * r["size"] <= 3 * r["size"] for r in got)
    assert m.mix(docs.filter("false")).count() == 0 and m.mix(docs.filter("text IS NULL")).first()["size"] == 0
    assert m.mixed_documents(docs).columns == ["doc_id", "text", "source", "copies", "copy"]
    assert m.mixed_documents(docs.filter("false")).count() == 0


@pytest.mark.parametrize("ids", ["distinct", "null", "one", "equal rows", "equal rows of one source"])
def test_targets_are_met_whatever_the_ids(spark, ids):
    """3,000 rows of ten words in three sources: targets of 5,000, 10,000 and 15,000 words."""
    doc_id = {"distinct": lambda i: i, "null": lambda i: None}.get(ids, lambda i: 7)
    word = lambda i: "same" if ids == "equal rows" or ids.endswith("source") and i % 3 == 1 else str(i)
    docs = spark.createDataFrame([(doc_id(i), f"{word(i)} " * 10, f"s{i % 3}", i % 5) for i in range(3000)], "doc_id long, text string, source string, more int").repartition(6)
    rows = m.mix(docs).collect()
    got = {s: [r for r in rows if r["source"] == s] for s in ("s0", "s1", "s2")}
    taken = {s: sum(r["copies"] * r["size"] for r in own) for s, own in got.items()}
    assert all(abs(taken[s] - own[0]["target"]) <= 0.02 * own[0]["target"] and len(own) == 1000 for s, own in got.items())
    mixed = {r["source"]: r["n"] for r in m.mixed_documents(docs).groupBy("source").agg((F.count("*") * 10).alias("n")).collect()}
    assert mixed == taken
    key = lambda rows: sorted((r["source"], r["doc_id"] or 0, r["copies"]) for r in rows)
    assert key(rows) == key(m.mix(docs.repartition(3)).collect())


def test_many_equal_rows_by_formula(spark, monkeypatch):
    docs = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 3000, "x").otherwise("y").alias("source"))
    want = sorted(tuple(r) for r in m.mix(docs).groupBy("source", "copies").count().collect())
    monkeypatch.setattr(m, "FEW_ROWS", 10**9)
    monkeypatch.setattr(m, "SPREAD", 70)
    assert sorted(tuple(r) for r in m.mix(docs).groupBy("source", "copies").count().collect()) == want
    taken = {s: sum(3 * c * n for t, c, n in want if t == s) for s in "xy"}
    assert taken["x"] == pytest.approx(5000, rel=0.01) and taken["y"] == pytest.approx(10000, rel=0.01)


def test_two_groupings_meet_their_targets(spark):
    sizes = spark.createDataFrame([("a", "en", 500), ("a", "de", 300), ("b", "en", 200), ("b", "de", 400)], "source string, lang string, size long")
    targets = {"source": spark.createDataFrame([("a", 700.0), ("b", 700.0)], "source string, target double"), "lang": spark.createDataFrame([("en", 600.0), ("de", 800.0)], "lang string, target double")}
    got = m.balance(sizes, targets)
    assert got.steps > 0 and got.gap <= 1e-9
    found = {c: dict(v) for c, v in got.multipliers.items()}
    rate = lambda r: min(3, math.exp(found["source"][r["source"]] + found["lang"][r["lang"]]))
    for c, t in targets.items():
        for group, want in t.collect():
            assert sum(rate(r) * r["size"] for r in sizes.collect() if r[c] == group) == pytest.approx(want, rel=1e-6)


def test_newton_meets_the_closed_form(spark):
    sizes = spark.createDataFrame([("a", 500), ("a", 10), ("b", 40), ("c", 900), (None, 7), ("d", 0)], "source string, size long")
    targets = spark.createDataFrame([("a", 255.0), ("b", 120.0), ("c", 1000.0), (None, 7.0), ("d", 0.0)], "source string, target double")
    got = m.balance(sizes, {"source": targets})
    assert got.steps > 2 and got.gap <= 1e-9
    rates = {g: min(3, math.exp(x)) for g, x in got.multipliers["source"]}
    assert rates == pytest.approx({"a": 0.5, "b": 3.0, "c": 1000 / 900, None: 1.0}, rel=1e-8)


def test_wide_plans_are_joined_with_the_same_result(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i * 7 % 50), f"s{i % 9}" if i % 9 else None) for i in range(300)], "doc_id long, text string, source string")
    key = lambda df: sorted((r["doc_id"], r["size"], r["target"], r["copies"]) for r in df.collect())
    assert key(m.mix(docs)) == key(m.mix(docs, most_broadcast=0))
    assert sorted(m.mixed_documents(docs.withColumn("copy", docs.doc_id)).select("doc_id", "copy", "_copy").collect()) == sorted(m.mixed_documents(docs, most_broadcast=0).select("doc_id", docs.doc_id.alias("copy"), m.F.col("copy").alias("_copy")).collect())


def test_sizes(spark):
    got = spark.createDataFrame([("a b c\td",), (" ",), (None,)], "t string").select(m.size_of(F.col("t"))).collect()
    assert [r[0] for r in got] == [3, 0, 0]
