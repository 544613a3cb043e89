import collections

from pyspark.sql.types import IntegerType, StructField, StructType

import corpus_pipeline as c
from tests.compare import SF
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_near_dedup import brute as classes
from tests.llm.test_pii import plain


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, held = docs.columns, []
    for k, (_, stage) in enumerate(c.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        held.append({r["doc_id"]: r for r in docs.collect()})
        assert docs.columns == (columns if k < 4 else [*columns, "copy"])
    good, unique, clean, masked, mixed = held
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(i in good for i, q in labels.items() if q == 1)
    assert set(unique) == set(classes([(i, r["text"]) for i, r in good.items()]).values())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(clean) == {i for i, r in unique.items() if not leaks(r["text"], items)[1]}
    assert set(masked) == set(clean) and not any(plain(r["text"]) for r in masked.values())
    assert all(r["n_chars"] == len(r["text"]) for i, r in masked.items() if r["text"] != clean[i]["text"])
    assert set(mixed) <= set(masked) and all(mixed[i]["text"] == masked[i]["text"] for i in mixed)
    copies = collections.Counter(r["doc_id"] for r in docs.collect())
    assert max(copies.values()) <= 3


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for _, stage in c.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_cases_in_every_stage(spark):
    """Nulls in any column, repeated rows, a very long text and clashing names: kept rows keep all their columns."""
    base = spark.read.parquet(f"{SF}/documents.parquet")
    fine = base.join(spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1"), "doc_id").select(base.columns).orderBy("doc_id").limit(3).collect()
    long = " ".join(f"w{i % 1013}x{i}" for i in range(60_000))
    rows = [tuple(r) for r in fine] + [tuple(fine[0])] + [(None, fine[1]["text"] + " end", None, None, None), (900_001, None, None, None, None), (900_002, "", "en", "a", 0), (900_003, long, "en", None, len(long))]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], StructType([*base.schema.fields, StructField("copy", IntegerType())]))
    for k, (_, stage) in enumerate(c.STAGES):
        out = stage(spark, docs, SF)
        got = out.collect()
        assert out.columns == (docs.columns if k < 4 else [*docs.columns, "_copy"])
        names = {r["copy"] for r in got}
        assert names <= set(range(len(rows)))
        if k == 1:  # of the repeated row one stays; rows without an id, or without words, all stay
            assert len(names & {0, 3}) == 1 and names >= {1, 2, 4, 5, 6, 7}
        if k == 2:
            assert names == set(range(len(rows)))
        if k == 3:
            assert len(got) == len(rows) and [r["text"] for r in got if r["copy"] == 5] == [None]


def test_run(spark):
    assert c.run(spark, SF).count() > 0
