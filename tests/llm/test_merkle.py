import hashlib
import zlib
from itertools import groupby

from pyspark.sql import functions as F

from tests.compare import SF, connect, rows
from tracklore.llm import merkle as m

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, tree string, pos string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[k] for k in m.FIELDS)])


def tree(nodes):
    """All levels, and the siblings of each lowest node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    proofs = []
    for i in range(len(nodes)):
        proof = []
        for level in levels[:-1]:
            run = level[i // 3 * 3 : i // 3 * 3 + 3]
            proof.append((run[: i % 3], run[i % 3 + 1 :]))
            i //= 3
        proofs.append(proof)
    return levels[-1][0], proofs


def brute(data):
    """(doc_id, leaf, subroot, root, proof) of each row, sorted."""
    order = lambda v: (v is not None, v if v is not None else 0)
    name = lambda r: (r["source"] is not None, (r["source"] or "").encode())
    own = []
    for _, part in groupby(sorted(data, key=name), key=name):
        part = sorted(part, key=lambda r: (order(r["doc_id"]), leaf(r)))
        own.append((part, *tree([leaf(r) for r in part])))
    root, over = tree([subroot for _, subroot, _ in own])
    return sorted((repr(r["doc_id"]), leaf(r), subroot, root, repr([("".join(a), "".join(b)) for a, b in proof + above])) for (part, subroot, proofs), above in zip(own, over, strict=True) for r, proof in zip(part, proofs, strict=True))


def found(df):
    return sorted((repr(r["doc_id"]), r["leaf"], r["subroot"], r["root"], repr([(s["left"], s["right"]) for s in r["proof"]])) for r in df.collect())


def case_rows():
    made = [(i * 7 % 1000, f"text {i}\nmore é", "en", "big", i) for i in range(700)]
    made += [(i, "x", None, f"s{i:03}", None) for i in range(90)]
    made += [(None, None, None, None, None)] * 5 + [(None, "", "", None, 0)] + [(3, "a", "en", "ü", 1), (3, "b", "en", "ü", 1), (3, "b", "en", "ü", 1), (4, "long " * 200_000, "en", "z", 1)]
    return [(*r, 9, "clash", None) for r in made]


def test_query_equals_sql(spark):
    df = m.op12_merkle(spark, SF)
    got = [tuple(r) for r in df.collect()]
    result = connect().execute(m.SQL)
    assert rows(df.columns, got) == rows([c[0] for c in result.description], result.fetchall())


def test_query_folds_what_was_tampered_with(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in m.op12_merkle(spark, SF).collect():
        touched = zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and "\n" in (docs[r["doc_id"]]["text"] or "")
        assert r["verified"] == (not touched) and r["leaf"] == leaf(docs[r["doc_id"]])


def test_proofs_equal_brute_force(spark):
    docs = spark.createDataFrame(case_rows(), SCHEMA).repartition(7)
    manifest = m.build(docs)
    assert len(manifest.levels) == 3 and len(manifest.root_levels) == 3
    want = brute([dict(zip(docs.columns, r, strict=True)) for r in case_rows()])
    assert found(m.proofs(manifest)) == want
    assert manifest.root().first()["root"] == want[0][3]
    some = spark.createDataFrame([(21,), (3,), (-5,), (21,)], "doc_id long")
    assert found(m.proofs(manifest, wanted=some)) == [r for r in want if r[0] in ("21", "3")]
    folded = m.proofs(manifest).withColumn("folded", m.fold_up(F.col("leaf"), F.col("proof")))
    assert folded.filter("folded <> root").count() == 0


def test_a_stored_manifest_is_read_again(spark, tmp_path):
    docs = spark.createDataFrame(case_rows(), SCHEMA)
    made = m.build(docs, path=str(tmp_path / "m"))
    again = m.load(spark, str(tmp_path / "m"))
    assert found(m.proofs(again)) == found(m.proofs(made)) and again.root().collect() == made.root().collect()


def test_small_tables(spark):
    one = spark.createDataFrame(case_rows()[:1], SCHEMA)
    got = m.proofs(m.build(one)).first()
    assert got["leaf"] == got["subroot"] == got["root"] and got["proof"] == []
    none = m.build(one.filter("false"))
    assert m.proofs(none).count() == 0 and none.root().count() == 0


def test_wide_ranges_are_joined(spark, monkeypatch):
    docs = spark.createDataFrame(case_rows(), SCHEMA)
    want = found(m.proofs(m.build(docs)))
    monkeypatch.setattr(m, "MOST_RANGES", 0)
    assert found(m.proofs(m.build(docs))) == want
