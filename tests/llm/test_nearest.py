import numpy as np
import pytest

from tests.compare import SF
from tracklore.llm import nearest as n


def brute(rows, k=5, every=50):
    """By row: the cosine of original vectors, every row but the query's own, ties to the smaller id."""
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    norms = np.sqrt((x * x).sum(1))
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = (x * x[i]).sum(1) / (norms * norms[i])
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out.setdefault(int(ids[i]), []).append([(int(ids[j]), s[j]) for j in order])
    return out


def test_recall_against_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, got = brute(rows), {}
    for r in n.op10_nearest(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.keys() == want.keys()
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in w}) / len(w) for q, (w,) in want.items()]) >= 0.9
    for q, found in got.items():
        exact = dict(want[q][0])
        assert all(s == exact[v] for v, s in found if v in exact)


@pytest.mark.parametrize("pack", [61, 500, 8192])
def test_copies_tie_exactly(spark, pack):
    r = np.random.default_rng(4)
    x = r.normal(size=(3000, 37))
    copies = [7, 8, 9, 33, 701, 1402, 2103, 2500, 2999]
    x[copies] = x[50]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = n.search(df, pack=pack).filter("query_id = 50").orderBy("rank").collect()
    assert [g["vec_id"] for g in got] == copies[:5] and len({g["score"] for g in got}) == 1


def test_repeated_ids_and_lengths(spark):
    rows = [(50, [1.0, 0.0]), (1, [1.0, 0.1]), (1, [0.0, 1.0]), (2, [0.5, 0.5]), (100, [1.0, 1.0, 1.0]), (3, [1.0, 2.0, 3.0]), (100, [3.0, 2.0, 1.0]), (150, [1e200, 2e200]), (4, [5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for g in n.search(df).orderBy("query_id", "rank").collect():
        got.setdefault(g["query_id"], []).append((g["rank"], g["vec_id"]))
    assert got[50] == [(1, 1), (2, 2), (3, 150), (4, 1)] and got[150] == [(1, 2), (2, 1), (3, 1), (4, 50)]
    assert sorted(got[100]) == [(1, 3), (1, 100), (2, 3), (2, 100)]
    mine = n.search(df.filter("vec_id < 3"), queries=df.filter("vec_id = 50")).orderBy("rank").collect()
    assert [g["vec_id"] for g in mine] == [1, 2, 1]


def test_cases(spark):
    one = [1.0, 2.0, 2.0]
    rows = [(0, one), (1, one), (2, [2.0, 4.0, 4.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [float("nan"), 1.0, 1.0]), (6, [1.0, None, 1.0]), (7, [1.0, 1.0]), (None, one), (8, [float("inf"), 1.0, 1.0]), (9, [-1.0, 0.5, 3.0]), (1, one), (50, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<double>, score double")
    got = n.search(df).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in got if r["query_id"] == 0] == [1, 1, 2, 50, 9] and {r["query_id"] for r in got} == {0, 50}
    assert n.search(df.filter("false")).count() == 0 and n.search(df.filter("vec_id = 50")).count() == 0
    crowd = spark.createDataFrame([(i, one) for i in range(3000)] + [(5000, [1.0, 2.0, 2.1])], "vec_id long, embedding array<double>")
    best = n.search(crowd, every=1000).filter("query_id = 1000").orderBy("rank").collect()
    assert [r["vec_id"] for r in best] == [0, 1, 2, 3, 4]
