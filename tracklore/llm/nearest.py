"""Approximate nearest neighbours by cosine: score-aware (anisotropic) quantisation, four-bit tables, exact reranking.

Vectors are brought to length one and cut into pairs of components; each pair is coded by one of 16 centres. Codes and
centres minimise |r|^2 + (ETA - 1) * (r . x)^2 for the residual r of the vector x, since the part of a residual parallel to its
vector disturbs large inner products most. A query's inner products with all centres form tables; summing table entries
by code, two codes to a byte, gives a rough score of every row. Rows whose rough score comes within ``MARGIN`` residual
deviations of the best k exact scores are scored exactly, however many they are. Exact scores are cosines of the original
vectors, each summed by itself in one fixed order, so that equal vectors have equal scores wherever they lie.

Defined cases: vectors that are null, zero, or hold a null or non-finite component take no part, nor do rows with a null id;
vectors meet those of their own length only; each row is a candidate and each row with a fitting id a query, also where ids
repeat (a query leaves out its own row alone); ties go to the smaller id; a query with fewer candidates gets all of them; an
empty table gives an empty result. Extra columns are not read.

Scale: centres are fitted on a bounded sample (``max_sample`` rows of each length, smallest hash first). Every row is indexed
where it lies, in packs of a few thousand, equal vectors of a pack once; queries go out in blocks of ``BLOCK`` (a bounded
broadcast), each scanned over all packs in parallel; only the k best of each query and pack are shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracklore.llm.common import materialise, table

CENTRES = 16
#: Weight of the parallel residual; for inner products over 0.2 of the largest in 64 dimensions.
ETA = 2.6
MARGIN = 3.0
BLOCK = 4_096
#: Queries scored together inside a task.
TILE = 256
PACK = 8_192


class Codebook:
    """centres: pairs x CENTRES x 2."""

    def __init__(self, centres: np.ndarray, dim: int):
        self.centres, self.dim = centres, dim

    def pairs(self, x: np.ndarray) -> np.ndarray:
        if x.shape[1] < 2 * len(self.centres):
            x = np.pad(x, ((0, 0), (0, 2 * len(self.centres) - x.shape[1])))
        return x.reshape(len(x), len(self.centres), 2)

    def encode(self, x: np.ndarray, sweeps: int = 2) -> np.ndarray:
        """A code per vector and pair. x: unit vectors."""
        v = self.pairs(x)
        codes = np.stack([((v[:, m, None, :] - c[None]) ** 2).sum(2).argmin(1) for m, c in enumerate(self.centres)], axis=1).astype(np.uint8)
        along = sum(((v[:, m] - c[codes[:, m]]) * v[:, m]).sum(1) for m, c in enumerate(self.centres)) if len(self.centres) else np.zeros(len(x))
        for _ in range(sweeps):
            for m, c in enumerate(self.centres):
                r = v[:, m, None, :] - c[None]
                own = (r * v[:, m, None, :]).sum(2)
                rest = along - own[np.arange(len(x)), codes[:, m]]
                codes[:, m] = ((r**2).sum(2) + (ETA - 1) * (rest[:, None] + own) ** 2).argmin(1)
                along = rest + own[np.arange(len(x)), codes[:, m]]
        return codes

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([c[codes[:, m]] for m, c in enumerate(self.centres)], axis=1)[:, : self.dim]


def fit(x: np.ndarray, rounds: int = 6, seed: int = 3) -> Codebook:
    """Alternate codes and centres on unit vectors."""
    n, d = x.shape
    v = np.pad(x, ((0, 0), (0, d % 2))).reshape(n, -1, 2)
    rng = np.random.default_rng(seed)
    centres = np.stack([v[rng.choice(n, CENTRES, replace=n < CENTRES), m] for m in range(v.shape[1])])
    book = Codebook(centres, d)
    for _ in range(4):  # plain rounds first
        for m in range(len(centres)):
            near = ((v[:, m, None, :] - centres[m][None]) ** 2).sum(2).argmin(1)
            size = np.bincount(near, minlength=CENTRES)
            sums = np.stack([np.bincount(near, v[:, m, j], CENTRES) for j in (0, 1)], 1)
            centres[m] = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres[m])
    for _ in range(rounds):
        codes = book.encode(x)
        along = sum(((v[:, m] - c[codes[:, m]]) * v[:, m]).sum(1) for m, c in enumerate(centres))
        for m in range(len(centres)):
            p, k = v[:, m], codes[:, m]
            own = ((p - centres[m][k]) * p).sum(1)
            rest = along - own
            pull = p + (ETA - 1) * (rest + (p * p).sum(1))[:, None] * p
            right = np.stack([np.bincount(k, pull[:, j], CENTRES) for j in (0, 1)], 1)
            left = np.stack([[np.bincount(k, p[:, i] * p[:, j], CENTRES) for j in (0, 1)] for i in (0, 1)]).transpose(2, 0, 1) * (ETA - 1)
            size = np.bincount(k, minlength=CENTRES)
            left += size[:, None, None] * np.eye(2) + 1e-9 * np.eye(2)
            centres[m] = np.where(size[:, None] > 0, np.linalg.solve(left, right[:, :, None])[:, :, 0], centres[m])
            along = rest + ((p - centres[m][k]) * p).sum(1)
    return book


def _usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and vector (array<double>) of the rows that take part, but for their length."""
    v = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")).filter("vec_id IS NOT NULL AND vector IS NOT NULL")
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    return v.filter(F.coalesce(good, F.lit(False)))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that no square overflows; this changes no cosine."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / _norms(x)[:, None]


def cosines(x: np.ndarray, norms: np.ndarray, q: np.ndarray, norm: float) -> np.ndarray:
    """Cosine of each row with q; a row's value does not depend on the rows beside it."""
    return (x * q).sum(1) / (norms * norm)


PACKS = "pack long, ids array<long>, starts array<int>, vectors binary, codes binary, deviation double"


def build_index(vectors: DataFrame, dim: int, max_sample: int = 20_000, pack: int = PACK) -> tuple[Codebook, DataFrame]:
    """The codebook, and packs over all rows, written to the shared folder: the distinct vectors, their codes two to a byte,
    and the ids of the rows that have them (those of vector i start at starts[i], in order)."""
    sample = vectors.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(max_sample).toPandas()
    book = fit(_unit(np.stack(sample["vector"])))
    shared = vectors.sparkSession.sparkContext.broadcast(book)

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, pack):
                part = batch.slice(at, pack)
                x = np.ascontiguousarray(np.asarray(part.column("vector").flatten(), np.float64).reshape(-1, dim))
                _, first, which = np.unique(x.view(f"V{8 * dim}").ravel(), return_index=True, return_inverse=True)
                ids = np.asarray(part.column("vec_id"), np.int64)
                order = np.lexsort((ids, which))
                starts = np.searchsorted(which[order], np.arange(len(first)))
                x = _scaled(x[first])
                codes = shared.value.encode(_unit(x))
                if codes.shape[1] % 2:
                    codes = np.pad(codes, ((0, 0), (0, 1)))
                deviation = np.sqrt(((_unit(x) - shared.value.decode(codes)) ** 2).sum(1) / dim)
                packed = (codes[:, 0::2] << 4) | codes[:, 1::2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([ids[order]], pa.list_(pa.int64())), pa.array([starts], pa.list_(pa.int32())), pa.array([x.tobytes()], pa.binary()), pa.array([packed.T.tobytes()], pa.binary()), pa.array([float(deviation.max())])],
                    names=["pack", "ids", "starts", "vectors", "codes", "deviation"],
                )
                number += 1

    return book, materialise(vectors.mapInArrow(run, PACKS))


def _scan(x: np.ndarray, packed: np.ndarray, starts: np.ndarray, ids: np.ndarray, deviation: float, book: Codebook, queries: np.ndarray, own: np.ndarray, k: int):
    """The k best rows of one pack for each query: (query, id, exact score). own: the query's row in this pack, or -1."""
    out = []
    norms = _norms(x)
    lengths = np.diff(np.append(starts, len(ids)))
    for at in range(0, len(queries), TILE):
        q = queries[at : at + TILE]
        q_norms = _norms(q)
        tables = np.einsum("qmj,mcj->qmc", book.pairs(q / q_norms[:, None]), book.centres).astype(np.float32)
        if tables.shape[1] % 2:
            tables = np.pad(tables, ((0, 0), (0, 1), (0, 0)))
        rough = np.zeros((len(q), len(x)), np.float32)
        for m, byte in enumerate(packed):
            two = (tables[:, 2 * m, :, None] + tables[:, 2 * m + 1, None, :]).reshape(len(q), 256)
            rough += two[:, byte]
        first = min(len(x), 8 * k + 1)
        top = np.argpartition(-rough, first - 1, axis=1)[:, :first]
        for i in range(len(q)):
            # one more than k, since one of these vectors may be the query's own row
            exact = cosines(x[top[i]], norms[top[i]], q[i], q_norms[i])
            floor = np.partition(exact, -k - 1)[-k - 1] if len(exact) > k + 1 else -np.inf
            near = np.flatnonzero(rough[i] >= floor - MARGIN * deviation)
            score = cosines(x[near], norms[near], q[i], q_norms[i])
            if len(near) > k + 1:
                good = score >= np.partition(score, -k - 1)[-k - 1]
                near, score = near[good], score[good]
            # the first k + 1 rows of each vector, smaller ids first
            take = np.minimum(lengths[near], k + 1)
            rows = np.repeat(starts[near] - np.cumsum(take) + take, take) + np.arange(take.sum())
            score = np.repeat(score, take)
            other = rows != own[at + i]
            rows, score = rows[other], score[other]
            best = np.lexsort((ids[rows], -score))[:k]
            out += [(at + i, ids[rows[b]], score[b]) for b in best]
    return out


def _packed_queries(packs: DataFrame, every: int) -> DataFrame:
    """pack, row, vec_id and vector of the rows of all packs whose id is divisible by ``every``."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, starts = np.asarray(batch.column("ids")[i].values), np.asarray(batch.column("starts")[i].values)
                x = np.frombuffer(batch.column("vectors")[i].as_py(), np.float64).reshape(len(starts), -1)
                rows = np.flatnonzero(ids % every == 0)
                which = np.searchsorted(starts, rows, side="right") - 1
                pack = batch.column("pack")[i].as_py()
                yield pa.RecordBatch.from_arrays([pa.array([pack] * len(rows), pa.int64()), pa.array(rows, pa.int32()), pa.array(ids[rows]), pa.array([x[j].tobytes() for j in which], pa.binary())], names=["pack", "row", "vec_id", "vector"])

    return packs.mapInArrow(run, "pack long, row int, vec_id long, vector binary")


def _search_length(vectors: DataFrame, queries: DataFrame | None, dim: int, k: int, every: int, pack: int) -> list[DataFrame]:
    """Hits (query, query_id, vec_id, score) among the vectors of one length, a table per block of queries."""
    spark = vectors.sparkSession
    book, packs = build_index(vectors, dim, pack=pack)
    if queries is None:
        asked = materialise(_packed_queries(packs, every))
    else:
        # a table of its own: its rows lie in no pack
        as_bytes = F.pandas_udf(lambda v: v.map(lambda x: _scaled(np.array([x], np.float64)).tobytes()), "binary")
        asked = materialise(queries.select(F.lit(-1).cast("long").alias("pack"), F.monotonically_increasing_id().alias("row"), "vec_id", as_bytes("vector").alias("vector")))
    blocks = max(1, -(-asked.count() // (BLOCK // 2)))
    shared_book = spark.sparkContext.broadcast(book)
    found = []
    for block in range(blocks):
        own = (asked.filter(F.pmod(F.xxhash64("pack", "row"), F.lit(blocks)) == block) if blocks > 1 else asked).orderBy("vec_id", "pack", "row").toPandas()
        if not len(own):
            continue
        q = np.frombuffer(b"".join(own["vector"]), np.float64).reshape(-1, dim)
        shared = spark.sparkContext.broadcast((own["pack"].to_numpy(np.int64), own["row"].to_numpy(np.int64), own["vec_id"].to_numpy(np.int64), q))

        def run(batches, shared=shared):
            query_pack, query_row, query_ids, q = shared.value
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, starts = np.asarray(batch.column("ids")[i].values), np.asarray(batch.column("starts")[i].values)
                    x = np.frombuffer(batch.column("vectors")[i].as_py(), np.float64).reshape(-1, dim)
                    packed = np.frombuffer(batch.column("codes")[i].as_py(), np.uint8).reshape(-1, len(x))
                    mine = np.where(query_pack == batch.column("pack")[i].as_py(), query_row, -1)
                    hits = _scan(x, packed, starts, ids, batch.column("deviation")[i].as_py(), shared_book.value, q, mine, k)
                    at = [h[0] for h in hits]
                    key = pa.array([f"{p}:{r}" for p, r in zip(query_pack[at], query_row[at], strict=True)], pa.string())
                    yield pa.RecordBatch.from_arrays([key, pa.array(query_ids[at], pa.int64()), pa.array([int(h[1]) for h in hits], pa.int64()), pa.array([float(h[2]) for h in hits], pa.float64())], names=["query", "query_id", "vec_id", "score"])

        hits = packs.mapInArrow(run, "query string, query_id long, vec_id long, score double")
        found.append(materialise(hits) if blocks > 1 else hits)
    return found


def search(embeddings: DataFrame, queries: DataFrame | None = None, k: int = 5, every: int = 50, pack: int = PACK) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows found for each query.

    embeddings(vec_id, embedding). queries: by default the rows whose vec_id is divisible by ``every``; else a table of the same
    columns, none of whose rows counts as one of embeddings.
    """
    spark = embeddings.sparkSession
    vectors = _usable(embeddings)
    asked = None if queries is None else _usable(queries)
    found: list[DataFrame] = []
    for r in vectors.groupBy(F.size("vector").alias("n")).count().orderBy("n").collect():
        of_length = lambda v, n=r["n"]: v.filter(F.size("vector") == n)
        found += _search_length(of_length(vectors), None if asked is None else of_length(asked), r["n"], k, every, pack)
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
