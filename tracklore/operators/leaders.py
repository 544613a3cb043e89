"""Leader clustering of places, in rounds over tiles of the map, with the result of one pass in order.

Rule: points come in order of ``seq``; each joins the first cluster, by creation, whose centre lies within the radius, and moves
that centre to the mean of its points; a point near no centre starts a cluster. A mean of places is the direction of the sum of
their unit vectors, so neither the date line nor a pole matters.

How it is spread: the centre that a point joins, and so the last point that joined it, lie within twice the radius. A tile of the
map therefore needs its own points and those up to twice the radius around it, and goes through them in order. What it does not
know is which clusters the points around it belong to: it takes the answers of the round before. Likewise a tile with very many
points is cut into blocks of ``seq``, and a block starts from the clusters as the round before left them. Centres are
sums over each cluster's points up to a place in the order, which Spark makes from the answers of all tiles. When a round
changes no answer, every point has been measured against the right centres, by induction over ``seq``, so the answers are those of
the sequential pass. Each round settles at least the first unsettled point; tiles that nothing changed around are not gone
through again, and a tile alone on the map is done in the first round.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklore.functions.geo import EARTH_M, unit_vector
from tracklore.operators.graph import stored

#: Width of a tile, in radii.
TILE_RADII = 64
#: A tile with more points is cut into blocks of seq: one for every TILE_POINTS of the table, and at most BUCKETS. In a dense part each round
#: settles little more than a block, so blocks are as long as a task goes through in some seconds.
TILE_POINTS = 1_000_000
BUCKETS = 128
#: Points that are guessed at once, and how often a guess is looked at again.
FIRST_RUN, LONGEST_RUN, LOOKS = 256, 4096, 8

SUM = ["sx", "sy", "sz", "n"]
_OUT = "seq long, latitude double, longitude double, x double, y double, z double, bucket int, ti long, tj long, tk long, kind int, cluster long, old_kind int, old_cluster long"
_ROW = dict.fromkeys(("vi", "vj", "vk", "seq", "ti", "tj", "tk", "cluster"), "long") | dict.fromkeys(("block", "stage", "bucket", "kind"), "int") | dict.fromkeys(("latitude", "longitude", "x", "y", "z", *SUM), "double")
_CARRIED = ["seq", "latitude", "longitude", "x", "y", "z", "bucket", "ti", "tj", "tk"]


class _Centres:
    """Clusters near one tile; a grid of cells finds those near a point.

    Points come one at a time, or as a run. A run is guessed and checked: clusters are guessed for all its points, from which
    follow the exact centres before each point, and from these the clusters again. Up to the first point where both differ, and
    with it, they are those of the one by one way, by induction. In dense parts, where centres hardly move any more, a second or third
    look agrees everywhere.
    """

    def __init__(self, radius: float):
        self.reach = 2 * EARTH_M * math.sin(min(radius / (2 * EARTH_M), math.pi / 2))
        # cells are wider than the reach, so that the 27 around a point still hold all it can meet when centres have moved by slack
        self.slack = self.reach / 4
        self.step = (self.reach + self.slack) * 1.000001 + 1e-8
        self.sums: dict[tuple[int, int], tuple] = {}
        self.places: dict[tuple[int, int], tuple] = {}
        self.cells: dict[tuple[int, int, int], set] = {}
        self.near: dict[tuple[int, int, int], list] = {}
        self.size, self.wait, self.alone, self.groups = FIRST_RUN, 0, FIRST_RUN, 0

    def put(self, own: tuple[int, int], x: float, y: float, z: float, n: float) -> None:
        """The cluster's sum of vectors is (x, y, z), of n points."""
        scale = EARTH_M / (math.sqrt(x * x + y * y + z * z) or 1.0)
        place = (x * scale, y * scale, z * scale)
        cell = tuple(math.floor(v / self.step) for v in place)
        before = self.places.get(own)
        if before is None or before[1] != cell:
            if before is not None:
                self.cells[before[1]].discard(own)
            self.cells.setdefault(cell, set()).add(own)
            self.near.clear()
        self.sums[own], self.places[own] = (x, y, z, n), (place, cell)

    def around(self, cell: tuple[int, int, int]) -> list[tuple[int, int]]:
        """Clusters in the cell and the 26 beside it, in order of creation."""
        found = self.near.get(cell)
        if found is None:
            i, j, k = cell
            found = self.near[cell] = sorted(own for a in (i - 1, i, i + 1) for b in (j - 1, j, j + 1) for c in (k - 1, k, k + 1) for own in self.cells.get((a, b, c), ()))
        return found

    def add(self, seq: int, x: float, y: float, z: float) -> tuple[int, int]:
        """The cluster that the point joins."""
        for best in self.around(tuple(math.floor(v / self.step) for v in (x, y, z))):
            (u, v, w), _ = self.places[best]
            if (u - x) ** 2 + (v - y) ** 2 + (w - z) ** 2 <= self.reach**2:
                sx, sy, sz, n = self.sums[best]
                self.put(best, sx + x, sy + y, sz + z, n + 1)
                return best
        self.put((1, seq), x, y, z, 1)
        return (1, seq)

    def add_all(self, seqs: np.ndarray, xyz: np.ndarray) -> list[tuple[int, int]]:
        """The clusters that the points join, one after the other."""
        out: list[tuple[int, int]] = []
        while (at := len(out)) < len(seqs):
            if self.wait or len(seqs) - at < FIRST_RUN:
                # guesses failed, or there is little to guess: points one at a time, for longer after each failure
                out.append(self.add(int(seqs[at]), *xyz[at].tolist()))
                self.wait = max(self.wait - 1, 0)
                continue
            tried = xyz[at : at + self.size]
            done = self._guess(tried)
            out += done
            if len(done) == len(tried):
                self.size = min(2 * self.size, LONGEST_RUN)
            else:
                self.size = max(FIRST_RUN, min(self.size, 2 * len(done)))
            if 2 * len(done) >= FIRST_RUN + 4 * self.groups:
                self.alone, self.wait = FIRST_RUN, int(len(done) < len(tried))
            else:
                self.alone = self.wait = min(2 * self.alone, 8 * LONGEST_RUN)
        return out

    def _guess(self, xyz: np.ndarray) -> list[tuple[int, int]]:
        """Clusters of the first points of a run, as far as they can be told at once: up to one that starts a cluster, or moves a
        centre by more than the slack. The sums are then those after these points."""
        cells, which = np.unique(np.floor(xyz / self.step), axis=0, return_inverse=True)
        lists = [self.around((int(i), int(j), int(k))) for i, j, k in cells.tolist()]
        names = sorted({own for one in lists for own in one})
        if not names:
            return []
        self.groups = len(names)
        number = {own: i for i, own in enumerate(names)}
        # candidates of each cell in order of creation, padded with a place that nothing is near
        table = np.full((len(lists), max(map(len, lists))), len(names))
        for i, one in enumerate(lists):
            table[i, : len(one)] = [number[own] for own in one]
        candidates = table[which.reshape(-1)]
        places = np.array([self.places[own][0] for own in names] + [(np.inf,) * 3])
        apart = np.sqrt(sum((places[candidates, i] - xyz[:, i, None]) ** 2 for i in range(3)))
        within = apart <= self.reach
        off = np.abs(apart - self.reach)
        start = np.array([self.sums[own] for own in names])
        every = np.arange(len(xyz))

        def first(hits: np.ndarray) -> np.ndarray:
            """Of each point the first candidate that it is within reach of, or -1."""
            place = hits.argmax(axis=1)
            return np.where(hits[every, place], candidates[every, place], -1)

        guess, good = first(within), 0
        for _ in range(LOOKS):
            # points by cluster and order, and each cluster's sums after 0, 1, .. of them, one addition after the other
            order = np.argsort(guess, kind="stable")
            order = order[np.searchsorted(guess[order], 0) :]
            groups, begins, counts = np.unique(guess[order], return_index=True, return_counts=True)
            moved, early = np.zeros(len(names) + 1), len(xyz)
            traces = {}
            for c, a, b in zip(groups.tolist(), begins.tolist(), (begins + counts).tolist(), strict=True):
                sums = np.cumsum(np.vstack([start[c, :3], xyz[order[a:b]]]), axis=0)
                norm = np.sqrt((sums * sums).sum(axis=1))
                centres = sums * (EARTH_M / np.where(norm == 0, 1.0, norm))[:, None]
                far = np.sqrt(((centres - places[c]) ** 2).sum(axis=1))
                moved[c] = far.max()
                if moved[c] > self.slack:
                    early = min(early, int(order[a:b][np.argmax(far > self.slack) - 1]) + 1)
                traces[c] = (order[a:b], sums, centres)
            # only pairs that are about a reach apart can differ from the guess by where the centres stood at first
            points, columns = np.nonzero(off <= moved[candidates] + 1e-6)
            hits, own = within.copy(), candidates[points, columns]
            for c, (members, _, centres) in traces.items():
                mine = own == c
                if mine.any():
                    p = points[mine]
                    at = centres[np.searchsorted(members, p)]  # after the members before p
                    hits[p, columns[mine]] = ((at - xyz[p]) ** 2).sum(axis=1) <= self.reach**2
            again = first(hits)
            differ = again != guess
            same = int(differ.argmax()) if differ.any() else len(xyz)
            none = again < 0
            stop = min(int(none.argmax()) if none.any() else len(xyz), early)
            good = min(same, stop)
            if same >= stop:
                break
            guess = again
        for c, (members, sums, _) in traces.items():
            n = int(np.searchsorted(members, good))
            if n:
                self.put(names[c], *sums[n].tolist(), float(start[c, 3] + n))
        return [names[c] for c in (again[:good]).tolist()]


def _walk(radius: float):
    """Rows in order of tile, block and seq: own points get a cluster, others and those of earlier rounds tell where centres are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit, centres = None, _Centres(radius)
        for rows in batches:
            found: list[tuple[int, int]] = []
            units, own = rows[["vi", "vj", "vk", "block"]].to_numpy(), rows["own"].to_numpy(bool)
            seqs, xyz = rows["seq"].to_numpy(), rows[["x", "y", "z"]].to_numpy()
            names, sums = rows[["kind", "cluster"]].to_numpy(), rows[SUM].to_numpy()
            ends = np.flatnonzero((units[1:] != units[:-1]).any(axis=1) | (own[1:] != own[:-1])) + 1
            for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(rows)], strict=True):
                if a == b:
                    continue
                if (one := tuple(units[a].tolist())) != unit:
                    unit, centres = one, _Centres(radius)
                if own[a]:
                    found += centres.add_all(seqs[a:b], xyz[a:b])
                else:
                    for name, (sx, sy, sz, n) in zip(names[a:b].tolist(), sums[a:b].tolist(), strict=True):
                        if n > 0:
                            centres.put(tuple(name), sx, sy, sz, n)
            mine = rows[own]
            out = mine[_CARRIED].copy()
            out["bucket"], out["kind"], out["cluster"] = out["bucket"].astype("int32"), np.array([k for k, _ in found], "int32"), np.array([c for _, c in found], "int64")
            out["old_kind"], out["old_cluster"] = mine["kind"].astype("int32"), mine["cluster"]
            yield out

    return run


def _bucket(ends: list[float]) -> Column:
    """Number of the interval of seq, a binary search in one expression."""
    if not ends:
        return F.lit(0)

    def pick(a: int, b: int) -> Column:
        if a == b:
            return F.lit(a)
        mid = (a + b) // 2
        return F.when(F.col("seq") < ends[mid], pick(a, mid)).otherwise(pick(mid + 1, b))

    return pick(0, len(ends))


def _tile(c: str, width: float, shift: float = 0.0) -> Column:
    return F.floor((F.col(c) + shift) / width)


def _seen(rows: DataFrame, width: float, reach: float) -> DataFrame:
    """Each row in its own tile and, with own false, in those whose border is within reach: tile (vi, vj, vk)."""
    sides = [F.array_distinct(F.array(*[_tile(c, width, d) for d in (-reach, 0.0, reach)])) for c in "xyz"]
    out = rows
    for name, side in zip(("vi", "vj", "vk"), sides, strict=True):
        out = out.withColumn(name, F.explode(side))
    return out.withColumn("own", (F.col("vi") == F.col("ti")) & (F.col("vj") == F.col("tj")) & (F.col("vk") == F.col("tk")) & (F.col("bucket") >= 0))


def _with_sums(rows: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """Each row with its cluster's sum of vectors up to and with itself. A cluster's rows are summed by bucket first, so a hot
    cluster is many groups; earlier clusters bring a sum of their own, as bucket -1."""
    parts = rows.filter("kind IS NOT NULL").groupBy("kind", "cluster", "bucket").agg(F.sum("x").alias("bx"), F.sum("y").alias("by"), F.sum("z").alias("bz"), F.count("*").cast("double").alias("bn"))
    if earlier is not None:
        parts = parts.unionByName(earlier.select("kind", "cluster", F.lit(-1).alias("bucket"), F.col("sx").alias("bx"), F.col("sy").alias("by"), F.col("sz").alias("bz"), F.col("n").alias("bn")))
    ahead = Window.partitionBy("kind", "cluster").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("kind", "cluster", "bucket", *[F.coalesce(F.sum(b).over(ahead), F.lit(0.0)).alias(f"_{b}") for b in ("bx", "by", "bz", "bn")])
    upto = Window.partitionBy("kind", "cluster", "bucket").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(base, ["kind", "cluster", "bucket"], "left")
    one = {"sx": "x", "sy": "y", "sz": "z"}
    return joined.select(*rows.columns, *[(F.col(f"_b{c}") + F.sum(c).over(upto)).alias(s) for s, c in one.items()], (F.col("_bn") + F.count("seq").over(upto)).alias("n"))


def _every(rows: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """Rows with sums, and the earlier clusters among them."""
    summed = _with_sums(rows, earlier)
    return summed if earlier is None else summed.unionByName(earlier)


def _starts(seen: DataFrame) -> DataFrame:
    """For each block of a cut tile, where the clusters that are seen there stood when it began: the last sum before it, once
    for each later block up to the cluster's next row."""
    last = seen.filter("hot AND n IS NOT NULL").groupBy("vi", "vj", "vk", "begin", "kind", "cluster", F.col("bucket").alias("at")).agg(F.max_by(F.struct(*SUM), "seq").alias("s"))
    follow = F.lead("at").over(Window.partitionBy("vi", "vj", "vk", "kind", "cluster").orderBy("at"))
    until = last.withColumn("until", F.coalesce(follow, F.lit(BUCKETS))).withColumn("from", F.greatest(F.col("at") + 1, F.col("begin"))).filter("until >= from")
    return until.select("vi", "vj", "vk", F.explode(F.sequence("from", "until")).alias("block"), "kind", "cluster", "s.*")


def leader_clusters(points: DataFrame, radius: float = 5.0, earlier: DataFrame | None = None, tile_points: int = TILE_POINTS) -> DataFrame:
    """points(seq, latitude, longitude), in order of seq, which is unique: adds ``cluster``, the seq of the cluster's first point.

    earlier(cluster, latitude, longitude, point_count): clusters of earlier runs, in order of ``cluster``; points join them and
    move their centres as if their points had come first. Rows without place or seq are left out.
    """
    placed = points.filter("latitude IS NOT NULL AND longitude IS NOT NULL AND seq IS NOT NULL").select(F.col("seq").cast("long").alias("seq"), F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"))
    width, reach = TILE_RADII * radius, 2 * radius * 1.000001 + 1e-6
    tile = [_tile(c, width).alias(t) for c, t in zip("xyz", ("ti", "tj", "tk"), strict=True)]
    vectors = lambda df: df.select("*", *[(v * EARTH_M).alias(c) for c, v in zip("xyz", unit_vector(F.col("latitude"), F.col("longitude")), strict=True)])
    own = vectors(placed)
    buckets = min(BUCKETS, -(-placed.count() // tile_points))
    ends = sorted(set(placed.approxQuantile("seq", [i / buckets for i in range(1, buckets)], 0.1 / buckets))) if buckets > 1 else []
    own = own.withColumn("bucket", _bucket(ends).cast("int"))
    current = stored(own.select("seq", "latitude", "longitude", "x", "y", "z", "bucket", *tile, F.lit(None).cast("int").alias("kind"), F.lit(None).cast("long").alias("cluster")))
    before = None
    if earlier is not None:
        e = vectors(earlier.filter("latitude IS NOT NULL AND longitude IS NOT NULL AND cluster IS NOT NULL").select(F.col("cluster").cast("long").alias("seq"), "latitude", "longitude", F.col("point_count").cast("double").alias("n")))
        before = stored(e.select("seq", "latitude", "longitude", "x", "y", "z", F.lit(-1).alias("bucket"), *tile, F.lit(0).alias("kind"), F.col("seq").alias("cluster"), *[(F.col(c) * F.col("n")).alias(f"s{c}") for c in "xyz"], "n"))
    cut = bool(ends)
    if cut:
        hot = current.groupBy("ti", "tj", "tk").agg(F.count("*").alias("n"), F.min("bucket").alias("first")).filter(F.col("n") > tile_points)
        # at most one row for every tile_points rows
        hot = stored(hot.select(F.col("ti").alias("vi"), F.col("tj").alias("vj"), F.col("tk").alias("vk"), "first", F.lit(True).alias("hot")))
        cut = not hot.isEmpty()

    def seen_of(rows: DataFrame) -> DataFrame:
        views = _seen(rows, width, reach)
        if cut:
            views = views.join(hot, ["vi", "vj", "vk"], "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
        else:
            views = views.withColumn("hot", F.lit(False)).withColumn("first", F.lit(0))
        return views.withColumn("block", F.when(F.col("hot"), F.col("bucket")).otherwise(0))

    def walk(seen: DataFrame) -> DataFrame:
        events = seen.filter("NOT hot OR bucket >= begin AND bucket >= 0").withColumn("stage", (F.col("bucket") >= 0).cast("int"))
        if cut:
            events = events.unionByName(_starts(seen).withColumn("stage", F.lit(0)).withColumn("own", F.lit(False)), allowMissingColumns=True)
        # a row without a cluster has kind -1; no column is null, so that whole numbers stay whole in pandas
        whole = [F.coalesce(F.col(c), F.lit(-1 if c == "kind" else 0).cast(kind)).alias(c) for c, kind in _ROW.items()]
        dealt = events.select("own", *whole).repartition("vi", "vj", "vk", "block")
        order = ["vi", "vj", "vk", "block", "stage", "seq"]
        return dealt.sortWithinPartitions(*order).mapInPandas(_walk(radius), _OUT)

    columns = current.columns
    fresh = [F.lit(None).cast("double").alias(s) for s in SUM]
    first = seen_of(current.select("*", *fresh)) if before is None else seen_of(current.select("*", *fresh).unionByName(before))
    # a first answer: tiles by themselves, cut tiles by their first block
    answered = stored(walk(first.filter("(own OR bucket < 0) AND (NOT hot OR bucket <= first)").withColumn("begin", F.lit(-1))))
    if cut:
        rest = seen_of(current.select("*", *fresh)).filter("own AND hot AND bucket > first").select(columns)
        current = stored(answered.select(columns).unionByName(rest))
    else:
        current = answered.select(columns)
    # tiles that see rows of other tiles, or of other blocks, are gone through until nothing changes
    changed = None
    while True:
        if changed is None:
            touched = seen_of(current)
        else:
            touched = seen_of(current).join(changed, ["kind", "cluster"]).filter("bucket >= since")
        # what comes before a change in a cut tile stays as it is
        begin = F.min(F.when(F.col("hot"), F.col("bucket")).otherwise(-1)).alias("begin")
        active = stored(touched.filter("bucket >= 0 AND (hot OR NOT own)").groupBy("vi", "vj", "vk").agg(begin))
        if active.isEmpty():
            return current.select("seq", "latitude", "longitude", "cluster")
        answered = stored(walk(seen_of(_every(current, before)).join(active, ["vi", "vj", "vk"])))
        moved = answered.filter("kind <> old_kind OR cluster <> old_cluster")
        labels = moved.select("kind", "cluster", "bucket").union(moved.filter("old_kind >= 0").select("old_kind", "old_cluster", "bucket"))
        changed = stored(labels.groupBy("kind", "cluster").agg(F.min("bucket").alias("since")))
        if changed.isEmpty():
            return current.select("seq", "latitude", "longitude", "cluster")
        kept = current.join(active.select(F.col("vi").alias("ti"), F.col("vj").alias("tj"), F.col("vk").alias("tk"), "begin"), ["ti", "tj", "tk"], "left").filter("begin IS NULL OR bucket < begin")
        current = stored(answered.select(columns).unionByName(kept.select(columns)))
