"""Centroid clustering (Lloyd's rounds) with Ptolemaic pivots, exact in integers.

A vector of ``dims`` finite components becomes the integers ``floor(scale * x)``.
Centroids start as the ``k`` vectors with the smallest SHA-256 of ``1:<vec_id>``;
every round assigns each vector to its nearest centroid (squared Euclidean
distance, ties to the smaller number) and moves every non-empty centroid to the
floor of its vectors' mean.  Vectors are assigned once more at the end.

*Ptolemaic pivots.*  For any four points d(x,c) d(p,s) >= |d(x,p) d(c,s) -
d(x,s) d(c,p)|.  The first ``PIVOTS`` starting vectors are pivots; a vector's
distances to them are computed once and staged with it.  In a round only
centroid-pivot distances are new, and every pivot pair (p, s) bounds d(x,c)
from below without looking at x.  The bound is lowered by ``SLACK``, far more
than double arithmetic can be off, so a centroid whose bound lies strictly
above the best exact distance so far can be neither nearer nor tied.  The rest
are checked in exact integers, beginning with the smallest bound.

*On Spark.*  A round is one scan of the staged vectors: a task sums its vectors
per centroid, and the sums (k * dims * 2 numbers a task, then k * dims * 2 in
all) are added exactly.  Centroids, pivots and sums are bounded by k and dims;
no vector goes to the driver but the starting ones.

Defined cases: vectors with a null, another length, or a null or non-finite
component are left out; so is nothing else: a row without ``vec_id`` is
clustered but can't be a starting vector, repeated rows count each and may
start several centroids (ties in the hash by the components); with fewer than
``k`` vectors there are as many centroids; components of more than 2^27 take a
slower path in unbounded integers, where a distance beyond a long is given as
the largest long and is exact in all comparisons; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stage

DIMS, SCALE, CLUSTERS, ROUNDS = 64, 64, 16, 3
PIVOTS = 6
SLACK = 2.0 ** -40   # relative, of the products a bound is made from
SAFE = 1 << 27       # components up to here: squared distances of 64 fit a long
LONG_MAX = (1 << 63) - 1
LIMB = 40            # bits of the pieces that wide sums travel in


def to_integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` as int64, or as Python integers where one is large."""
    y = np.floor(x.astype(np.float64) * scale)
    if not np.abs(y).max(initial=0) > SAFE:
        return y.astype(np.int64)
    out = np.empty(y.shape, object)
    out[...] = [[int(v) for v in row] for row in y.tolist()]
    return out


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired rows."""
    if a.dtype != object and b.dtype != object:
        d = a - b
        return np.einsum("ij,ij->i", d, d)
    d = a.astype(object) - b.astype(object)
    return (d * d).sum(axis=1)


def distances(a: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of every row of ``a`` to every point, as doubles."""
    return np.stack([np.sqrt(squared(a, np.broadcast_to(p, a.shape)).astype(np.float64))
                     for p in points], axis=1)


class Nearest:
    """Centroids with their distances to the pivots."""

    def __init__(self, centroids: np.ndarray, pivots: np.ndarray):
        self.centroids = centroids
        self.to_pivots = distances(centroids, pivots)
        between = distances(pivots, pivots)
        self.pairs = [(p, s, between[p, s]) for p, s in
                      itertools.combinations(range(len(pivots)), 2) if between[p, s] > 0]

    def bounds(self, to_pivots: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances, rows by centroids."""
        best = np.zeros((len(to_pivots), len(self.centroids)))
        for p, s, apart in self.pairs:
            a = to_pivots[:, p, None] * self.to_pivots[None, :, s]
            b = to_pivots[:, s, None] * self.to_pivots[None, :, p]
            np.maximum(best, (np.abs(a - b) - (a + b) * SLACK) / apart, out=best)
        return best * best * (1 - SLACK)

    def assign(self, x: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid and exact squared distance of every row, and how many
        distances were computed for it."""
        bound = self.bounds(to_pivots)
        rows = np.arange(len(x))
        cluster = bound.argmin(axis=1)
        found = squared(x, self.centroids[cluster])
        checked = len(x)
        bound[rows, cluster] = np.inf
        for c in range(len(self.centroids)):
            # a distance in double arithmetic is off by less than SLACK of it
            left = np.flatnonzero(bound[:, c] <= found.astype(np.float64) * (1 + SLACK))
            if len(left):
                d = squared(x[left], np.broadcast_to(self.centroids[c], x[left].shape))
                better = (d < found[left]) | ((d == found[left]) & (c < cluster[left]))
                won = left[better]
                if d.dtype == object and found.dtype != object:
                    found = found.astype(object)
                found[won], cluster[won] = d[better], c
                checked += len(left)
        return cluster, found, checked


def _vectors(batch: pa.RecordBatch, column: str, dims: int) -> np.ndarray:
    """The staged integers of a batch; large ones come as text."""
    col = batch.column(batch.schema.get_field_index(column))
    wide = batch.column(batch.schema.get_field_index("wide"))
    x = col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    if wide.null_count == len(wide):
        return x
    x = x.astype(object)
    for i, w in enumerate(wide.to_pylist()):
        if w is not None:
            x[i] = [int(v) for v in w.split(",")]
    return x


def _longs(found: np.ndarray) -> pa.Array:
    if found.dtype == object:
        found = [min(int(v), LONG_MAX) for v in found]
    return pa.array(found, pa.int64())


def _digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def _as_array(rows: list[list[int]]) -> np.ndarray:
    big = any(abs(v) > SAFE for r in rows for v in r)
    return np.array(rows, object if big else np.int64)


# -- Spark ------------------------------------------------------------------

def usable(vectors: DataFrame, dims: int = DIMS) -> DataFrame:
    """``vec_id`` and ``x`` of the vectors of ``dims`` finite components."""
    e = F.col("embedding")
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.where(F.coalesce((F.size(e) == dims) & ~bad, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("x"))


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS,
            scale: int = SCALE, n_pivots: int = PIVOTS) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``,
    ``inertia``, ``centroid_sha256`` and ``n_checked`` (exact distances computed
    for the batch of the row in the last assignment, per vector)."""
    spark = vectors.sparkSession
    ship(spark)
    kept = usable(vectors, dims)
    empty = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, " \
            "centroid_sha256 string, n_checked double"
    first = (kept.where("vec_id is not null")
             .withColumn("h", F.sha2(F.concat(F.lit("1:"), "vec_id").cast("binary"), 256))
             .orderBy("h", "x").limit(k).select("x").collect())
    if not first:
        return spark.createDataFrame([], empty)
    starts = to_integers(np.array([r.x for r in first]), scale)
    pivots = starts[:n_pivots]

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = to_integers(b.column(1).flatten().to_numpy(zero_copy_only=False)
                            .reshape(-1, dims), scale)
            if x.dtype == object:
                large = [any(abs(v) > SAFE for v in r) for r in x]
                wide = [",".join(map(str, r)) if w else None for r, w in zip(x, large, strict=True)]
                flat = np.array([[0] * dims if w else r for r, w in
                                 zip(x.tolist(), large, strict=True)], np.int64)
            else:
                wide, flat = [None] * len(x), x
            apart = distances(x, pivots)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), _lists(flat, pa.int64()), pa.array(wide, pa.string()),
                 _lists(apart, pa.float64())], ["vec_id", "x", "wide", "apart"])

    table = stage(kept.mapInArrow(
        prepare, "vec_id long, x array<long>, wide string, apart array<double>"), "vectors")

    def assigned(batches, nearest):
        for b in batches:
            if b.num_rows:
                x = _vectors(b, "x", dims)
                apart = b.column(3).flatten().to_numpy(zero_copy_only=False)
                yield b, x, *nearest.assign(x, apart.reshape(len(x), -1))

    def sums_of(centroids):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals, counts = {}, {}
            for _, x, cluster, _, _ in assigned(batches, Nearest(centroids, pivots)):
                for c in np.unique(cluster).tolist():
                    own = x[cluster == c]
                    # a batch's sums of safe components fit; its totals are Python integers
                    part = [int(v) for v in own.sum(axis=0)]
                    counts[c] = counts.get(c, 0) + len(own)
                    totals[c] = [a + b for a, b in zip(totals.get(c, [0] * dims), part,
                                                       strict=True)]
            rows = [(c, -1, 0, n) for c, n in counts.items()]
            rows += [(c, d, limb, v) for c, t in totals.items() for d, total in enumerate(t)
                     for limb, v in enumerate(limbs(total))]
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(col, t) for col, t in zip(cols, _SUM_TYPES, strict=True)],
                ["c", "d", "limb", "v"])
        return run

    centroids = starts
    for _ in range(rounds):
        # k * (dims * limbs + 1) rows at most
        sums = (table.mapInArrow(sums_of(centroids), "c int, d int, limb int, v long")
                .groupBy("c", "d", "limb").agg(F.sum("v").alias("v")).collect())
        counts = {r.c: r.v for r in sums if r.d < 0}
        totals: dict[tuple[int, int], int] = {}
        for r in sums:
            if r.d >= 0:
                totals[r.c, r.d] = totals.get((r.c, r.d), 0) + (r.v << (LIMB * r.limb))
        centroids = _as_array([
            [totals.get((c, d), 0) // counts[c] for d in range(dims)] if c in counts
            else centroids[c].tolist() for c in range(len(centroids))])

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([_digest(c) for c in centroids], object)
        for b, _, cluster, found, checked in assigned(batches, Nearest(centroids, pivots)):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cluster.astype(np.int32)), _longs(found),
                 pa.array(names[cluster], pa.string()),
                 pa.array(np.full(len(cluster), checked / len(cluster)))],
                ["vec_id", "cluster", "distance", "centroid_sha256", "n_checked"])

    out = stage(table.mapInArrow(final, "vec_id long, cluster int, distance long, "
                                 "centroid_sha256 string, n_checked double"), "clusters")
    total = out.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(28,0)")).cast("decimal(28,0)").alias("s"))
    most = F.lit(LONG_MAX).cast("decimal(38,0)")
    whole = F.sum("s").over(Window.partitionBy())  # of k rows
    inertia = total.select("cluster", F.least("s", most).cast("long").alias("cluster_inertia"),
                           F.least(whole, most).cast("long").alias("inertia"))
    return out.join(F.broadcast(inertia), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256",
        "n_checked")


_SUM_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]


def limbs(value: int) -> list[int]:
    """``value`` in pieces of ``LIMB`` bits, the last one signed; zero has none."""
    out = []
    while value not in (0, -1):
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return out + [-1] if value else out


def _lists(rows: np.ndarray, t: pa.DataType) -> pa.Array:
    offsets = np.arange(0, rows.size + 1, rows.shape[1] if rows.ndim > 1 else 1, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1), t))
