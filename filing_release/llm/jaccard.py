"""N-gram Jaccard join with a count-vector R-tree.

A document's set is its distinct 5-word shingles (lower-cased A-Z; with fewer
words the whole sequence is one shingle).  Two documents link when
``100 * |A and B| >= percent * |A or B|``.

*Index.*  Shingles are hashed into ``GROUPS`` groups; a set is the point of its
group counts.  ``sum(min(x_g, y_g))`` bounds the overlap of two sets from
above, and for an R-tree node the coordinate maxima of its box bound it for
all points below.  Pairs that survive the bound are verified on the sets.

*Distribution.*  Sets that are equal are one class (its smallest doc_id stands
for it), so copies cost nothing further.  Points are dealt to blocks: classes
whose sets agree to ``percent`` share one of the first
``n - ceil(percent * n / 100) + 1`` shingles in any fixed order, so they meet in
the block of that shingle.  The order puts frequent shingles last (the
``HOT`` most frequent of those in over about 0.3 % of the sets), which keeps
blocks of boilerplate away; the order changes cost, never results.

Blocks with the same members (the shingles of one shared passage) are one.

*No pairs within a group.*  First each block's smallest member is tried with
every other member: a linear number of pairs, which already joins groups of
near copies into components.  Only blocks that still hold several components
are searched with an R-tree, for pairs between components.  Links inside one
component would change nothing and are not enumerated.

Defined cases: null text, or text without words: empty set, linked with
nothing; rows sharing a ``doc_id`` share a component; an empty table gives an
empty result.  Shingles are compared as 64-bit hashes and classes as 64-bit
hash and size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (if_small, lower_words, map_rows, ship, signed, stage, window_hashes,
                     with_id, word_hashes)
from .graph import components

SHINGLE = 5
PERCENT = 80
GROUPS = 512         # of a point; the tree adds them up to COARSE
COARSE = 64
HOT = 100_000        # shingles ordered last, at most
CHUNK = 1_000_000    # shingles counted together when looking for frequent ones
HOT_IN_CHUNK = 6
SALTS = 128          # a frequent shingle's block is dealt to so many tasks
FANOUT = 16


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of one whole text."""
    ws = lower_words(text)
    if not ws:
        return np.zeros(0, np.uint64)
    h = word_hashes(ws)
    if len(h) < k:
        return window_hashes(h, len(h)) ^ np.uint64(len(h))
    h = np.sort(window_hashes(h, k))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def set_key(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - 2 ** 63


def point_of(s: np.ndarray) -> bytes:
    """Group counts of a set, the group being a hash's highest bits.  255 means
    "so many or more" and switches the bound off for the set."""
    v = np.bincount((s >> np.uint64(55)).astype(np.int64), minlength=GROUPS)
    return np.minimum(v, 255).astype(np.uint8).tobytes()


def overlap_bound(points: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Summed coordinate minima: no fewer than the overlap of the sets."""
    bound = np.minimum(points, q).sum(axis=-1, dtype=np.int64)
    full = (points == 255).any(axis=-1) | (q == 255).any(axis=-1)
    return np.where(full, 2 ** 40, bound)


def need(n, percent: int = PERCENT):
    """Smallest overlap that a set of size n must have with a linked one."""
    return -(-n * percent // 100)


def overlap_needed(n, m, percent: int = PERCENT):
    """Smallest overlap that links sets of sizes n and m."""
    return -(-(n + m) * percent // (100 + percent))


# -- pass 1: sets, and the shingles that are frequent --------------------------

def _sets(batches):
    names = ["doc_id", "h", "n", "point", "token", "times"]
    held: list[np.ndarray] = []
    seen: set[int] = set()
    size = 0

    def frequent():
        tokens, times = np.unique(np.concatenate(held), return_counts=True)
        keep = times >= HOT_IN_CHUNK
        t, c = signed(tokens[keep]), times[keep]
        none = pa.nulls(len(t), pa.int64())
        return pa.RecordBatch.from_arrays(
            [none, none, pa.nulls(len(t), pa.int32()), pa.nulls(len(t), pa.binary()), pa.array(t),
             pa.array(c, pa.int64())], names)

    for b in batches:
        rows = []
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            s = shingles(text)
            key = set_key(s) if len(s) else 0
            rows.append((i, key, len(s), point_of(s)))
            if len(s) and key not in seen:
                seen.add(key)
                held.append(s)
                size += len(s)
            if size >= CHUNK:
                yield frequent()
                held, size, seen = [], 0, set()
        n = len(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.binary()),
             pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names)
    if held:
        yield frequent()


# -- pass 2: the shingles by which a class is found -----------------------------

def _prefixes(hot: np.ndarray, percent: int):
    def run(batches):
        seen: set[int] = set()
        for b in batches:
            out = []
            for text in b.column(0).to_pylist():
                s = shingles(text)
                if not len(s):
                    continue
                key = set_key(s)
                if key in seen:
                    continue
                if len(seen) > 100_000:
                    seen.clear()
                seen.add(key)
                n = len(s)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                    last = hot[at] == s
                else:
                    last = np.zeros(n, bool)
                take = n - need(n, percent) + 1
                first = s[~last][:take]
                rest = s[last][:take - len(first)]
                salt = (key % SALTS) + 1
                out.append((np.concatenate([first, rest]), key, n,
                            np.repeat([0, salt], [len(first), len(rest)])))
            if out:
                sizes = [len(o[0]) for o in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(np.concatenate([o[0] for o in out]))),
                     pa.array(np.concatenate([o[3] for o in out]), pa.int32()),
                     pa.array(np.repeat([o[1] for o in out], sizes), pa.int64()),
                     pa.array(np.repeat([o[2] for o in out], sizes), pa.int32())],
                    ["token", "salt", "h", "n"])
    return run


def _shared(batches):
    """Of rows sorted by (token, salt, h, n): one of each, where the token has
    another class too.  Salted rows are of frequent tokens and pass anyway.
    Holds one batch and one row."""
    names = ["token", "h", "n"]
    held = None  # the last row, and whether it has been given out
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(i).to_numpy() for i in range(4)]
        if held is not None:
            cols = [np.concatenate([[held[0][i]], c]) for i, c in enumerate(cols)]
        token, salt, h, n = cols
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (h[1:] != h[:-1]) | (n[1:] != n[:-1])
        if held is not None and not new.all():
            # row 0 is the held one and stays, its repeats go
            pass
        token, salt, h, n = (c[new] for c in (token, salt, h, n))
        same = token[1:] == token[:-1]
        give = salt > 0
        give[1:] |= same
        give[:-1] |= same
        done = held is not None and held[1]
        out = give.copy()
        if done:
            out[0] = False
        gone = bool(give[-1]) or (done and len(token) == 1)
        held = ((token[-1], salt[-1], h[-1], n[-1]), gone)
        if out.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[out], pa.int64()), pa.array(h[out], pa.int64()),
                 pa.array(n[out], pa.int32())], names)


# -- the R-tree ------------------------------------------------------------------

class RTree:
    """Points (rows of group counts) with set sizes, packed bottom-up.

    Boxes have ``COARSE`` coordinates, each the sum of neighbouring groups.
    Points are sorted by size and then by their largest coordinates, so leaves
    hold like points; each level keeps the coordinate maxima and the size range
    of ``fanout`` entries below.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, fanout: int = FANOUT):
        self.coarse = min(COARSE, points.shape[1])
        hi = self._sums(points)
        first = np.argsort(-hi, axis=1, kind="stable")[:, :2]
        self.order = np.lexsort((first[:, 1], first[:, 0], sizes))
        self.points, self.sizes, self.fanout = points[self.order], sizes[self.order], fanout
        self.levels = []
        hi, lo_n, hi_n = hi[self.order].astype(np.int32), self.sizes, self.sizes
        self.base = hi
        while len(hi) > 1:
            starts = np.arange(0, len(hi), fanout)
            hi = np.maximum.reduceat(hi, starts, axis=0)
            lo_n, hi_n = np.minimum.reduceat(lo_n, starts), np.maximum.reduceat(hi_n, starts)
            self.levels.append((hi, lo_n, hi_n))

    def _sums(self, points: np.ndarray) -> np.ndarray:
        """Coarse counts; a full group counts as unbounded."""
        wide = np.where(points == 255, 2 ** 20, points).astype(np.int32)
        return wide.reshape(len(points), self.coarse, -1).sum(axis=2)

    def join(self, percent: int = PERCENT, chunk: int = 512):
        """All pairs of positions (in the given order) whose bound allows a
        link, as arrays, a chunk at a time.

        Pairs of nodes go down the tree together, from the root with itself; a
        pair is left where the sizes below can't match, or the summed minima of
        the two boxes stay under the least overlap they would need.
        """
        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        if not self.levels:
            return
        while stack:
            depth, i, j = stack.pop()
            # children of the nodes i and j, each pair of them once
            f = self.fanout
            below = self.levels[depth - 1] if depth else (self.base, self.sizes, self.sizes)
            hi, lo_n, hi_n = below
            x = (i[:, None] * f + np.repeat(np.arange(f), f)).ravel()
            y = (j[:, None] * f + np.tile(np.arange(f), f)).ravel()
            ok = (x < len(hi)) & (y < len(hi)) & ((x <= y) if depth else (x < y))
            x, y = x[ok], y[ok]
            ok = (100 * hi_n[x] >= percent * lo_n[y]) & (100 * hi_n[y] >= percent * lo_n[x])
            x, y = x[ok], y[ok]
            low_x = np.maximum(lo_n[x], need(lo_n[y], percent))
            low_y = np.maximum(lo_n[y], need(lo_n[x], percent))
            ok = (np.minimum(hi[x], hi[y]).sum(axis=1, dtype=np.int64)
                  >= overlap_needed(low_x, low_y, percent))
            x, y = x[ok], y[ok]
            if depth:
                stack += [(depth - 1, x[k:k + chunk], y[k:k + chunk])
                          for k in range(0, len(x), chunk)]
            elif len(x):
                ok = (overlap_bound(self.points[x], self.points[y])
                      >= overlap_needed(self.sizes[x], self.sizes[y], percent))
                if ok.any():
                    yield self.order[x[ok]], self.order[y[ok]]


def _tree_pairs(percent: int):
    """Of rows sorted by token: pairs of one block and two components that
    survive the bound, ``a < b``."""
    def block(rows):
        rep = np.array([r[0] for r in rows])
        part = np.array([r[1] for r in rows])
        sizes = np.array([r[2] for r in rows], np.int64)
        points = np.stack([r[3] for r in rows])
        tree = RTree(points, sizes)
        for i, j in tree.join(percent):
            apart = part[i] != part[j]
            yield from zip(np.minimum(rep[i], rep[j])[apart].tolist(),
                           np.maximum(rep[i], rep[j])[apart].tolist(), strict=True)

    def run(batches):
        token, rows, out = None, [], []
        for b in batches:
            for t, r, p, n, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if t != token:
                    out.extend(block(rows) if len(rows) > 1 else ())
                    token, rows = t, []
                rows.append((r, p, n, np.frombuffer(v, np.uint8)))
            if out:
                yield _pairs_batch(out)
                out = []
        out.extend(block(rows) if len(rows) > 1 else ())
        if out:
            yield _pairs_batch(out)
    return run


def _pairs_batch(out):
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())],
        ["a", "b"])


def bounded(pairs: DataFrame, points: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (``a``, ``b``, sizes ``na``, ``nb``) whose summed coordinate minima
    allow a link."""
    def row(a, b, na, pa_, nb, pb):
        bound = overlap_bound(np.frombuffer(pa_, np.uint8), np.frombuffer(pb, np.uint8))
        return [(a, b)] if int(bound) >= overlap_needed(na, nb, percent) else []

    def side(x):
        return points.select(F.col("rep").alias(x), F.col("point").alias(f"p{x}"))
    # the hub side (a) is joined last, as a plain join that can be split
    rows = pairs.join(side("b"), "b").join(side("a"), "a")
    return map_rows(rows.select("a", "b", "na", "pa", "nb", "pb"), row, "a long, b long")


def verify(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (``a``, ``b``) of ``pairs`` (a stage) whose sets link.  Sets are
    made for the documents in ``pairs`` only."""
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "members")
    sets = stage(map_rows(docs.join(if_small(ids), "doc_id").select("doc_id", "text"),
                          lambda i, text: [(i, signed(shingles(text)))],
                          "rep long, shingles array<long>", chunk=256), "sets")

    def row(a, b, sa, sb):
        both = np.concatenate([sa, sb])
        both.sort()
        same = int((both[1:] == both[:-1]).sum())
        return [(a, b)] if same >= overlap_needed(len(sa), len(sb), percent) else []

    def side(x):
        return sets.select(F.col("rep").alias(x), F.col("shingles").alias(f"s{x}"))
    rows = pairs.join(side("b"), "b").join(side("a"), "a")
    return map_rows(rows.select("a", "b", "sa", "sb"), row, "a long, b long")


def join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    d = with_id(docs)
    first = stage(d.mapInArrow(_sets, "doc_id long, h long, n int, point binary, token long, times long"),
                  "shingle-sets")
    sets = first.where("doc_id is not null").select("doc_id", "h", "n")
    hot = (first.where("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
           .orderBy(F.desc("times"), "token").limit(HOT).select("token").toPandas()["token"])
    hot = np.sort(hot.to_numpy(np.int64).view(np.uint64))  # at most HOT numbers
    reps = stage(sets.where("n > 0").groupBy("h", "n").agg(F.min("doc_id").alias("rep")), "classes")

    prefixes = d.select("text").mapInArrow(_prefixes(hot, percent),
                                           "token long, salt int, h long, n int")
    found = stage(prefixes.repartition("token", "salt")
                  .sortWithinPartitions("token", "salt", "h", "n")
                  .mapInArrow(_shared, "token long, h long, n int"), "blocks-by-class")
    every = stage(found.distinct().join(reps, ["h", "n"]).select("token", "rep", "n"),
                  "blocks-by-shingle")
    # shingles with the same members (those of one shared passage) make one block
    unique = stage(every.groupBy("token").agg(
        F.count("*").alias("size"), F.min("rep").alias("a"), F.min_by("n", "rep").alias("na"),
        F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y"))
        .where("size > 1").groupBy("size", "a", "na", "x", "y").agg(
            F.min("token").alias("token")).select("token", "a", "na"), "block-names")
    blocks = stage(every.join(unique, "token").where("rep <> a"), "blocks")
    pairs = stage(blocks.where("100 * least(n, na) >= %d * greatest(n, na)" % percent).select(
        "a", "na", F.col("rep").alias("b"), F.col("n").alias("nb")).distinct(), "pairs")

    # blocks' other members, and those tried against the smallest
    wanted = stage(pairs.select(F.col("a").alias("doc_id")).unionByName(
        blocks.select(F.col("rep").alias("doc_id"))).distinct(), "members")
    points = stage(first.where("doc_id is not null").join(if_small(wanted), "doc_id").select(
        F.col("doc_id").alias("rep"), "point"), "points")

    near = stage(bounded(pairs, points, percent).distinct(), "near-pairs")
    parts = components(stage(verify(near, d, percent), "links"))

    # blocks whose other members still are of several components
    named = blocks.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "token", "rep", "n", F.coalesce("component", "rep").alias("part"))
    open_blocks = named.groupBy("token").agg(
        F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("token")
    rest = named.join(open_blocks, "token").join(points, "rep").select(
        "token", "rep", "part", "n", "point")
    more = stage(rest.repartition("token").sortWithinPartitions("token")
                 .mapInArrow(_tree_pairs(percent), "a long, b long").distinct(), "tree-pairs")
    untried = stage(more.join(near, ["a", "b"], "left_anti"), "late-pairs")
    late = stage(verify(untried, d, percent), "late-links")
    whole = components(late.unionByName(parts.select(
        F.col("node").alias("a"), F.col("component").alias("b"))))
    named_class = reps.join(whole.select(F.col("node").alias("rep"), "component"), "rep", "left") \
        .select("h", "n", F.coalesce("component", "rep").alias("component"))
    return sets.join(named_class, ["h", "n"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"))


def deduplicate(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of linked documents: the one with
    the smallest doc_id.  Of rows that share this doc_id all stay."""
    found = join(docs, percent)
    others = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.where(F.col("doc_id").isNotNull()).join(
        if_small(stage(others, "near-copies")), "doc_id", "left_anti").select(*docs.columns)
