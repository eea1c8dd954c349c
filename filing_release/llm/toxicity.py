"""Toxicity by nearest labelled examples.

Bounded part (documented parameter): ``EXAMPLES`` labelled rows per class, from
which near copies are left out.  The terms are *all* letter runs of the
examples, lower-cased, clean examples included, and those prefixes of 4 to 6
characters (stems of inflected words) that tell the classes apart by
chi-square; nothing limits their number.  Document frequencies come from *all*
documents.  A document is the vector of all these terms in its whole text,
``(1 + ln tf) * ln(1 + N / df) * (FLOOR + effect)``, scaled to length 1, where a
term's effect is how far its chi-square goes beyond chance.  So a term that
tells the classes apart weighs more, and every other one still counts.

The index is a block-max inverted index: examples lie in blocks, every term has
a list of postings, cut at the blocks, with its largest weight in each block.
A query reads its terms' lists of maxima, visits the blocks of the highest
bounds ``sum q_t * max_t,block``, and then every block whose bound reaches the
k-th best cosine.  So the neighbours are exact.  A term that at least one in
``LONG`` examples holds has a list with a place for every example; these rows are
multiplied with many documents at once, and the bound of a block is its best sum
so far plus the maxima of the other terms.  Votes are weighted by distance
and turned into probabilities by a logistic curve fitted on the examples' own
leave-one-out votes, with the class shares of all labelled rows.

Defined cases: a null or empty text, and a text that shares no term with any
example, has no neighbour and gets the share of toxic rows among examples
without terms (weighted to the shares of all labelled rows; without such
examples the share of all); repeated rows each get a row, and of the texts
under one labelled id the smallest is the example; an id with several labels is
toxic if one says so; without any labelled row every score is 0; ties in cosine
go to the example with the smaller doc_id; an empty table gives no rows; extra
columns are not read; a text of any length is one row of term counts.

What reaches the driver (the examples' terms, their document frequencies and the
examples' own vectors) stays in Arrow and NumPy arrays, some ten bytes a term or
posting, never one Python object for each.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Sequence
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (WORD_CACHE, fold_bucket, letter_runs, map_chunks, map_rows, mix, stage,
                     values)

EXAMPLES = 2000   # labelled rows kept per class
CHI = 30.0        # chi-square that chance may reach
EFFECT = 0.005    # the same per example (phi squared)
FLOOR = 0.005     # weight of a term without effect
NEIGHBOURS = 15
BLOCK = 64        # examples
FIRST = 4         # blocks a query visits before it has a k-th best
LONG = 8          # a list of at least one in so many examples is a full row
TOGETHER = 64     # documents whose terms with full rows are multiplied at once


def terms(text: str | None) -> set[str]:
    """Letter runs of one text, and their stems (marked with ``*``)."""
    runs = {r.decode() for r in set(letter_runs(text))}
    return runs | {t for w in runs for t in stems(w)}


def stems(run: str) -> set[str]:
    return {run[:n] + "*" for n in (4, 5, 6) if len(run) >= n}


def signature(text: str | None, seeds: int = 16) -> list[int]:
    """Smallest hashes of a text's runs, one per seed: near copies share most."""
    h = np.array([xxhash.xxh3_64_intdigest(r) for r in set(letter_runs(text))] or [0], np.uint64)
    with np.errstate(over="ignore"):
        return [int(mix(h + np.uint64(1 + k) * np.uint64(0x9E3779B97F4A7C15)).min() >> 1)
                for k in range(seeds)]


def groups_of_copies(signatures: list[list[int]]) -> list[int]:
    """For each example the first one that it (nearly) copies: half of the
    smallest hashes agree.  Each is compared with the first holder of each of
    its hashes only, so a large group costs no more than its size."""
    first: dict[tuple[int, int], int] = {}
    group: list[int] = []
    for i, sig in enumerate(signatures):
        found = {group[first[k]] for k in enumerate(sig) if k in first}
        near = [j for j in found if sum(x == y for x, y in zip(
            sig, signatures[j], strict=True)) * 2 >= len(sig)]
        group.append(min(near, default=i))
        for k in enumerate(sig):
            first.setdefault(k, i)
    return group


class Counts:
    """Counts of the known terms in texts, as ``(columns, tf)`` in ascending order."""

    def __init__(self, vocabulary: list[str]):
        self.column = {t: i for i, t in enumerate(vocabulary)}
        self.forget()

    def forget(self) -> None:
        """A run's number leads to its columns; 0 is every run without any."""
        self.memo: dict[bytes, int] = {}
        self.flat, self.start = array("i"), array("i", [0, 0])

    def __call__(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        memo = self.memo
        if len(memo) > WORD_CACHE:
            self.forget()
            memo = self.memo
        found: list[int] = []
        times: list[int] = []
        sizes = []
        for text in texts:
            seen = Counter(letter_runs(text))
            numbers = list(map(memo.get, seen))
            if None in numbers:
                for r in seen:
                    if r not in memo:
                        memo[r] = self.learn(r.decode())
                numbers = list(map(memo.get, seen))
            found += numbers
            times += seen.values()
            sizes.append(len(seen))
        run, flat, start = (np.array(x, np.int64) for x in (found, self.flat, self.start))
        n = start[run + 1] - start[run]
        text_of = np.repeat(np.arange(len(texts)), sizes)
        width = len(self.column)
        key = np.repeat(text_of * width, n) + flat[ranges(start[run], n)]
        # several runs of a text may have a stem in common
        order = np.argsort(key)
        key, tf = key[order], np.repeat(np.array(times, np.int32), n)[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        key, tf = key[new], np.add.reduceat(tf, new) if len(new) else tf
        ends = np.searchsorted(key, np.arange(len(texts) + 1) * width)
        return [((key[i:j] - k * width).astype(np.int32), tf[i:j])
                for k, (i, j) in enumerate(zip(ends[:-1], ends[1:], strict=True))]

    def learn(self, run: str) -> int:
        cols = [self.column[t] for t in (run, *stems(run)) if t in self.column]
        if not cols:
            return 0
        self.flat.extend(cols)
        self.start.append(len(self.flat))
        return len(self.start) - 2


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``start .. start + length - 1``, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def arrays_of(counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    cols = np.array(sorted(counts), np.int64)
    return cols, np.array([counts[c] for c in cols], np.int64)


class Index:
    """The examples as a block-max inverted index with calibrated votes.

    ``scale`` is each term's weight but for its frequency in the text.
    """

    def __init__(self, scale: np.ndarray, ids: list[int], labels: list[int],
                 counts: Sequence[dict[int, int] | tuple[np.ndarray, np.ndarray]],
                 toxic_share: float, k: int = NEIGHBOURS, block: int = BLOCK):
        self.scale, self.k, self.block = scale, k, block
        arrays = [arrays_of(c) if isinstance(c, dict) else c for c in counts]
        kept = [i for i, (cols, _) in enumerate(arrays) if len(cols)]
        vectors = [self.weigh(*arrays[i]) for i in kept]
        # like rows share a block when sorted by their heaviest terms
        rank = sorted(range(len(kept)), key=lambda j: (
            tuple(vectors[j][0][np.argsort(-vectors[j][1], kind="stable")][:3]), ids[kept[j]]))
        self.ids = np.array([ids[kept[j]] for j in rank], np.int64)
        self.labels = np.array([labels[kept[j]] for j in rank], np.float64)
        self.post(len(scale), [vectors[j] for j in rank])
        n1 = sum(labels)
        weight = {1: toxic_share / max(n1, 1), 0: (1 - toxic_share) / max(len(labels) - n1, 1)}
        self.class_weight = np.array([weight[int(y)] for y in self.labels])
        self.mean_weight = self.class_weight.mean() if len(self.labels) else 0.0
        bare = [labels[i] for i, (cols, _) in enumerate(arrays) if not len(cols)]
        w1, w0 = weight[1] * sum(bare), weight[0] * (len(bare) - sum(bare))
        self.bare_score = w1 / (w1 + w0) if w1 + w0 else toxic_share
        self.slope, self.offset = self.calibrate(vectors, rank)

    def post(self, n_terms: int, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Postings by term, then example; each stretch of a term in one block
        is an entry with its block, largest weight and first posting.  A long
        list is a row with a place for every example instead."""
        empty = [(np.zeros(0, np.int64), np.zeros(0))]
        col = np.concatenate([c for c, _ in vectors or empty])
        pos = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(c) for c, _ in vectors])
        order = np.argsort(col, kind="stable")
        col, self.pos = col[order], pos[order]
        self.weight = np.concatenate([w.astype(np.float32) for _, w in vectors or empty])[order]
        long = np.bincount(col, minlength=n_terms) * LONG >= max(len(vectors), 1)
        self.row = np.where(long, np.cumsum(long) - 1, -1).astype(np.int32)
        self.blocks = -(-len(vectors) // self.block)
        self.rows = np.zeros((long.sum(), self.blocks * self.block))
        full = long[col]
        self.rows[self.row[col[full]], self.pos[full]] = self.weight[full]
        col, self.pos, self.weight = col[~full], self.pos[~full], self.weight[~full]
        blocks = self.pos // self.block
        new = np.ones(len(col), bool)
        new[1:] = (col[1:] != col[:-1]) | (blocks[1:] != blocks[:-1])
        self.first = np.flatnonzero(new)
        self.length = np.diff(self.first, append=len(col)).astype(np.int32)
        self.entry_block = blocks[self.first]
        self.maximum = (np.maximum.reduceat(self.weight, self.first) if len(col)
                        else np.zeros(0, np.float32))
        self.entries = np.searchsorted(col[self.first], np.arange(n_terms + 1))
        self.first = self.first.astype(np.int32)

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        return self.weigh(*arrays_of(counts))

    def weigh(self, cols: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(tf)) * self.scale[cols]
        return cols, w / np.sqrt((w * w).sum())

    def neighbours(self, cols: np.ndarray, w: np.ndarray, skip: int = -1):
        """Exact k best ``(cosine, position)``; ``skip`` leaves one example out."""
        return next(self.all_neighbours([(cols, w)], [skip]))

    def all_neighbours(self, vectors: list[tuple[np.ndarray, np.ndarray]],
                       skips: Sequence[int] | None = None):
        """The same for many vectors: their terms with full rows are multiplied
        together, the others follow one vector at a time."""
        for at in range(0, len(vectors), TOGETHER):
            part = vectors[at:at + TOGETHER]
            rows = [self.row[cols] for cols, _ in part]
            q = np.zeros((len(part), len(self.rows)))
            for i, ((_, w), r) in enumerate(zip(part, rows, strict=True)):
                q[i, r[r >= 0]] = w[r >= 0]
            for i, ((cols, w), r, cos) in enumerate(zip(part, rows, q @ self.rows, strict=True)):
                yield self.best(cols[r < 0], w[r < 0], cos, skips[at + i] if skips else -1)

    def best(self, cols: np.ndarray, w: np.ndarray, cos: np.ndarray, skip: int):
        """The k best when ``cos`` holds what the terms with full rows add."""
        n = self.entries[cols + 1] - self.entries[cols]
        entry, q = ranges(self.entries[cols], n), np.repeat(w, n)
        of = self.entry_block[entry]
        by_block = cos.reshape(self.blocks, self.block)
        if skip >= 0:
            cos[skip] = 0.0
        bound = by_block.max(axis=1) + np.bincount(of, q * self.maximum[entry], self.blocks)
        best_c, best_p = np.zeros(0), np.zeros(0, np.int64)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        for least in (0, 1):
            if least:
                # a small slack covers rounded sums
                kth = best_c[-1] if len(best_c) >= self.k else 0.0
                visit = order[FIRST:][bound[order[FIRST:]] >= kth - 2e-6]
            else:
                visit = order[:FIRST]
            if not len(visit):
                break
            here = np.zeros(len(bound), bool)
            here[visit] = True
            take = here[of]
            e = entry[take]
            at = ranges(self.first[e], self.length[e])
            cos += np.bincount(self.pos[at], np.repeat(q[take], self.length[e]) * self.weight[at],
                               len(cos))
            if skip >= 0:
                cos[skip] = 0.0
            c = np.round(by_block[visit].ravel(), 6)
            # the k best of these blocks, with all ties
            near = np.flatnonzero(c >= np.partition(c, -self.k)[-self.k]) if len(c) > self.k \
                else np.arange(len(c))
            pos = visit[near // self.block] * self.block + near % self.block
            some = cos[pos] > 0
            best_c = np.concatenate([best_c, c[near[some]]])
            best_p = np.concatenate([best_p, pos[some]])
            top = np.lexsort((self.ids[best_p], -best_c))[:self.k]
            best_c, best_p = best_c[top], best_p[top]
        return best_c, best_p

    def vote(self, cos: np.ndarray, pos: np.ndarray) -> float:
        """Log odds of the neighbours' votes, each weighing 1 / distance."""
        w = self.class_weight[pos] / (1.05 - cos)
        yes, no = (w * self.labels[pos]).sum(), (w * (1 - self.labels[pos])).sum()
        prior = 0.5 * self.mean_weight if len(pos) else 1.0
        return math.log((yes + prior) / (no + prior))

    def calibrate(self, vectors, rank) -> tuple[float, float]:
        """Logistic curve on leave-one-out votes, by Newton steps."""
        if not len(self.ids) or len(set(self.labels.tolist())) < 2:
            return 1.0, 0.0
        x = np.array([self.vote(*near) for near in self.all_neighbours(
            [vectors[j] for j in rank], range(len(rank)))])
        y = self.labels * 0.998 + 0.001
        a, b = 1.0, 0.0
        sw = self.class_weight / self.class_weight.sum() * len(x)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            g = np.array([(sw * (y - p) * x).sum() - 0.1 * (a - 1), (sw * (y - p)).sum()])
            h = sw * p * (1 - p)
            m = np.array([[(h * x * x).sum() + 0.1, (h * x).sum()],
                          [(h * x).sum(), h.sum() + 1e-6]])
            step = np.clip(np.linalg.solve(m, g), -1, 1)
            a, b = a + step[0], b + step[1]
        return float(a), float(b)

    def score(self, counts: dict[int, int]) -> tuple[float, list[int]]:
        """Score and the neighbours' doc_ids (evidence)."""
        return self.scores([arrays_of(counts)])[0]

    def scores(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, list[int]]]:
        """The same for many documents' ``(columns, tf)``."""
        out: list[tuple[float, list[int]]] = [(self.bare_score, [])] * len(counts)
        some = [i for i, (cols, _) in enumerate(counts) if len(cols) and len(self.ids)]
        vectors = [self.weigh(*counts[i]) for i in some]
        for i, (cos, pos) in zip(some, self.all_neighbours(vectors), strict=True):
            if len(pos):
                z = self.slope * self.vote(cos, pos) + self.offset
                out[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), self.ids[pos].tolist()
        return out


def effect(p: np.ndarray, q: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """How far the chi-square of terms held by ``p`` toxic and ``q`` clean
    examples goes beyond chance, as a share of the examples, square-rooted."""
    n = n1 + n0
    chi = n / max(n1 * n0, 1.0) * (p * (n0 - q) - q * (n1 - p)) ** 2 / np.maximum(
        (p + q) * (n - p - q), 1.0)
    return np.sqrt(np.maximum(chi - max(CHI, EFFECT * n), 0) / max(n, 1.0))


def choose(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES
           ) -> tuple[DataFrame, pa.Array, np.ndarray, float]:
    """The examples (``doc_id``, ``toxic``, ``text``), their terms, the terms'
    effects, and the toxic share of all labelled rows.

    At most ``examples`` rows per class, in hash order of their ids; everything
    that reaches the driver or a broadcast is of these rows.
    """
    spark = docs.sparkSession
    known = stage(labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
                  .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                  .agg(F.max("toxic").cast("int").alias("toxic")), "toxic-labels")
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    one, other = (known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id")
                  .limit(examples) for y in (0, 1))
    # at most 2 * examples rows of two integers: a proven bound for the broadcast
    held = stage(docs.join(F.broadcast(one.unionByName(other)), "doc_id").groupBy(
        "doc_id", "toxic").agg(F.min("text").alias("text")), "toxic-examples")
    # of copies and near copies one stays, or their chance words look like evidence
    rows = map_rows(held, lambda i, y, t: [(i, y, signature(t))],
                    "doc_id long, toxic int, signature array<long>").orderBy(
        "toxic", "doc_id").collect()
    group = groups_of_copies([r["signature"] for r in rows])
    alone = [r for k, r in enumerate(rows) if group[k] == k]
    sample = held.join(F.broadcast(spark.createDataFrame(
        [(r["doc_id"],) for r in alone], "doc_id long")), "doc_id", "left_semi")
    n1 = float(sum(r["toxic"] for r in alone))
    found = (map_rows(sample, lambda i, y, t: [(y, w) for w in terms(t)],
                      "toxic int, term string").groupBy("term")
             .agg(F.sum(F.col("toxic").cast("double")).alias("p"),
                  F.sum((1 - F.col("toxic")).cast("double")).alias("q"))
             .orderBy("term").toArrow().combine_chunks())
    size = effect(found["p"].to_numpy(), found["q"].to_numpy(), n1, len(alone) - n1)
    # a stem that doesn't tell the classes apart says no more than its runs
    kept = ~pc.ends_with(found["term"], "*").to_numpy() | (size > 0)
    vocabulary = pa.array(found["term"].filter(pa.array(kept)).combine_chunks())
    return sample, vocabulary, size[kept], float(share)


def vectorise(docs: DataFrame, vocabulary: pa.Array, *keep: str) -> DataFrame:
    """``doc_id``, the ``keep`` columns, ``cols``, ``tf``: the terms of every whole text."""
    # the terms of a bounded number of examples
    held, key = docs.sparkSession.sparkContext.broadcast(vocabulary), uuid4().hex
    kept = docs.select("doc_id", *keep, "text")

    def rows(counts, *columns):
        return [(*r[:-1], *r[-1]) for r in zip(*columns[:-1], counts(columns[-1]), strict=True)]
    fields = ", ".join(f"{c} {t}" for c, t in kept.dtypes[:-1])
    return map_chunks(kept, rows, f"{fields}, cols array<int>, tf array<int>",
                      setup=lambda: _counts(key, held), chunk=TOGETHER)


_COUNTS: dict[str, Counts] = {}


def _counts(key: str, held) -> Counts:
    """A worker's counts of the latest vocabulary, kept from task to task."""
    if key not in _COUNTS:
        _COUNTS.clear()
        _COUNTS[key] = Counts(held.value.to_pylist())
    return _COUNTS[key]


def index(vectors: DataFrame, sample: DataFrame, vocabulary: pa.Array, size: np.ndarray,
          share: float) -> Index:
    """Document frequencies over all vectors, and the sample's own vectors."""
    total = vectors.count()
    df = np.ones(len(vocabulary))
    held = vectors.select(F.explode("cols").alias("col")).groupBy("col").count().toArrow()
    df[held["col"].to_numpy()] = held["count"].to_numpy()
    rows = vectorise(sample, vocabulary, "toxic").orderBy("doc_id").toArrow().combine_chunks()
    cols, tf = (values(rows[c].combine_chunks()) for c in ("cols", "tf"))
    return Index(np.log(1 + total / df) * (FLOOR + size), rows["doc_id"].to_pylist(),
                 rows["toxic"].to_pylist(), list(zip(cols, tf, strict=True)), share)


def score(vectors: DataFrame, ix: Index) -> DataFrame:
    """``doc_id``, ``score``, ``predicted``, ``evidence`` (nearest examples' ids)."""
    held = vectors.sparkSession.sparkContext.broadcast(ix)  # bounded by the parameters

    def rows(ix, ids, cols, tf):
        found = ix.scores(list(zip(cols, tf, strict=True)))
        return [(i, s, int(s >= 0.5), near[:5]) for i, (s, near) in zip(ids, found, strict=True)]
    return map_chunks(vectors.select("doc_id", "cols", "tf"), rows, "doc_id long, score double, "
                      "predicted int, evidence array<long>", setup=lambda: held.value,
                      chunk=TOGETHER)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn outside fold 0, score every row; each text is read once for its
    vector, and scoring works on the vectors."""
    d = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample, vocabulary, size, share = choose(d, labels.where(fold_bucket("doc_id") != 0))
    vectors = stage(vectorise(d, vocabulary), "toxic-vectors")
    return score(vectors, index(vectors, sample, vocabulary, size, share)).select(
        "doc_id", (fold_bucket("doc_id") == 0).alias("held_out"), "score", "predicted",
        "evidence")
