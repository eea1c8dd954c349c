"""Substring dedup by seed and extend.

A word goes when a window of ``WINDOW`` consecutive words over it also starts
in a document with a smaller doc_id (judged on the input, whole texts).

*Seeds.*  Every run of ``SEED`` words is hashed, and each window keeps its
smallest one (winnowing).  Equal windows keep equal seeds, so two documents
that share a window share a seed: the join on seeds misses nothing, at about
one row per 20 words.

*Extension.*  Where a seed lies in several documents, the match is extended
both ways over all windows that kept this seed.  Instead of comparing each
occurrence with each other one (quadratic in a group of copies), every
extended window looks up the smallest document that holds it: a map-side
``min`` and a join that can be split.  Consecutive hits merge into the maximal
repeat, and its words go.

Whole copies are settled before: of documents with equal words only the
smallest is searched, the others (of at least one window) go entirely.

Defined cases: null text has no words; shorter documents than a window are
kept; rows that share a doc_id never remove one another's words.  Windows are
compared as 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import if_small, map_rows, signed, stage, window_hashes, with_id, word_hashes, words

WINDOW = 50
SEED = 12
EMPTY = hashlib.sha256(b"").hexdigest()


def kept_seeds(h: np.ndarray, window: int, seed: int) -> np.ndarray:
    """For every window the position of its smallest seed hash (rightmost on ties)."""
    grams = window_hashes(h, seed)
    span = window - seed + 1
    n = len(grams) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    # blockwise running minima: each window is the tail of one block of span
    # grams and the head of the next
    pad = -len(grams) % span
    top = np.uint64(2 ** 64 - 1)
    g = np.concatenate([grams, np.full(pad, top)]).reshape(-1, span)
    heads = np.minimum.accumulate(g, axis=1).ravel()
    tails = np.minimum.accumulate(g[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(tails[:n], heads[span - 1:span - 1 + n])
    # a seed that is a minimum of a window over it
    at = np.arange(len(grams))
    # position of the rightmost gram equal to the minimum: the last candidate
    order = np.lexsort((at, grams))
    sorted_grams = grams[order]
    j = np.searchsorted(sorted_grams, low, side="right") - 1
    pos = order[j]
    wrong = pos > np.arange(n) + span - 1  # an equal gram beyond the window
    for i in np.flatnonzero(wrong):
        seg = grams[i:i + span]
        pos[i] = i + span - 1 - int(np.argmin(seg[::-1]))
    return pos


def _key(ws: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(ws)) - 2 ** 63


def dedup(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` of every row, and
    ``removed``: the word spans ``[start, end)`` taken out."""
    d = with_id(docs)

    def seeds(doc_id, text):
        ws = words(text)
        pos = np.zeros(0, np.int64)
        gram = np.zeros(0, np.uint64)
        if len(ws) >= window:
            h = word_hashes(ws)
            pos = np.unique(kept_seeds(h, window, seed))
            gram = window_hashes(h, seed)[pos]
        whole = b" ".join(ws)
        return [(doc_id, len(ws), xxhash.xxh3_64_intdigest(whole) - 2 ** 63,
                 hashlib.sha256(whole).hexdigest(), signed(gram), pos.astype(np.int32))]

    found = stage(map_rows(d, seeds, "doc_id long, n_words int, h long, sha string, "
                           "gram array<long>, pos array<int>", chunk=512), "seeds")
    long = found.where(F.col("n_words") >= window)
    first = stage(long.groupBy("h", "n_words").agg(F.min("doc_id").alias("doc_id")), "firsts")
    copies = found.select("doc_id", "h", "n_words", "sha").join(
        first.withColumnRenamed("doc_id", "first"), ["h", "n_words"], "left")

    seeds_at = long.select("doc_id", "h", "gram", "pos").join(first, ["doc_id", "h"]).select(
        "doc_id", "h", F.explode(F.arrays_zip("gram", "pos")).alias("s")).select(
        "doc_id", "h", F.col("s.gram").alias("gram"), F.col("s.pos").alias("pos"))
    several = seeds_at.groupBy("gram").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("gram")
    at = stage(seeds_at.join(several, "gram").select("doc_id", "h", "pos"), "shared-seeds")

    # extend: the windows around every shared seed
    by_doc = at.groupBy("doc_id", "h").agg(F.collect_set("pos").alias("pos"))
    involved = stage(at.select("doc_id").distinct(), "involved")
    texts = d.join(if_small(involved), "doc_id")

    def extend(doc_id, text, key, pos):
        ws = words(text)
        if _key(ws) != key:
            return []  # another row under the same doc_id
        h = word_hashes(ws)
        starts = np.flatnonzero(np.isin(kept_seeds(h, window, seed), np.array(pos)))
        hashes = signed(window_hashes(h, window))[starts]
        return [(doc_id, key, w, i) for w, i in zip(hashes.tolist(), starts.tolist(), strict=True)]

    windows = stage(map_rows(texts.join(by_doc, "doc_id").select("doc_id", "text", "h", "pos"),
                             extend, "doc_id long, h long, w long, i int", chunk=20_000),
                    "windows")
    smallest = windows.groupBy("w").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")) \
        .where("lo < hi").select("w", "lo")
    hits = windows.join(smallest, "w").where("doc_id > lo").groupBy("doc_id", "h").agg(
        F.collect_set("i").alias("starts"))
    hits = stage(map_rows(hits, lambda i, h, s: [(i, h, *spans(np.array(s), window))],
                          "doc_id long, h long, starts array<int>, ends array<int>"), "hits")

    def cut(doc_id, text, key, starts, ends):
        ws = words(text)
        if _key(ws) != key:
            return []
        keep = np.ones(len(ws), bool)
        for a, b in zip(starts, ends, strict=True):
            keep[a:b] = False
        rest = b" ".join(w for w, k in zip(ws, keep.tolist(), strict=True) if k)
        return [(doc_id, key, int((~keep).sum()), hashlib.sha256(rest).hexdigest(),
                 list(starts), list(ends))]

    touched = if_small(stage(hits.select("doc_id").distinct(), "touched"))
    cuts = map_rows(d.join(touched, "doc_id").join(hits, "doc_id").select(
        "doc_id", "text", "h", "starts", "ends"), cut,
        "doc_id long, h long, n_cut int, cut_sha string, starts array<int>, ends array<int>") \
        .dropDuplicates(["doc_id", "h"])
    gone = F.col("first") < F.col("doc_id")  # a whole copy
    span = F.struct(F.col("starts").alias("starts"), F.col("ends").alias("ends"))
    all_of_it = F.struct(F.array(F.lit(0)).alias("starts"), F.array("n_words").alias("ends"))
    return copies.join(cuts, ["doc_id", "h"], "left").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0)))
        .cast("long").alias("n_removed"),
        F.when(gone, EMPTY).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
        F.when(gone, all_of_it).otherwise(span).alias("removed"))


def spans(starts: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """Window starts merged into maximal repeats ``[start, end)``."""
    s = np.sort(starts)
    edge = np.flatnonzero(s[1:] > s[:-1] + window)
    return (s[np.concatenate([[0], edge + 1])].tolist(),
            (s[np.concatenate([edge, [len(s) - 1]])] + window).tolist())
