"""Line dedup by pairwise alignment.

Documents that overlap are found through the hashes of *runs* that several of
them hold: lines in a row, blank ones aside, the shortest that start or end at
a line and reach ``BLOCK_SIZE``.  Each such pair is aligned with patience diff,
and the aligned common blocks are deleted from the later document (the larger
doc_id).

*Pairs stay linear and lose nothing.*  A document is aligned with the first
holder (smallest doc_id) of each of its repeated runs, so a run held by a
million documents gives a million pairs with one partner; rarer runs lead to
further partners, and none is left out for being frequent.  What patience diff
can't align with that partner (moved passages, lines that occur twice) is
aligned again from the shared runs that are left, each grown both ways.  So a
line goes exactly if a block of ``BLOCK_SIZE`` or more around it occurs in any
earlier document: every such block is covered by its own shortest runs, and
each of those is deleted against its first holder.  The hub is joined with a
plain join that can be split.  Documents with the same lines are settled before
pairing: all but the smallest lose every line.

*Patience diff.*  Lines that occur once in both ranges are anchors; their
longest increasing sequence is kept, matches grow from it both ways, and the
gaps are aligned in the same way.

A line's size is its number of words, or half its characters of scripts
written without spaces when that is more, so single short lines stay.  Lines
are compared without the white space around them; blank lines are kept and
don't break a block.

Defined cases: null text has no lines and stays null; a document keeps at least
its blank lines; rows that share a doc_id never delete one another's lines,
repeated rows each get a row; of documents with the same lines the smallest
doc_id is the earlier one (there are no other ties); an empty table gives no
rows; an extra column named like one of the results gives way to the result,
any other is kept as it is; a text of any length is one row of line hashes.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, ship, signed, stage, with_id

BLOCK_SIZE = 5
_SPACES = b" \t\n\x0b\x0c\r"
#: Thai, Lao, Burmese, Khmer, and the Chinese and Japanese scripts.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff"
                       "\uf900-\ufaff\U00020000-\U0003ffff]")


def line_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and size of every line that isn't blank, 0 for blank ones."""
    if not text:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    lines = [s.strip(_SPACES) for s in text.encode().split(b"\n")]
    h = xxhash.xxh3_64_intdigest
    return (np.array([h(s) or 1 if s else 0 for s in lines], np.uint64),
            np.array([line_size(s) for s in lines], np.int32))


def line_size(line: bytes) -> int:
    n = len(line.split())
    return n if line.isascii() else max(n, len(_UNSPACED.findall(line.decode())) // 2)


def shortest_runs(lines: np.ndarray, sizes: np.ndarray, least: int = BLOCK_SIZE
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shortest runs of lines, none blank, that start or end at a line and
    reach ``least``: their hashes, first and last places."""
    n = len(lines)
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    first = np.arange(n)
    last = np.searchsorted(ends, ends[:-1] + least) - 1
    starts = np.searchsorted(ends, ends[1:] - least, side="right") - 1
    spans = np.unique(np.concatenate([np.stack([first, last], 1)[last < n],
                                      np.stack([starts, first], 1)[starts >= 0]]), axis=0)
    first, last = spans[:, 0], spans[:, 1]
    keys = lines[first].view(np.int64)
    for k in np.flatnonzero(last > first):
        keys[k] = _key(lines[first[k]:last[k] + 1])
    return keys, first, last


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned index pairs of two sequences, by patience diff."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        # equal heads and tails are aligned at once
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = _once(a, a0, a1), _once(b, b0, b1)
        anchors = _rising(sorted((i, once_b[x]) for x, i in once_a.items() if x in once_b))
        if not anchors:
            continue
        pa, pb = a0, b0
        for i, j in anchors:
            if i < pa or j < pb:
                continue
            # the gap before the anchor is aligned apart; its tail joins the
            # anchor because equal tails are matched first
            work.append((pa, i + 1, pb, j + 1))
            pa, pb = i + 1, j + 1
        work.append((pa, a1, pb, b1))
    return sorted(out)


def _once(x: list[int], lo: int, hi: int) -> dict[int, int]:
    seen: dict[int, int] = {}
    for i in range(lo, hi):
        seen[x[i]] = -1 if x[i] in seen else i
    return {k: i for k, i in seen.items() if i >= 0}


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest sequence of pairs rising in both places."""
    ends: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(ends, j)
        if p == len(ends):
            ends.append(j)
            last.append(k)
        else:
            ends[p], last[p] = j, k
        back.append(last[p - 1] if p else -1)
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def common_blocks(early: np.ndarray, late: np.ndarray, late_sizes: np.ndarray,
                  least: int = BLOCK_SIZE) -> list[int]:
    """Line numbers of the late document inside aligned blocks that reach
    ``least``.  A block is a run of lines that follow one another in both,
    blanks aside."""
    ia, ib = np.flatnonzero(early), np.flatnonzero(late)
    a, b, sizes = early[ia], late[ib], late_sizes[ib]
    pairs = patience(a.tolist(), b.tolist())
    gone = np.zeros(len(b), bool)
    run: list[int] = []
    for k, (i, j) in enumerate(pairs):
        run.append(j)
        if k + 1 == len(pairs) or pairs[k + 1] != (i + 1, j + 1):
            if int(sizes[run].sum()) >= least:
                gone[run] = True
            run = []
    moved(a, b, sizes, gone, least)
    return ib[gone].tolist()


def moved(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, gone: np.ndarray, least: int) -> None:
    """Mark in ``gone`` the blocks of ``b`` that occur in ``a`` but lie across
    the alignment: shared runs that aren't marked yet, grown both ways."""
    if gone.all():
        return
    keys, first, last = shortest_runs(b, sizes, least)
    # a line that b lacks can't be part of a shared run, whatever its size
    size_of = dict(zip(b.tolist(), sizes.tolist(), strict=True))
    at = dict(zip(*(x.tolist() for x in shortest_runs(
        a, np.array([size_of.get(x, least) for x in a.tolist()], np.int64), least)[:2]),
        strict=True))
    for key, lo, hi in zip(keys.tolist(), first.tolist(), last.tolist(), strict=True):
        if key not in at or gone[lo:hi + 1].all():
            continue
        i, j, shift = lo, hi, at[key] - lo
        while i > 0 and i + shift > 0 and b[i - 1] == a[i - 1 + shift]:
            i -= 1
        while j + 1 < len(b) and j + 1 + shift < len(a) and b[j + 1] == a[j + 1 + shift]:
            j += 1
        gone[i:j + 1] = True


def _key(h: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(h.tobytes()) - 2 ** 63


def deletions(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``cuts``: for each text under the id its key (``h``) and the
    deleted line numbers.  Documents that lose nothing have no row."""
    d = with_id(docs)

    def lines(doc_id, text):
        h, n = line_hashes(text)
        held = np.flatnonzero(h)
        runs = np.unique(shortest_runs(h[held], n[held])[0])
        return [(doc_id, _key(h), signed(h), n, runs)]

    seqs = stage(map_rows(d.where("text is not null"), lines, "doc_id long, h long, "
                          "lines array<long>, sizes array<int>, runs array<long>"), "lines")
    firsts = stage(seqs.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")),
                   "first-copies")
    copies = seqs.select("doc_id", "h", "lines").join(
        firsts.where("n > 1").select("h", F.col("doc_id").alias("first")), "h").where(
        "doc_id > first and size(lines) > 0").select("doc_id", "h", F.expr(
            "filter(sequence(0, size(lines) - 1), i -> lines[i] <> 0)").alias("cut"))

    own = seqs.join(firsts.select("doc_id", "h"), ["doc_id", "h"])
    held = own.select("doc_id", "h", F.explode("runs").alias("run"))
    first_holder = held.groupBy("run").agg(
        F.min(F.struct("doc_id", "h")).alias("first"), F.max("doc_id").alias("hi")).where(
        "first.doc_id < hi").select("run", "first")
    pairs = stage(held.join(first_holder, "run").where("doc_id > first.doc_id").select(
        F.col("first.doc_id").alias("early"), F.col("first.h").alias("early_h"),
        "doc_id", "h").distinct(), "line-pairs")

    def align(doc_id, h, late, late_sizes, early):
        cut = common_blocks(early, late, late_sizes)
        return [(doc_id, h, cut)] if cut else []

    rows = pairs.join(own.select("doc_id", "h", F.col("lines").alias("late"),
                                 F.col("sizes").alias("late_sizes")), ["doc_id", "h"]).join(
        own.select(F.col("doc_id").alias("early"), F.col("h").alias("early_h"),
                   F.col("lines").alias("early_lines")), ["early", "early_h"])
    cuts = map_rows(rows.select("doc_id", "h", "late", "late_sizes", "early_lines"), align,
                    "doc_id long, h long, cut array<int>")
    # a document has at most one partner for each of its runs, so at most two a line
    each = cuts.unionByName(copies).groupBy("doc_id", "h").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("cut")))).alias("cut"))
    return each.groupBy("doc_id").agg(F.collect_list(F.struct("h", "cut")).alias("cuts"))


def cut_lines(text: str | None, cuts) -> tuple[str | None, int, int, bool]:
    """Text without its deleted lines; lines, deleted lines; whether words are left."""
    if text is None:
        return None, 0, 0, False
    lines = text.split("\n")
    gone: set[int] = set()
    if cuts:
        key = _key(line_hashes(text)[0])
        for c in cuts:
            if c["h"] == key:
                gone = set(c["cut"])
    kept = [s for i, s in enumerate(lines) if i not in gone]
    return "\n".join(kept), len(lines), len(gone), any(s.encode().split() for s in kept)


def dedup(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` that has a doc_id, with ``kept_text``, ``n_lines``,
    ``n_deleted`` and ``emptied`` (all its words were deleted)."""
    ship(docs.sparkSession)
    cuts = stage(deletions(docs), "line-cuts")
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULT]
    # the document's columns travel in a struct, out of the way of this job's own
    d = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(*keep).alias("row")).join(
        cuts, "doc_id", "left")

    @F.pandas_udf("kept_text string, n_lines int, n_deleted int, emptied boolean")
    def run(text: pd.Series, cuts: pd.Series) -> pd.DataFrame:
        rows = [cut_lines(t, c) for t, c in zip(text, cuts, strict=True)]
        return pd.DataFrame([(t, n, g, g > 0 and not left) for t, n, g, left in rows],
                            columns=RESULT)

    return d.select("row", run("text", "cuts").alias("cut")).select("row.*", "cut.*")


RESULT = ["kept_text", "n_lines", "n_deleted", "emptied"]
