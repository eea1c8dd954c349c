"""Packing documents into training sequences by order-preserving dynamic programming.

All documents, ascending by ``doc_id``, form one stream of tokens; a document's
tokens are its byte-level BPE ids and a closing end id.  The stream is cut into
windows of at most ``window`` tokens, and every window is one sequence.  A
window pads up to ``window`` unless its length is a power of two.  The cuts
minimise

    padding of all windows + penalty of every cut

where a cut at a document's end costs nothing, at a sentence's or line's end
``SENTENCE`` tokens and elsewhere ``HARD``; equal costs prefer fewer windows.
Places for cuts are the ends of documents, sentences (a token that ends with
``.``, ``!`` or ``?`` and perhaps closing quotes, before white space) and lines;
a stretch of more than ``GAP`` tokens without one gets a place every ``GAP / 2``
tokens.

*Monotone queue.*  With ``f`` the least cost up to a place and ``p`` its
position, ``f[j] = min(f[i] + window - (p[j] - p[i])) + penalty[j]`` over the
places in reach.  ``f[i] + p[i]`` does not depend on ``j``, so the minimum over
the sliding reach is the front of a queue that keeps only rising values: each
place enters and leaves once.  Lengths that are powers of two are looked up
beside it (a few exact positions).

*Encoding.*  Matching without lookahead is half as fast again.  It differs from
the pre-tokeniser only in runs of white space before a word, whose last
character is apart from the others, so such runs are cut there first.

*On Spark.*  Documents are encoded once and staged in segments of at most
``BLOCK`` tokens.  Running sums over the sorted ids give every segment its
position in the stream; segments that start in the same ``BLOCK`` tokens are
one task's dynamic program, which reads one byte per place and no ids.  A
block ends with a cut, which costs at most one window's padding in 256.
Blocks follow from positions alone, so neither partitions nor lost executors
change a result.

Defined cases: a null or empty text is its end id alone; a row without
``doc_id`` is left out; rows that share a ``doc_id`` follow one another by a
hash of their text, and repeated rows are packed once each; very long texts
are cut into segments; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batch, map_rows, running, ship, stage, with_id

WINDOW = 1024
SENTENCE, HARD = 8, 16   # tokens a cut inside a document costs
GAP = 64                 # the longest stretch without a place to cut
BLOCK = 1 << 18          # tokens of one dynamic program
END_ID = 0

#: Kinds of places, in the two high bits of a place's byte; the low six bits
#: hold the distance from the place before, less one.
DOCUMENT, SENTENCE_END, INSIDE = 0, 1, 2

SHORT = 32               # shorter windows only end a block

#: Unicode's White_Space, as the pre-tokeniser's ``\s`` has it (fixed values).
_SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_RUNS = re.compile(f"{_SPACE}+(?={_SPACE}(?!{_SPACE}|\\Z))")
_ODD_ASCII = "\t\x0b\x0c\r"
_ODD = _ODD_ASCII + "".join(c for c in map(chr, range(128, 0x3001)) if re.match(_SPACE, c))
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


def has_runs(text: str) -> bool:
    """Whether white space may follow white space; quick where it is spaces and line ends."""
    return ("  " in text or "\n\n" in text or " \n" in text or "\n " in text
            or any(c in text for c in (_ODD_ASCII if text.isascii() else _ODD)))


class Encoder:
    """A byte-level vocabulary file, one per Python worker.

    The library's own encoder spends most of its time on offsets that are not
    needed here; ranked merges of the same file give the same ids (the tests
    compare them), so they must come in the order of their ids.
    """

    def __init__(self, vocabulary: str):
        import tiktoken
        from tokenizers.pre_tokenizers import ByteLevel
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))]
                  for m in model["merges"]]
        if (pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]
                or not pre.get("use_regex", True) or merged != sorted(merged)):
            raise ValueError(f"{vocabulary}: not a plain byte-level BPE vocabulary")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # ByteLevel writes a byte as one printable character
        alphabet = sorted(ByteLevel.alphabet())
        plain = [b for b in range(256) if chr(b) in alphabet]
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items()
                 if token not in special}
        self.special = special
        self.cut_special = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.encoding = tiktoken.Encoding(
            vocabulary, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = max([*ranks.values(), *special.values()]) + 1
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        # what a token tells about places
        closers = b"\"')]"
        self.stops, self.closes, self.spaced, self.line = (np.zeros(size, bool) for _ in range(4))
        for token, i in ranks.items():
            self.stops[i] = token.rstrip(closers)[-1:] in (b".", b"!", b"?")
            self.closes[i] = not token.strip(closers)
            self.spaced[i] = token[:1].isspace()
            self.line[i] = token.endswith(b"\n")

    def encode(self, text: str) -> list[int]:
        if any(t in text for t in self.special):
            parts = self.cut_special.split(text)
            return [i for n, part in enumerate(parts)
                    for i in ([self.special[part]] if n % 2 else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[int]:
        if not has_runs(text):
            return self.encoding.encode_ordinary(text)
        out, start = [], 0
        for m in _RUNS.finditer(text):
            out += self.encoding.encode_ordinary(text[start:m.end()])
            start = m.end()
        return out + self.encoding.encode_ordinary(text[start:] if start else text)


@lru_cache(maxsize=2)
def encoder_of(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def places(encoder: Encoder, ids: np.ndarray, ends: np.ndarray,
           gap: int = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Positions (tokens before a cut) and kinds of the places of documents that
    follow one another in ``ids``, each up to its ``ends`` (its end id included)."""
    stop, line = encoder.stops[ids], encoder.line[ids]
    stop[1:] |= stop[:-1] & encoder.closes[ids[1:]]
    spaced = encoder.spaced[ids]
    mark = np.empty(len(ids), bool)  # a place after the token
    mark[:-1] = (stop[:-1] & spaced[1:]) | (line[:-1] & ~(line[1:] & spaced[1:]))
    mark[ends[ends > 1] - 2] = False  # not between the text and its end id
    mark[ends - 1] = True
    marks = np.concatenate([[0], np.flatnonzero(mark) + 1])
    width = np.diff(marks)
    step = max(1, gap // 2)
    extra = np.where(width > gap, (width - 1) // step, 0)  # places added before each mark
    last = np.cumsum(extra + 1) - 1  # where the marks themselves go
    pos = np.full(len(width) + int(extra.sum()), step)
    pos[last] = width - extra * step
    kind = np.full(len(pos), INSIDE, np.uint8)
    kind[last] = SENTENCE_END
    kind[last[np.searchsorted(marks[1:], ends)]] = DOCUMENT
    return np.cumsum(pos), kind


def segments(pos: np.ndarray, block: int) -> list[tuple[int, int, int, int]]:
    """``(first place, last place + 1, first token, last token + 1)`` of the
    segments of at most ``block`` tokens."""
    out, i, start = [], 0, 0
    while i < len(pos):
        j = int(np.searchsorted(pos, start + block, side="right"))
        out.append((i, j, start, int(pos[j - 1])))
        i, start = j, int(pos[j - 1])
    return out


def best_cuts(pos: list[int], penalty: list[int], window: int = WINDOW,
              short: int = SHORT) -> list[int]:
    """Indices of the chosen places; ``pos[0]`` is the stream's start and the
    last place is its end.  Neighbouring places lie within one window."""
    m = len(pos)
    # i -> j of windows whose length is a power of two, grouped by j
    p = np.array(pos, np.int64)
    into, out_of = [], []
    d = 1
    while d <= window:
        j = np.arange(m) if d >= short else np.array([m - 1])
        i = np.searchsorted(p, p[j] - d)
        ok = np.flatnonzero(p[i] == p[j] - d)
        into.append(j[ok])
        out_of.append(i[ok])
        d *= 2
    j_all, i_all = np.concatenate(into), np.concatenate(out_of)
    order = np.argsort(j_all, kind="stable")
    exact_i = i_all[order].tolist()
    first = np.searchsorted(j_all[order], np.arange(m + 1)).tolist()

    # costs in tokens above, the number of windows below
    unit = 1 << 32
    full = ((window - p) * unit).tolist()
    after = (p * unit).tolist()
    leave = (np.array(penalty, np.int64) * unit + 1).tolist()
    best, back, rising = [0] * m, [0] * m, [0] * m
    queue, head = [0], 0
    reach = np.searchsorted(p, p - window).tolist()  # the first place in reach
    for j in range(1, m):
        while queue[head] < reach[j]:
            head += 1
        source = queue[head]
        cost = rising[source] + full[j]
        a, b = first[j], first[j + 1]
        if a < b:
            for i in exact_i[a:b]:
                if best[i] < cost:
                    cost, source = best[i], i
        cost += leave[j]
        best[j], back[j] = cost, source
        rising[j] = v = cost + after[j]
        while len(queue) > head and rising[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    chosen, j = [], m - 1
    while j > 0:
        chosen.append(j)
        j = back[j]
    return chosen[::-1]


def pack_block(rows: list[tuple[int, int, bytes]], window: int, sentence: int,
               hard: int) -> tuple[np.ndarray, ...]:
    """The pieces of one block: ``rows`` are ``(key, tokens, places)`` in stream
    order.  Returns row index, start in the row, length, window, offset."""
    marks = np.frombuffer(b"".join(r[2] for r in rows), np.uint8)
    pos = np.concatenate([[0], np.cumsum((marks & 63).astype(np.int64) + 1)])
    cost = np.array([0, sentence, hard], np.int64)[np.concatenate([[0], marks >> 6])]
    windows = np.concatenate([[0], pos[best_cuts(pos.tolist(), cost.tolist(), window)]])
    ends = np.cumsum([r[1] for r in rows])
    cuts = np.union1d(windows, ends)
    starts, length = cuts[:-1], np.diff(cuts)
    row = np.searchsorted(ends, starts, side="right")
    seq = np.searchsorted(windows, starts, side="right") - 1
    begin = np.concatenate([[0], ends])[row]
    return row, starts - begin, length, seq, starts - windows[seq]


# -- Spark ------------------------------------------------------------------

def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID,
         sentence: int = SENTENCE, hard: int = HARD, block: int = BLOCK) -> DataFrame:
    """One row per piece of a document in a sequence: ``doc_id``, ``start`` (its
    document's ids before it), ``length``, ``doc_tokens``, ``sequence_id``
    (ascends with the stream), ``offset`` (in the sequence) and ``ids`` (binary,
    little-endian unsigned 32-bit).  ``vocabulary`` is a file every executor
    can read."""
    gap = min(GAP, window)
    ship(docs.sparkSession)
    schema = ("doc_id long, key long, first long, tokens long, doc_tokens long, places binary, "
              "ids binary")
    names = ["doc_id", "key", "first", "tokens", "doc_tokens", "places", "ids"]
    types = [pa.int64()] * 5 + [pa.binary()] * 2

    def cut(batches):
        encoder = encoder_of(vocabulary)
        end = np.array([end_id], encoder.dtype)
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, key, texts = (c.to_pylist() for c in batch.columns)
            each = [np.array(encoder.encode(t or ""), encoder.dtype) for t in texts]
            ids = np.concatenate([x for e in each for x in (e, end)])
            ends = np.cumsum([len(e) + 1 for e in each])
            pos, kind = places(encoder, ids, ends, gap)
            marks = (np.diff(pos, prepend=0) - 1).astype(np.uint8) | (kind << 6)
            rows, i, start = [], 0, 0
            for n, (stop, j) in enumerate(zip(ends.tolist(), np.searchsorted(pos, ends).tolist(),
                                              strict=True)):
                for x, y, a, b in segments(pos[i:j + 1] - start, block):
                    rows.append((doc[n], key[n], a, b - a, stop - start,
                                 marks[i + x:i + y].tobytes(), ids[start + a:start + b].tobytes()))
                i, start = j + 1, stop
            yield arrow_batch(rows, names, types)

    d = with_id(docs).select("doc_id", F.xxhash64("text").alias("key"), "text")
    encoded = stage(d.mapInArrow(cut, schema)
                    # rises with the segments of a row; written, so it stays
                    .withColumn("segment", F.monotonically_increasing_id()), "encoded")
    in_stream = running(encoded.select("doc_id", "key", "segment", "tokens", "places"),
                        ["doc_id", "key", "segment"], "tokens", "stream")

    def solve(number, members):
        members = sorted((m["before"], m["segment"], m["tokens"], bytes(m["places"]))
                         for m in members)
        row, start, length, seq, offset = pack_block([m[1:] for m in members], window, sentence,
                                                     hard)
        edge = np.searchsorted(row, np.arange(len(members) + 1)).tolist()
        seq = seq + number * (2 * block)  # a block has fewer windows than tokens
        return [(m[1], start[a:b], length[a:b], seq[a:b], offset[a:b])
                for m, a, b in zip(members, edge, edge[1:], strict=False)]

    blocks = (in_stream.groupBy(F.expr(f"before div {block}").alias("number"))
              .agg(F.collect_list(F.struct("before", "segment", "tokens", "places")).alias("m")))
    cuts = map_rows(blocks, solve, "segment long, starts array<long>, lengths array<long>, "
                    "sequences array<long>, offsets array<long>", chunk=512)

    def pieces(encoder, doc_id, first, doc_tokens, ids, starts, lengths, sequences, offsets):
        got = np.frombuffer(ids, encoder.dtype).astype("<u4")
        return [(doc_id, first + s, n, doc_tokens, q, o, got[s:s + n].tobytes())
                for s, n, q, o in zip(starts.tolist(), lengths.tolist(), sequences.tolist(),
                                      offsets.tolist(), strict=True)]

    joined = encoded.join(cuts, "segment").select(
        "doc_id", "first", "doc_tokens", "ids", "starts", "lengths", "sequences", "offsets")
    return map_rows(joined, pieces, "doc_id long, start long, length long, doc_tokens long, "
                    "sequence_id long, offset long, ids binary",
                    setup=lambda: encoder_of(vocabulary))


def with_padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``sequence_id``, ``length`` and ``padding`` of every sequence."""
    n = F.col("length")
    return (pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"))
            .withColumn("padding", F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(window - n)))
