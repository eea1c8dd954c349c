"""BPE encoding and decoding by tree concatenation.

A text is cut at ASCII white space, where the pre-tokeniser always cuts, so
encodings of such pieces simply follow one another.  What is left is long
*unsplit* text: a pre-token of thousands of symbols.  It is cut into leaves,
the leaves are encoded apart (on a cluster: in separate tasks), and the
results are joined pairwise up a tree.  At each join a window around it is
encoded anew and grows until both of its edges agree with the sides.

*Agreement is a proof.*  A sequence of tokens is the BPE encoding of its text
exactly when every two neighbours are the encoding of their own text.  So a
join is right when the pairs across the window's edges re-encode to
themselves, and no distance or confidence limit is involved.

Defined cases: a null text is encoded as the empty text (no ids, decoded to
``''``); extra columns are ignored; repeated rows each give a row.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_CACHE, forget, map_rows, with_id

LEAF = 2048          # symbols encoded at once in an unsplit run
SPLIT_CHARS = 65536  # longer texts are dealt out to tasks in pieces


class Codec:
    """One vocabulary file with its memo of words, one per Python worker."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(vocabulary)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut_special = (re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
                            if self.special else None)
        n = self.tok.get_vocab_size(with_added_tokens=True)
        self.tokens = np.array([self.tok.id_to_token(i) or "" for i in range(n)], object)
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    # -- encoding -----------------------------------------------------------
    def encode(self, text: str, leaf: int = LEAF) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        ws = text.encode().split()
        out = list(map(self.memo.get, ws))
        if None in out:
            miss = dict.fromkeys(w for w, v in zip(ws, out, strict=True) if v is None)
            old = self.older
            short = []
            for w in miss:
                if (v := old.get(w)) is not None:
                    miss[w] = v
                elif len(w) <= leaf:
                    short.append(w)
                else:
                    miss[w] = self.encode_unsplit(w.decode(), leaf)
            miss.update((w, ids_bytes(e.ids)) for w, e in zip(short, self.tok.encode_batch_fast(
                [w.decode() for w in short], add_special_tokens=False), strict=True))
            if len(self.memo) + len(miss) > WORD_CACHE:
                # words in use come back from the older half, the others go with it
                self.older, self.memo = self.memo, {}
            self.memo.update((w, v) for w, v in miss.items() if len(w) <= 64)
            out = [miss[w] if v is None else v for w, v in zip(ws, out, strict=True)]
        return b"".join(out)

    def encode_unsplit(self, word: str, leaf: int = LEAF) -> bytes:
        """A long run without white space."""
        parts = []
        for kind, run in self.runs(word):
            parts.append(ids_bytes([kind]) if kind >= 0 else self.ids(join_tree(
                self, [self.merge(s) for s in leaves(run, leaf)])))
        return b"".join(parts)

    def runs(self, word: str) -> list[tuple[int, list[str]]]:
        """The pre-tokens of ``word`` as symbols (kind -1) and the special
        tokens in it (kind = their id)."""
        out: list[tuple[int, list[str]]] = []
        for part in self.cut_special.split(word) if self.cut_special else [word]:
            if part in self.special:
                out.append((self.tok.token_to_id(part), []))
            elif part:
                norm = self.tok.normalizer.normalize_str(part) if self.tok.normalizer else part
                for pre, _ in self.tok.pre_tokenizer.pre_tokenize_str(norm):
                    out.append((-1, [*pre[:-1], pre[-1] + self.suffix]))
        return out

    def merge(self, symbols: list[str]) -> list[str]:
        """BPE of one run: the lowest-ranked pair first, leftmost on ties."""
        n, text = len(symbols), list(symbols)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        rank = self.rank
        heap = [(r, i, text[i], text[i + 1]) for i in range(n - 1)
                if (r := rank.get((text[i], text[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if j < 0 or text[i] != a or text[j] != b:
                continue
            text[i], text[j] = a + b, ""
            right[i] = k = right[j]
            right[j] = -1
            if k >= 0:
                left[k] = i
                if (r := rank.get((text[i], text[k]))) is not None:
                    heapq.heappush(heap, (r, i, text[i], text[k]))
            if (p := left[i]) >= 0 and (r := rank.get((text[p], text[i]))) is not None:
                heapq.heappush(heap, (r, p, text[p], text[i]))
        return [t for t in text if t]

    def symbols(self, token: str) -> list[str]:
        if self.suffix and token.endswith(self.suffix):
            core = token[:-len(self.suffix)]
            return [*core[:-1], core[-1] + self.suffix]
        return list(token)

    def agree(self, a: str, b: str) -> bool:
        return self.merge(self.symbols(a) + self.symbols(b)) == [a, b]

    def ids(self, tokens: list[str]) -> bytes:
        # symbols outside the vocabulary are left out, as the library does without an unk token
        return ids_bytes([i for t in tokens if (i := self.vocab.get(t)) is not None])

    # -- decoding -----------------------------------------------------------
    def decode(self, ids: bytes) -> str:
        """Without a decoder in the file the library joins tokens by a space."""
        if self.tok.decoder is not None:
            return self.tok.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        return " ".join(self.tokens[np.frombuffer(ids, "<u4")].tolist())


def ids_bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def leaves(symbols: list[str], leaf: int) -> list[list[str]]:
    return [symbols[i:i + leaf] for i in range(0, len(symbols), leaf)] or [[]]


def join(codec: Codec, left: list[str], right: list[str]) -> list[str]:
    """The encoding of two encoded neighbours' whole text."""
    if not left or not right:
        return left + right
    i = j = 0
    middle: list[str] = []
    while True:
        a = left[len(left) - i - 1] if i < len(left) else None
        b = right[j] if j < len(right) else None
        if not middle:
            ok_left = ok_right = codec.agree(a, b)
        else:
            ok_left = a is None or codec.agree(a, middle[0])
            ok_right = b is None or codec.agree(middle[-1], b)
        if ok_left and ok_right:
            return left[:len(left) - i] + middle + right[j:]
        # the window doubles on the side that disagrees
        i = i if ok_left else min(len(left), 2 * i + 1)
        j = j if ok_right else min(len(right), 2 * j + 1)
        middle = codec.merge([s for t in (*left[len(left) - i:], *right[:j])
                              for s in codec.symbols(t)])


def join_tree(codec: Codec, parts: list[list[str]]) -> list[str]:
    while len(parts) > 1:
        parts = [join(codec, parts[k], parts[k + 1]) if k + 1 < len(parts) else parts[k]
                 for k in range(0, len(parts), 2)]
    return parts[0]


@lru_cache(maxsize=2)
def codec_of(vocabulary: str) -> Codec:
    return Codec(vocabulary)


# -- Spark ------------------------------------------------------------------

def encode(docs: DataFrame, vocabulary: str, split_chars: int = SPLIT_CHARS,
           leaf: int = LEAF) -> DataFrame:
    """``doc_id``, ``ids`` (binary, little-endian u32) of every row.

    ``vocabulary`` is a file every executor can read.  Texts of up to
    ``split_chars`` are encoded where they lie, without a shuffle.  A longer
    text is cut at white space into pieces, and its unsplit runs into leaves;
    pieces and leaves are dealt to tasks one by one and joined afterwards, so
    no single text decides how long a stage takes.
    """
    d = with_id(docs).withColumn("text", F.coalesce("text", F.lit("")))
    long = F.length("text") > split_chars

    def whole(codec, doc_id, text):
        return [(doc_id, codec.encode(text, leaf))]

    def cut(codec, doc_id, text):
        # text_key tells two texts under one doc_id apart
        key = hashlib.md5(text.encode()).hexdigest()
        return [(doc_id, key, n, kind, body) for n, (kind, body)
                in enumerate(_pieces(codec, text, split_chars // 2, leaf))]

    def piece(codec, doc_id, key, n, kind, body):
        if kind == "text":
            got = codec.encode(body, leaf)
        else:
            got = " ".join(codec.merge(codec.symbols(body))).encode()
        return [(doc_id, key, n, kind, got)]

    def assemble(codec, doc_id, copies, pieces):
        out, run = [], []
        seen = {p["n"]: p for p in pieces}
        for n in sorted(seen):
            p = seen[n]
            if p["kind"] == "leaf" or p["kind"] == "last":
                run.append(bytes(p["body"]).decode().split(" "))
                if p["kind"] == "last":
                    out.append(codec.ids(join_tree(codec, run)))
                    run = []
            else:
                out.append(bytes(p["body"]))
        return [(doc_id, b"".join(out))] * copies

    def setup():
        forget()
        return codec_of(vocabulary)

    short = map_rows(d.where(~long), whole, "doc_id long, ids binary", setup=setup)
    pieces = map_rows(d.where(long), cut,
                      "doc_id long, key string, n int, kind string, body string",
                      chunk=64, setup=setup)
    dealt = pieces.repartition(F.xxhash64("doc_id", "key", "n"))
    encoded = map_rows(dealt, piece, "doc_id long, key string, n int, kind string, body binary",
                       chunk=256, setup=setup)
    # a row repeated c times brings each piece c times: count copies by piece 0
    gathered = (encoded.groupBy("doc_id", "key")
                .agg(F.sum((F.col("n") == 0).cast("int")).alias("copies"),
                     F.collect_list(F.struct("n", "kind", "body")).alias("pieces"))
                .select("doc_id", "copies", "pieces"))
    joined = map_rows(gathered, assemble, "doc_id long, ids binary", chunk=64, setup=setup)
    return short.unionByName(joined)


def _pieces(codec: Codec, text: str, piece_chars: int, leaf: int) -> list[tuple[str, str]]:
    """``("text", piece)`` cut at white space; ``("leaf" | "last", symbols)``
    for the leaves of an unsplit run, "last" closing the run."""
    out: list[tuple[str, str]] = []
    buf: list[str] = []
    size = 0
    for raw in text.encode().split():
        if len(raw) > leaf:
            if buf:
                out.append(("text", " ".join(buf)))
                buf, size = [], 0
            for kind, run in codec.runs(raw.decode()):
                if kind >= 0:
                    out.append(("text", codec.tok.id_to_token(kind)))
                elif run:
                    cut = leaves(run, leaf)
                    out += [("leaf", "".join(s)) for s in cut[:-1]]
                    out.append(("last", "".join(cut[-1])))
            continue
        w = raw.decode()
        buf.append(w)
        size += len(w) + 1
        if size >= piece_chars:
            out.append(("text", " ".join(buf)))
            buf, size = [], 0
    if buf or not out:
        out.append(("text", " ".join(buf)))
    return out


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id``, ``decoded`` text of every row of ``encoded``."""
    return map_rows(encoded.select("doc_id", "ids"),
                    lambda c, doc_id, ids: [(doc_id, c.decode(bytes(ids or b"")))],
                    "doc_id long, decoded string", setup=lambda: codec_of(vocabulary))


def digests(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Counts and SHA-256 of ids and decoded text, without another pass."""
    def row(c, doc_id, ids):
        ids = bytes(ids)
        return [(doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                 hashlib.sha256(c.decode(ids).encode()).hexdigest())]
    return map_rows(encoded, row, "doc_id long, n_tokens long, ids_sha256 string, "
                    "decoded_sha256 string", setup=lambda: codec_of(vocabulary))
