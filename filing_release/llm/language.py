"""Language ID by compression.

Every language gets a zstandard raw-content dictionary made of its learning
texts.  Short ones are repeated up to the size of the longest, so no language
loses learning data to a rare one.  A text is compressed with each of them, and
the language whose dictionary gives the smallest frame wins.  A narrow margin between the best
and the second is reported as ``rejected``.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
size ties go to the language with more learning rows, then by name; rows
without a language are never learned from; with no language learned at all
every row is ``und``.
"""

from __future__ import annotations

from functools import lru_cache

import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fold_bucket, letter_runs, map_rows

SAMPLE_ROWS = 400       # learning rows read per language
DICT_BYTES = 128 * 1024  # dictionary bytes per language
LEVEL = 3
MARGIN = 0.01           # below this relative gap the answer is rejected
_LETTER = regex.compile(r"\p{L}")


def dictionaries(docs: DataFrame, sample_rows: int = SAMPLE_ROWS,
                 dict_bytes: int = DICT_BYTES) -> list[tuple[str, bytes]]:
    """``(language, content)``, most frequent language first.

    A bounded fit: at most ``sample_rows`` rows of each language in hash order
    of their ids (a grouped limit, so a hot language isn't gathered).  Texts
    of over ``dict_bytes / 8`` characters come last, so that one can't fill a
    dictionary while others are there.
    """
    learn = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
                       & F.col("text").isNotNull())
    counts = dict(learn.groupBy("lang").count().collect())
    order = Window.partitionBy("lang").orderBy("over", F.xxhash64("doc_id"), "doc_id")
    picked = (learn.select("lang", "doc_id", (F.length("text") > dict_bytes // 8).alias("over"))
              .withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= sample_rows)
              .select("lang", "doc_id", "rn"))
    # at most sample_rows short rows per language: a proven bound for the broadcast
    texts = map_rows(
        learn.join(F.broadcast(picked), ["lang", "doc_id"])
        .select("lang", "rn", F.substring("text", 1, dict_bytes).alias("text")),
        lambda lang, rn, text: [(lang, rn, (plain(text) + b" ")[:dict_bytes])],
        "lang string, rn int, content binary")
    # only what a dictionary takes is collected
    before = F.sum(F.octet_length("content")).over(
        Window.partitionBy("lang").orderBy("rn", "content").rowsBetween(
            Window.unboundedPreceding, -1))
    taken = texts.withColumn("before", F.coalesce(before, F.lit(0))).where(
        F.col("before") < dict_bytes)
    content: dict[str, bytes] = {}
    for r in taken.orderBy("lang", "before").collect():
        content[r["lang"]] = content.get(r["lang"], b"") + bytes(r["content"])
    return [(lang, content[lang][:dict_bytes])
            for lang in sorted(content, key=lambda x: (-counts[x], x))]


def plain(text: str) -> bytes:
    """What is compressed: lower-cased letters, everything else one space."""
    return b" ".join(letter_runs(text))


def filled(content: bytes, size: int) -> bytes:
    """``content`` repeated up to ``size`` bytes."""
    return (content * (size // len(content) + 1))[:size] if content.strip() else content


@lru_cache(maxsize=2)
def _compressors(dicts: tuple[tuple[str, bytes], ...], level: int):
    out = []
    # equal sizes: offsets into a shorter dictionary would be cheaper
    size = max((len(c) for _, c in dicts), default=0)
    for lang, content in dicts:
        content = filled(content, size)
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        out.append((lang, zstandard.ZstdCompressor(
            level=level, dict_data=d, write_content_size=False, write_checksum=False)))
    return out


def identify(docs: DataFrame, dicts: list[tuple[str, bytes]], level: int = LEVEL,
             margin: float = MARGIN) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (0 to 1), ``rejected``.

    ``score`` is gap / (gap + ``margin``) for the relative gap between the
    two smallest frames, so 0.5 is the rejection limit.
    """
    spark = docs.sparkSession
    # the dictionaries' bytes are bounded by languages x dict_bytes
    held = spark.sparkContext.broadcast(tuple(dicts))

    def row(compressors, doc_id, text):
        if not compressors or not text or not _LETTER.search(text):
            return [(doc_id, "und", 0.0, True)]
        raw = plain(text)
        sizes = sorted((len(c.compress(raw)), k) for k, (_, c) in enumerate(compressors))
        best, k = sizes[0]
        gap = (sizes[1][0] - best) / best if len(sizes) > 1 else 1.0
        return [(doc_id, compressors[k][0], gap / (gap + margin), gap < margin)]

    return map_rows(docs.select("doc_id", "text"), row,
                    "doc_id long, lang_pred string, score double, rejected boolean",
                    setup=lambda: _compressors(held.value, level))


def identify_documents(docs: DataFrame) -> DataFrame:
    """Learn outside fold 0, predict every row."""
    d = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    dicts = dictionaries(d.where(fold_bucket("doc_id") != 0))
    out = identify(d, dicts)
    return out.select("doc_id", (fold_bucket("doc_id") == 0).alias("held_out"),
                      "lang_pred", "score", "rejected")
