"""I-Match document fingerprints, with native expressions only.

Terms are lower-cased runs of letters and digits, as 64-bit hashes.  The
lexicon holds the terms whose share of documents lies in a band (equivalently
an inverse-document-frequency band).  A document's terms in the lexicon are
made distinct and sorted, and ``SUBSETS`` randomised subsets of the lexicon
each give one hash of the terms they keep.  The fingerprint is the list of
these hashes; the likeness of two fingerprints is the share of equal ones.

The band bounds the lexicon: a term in at least ``LOW`` of all documents is
one of at most (distinct terms per document) / ``LOW``, whatever the corpus
size.  All of them are kept, as a hash table that every task reads: an array
of slots, each with all its terms.  There are at least twice as many slots as
terms, so a term is looked up in constant time without a join.

Defined cases: null text counts as empty; a text without lexicon terms uses
all its terms, one without terms the hash of the text; a subset that keeps
none of the terms uses the one that is first in its random order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

LOW, HIGH = 0.0005, 0.2   # share of documents that hold a lexicon term
#: (seed, keep one term in ...) of every randomised lexicon subset
SUBSETS = [(seed, keep) for seed, keep in enumerate(
    [4, 8, 16, 32, 48, 64, 64, 96, 96, 128, 128, 160, 192, 256, 256, 384], start=1)]


def terms(text: Column) -> Column:
    """Distinct term hashes of a text."""
    runs = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.transform(F.filter(runs, lambda w: w != ""), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """One row: ``slots`` holds every band term, in the order of its hash slot,
    ``table`` the array of terms of each slot.

    Document frequencies are counted over all documents.
    """
    spark = docs.sparkSession
    n = docs.count()
    df = docs.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").count()
    band = stage(df.where(F.col("count").between(max(2, low * n), max(2, high * n)))
                 .select("term"), "band")
    n_slots = 2 ** (2 * band.count()).bit_length()
    # from here on all is bounded by the band
    held = band.groupBy(F.pmod("term", F.lit(n_slots)).alias("slot")).agg(
        F.sort_array(F.collect_list("term")).alias("terms"))
    every = spark.range(n_slots).withColumnRenamed("id", "slot").join(held, "slot", "left")
    table = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", F.coalesce(
        "terms", F.array().cast("array<bigint>")).alias("terms")))), lambda x: x["terms"])
        .alias("table"))
    return stage(table.select(F.flatten("table").alias("slots"), "table"), "lexicon")


def once(value: Column, use) -> Column:
    """``use(value)``, with the value computed a single time."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fingerprint(text: Column, table: Column) -> Column:
    """Hex hashes of the subsets, joined by ``-``."""
    def known(ts: Column) -> Column:
        return F.filter(ts, lambda t: F.array_contains(F.element_at(
            table, (F.pmod(t, F.size(table)) + 1).cast("int")), t))

    def used(ts: Column) -> Column:
        return once(known(ts), lambda k: F.when(F.size(k) > 0, k).when(
            F.size(ts) > 0, ts).otherwise(F.array(F.xxhash64(text))))

    def subset(ts: Column, s: Column) -> Column:
        kept = F.filter(ts, lambda t: F.pmod(F.xxhash64(t, s["seed"]), s["keep"]) == 0)
        one = F.array_min(F.transform(ts, lambda t: F.xxhash64(t, s["seed"])))
        return F.hex(once(kept, lambda k: F.when(F.size(k) > 0, F.xxhash64(k)).otherwise(one)))

    plan = F.array(*[F.struct(F.lit(a).alias("seed"), F.lit(b).alias("keep"))
                     for a, b in SUBSETS])
    return once(F.array_sort(once(terms(text), used)), lambda ts: F.array_join(
        F.transform(plan, lambda s: subset(ts, s)), "-"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal subset hashes of two fingerprints."""
    pairs = F.arrays_zip(F.split(a, "-").alias("x"), F.split(b, "-").alias("y"))
    return F.size(F.filter(pairs, lambda p: p["x"] == p["y"])) / F.lit(float(len(SUBSETS)))


def with_next(docs: DataFrame, columns: list[str], rows: int = 256) -> DataFrame:
    """Adds ``next_<column>`` of the next row by ``doc_id`` (after the last: the
    first), without sorting all rows in one place.

    Ids are cut into ranges of equal width, at most 2 ** 20 of them; inside a
    range a window finds the next row, and each range gets a copy of the first
    row of the range after it.  One shuffle of the rows.
    """
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        return docs.withColumns({f"next_{c}": F.col(c) for c in columns})
    width = max(rows, (high - low) // 2 ** 20 + 1)
    part = F.floor((F.col("doc_id") - F.lit(low)) / F.lit(width)).cast("long")
    heads = docs.groupBy(part.alias("part")).agg(F.min("doc_id").alias("doc_id"))
    order = Window.orderBy("part")  # over at most 2 ** 20 rows
    after = heads.select("part", F.coalesce(F.lead("doc_id").over(order), F.lit(low))
                         .alias("doc_id"))
    # a proven bound: one row per range
    tagged = docs.join(F.broadcast(after.select("doc_id", F.col("part").alias("before"))),
                       "doc_id", "left")
    spots = F.array(F.struct(part.alias("part"), F.lit(False).alias("copy")),
                    F.struct(F.col("before").alias("part"), F.lit(True).alias("copy")))
    dealt = tagged.withColumn("spot", F.explode(F.filter(
        spots, lambda s: s["part"].isNotNull()))).select(
        *docs.columns, F.col("spot.part").alias("part"), F.col("spot.copy").alias("copy"))
    w = Window.partitionBy("part").orderBy("copy", "doc_id", *columns)
    return dealt.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns}).where(
        "not copy").drop("part", "copy")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half is
    replaced by the start of the next document."""
    d = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    table = lexicon(d).select("table")

    def printed(df: DataFrame, name: str, text: str) -> DataFrame:
        # the one-row lexicon enters as a scalar subquery: a constant to every task
        return df.withColumn("lexicon", table.scalar()).withColumn(
            name, fingerprint(F.col(text), F.col("lexicon"))).drop("lexicon")

    own = with_next(printed(d, "fingerprint", "text"), ["text", "fingerprint"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = own.select(
        "doc_id", n.cast("long").alias("n_chars"), "fingerprint", "next_fingerprint",
        F.concat(F.substring("text", 1, n - half), F.substring("next_text", 1, half))
        .alias("edited"))
    return printed(edited, "edited_fingerprint", "edited").select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
