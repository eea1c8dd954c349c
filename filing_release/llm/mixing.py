"""Mixing sources to target weights by temperature, with native expressions only.

A source's weight is its token share to the power ``t``, normalised: ``t`` = 1
keeps the corpus as it is, ``t`` = 0 makes all sources equal.  ``t`` is found
by bisection (six halvings a job, each one aggregation over the source table):
the largest ``t`` whose entropy is at least ``entropy`` of the possible, raised
as far as needed so that no source is read more than ``repeats`` times.

*Realisation.*  A source's documents are dealt by hash into blocks of about
``BLOCK_TOKENS`` tokens.  Each epoch visits the blocks in another random order,
and documents in a block in random order.  A source's quota is its weight
times the budget: whole epochs, then blocks of one more epoch while they fit;
only the block where the quota ends is cut, document by document.  Running sums
so go over blocks of a source and over documents of one block, never over all
documents of a hot source.

Without a budget the smallest one is taken that reads every document at least
once, so nothing is left out.

Defined cases: null text has no tokens; a null source counts as ``''``;
sources without tokens keep their documents once; rows that share doc_id and
source stay together; an empty table gives an empty plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

ENTROPY = 0.95
REPEATS = 4.0
BLOCK_TOKENS = 2 ** 18
HALVINGS, ROUNDS = 6, 4
SEED = 17


def tokens(text: Column) -> Column:
    """Number of words."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def exponent(shares: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS) -> float:
    """The exponent for ``shares`` (``share``, one row per source, sums to 1)."""
    lo_e, lo_r = 0.0, 0.0
    step = 1.0
    steps = 2 ** HALVINGS

    def measured(starts: list[float], width: float) -> dict[float, tuple[bool, bool]]:
        grid = sorted({s + width * i / steps for s in starts for i in range(steps + 1)})
        t = F.col("t")
        power = F.pow("share", t)
        rows = (shares.select("share", F.explode(F.array(*map(F.lit, grid))).alias("t"))
                .groupBy("t").agg(F.sum(power).alias("z"),
                                  F.sum(power * F.log("share")).alias("s"),
                                  F.max(F.pow("share", t - 1)).alias("most"),
                                  F.count("*").alias("k"))
                .select("t", (F.log("z") - t * F.col("s") / F.col("z")
                              >= F.lit(entropy) * F.log("k") - 1e-9).alias("even"),
                        (F.col("most") / F.col("z") <= repeats + 1e-9).alias("within")).collect())
        return {r["t"]: (r["even"], r["within"]) for r in rows}  # a grid, not sources

    for _ in range(ROUNDS):
        got = measured([lo_e, lo_r], step)
        if not got:
            return 1.0
        inside = lambda s, t: s <= t <= s + step
        lo_e = max((t for t, (even, _) in got.items() if even and inside(lo_e, t)), default=lo_e)
        lo_r = max((t for t, (_, fits) in got.items() if not fits and inside(lo_r, t)),
                   default=lo_r)
        step /= steps
        limited = any(not fits for _, fits in got.values())
    hi_r = lo_r + step if limited or lo_r > 0 else 0.0
    return min(1.0, max(lo_e, hi_r))


def _order(*parts) -> Column:
    """A random but repeatable order: md5 of the parts."""
    return F.md5(F.concat_ws("|", F.lit(str(SEED)), *[
        F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]))


def plan(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS,
         budget: str | int | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``doc_id``, ``source``, ``n_tokens``, ``epoch``, ``block``, ``visit``: one
    row for each time a document is read.

    Sorting by ``epoch``, ``visit`` and ``md5(doc_id)`` gives the reading order.
    ``budget`` is a number of tokens, ``"corpus"`` for as many as there are, or
    None for the smallest that reads everything.
    """
    each = stage(docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("source"), tokens(F.col("text")).alias("n_tokens"))
        .groupBy("doc_id", "source").agg(F.sum("n_tokens").alias("n_tokens")), "tokens")
    sizes = each.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    shares = stage(sizes.select("source", "tokens", (F.col("tokens") / F.lit(float(max(total, 1))))
                                .alias("share")), "shares")
    some = shares.where("tokens > 0")
    t = exponent(some, entropy, repeats)
    z = some.agg(F.sum(F.pow("share", F.lit(t)))).first()[0] or 1.0
    weight = F.when(F.col("tokens") > 0, F.pow("share", F.lit(t)) / F.lit(z)).otherwise(F.lit(0.0))
    weights = shares.withColumn("weight", weight)
    if budget is None:
        budget = weights.where("tokens > 0").agg(F.max(F.col("tokens") / F.col("weight"))).first()[0]
    budget = float(total if budget == "corpus" else budget or 0)
    quota = F.round(F.col("weight") * F.lit(budget)).cast("long")
    room = stage(weights.withColumn("quota", quota).select(
        "source", "tokens", "weight", "quota",
        F.ceil(F.greatest(F.col("tokens"), F.lit(1)) / F.lit(float(block_tokens))).cast("long")
        .alias("n_blocks"),
        F.when(F.col("tokens") > 0, F.expr("quota div greatest(tokens, 1)")).otherwise(1)
        .alias("epochs")), "quotas").withColumn(
        "rest", F.when(F.col("tokens") > 0, F.col("quota") - F.col("epochs") * F.col("tokens"))
        .otherwise(0))

    block = F.pmod(F.conv(F.substring(_order("block", F.col("doc_id")), 1, 8), 16, 10)
                   .cast("long"), F.col("n_blocks"))
    dealt = each.join(room, "source").withColumn("block", block)
    in_source = Window.partitionBy("source").orderBy("turn").rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = dealt.groupBy("source", "block").agg(
        F.sum("n_tokens").alias("block_tokens"), F.max("epochs").alias("epochs"),
        F.max("rest").alias("rest"))
    visits = stage(blocks.withColumn("turn", _order(
        "last", F.col("source"), F.col("epochs"), F.col("block"))).withColumn(
        "before", F.coalesce(F.sum("block_tokens").over(in_source), F.lit(0))).select(
        "source", "block", "epochs", F.greatest(F.lit(0), F.col("rest") - F.col("before"))
        .alias("left"), "block_tokens"), "blocks")
    placed = dealt.select("doc_id", "source", "n_tokens", "block").join(visits, ["source", "block"])
    in_block = Window.partitionBy("source", "block").orderBy(
        _order("doc", F.col("doc_id")), "doc_id")
    cut = placed.where("0 < left and left < block_tokens").withColumn(
        "extra", (F.sum("n_tokens").over(in_block) <= F.col("left")).cast("int"))
    whole = placed.where("not (0 < left and left < block_tokens)").withColumn(
        "extra", ((F.col("block_tokens") <= F.col("left")) & (F.col("left") > 0)).cast("int"))
    times = cut.unionByName(whole).withColumn(
        "times", (F.col("epochs") + F.col("extra")).cast("int")).where("times > 0")
    return times.select("doc_id", "source", "n_tokens", "block", F.explode(
        F.sequence(F.lit(0), F.col("times") - 1)).alias("epoch")).select(
        "doc_id", "source", "n_tokens", "epoch", "block",
        _order("visit", F.col("source"), F.col("epoch"), F.col("block")).alias("visit"))


def mixed(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS,
          budget: str | int | None = None) -> DataFrame:
    """``docs`` with every row as often as the plan reads it."""
    times = plan(docs, entropy, repeats, budget).groupBy("doc_id", "source").agg(
        F.count("*").cast("int").alias("_times")).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), "_times")
    d = docs.where("doc_id is not null")
    joined = d.join(times, (d["doc_id"].cast("long") == times["_id"])
                    & (F.coalesce(d["source"], F.lit("")) == times["_source"]))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(
        *[d[c] for c in d.columns])
