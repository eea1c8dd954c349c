"""Review work as a log that can be replayed.

Every reviewer's step is one event, appended and never changed:

    EIN, round, ts, seq, kind, field, amount, user, explanation

``kind`` is an edit (``level`` sets a field, ``delta`` adds to it) or an action
(``fix``, ``fix_ignore``, ``check``, ``ignore``, ``skip``, ``reset``).  A round is
one sitting over an EIN; its last action closes it.  The state of every row is
the fold of its log over the row as extracted, so there are no saved rows that
could disagree with a ledger: resuming is replaying a longer log.

*Within a round*  edits before the last ``reset`` are cut; ``skip`` cuts all of
them and leaves the row unreviewed; edits after the closing action, and a round
without one (or whose last action is ``reset``), have no effect.

*A closing action is accepted*  ``fix`` with edits -> 1; ``fix_ignore`` with edits
-> 2 where residuals remain over the threshold, else 1; ``check`` without edits
and residuals -> 3; ``ignore`` -> 2; ``skip`` -> 0.  A rejected one leaves the row
as the round found it.  Rounds follow one another: later ones see the values,
states and fixed fields of earlier ones, and changes add up.

*On Spark*  Events are aggregated to one row per (EIN, round, field), then
pivoted to one row per (EIN, round): both with partial aggregates, so an EIN
with a third of all events is no hot group.  What is left per EIN is one entry
per round, a list as long as the review had rounds, which one higher-order
``aggregate`` folds on the row.  ``unapplied`` names every event without effect
and says why; nothing vanishes.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .absent import amount, check_present
from .filters import CHECKED, FIXED, IGNORED, UNREVIEWED
from .review import explanation_text, rules_of_table
from .rules import add_residuals, residual_columns, residual_of, rule_fields, rules_for
from .schema import FIXED_COL, STATE_COL

LOG_SCHEMA = ("EIN string, round int, ts timestamp, seq long, kind string, field string, "
              "amount double, user string, explanation string")
EDITS = ("level", "delta")
CLOSING = ("fix", "fix_ignore", "check", "ignore", "skip")
ACTIONS = (*CLOSING, "reset")


@dataclass
class Review:
    rows: DataFrame        # the reviewed table
    unapplied: DataFrame   # the log's columns, outcome


# --- the log on disk -----------------------------------------------------------------
def append(events: DataFrame, path: str, round_number: int) -> None:
    """Add one round's events; a round that is there already is an error, so a
    repeated job can't count events twice."""
    columns = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
    (events.withColumn("round", F.lit(int(round_number))).select(*columns).drop("round")
     .write.mode("errorifexists").parquet(f"{path.rstrip('/')}/round={int(round_number)}"))


def rounds_on_disk(spark: SparkSession, path: str) -> list[int]:
    from ..sources.sinks import _list
    return sorted(int(n.removeprefix("round=")) for n in _list(spark, path)
                  if n.startswith("round=") and _list(spark, f"{path}/{n}"))


def read(spark: SparkSession, path: str) -> DataFrame:
    if not rounds_on_disk(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def events_of(adjustments: DataFrame | None, actions: DataFrame | None,
              spark: SparkSession) -> DataFrame:
    """One round's events from a table of edits (EIN, field, action, amount,
    user, explanation, ts, seq) and one of actions (EIN, action, and ts, seq,
    user, explanation where it has them).  An action without a time closes the
    round, after all edits."""
    out = spark.createDataFrame([], LOG_SCHEMA).drop("round")
    if adjustments is not None:
        out = out.unionByName(adjustments.select(
            "EIN", "ts", "seq", F.col("action").alias("kind"), "field", "amount", "user",
            "explanation"))
    if actions is not None:
        def given(name, kind, default="null"):
            return (F.col(name) if name in actions.columns else F.expr(default)).cast(kind).alias(name)
        out = out.unionByName(actions.select(
            "EIN", given("ts", "timestamp", "timestamp'9999-12-31 00:00:00'"), given("seq", "long", "0"),
            F.col("action").alias("kind"), F.lit(None).cast("string").alias("field"),
            F.lit(None).cast("double").alias("amount"), given("user", "string"),
            given("explanation", "string")))
    return out


# --- the fold ------------------------------------------------------------------------
def normalised(log: DataFrame) -> DataFrame:
    """Field names in upper case, kinds in lower case, blanks trimmed."""
    return log.withColumns({"EIN": F.trim("EIN"), "field": F.upper(F.trim("field")),
                            "kind": F.lower(F.trim("kind"))})


def _at(name: str | None = None) -> Column:
    return F.struct("ts", "seq") if name is None else F.struct(f"{name}.ts", f"{name}.seq")


def judged(log: DataFrame, rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The log with ``outcome`` (why an event has no effect by itself, or null)
    and ``close``, the closing action of its round."""
    kind, edit = F.col("kind"), F.col("kind").isin(*EDITS)
    acts = log.filter(kind.isin(*ACTIONS))
    rounds = acts.groupBy("EIN", "round").agg(
        F.max(F.struct("ts", "seq", "kind", "user", "explanation")).alias("close"),
        F.max(F.when(kind == "reset", _at())).alias("reset"))
    known = rows.select(F.col("EIN"), F.lit(True).alias("in_rows"))
    j = log.join(rounds, ["EIN", "round"], "left").join(known, "EIN", "left")
    open_round = F.col("close").isNull() | (F.col("close.kind") == "reset")
    outcome = (
        F.when(F.col("in_rows").isNull(), "EIN not in the extract")
        .when(F.col("round").isNull() | F.col("ts").isNull() | F.col("seq").isNull(),
              "no round or time")
        .when(kind.isNull() | ~kind.isin(*EDITS, *ACTIONS), "unknown kind")
        .when(edit & (F.col("field").isNull() | ~F.col("field").isin(list(fields))),
              "field can't be edited")
        .when(edit & F.col("amount").isNull(), "no amount")
        .when(open_round & (kind != "reset"), "round not closed")
        .when(edit & F.coalesce(_at() <= F.col("reset"), F.lit(False)), "reset")
        .when(edit & (_at() > _at("close")), "after the closing action")
        .when(kind.isin(*CLOSING) & (_at() < _at("close")), "not the closing action")
        .when(edit & (F.col("close.kind") == "skip"), "skipped"))
    return j.withColumn("outcome", outcome).drop("reset", "in_rows")


def _rounds(events: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per (EIN, round): the closing action, and per field the last level
    set and the sum of the deltas after it."""
    k = ["EIN", "round", "field"]
    edits = events.filter(F.col("outcome").isNull() & F.col("kind").isin(*EDITS))
    per = edits.groupBy(*k).agg(
        F.max(F.when(F.col("kind") == "level", F.struct("ts", "seq", "amount"))).alias("level"),
        F.min(_at()).alias("first"), F.max(F.struct("ts", "seq", "user", "explanation")).alias("last"))
    deltas = (edits.filter(F.col("kind") == "delta").join(per.select(*k, "level"), k)
              .filter(F.col("level").isNull() | (_at() > _at("level")))
              # past the last digit of money, so the order of partial sums can't show
              .groupBy(*k).agg(F.round(F.sum("amount"), 6).alias("delta")))
    nets = per.join(deltas, k, "left").select(
        *k, "first", "last", F.struct(F.col("level.amount").alias("level"),
                                      F.coalesce("delta", F.lit(0.0)).alias("delta")).alias("net"))
    pivoted = nets.groupBy("EIN", "round").agg(
        *[F.max(F.when(F.col("field") == f, F.col("net"))).alias(f) for f in fields],
        F.transform(F.array_sort(F.collect_list(F.struct("first", "field"))),
                    lambda x: x["field"]).alias("changed"),
        F.max("last").alias("last"))
    closed = events.filter(F.col("outcome").isNull() & F.col("kind").isin(*CLOSING)) \
        .select("EIN", "round", "close").distinct()
    return closed.join(pivoted, ["EIN", "round"], "left")


def _worst(values: dict[str, Column], df: DataFrame, forms: Sequence[str],
           kind_col: str | None) -> Column:
    """The largest |residual| of a row with ``values`` in place of its fields; a
    null residual counts as 0."""
    def amt(name):
        return values.get(name, amount(df.columns, name))
    out = []
    for form in forms:
        for r in rules_for(form):
            e = F.abs(F.coalesce(residual_of(r, amt), F.lit(0.0)))
            out.append(F.when(F.col(kind_col) == form, e).otherwise(0.0) if kind_col else e)
    return F.greatest(*out) if len(out) > 1 else out[0] if out else F.lit(0.0)


def replay(rows: DataFrame, log: DataFrame, fields: Sequence[str], threshold: float = 1000.0,
           optional: Collection[str] = ()) -> Review:
    """The reviewed table and the events without effect.

    ``rows`` has one row per EIN.  Adds ``<field>_adjusted_by`` (sum over all
    accepted rounds), ``validated_by``, ``EXPLANATION`` and ``ROUNDS`` (round,
    accepted, reason of every closed round); ``VALIDATION_STATE`` and
    ``MANUALLY_FIXED`` (fields in the order of their first edit) are replayed.
    """
    forms, kind_col = rules_of_table(rows)
    check_present(rows, rule_fields(forms), "rules", optional)
    check_present(rows, fields, "fields that can be edited")
    fields = list(fields)
    events = judged(normalised(log), rows, fields)
    entry = F.struct("round", "close", "changed", "last", *fields)
    per_ein = _rounds(events, fields).groupBy("EIN").agg(
        F.array_sort(F.collect_list(entry)).alias("_rounds"))  # as long as the review had rounds

    text = F.coalesce(F.col(FIXED_COL), F.lit(""))
    start = F.struct(
        F.struct(*[F.col(f).cast("double").alias(f) for f in fields]).alias("values"),
        F.col(STATE_COL).cast("int").alias("state"), F.lit("").alias("user"),
        F.lit("").alias("explanation"),
        F.filter(F.split(text, " "), lambda x: x != "").alias("fixed"),
        F.array().cast("array<struct<round:int,accepted:boolean,reason:string>>").alias("log"))

    def step(acc, r):
        old = {f: acc["values"][f] for f in fields}
        new = {f: F.when(r[f].isNull(), old[f]).otherwise(
            F.coalesce(r[f]["level"], old[f]) + r[f]["delta"]) for f in fields}
        kind, edited = r["close"]["kind"], r["changed"].isNotNull()
        clean = _worst(new, rows, forms, kind_col) <= threshold
        state = (F.when(kind == "ignore", IGNORED).when(kind == "skip", UNREVIEWED)
                 .when(kind == "fix_ignore", F.when(edited & ~clean, IGNORED).when(edited, FIXED))
                 .when(kind == "fix", F.when(edited, FIXED))
                 .when(kind == "check", F.when(~edited & clean, CHECKED)))
        why = (F.when(state.isNotNull(), "")
               .when(kind.isin("fix", "fix_ignore"), "no change made")
               .when(edited, "changes made").otherwise("residual over threshold"))
        ok, skip = state.isNotNull(), kind == "skip"
        # the closing action names the reviewer, else the round's last edit does
        user = F.coalesce(r["close"]["user"], r["last"]["user"], F.lit(""))
        said = F.coalesce(explanation_text(F.coalesce(r["close"]["explanation"],
                                                      r["last"]["explanation"])), F.lit(""))
        return F.struct(
            F.struct(*[F.when(ok, new[f]).otherwise(old[f]).alias(f) for f in fields]).alias("values"),
            F.coalesce(state, acc["state"]).alias("state"),
            F.when(skip, "").when(ok, user).otherwise(acc["user"]).alias("user"),
            F.when(skip, "").when(ok, said).otherwise(acc["explanation"]).alias("explanation"),
            F.when(ok & edited, F.array_distinct(F.concat(acc["fixed"], r["changed"])))
             .otherwise(acc["fixed"]).alias("fixed"),
            F.concat(acc["log"], F.array(F.struct(
                r["round"].alias("round"), ok.alias("accepted"), why.alias("reason")))).alias("log"))

    j = rows.join(per_ein, "EIN", "left")
    none = F.array().cast(dict(j.dtypes)["_rounds"])
    folded = j.withColumn("_end", F.aggregate(F.coalesce("_rounds", none), start, step))
    end = F.col("_end")
    out = folded.withColumns({
        **{f"{f.lower()}_adjusted_by":
           F.coalesce(end["values"][f] - F.col(f), F.lit(0.0)) for f in fields},
        **{f: end["values"][f] for f in fields},
        STATE_COL: end["state"], FIXED_COL: F.array_join(end["fixed"], " "),
        "validated_by": end["user"], "EXPLANATION": end["explanation"], "ROUNDS": end["log"]})
    out = out.drop("_rounds", "_end", *residual_columns(rows))
    out = add_residuals(out, forms, kind_col, optional)

    refused = (out.filter(F.exists("ROUNDS", lambda r: ~r["accepted"]))
               .select("EIN", F.explode("ROUNDS").alias("r")).filter(~F.col("r.accepted"))
               .select("EIN", "r.round", F.concat(F.lit("rejected: "), F.col("r.reason")).alias("why")))
    columns = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
    unapplied = (events.join(refused, ["EIN", "round"], "left")
                 .withColumn("outcome", F.coalesce("outcome", F.when(F.col("kind") != "reset", F.col("why"))))
                 .filter(F.col("outcome").isNotNull()).select(*columns, "outcome"))
    return Review(out, unapplied)
