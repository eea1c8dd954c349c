"""Replayed review logs against a sequential fold in Python."""

import datetime as d
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from filing_release.operators import review_log as rl
from filing_release.operators.absent import AbsentColumns
from filing_release.operators.rules import rule_fields, rules_for

FIELDS = ["FUNDBAL", "EXPS", "ASS_EOY"]
HAVE = ["ASS_EOY", "LIAB_EOY", "FUNDBAL", "TOTREV2", "EXPS", "NETINC", "TOTREV"]
ROWS = "EIN string, SOURCE_KIND string, " + ", ".join(f"{f} double" for f in HAVE) + \
    ", VALIDATION_STATE int, MANUALLY_FIXED string"
OPTIONAL = [f for f in rule_fields(("EZ", "FULL")) if f not in HAVE]
T0 = d.datetime(2024, 1, 1)


def ev(ein, rnd, t, kind, field=None, amount=None, user=None, explanation=None):
    return (ein, rnd, T0 + d.timedelta(minutes=t), t, kind, field, amount, user, explanation)


def row(ein, kind="FULL", state=0, fixed="", **values):
    base = {f: 0.0 for f in HAVE} | values
    return (ein, kind, *[base[f] for f in HAVE], state, fixed)


def residuals(kind, values):
    out = []
    for r in rules_for(kind):
        out.append(abs(values.get(r.total, 0.0) - sum(s * values.get(f, 0.0) for s, f in r.parts)))
    return max(out, default=0.0)


def fold(rows, log, threshold=1000.0):
    """One event after the other, as a reviewer would work."""
    state, unapplied = {}, []
    for r in rows:
        state[r[0]] = {"kind": r[1], "values": dict(zip(HAVE, r[2:2 + len(HAVE)], strict=True)),
                       "state": r[-2], "fixed": r[-1].split(), "user": "", "rounds": [],
                       "start": dict(zip(HAVE, r[2:2 + len(HAVE)], strict=True))}
    for e in log:
        if e[0] not in state:
            unapplied.append((e, "EIN not in the extract"))
    for ein, s in state.items():
        mine = [e for e in log if e[0] == ein]
        for rnd in sorted({e[1] for e in mine}):
            events = sorted((e for e in mine if e[1] == rnd), key=lambda e: e[2:4])
            ok = []
            for e in events:
                if e[4] not in rl.EDITS + rl.ACTIONS:
                    unapplied.append((e, "unknown kind"))
                elif e[4] in rl.EDITS and e[5] not in FIELDS:
                    unapplied.append((e, "field can't be edited"))
                elif e[4] in rl.EDITS and e[6] is None:
                    unapplied.append((e, "no amount"))
                else:
                    ok.append(e)
            acts = [e for e in ok if e[4] in rl.ACTIONS]
            if not acts or acts[-1][4] == "reset":
                unapplied += [(e, "round not closed") for e in ok if e[4] != "reset"]
                continue
            close, done, edits = acts[-1], [], []
            values, fixed, user = dict(s["values"]), list(s["fixed"]), None
            for e in ok:
                if e[4] == "reset":
                    values, fixed, user = dict(s["values"]), list(s["fixed"]), None
                    unapplied += [(x, "reset") for x in edits]
                    edits = []
                elif e[4] in rl.EDITS:
                    if e[2:4] > close[2:4]:
                        unapplied.append((e, "after the closing action"))
                        continue
                    values[e[5]] = e[6] if e[4] == "level" else values[e[5]] + e[6]
                    fixed += [e[5]] if e[5] not in fixed else []
                    user = e[7]
                    edits.append(e)
                elif e is not close:
                    unapplied.append((e, "not the closing action"))
            clean = residuals(s["kind"], values) <= threshold
            kind = close[4]
            new = {"ignore": 2, "skip": 0, "fix": 1 if edits else None,
                   "fix_ignore": (1 if clean else 2) if edits else None,
                   "check": 3 if clean and not edits else None}[kind]
            why = ("" if new is not None else "no change made" if kind != "check"
                   else "changes made" if edits else "residual over threshold")
            s["rounds"].append((rnd, new is not None, why))
            if new is None:
                unapplied += [(e, f"rejected: {why}") for e in [*edits, close]]
                continue
            s["state"] = new
            if kind == "skip":
                s["user"] = ""
                unapplied += [(e, "skipped") for e in edits]
                continue
            s["values"], s["fixed"] = values, fixed
            s["user"] = close[7] or user or ""
            assert done == []
    return state, unapplied


def check(spark, rows, log):
    got = rl.replay(spark.createDataFrame(rows, ROWS), spark.createDataFrame(log, rl.LOG_SCHEMA),
                    FIELDS, optional=OPTIONAL)
    state, unapplied = fold(rows, log)
    out = {r.EIN: r for r in got.rows.collect()}
    assert set(out) == set(state)
    for ein, s in state.items():
        r = out[ein]
        assert r.VALIDATION_STATE == s["state"], ein
        assert r.MANUALLY_FIXED.split() == s["fixed"] and r.validated_by == s["user"], ein
        assert [tuple(x) for x in r.ROUNDS] == s["rounds"], ein
        for f in HAVE:
            assert abs(r[f] - s["values"][f]) < 1e-6
        for f in FIELDS:
            assert abs(r[f"{f.lower()}_adjusted_by"] - (s["values"][f] - s["start"][f])) < 1e-6
    want = sorted((str(e), why) for e, why in unapplied)
    assert sorted((str(tuple(r)[:-1]), r.outcome) for r in got.unapplied.collect()) == want
    return out


def test_named_cases(spark):
    bad = {"ASS_EOY": 9000.0, "LIAB_EOY": 1000.0, "FUNDBAL": 2000.0}
    rows = [row(str(i), **bad) for i in range(8)] + [row("clean", state=1, fixed="EXPS"), row("quiet")]
    log = [
        # two rounds add up; the second sees the first one's values
        ev("0", 1, 1, "delta", "FUNDBAL", 1000.0, "a"), ev("0", 1, 2, "fix"),
        ev("0", 2, 3, "delta", "FUNDBAL", 5000.0, "b"), ev("0", 2, 4, "fix_ignore"),  # clean: 1
        ev("1", 1, 1, "level", "FUNDBAL", 1.0, "a"), ev("1", 1, 2, "reset"),
        ev("1", 1, 3, "delta", "FUNDBAL", 6000.0, "a", "1"), ev("1", 1, 4, "fix"),
        ev("2", 1, 1, "delta", "FUNDBAL", 1.0, "a"), ev("2", 1, 2, "fix_ignore", user="c"),  # 2
        ev("3", 1, 1, "check"), ev("3", 2, 1, "ignore", user="c"),
        ev("4", 1, 1, "delta", "FUNDBAL", 6000.0, "a"), ev("4", 1, 2, "fix"),
        ev("4", 2, 3, "check", user="z"),                                  # clean after round 1
        ev("4", 3, 4, "delta", "FUNDBAL", 1.0, "q"), ev("4", 3, 5, "skip"),
        ev("5", 1, 1, "fix"), ev("5", 2, 2, "delta", "FUNDBAL", 1.0), ev("5", 2, 3, "check"),
        ev("6", 1, 1, "delta", "FUNDBAL", 1.0), ev("6", 1, 2, "fix"), ev("6", 1, 3, "reset"),
        ev("7", 1, 1, "delta", "NAME", 1.0), ev("7", 1, 2, "delta", None, 1.0),
        ev("7", 1, 3, "delta", "EXPS", None), ev("7", 1, 4, "mend", "EXPS", 1.0),
        ev("7", 1, 5, "ignore"), ev("7", 1, 6, "delta", "EXPS", 1.0),
        ev("gone", 1, 1, "delta", "EXPS", 1.0), ev("clean", 1, 1, "check", user="x"),
    ]
    got = check(spark, rows, log)
    assert [got[k].VALIDATION_STATE for k in "0123456"] == [1, 1, 2, 2, 0, 0, 0]
    assert got["0"].fundbal_adjusted_by == 6000.0 and got["clean"].VALIDATION_STATE == 3
    assert got["1"].EXPLANATION == "Error on form: fields do not sum to total"


@pytest.mark.parametrize("seed", [1, 2])
def test_random_logs(spark, seed):
    rng = random.Random(seed)
    rows = [row(str(i), rng.choice(["EZ", "FULL"]), rng.choice([0, 0, 1]), rng.choice(["", "EXPS"]),
                **{f: float(rng.randint(0, 20) * 500) for f in HAVE}) for i in range(25)]
    log = []
    for t in range(700):
        ein = "0" if rng.random() < 0.3 else str(rng.randint(0, 26))   # a third on one EIN
        kind = rng.choice(["level", "delta", "delta", *rl.ACTIONS, "other"])
        edit = kind in rl.EDITS
        log.append(ev(ein, rng.randint(1, 4), t, kind, rng.choice([*FIELDS, "NAME"]) if edit else None,
                      rng.choice([None, *[500.0 * k for k in range(-9, 10)]]) if edit else None,
                      rng.choice(["u", "v", None])))
    rng.shuffle(log)
    check(spark, rows, log)


def test_spelling_of_fields_and_kinds(spark):
    rows = spark.createDataFrame([row("1")], ROWS)
    log = spark.createDataFrame([ev("1 ", 1, 1, " Delta", " exps ", 5.0), ev("1", 1, 2, "FIX")],
                                rl.LOG_SCHEMA)
    got = rl.replay(rows, log, FIELDS, optional=OPTIONAL)
    assert got.rows.first().EXPS == 5.0 and got.unapplied.count() == 0
    empty = rl.replay(rows, log.limit(0), FIELDS, optional=OPTIONAL).rows.first()
    assert (empty.EXPS, empty.VALIDATION_STATE, empty.ROUNDS) == (0.0, 0, [])
    with pytest.raises(AbsentColumns, match=OPTIONAL[0]):
        rl.replay(rows, log, FIELDS, optional=OPTIONAL[1:])


def test_pf_tables_get_the_pf_rules(spark):
    need = rule_fields(("PF",))
    r = rules_for("PF")[0]
    rows = spark.createDataFrame([("1", 0, "", *[0.0] * len(need))],
                                 "EIN string, VALIDATION_STATE int, MANUALLY_FIXED string, "
                                 + ", ".join(f"{f} double" for f in need)) \
        .withColumn(r.column, F.lit(0.0))
    log = spark.createDataFrame([ev("1", 1, 1, "delta", r.total, 7000.0), ev("1", 1, 2, "fix_ignore")],
                                rl.LOG_SCHEMA)
    got = rl.replay(rows, log, [r.total]).rows.first()
    assert got[r.column] == 7000.0 and got.VALIDATION_STATE == 2
    assert {c for c in got.asDict() if c.startswith("validate_")} == {
        x.column for x in rules_for("PF")}


def test_log_on_disk_is_append_only(spark):
    path = tempfile.mkdtemp(prefix="log-", dir="/tmp") + "/co"
    assert rl.read(spark, path).count() == 0 and rl.rounds_on_disk(spark, path) == []
    edits = spark.createDataFrame([("1", "EXPS", "delta", 5.0, "u", "1", T0, 1)],
                                  "EIN string, field string, action string, amount double, "
                                  "user string, explanation string, ts timestamp, seq long")
    actions = spark.createDataFrame([("1", "fix")], "EIN string, action string")
    events = rl.events_of(edits, actions, spark)
    rl.append(events, path, 1)
    with pytest.raises(Exception, match="already exists"):
        rl.append(events, path, 1)
    rl.append(events, path, 2)
    assert rl.rounds_on_disk(spark, path) == [1, 2]
    rows = spark.createDataFrame([row("1")], ROWS)
    got = rl.replay(rows, rl.read(spark, path), FIELDS, optional=OPTIONAL).rows.first()
    assert (got.EXPS, got.exps_adjusted_by, got.VALIDATION_STATE) == (10.0, 10.0, 1)
