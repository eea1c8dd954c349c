"""Quality rules by weak supervision.

Each rule looks at cheap counts of a text and votes good (+1), bad (-1) or
abstains (0).  Nobody labels anything: expectation-maximisation over the votes
of all documents estimates how often good and bad documents get each vote, and
the posterior probability of "good" replaces all-must-pass filtering.

The votes of all documents enter as counts per vote pattern.  There are at
most 3 ** len(RULES) patterns, so the table the driver fits on is bounded
whatever the corpus size, and a fit costs one aggregation.

Defined cases: a null text counts as empty; a text without words fails the base
rule; repeated rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, stage, window_hashes, with_id, word_hashes, words

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_SPACE_CODES = list(_SPACES.encode())
_SYMBOL_CODES = list(_SYMBOLS.encode())
_ENDS = (".", "!", "?", '"', ":")

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, n_lines long, n_upper long, n_letters long, "
            "n_digits long, n_exclaim long, n_ended_lines long, n_distinct long")


def measure_text(text: str | None) -> tuple:
    """The counts named in ``MEASURES`` of one whole text."""
    text = text or ""
    ws = words(text)
    n = len(ws)
    if not n:
        return (0, 0, sum(map(text.count, _SYMBOLS))) + (0,) * 9
    lines = [s for s in text.split("\n") if s.strip(_SPACES)]
    h = word_hashes(ws)
    ascii_counts = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=128)
    n_upper = int(ascii_counts[65:91].sum())
    return (n, len(text) - int(ascii_counts[_SPACE_CODES].sum()),
            int(ascii_counts[_SYMBOL_CODES].sum()), len(lines) - len(set(lines)),
            repeated_words(h), len(lines), n_upper, n_upper + int(ascii_counts[97:123].sum()),
            int(ascii_counts[48:58].sum()), int(ascii_counts[33]),
            sum(s.rstrip(_SPACES).endswith(_ENDS) for s in lines), len(set(ws)))


def repeated_words(h: np.ndarray, k: int = 3) -> int:
    """Words inside ``k``-word windows that occur twice or more."""
    keys = window_hashes(h, k)
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(keys, twice)
    covered = np.zeros(len(h), bool)
    for d in range(k):
        covered[d:len(h) - k + 1 + d] |= hit
    return int(covered.sum())


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every row."""
    return map_rows(with_id(docs), lambda i, t: [(i, *measure_text(t))],
                    "doc_id long, " + MEASURES)


def stage_measures(docs: DataFrame) -> DataFrame:
    """``measure`` written once: the fit and the verdicts read the same counts."""
    return stage(measure(docs), "measures")


def _share(a: str, b: str) -> Column:
    return F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1))


def _vote(bad: Column, good: Column | None = None) -> Column:
    v = F.when(bad, -1)
    return (v.when(good, 1) if good is not None else v).otherwise(0)


def rules() -> dict[str, Column]:
    """Rule name -> vote.  A rule that knows one defect abstains on texts
    without it: that a text isn't shouted says little about the rest of it."""
    n = F.col("n_words")
    mean_word = _share("word_chars", "n_words")
    ended = _share("n_ended_lines", "n_lines")
    return {
        "length": _vote(n < 50),
        "word_size": _vote((mean_word < 2.5) | (mean_word > 14)),
        "symbols": _vote(_share("n_symbols", "n_words") > 0.1),
        "symbol_chars": _vote(_share("n_symbols", "word_chars") > 0.03),
        "clutter": _vote((F.col("n_symbols") + F.col("n_digits") + F.col("n_exclaim"))
                         > 0.12 * F.col("word_chars")),
        "duplicate_lines": _vote(_share("n_dup_lines", "n_lines") > 0.3),
        "repetition": _vote(_share("n_repeat_words", "n_words") > 0.5),
        "shouting": _vote((_share("n_upper", "n_letters") > 0.4) & (F.col("n_letters") > 20)),
        "exclaiming": _vote(_share("n_exclaim", "n_words") > 0.2),
        "numbers": _vote(_share("n_digits", "word_chars") > 0.25),
        "sentences": _vote((ended < 0.1) & (F.col("n_lines") >= 3), ended >= 0.5),
        "variety": _vote((_share("n_distinct", "n_words") < 0.15) & n.between(50, 3000),
                         (_share("n_distinct", "n_words") >= 0.3) & (n >= 50)),
    }


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200,
        tolerance: float = 1e-7) -> tuple[float, np.ndarray]:
    """EM over vote patterns (rows of -1/0/1).

    Returns the share of good documents and ``p[class, rule, vote + 1]``, class
    0 being bad.  It starts from "no bad vote" and keeps one pseudo-count per
    cell, so a rule that never fires stays without influence.
    """
    r = patterns.shape[1]
    total = counts.sum()
    if not total:
        return 0.5, np.full((2, r, 3), 1 / 3)
    any_bad = (patterns < 0).any(axis=1)
    good = np.where(any_bad, 0.02, 0.98)
    seen = np.stack([(patterns == v) for v in (-1, 0, 1)], axis=2).astype(float)
    before = -math.inf
    for _ in range(rounds):
        w = np.stack([(1 - good) * counts, good * counts])
        share = float((w[1].sum() + 1) / (total + 2))
        p = np.einsum("cn,nrv->crv", w, seen) + 1
        p /= p.sum(axis=2, keepdims=True)
        joint = np.einsum("nrv,crv->cn", seen, np.log(p)) + np.log([[1 - share], [share]])
        top = joint.max(axis=0)
        evidence = top + np.log(np.exp(joint - top).sum(axis=0))
        good = np.exp(joint[1] - evidence)
        now = float((evidence * counts).sum())
        if now - before < tolerance * abs(now):
            break
        before = now
    return share, p


def score(measures: DataFrame) -> DataFrame:
    """``measures`` with ``base_failed``, ``posterior`` and ``kept``.

    The fit reads the votes of every row that the posterior has to decide (a
    row that fails the base rule is out anyway), grouped by pattern; the
    posterior is then a sum of log odds per vote, computed on each row with
    plain expressions.
    """
    names = list(rules())
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    voted = measures.withColumns({f"vote_{k}": v for k, v in rules().items()}
                                 | {"base_failed": failed})
    votes = [f"vote_{k}" for k in names]
    table = voted.where(~failed).groupBy(*votes).count().collect()  # bounded by the patterns
    patterns = np.array([[row[v] for v in votes] for row in table], int).reshape(-1, len(votes))
    share, p = fit(patterns, np.array([row["count"] for row in table], float))
    odds = np.log(p[1] / p[0])
    z = F.lit(math.log(share / (1 - share)))
    for k, v in enumerate(votes):
        z = z + F.when(F.col(v) < 0, float(odds[k, 0])).when(
            F.col(v) == 0, float(odds[k, 1])).otherwise(float(odds[k, 2]))
    return (voted.withColumn("posterior", 1 / (1 + F.exp(-F.least(F.lit(700.0), F.greatest(
        F.lit(-700.0), z)))))
        .withColumn("kept", ~failed & (F.col("posterior") >= 0.5)))
