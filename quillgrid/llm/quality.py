"""Quality rules whose cutoffs keep a promise on labelled documents.

Each rule is a rate of a document, such as symbols a word; above the cutoff of its
stratum the document is rejected. Labelled texts are cut in two by their hash. One
half proposes: for each stratum and rule the cutoff that parts bad texts from good
ones best, if one does. The other half holds out: going from lenient cutoffs to the
proposed one, each must pass an exact binomial test that the rule rejects at most its
share of ``RISK`` of good texts, and the first failure ends the walk, so that no
correction is due inside a walk. Walks share ``DOUBT`` evenly (Bonferroni), and the
rules of a stratum share ``RISK``, so that with probability ``1 - DOUBT`` no stratum
loses more than ``RISK`` of its good documents to all of its rules together. A rule
that cannot be shown to keep this promise has no cutoff and rejects nothing.

Texts are read once, in tasks; rates fall on a fixed grid, so that labelled texts come
down to counts, one for each stratum, half, label, rule and step of the grid.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.llm.common import add_columns, checkpointed, whole

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
WINDOW = 3
# The base rule of the corpus: fixed values.
LEAST_WORDS, MOST_REPEATED = 50, 50

RISK, DOUBT = 0.05, 0.05
WEIGHT, LEAST_GAIN = 50, 0.02
"""A proposed cutoff makes the share of bad texts rejected, less WEIGHT times that of good ones, largest, and at least LEAST_GAIN."""
STEPS = 64
"""Cutoffs of a rule; they rise by a fifth from step to step."""

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_calls"]
# Rule: numerator and denominator of its rate, and the lowest cutoff.
RULES = {
    "symbols": ("n_symbols", "n_words", 0.001),
    "repeated lines": ("n_dup_lines", "n_lines", 0.001),
    "repeated words": ("n_repeat_words", "n_words", 0.001),
    "capitals": ("n_capitals", "word_chars", 0.001),
    "exclamation marks": ("n_calls", "n_words", 0.001),
    "long words": ("word_chars", "n_words", 1.0),
    "short words": ("n_words", "word_chars", 0.01),
}


# ---- counts of a text ---------------------------------------------------------

def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three which the text holds twice or more."""
    n = len(words)
    if n <= WINDOW:
        return 0
    numbers: dict[bytes, int] = {}
    at = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    size = len(numbers)
    if size == n:
        return 0
    windows = at[:-2] * size + at[1:-1]
    if size >= 2_000_000:  # three numbers would not fit a long
        windows = np.unique(windows, return_inverse=True)[1]
    _, which, times = np.unique(windows * size + at[2:], return_inverse=True, return_counts=True)
    twice = times[which] > 1
    hit = np.zeros(n, bool)
    for i in range(WINDOW):
        hit[i:n - 2 + i] |= twice
    return int(hit.sum())


def count_text(text: str | None) -> list[int]:
    """The ``COUNTS`` of a text."""
    if not text:
        return [0] * len(COUNTS)
    raw = text.encode()
    words = raw.split()  # of bytes: blanks of ASCII alone part words
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    capitals = sum(raw.count(c) for c in range(65, 91)) if len(raw) < 200 else int(np.isin(np.frombuffer(raw, np.uint8), range(65, 91)).sum())
    return [
        len(words), len(text) - sum(text.count(c) for c in BLANKS), sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)), repeated_words(words), len(lines), capitals, raw.count(b"!"),
    ]


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without texts, with the ``COUNTS`` of each whole text and ``text_id``, its
    hash. NULL counts as empty. Columns of these names are replaced; rows that repeat
    repeat; an empty table gives an empty one.
    """
    hashed = docs.withColumn("text_id", F.md5(whole(text_col).cast("binary")))
    made = add_columns(
        hashed, ", ".join(f"{c} bigint" for c in COUNTS), text_col, lambda texts: list(zip(*map(count_text, texts))),
    )
    return made.drop(text_col)


def base_failed() -> Column:
    """Too few words, or too many in windows that repeat."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


# ---- exact bounds ----------------------------------------------------------------

def at_most(k: int, n: int, p: float) -> float:
    """The probability of at most ``k`` hits in ``n`` trials of probability ``p``, exact
    but for rounding: terms are added from the k-th down, until they vanish."""
    if k >= n or p <= 0:
        return 1.0
    if p >= 1:
        return 0.0
    if k > n * p:  # the smaller tail is added up
        return 1.0 - at_most(n - k - 1, n, 1 - p)
    # n over k as a sum of logarithms: gamma functions of large n cancel too much.
    log = (n - k) * math.log1p(-p)
    for start in range(1, k + 1, 1_000_000):
        j = np.arange(start, min(k + 1, start + 1_000_000))
        log += float(np.log((n - k + j) / j * p).sum())
    term = total = 1.0
    for j in range(k, 0, -1):
        term *= j / (n - j + 1) * (1 - p) / p
        total += term
        if term < total * 1e-17:
            break
    return min(1.0, math.exp(log + math.log(total)))


def upper_bound(k: int, n: int, doubt: float) -> float:
    """Clopper and Pearson's upper bound of the rate behind ``k`` hits in ``n`` trials."""
    low, high = k / n if n else 0.0, 1.0
    if k >= n:
        return 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if at_most(k, n, middle) > doubt else (low, middle)
    return high


# ---- cutoffs -----------------------------------------------------------------------

def cutoff(rule: str, step: int) -> float:
    return RULES[rule][2] * 1.2**step


def step_of(rule: str) -> Column:
    """How many cutoffs of the grid the rate of a document is above."""
    above, below, low = RULES[rule]
    rate = F.col(above) / F.greatest(F.col(below), F.lit(1))
    grid = F.array(*[F.lit(cutoff(rule, i)) for i in range(STEPS)])
    return F.size(F.filter(grid, lambda c: c < rate))


def histogram(measured: DataFrame, labels: DataFrame, id_col: str, stratum_col: str, label_col: str) -> DataFrame:
    """``(stratum, held, good, rule, step, n)``: how many different labelled texts that
    pass the base rule fall on a step. A text with both labels counts as good."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_good")).where("_id IS NOT NULL AND _good IS NOT NULL")
    own = measured.where(~base_failed()).select(
        F.col(f"`{id_col}`").alias("_id"), F.col(f"`{stratum_col}`").alias("stratum"), "text_id", *COUNTS
    )
    held = F.conv(F.substring("text_id", 1, 1), 16, 10).cast("int") >= 8
    texts = own.join(known, "_id").groupBy("stratum", "text_id", *COUNTS).agg(F.max(F.col("_good") == 1).alias("good"))
    steps = F.array(*[F.struct(F.lit(r).alias("rule"), step_of(r).alias("step")) for r in RULES])
    return (
        texts.select("stratum", held.alias("held"), "good", F.inline(steps))
        .groupBy("stratum", "held", "good", "rule", "step").agg(F.count(F.lit(1)).alias("n"))
    )


def proposed(counts: pd.DataFrame) -> int | None:
    """The best step of one stratum and rule, from its proposing half."""
    above = {good: np.zeros(STEPS) for good in (False, True)}
    for good, step, n in zip(counts["good"], counts["step"], counts["n"]):
        above[bool(good)][:step] += n  # a rate on step s is above the cutoffs 0 to s - 1
    totals = {good: counts.loc[counts["good"] == good, "n"].sum() for good in (False, True)}
    if not all(totals.values()):
        return None
    gain = above[False] / totals[False] - WEIGHT * above[True] / totals[True]
    best = int(np.flatnonzero(gain == gain.max())[-1])  # of equals the most lenient
    return best if gain[best] >= LEAST_GAIN else None


def certified(counts: pd.DataFrame, goal: int, risk: float, doubt: float) -> tuple[int | None, int, int]:
    """The strictest step down to ``goal`` that the holdout lets pass, with the good texts
    it rejects and all good ones."""
    good = counts[counts["good"]]
    n = int(good["n"].sum())
    passed, rejected = None, 0
    for step in range(STEPS - 1, goal - 1, -1):
        k = int(good.loc[good["step"] > step, "n"].sum())
        if at_most(k, n, risk) > doubt:
            break
        passed, rejected = step, k
    return passed, rejected, n


def calibrate(
    measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", stratum_col: str = "lang", label_col: str = "quality",
    risk: float = RISK, doubt: float = DOUBT,
) -> DataFrame:
    """``(stratum, rule, cutoff, rejected, held_out, bound)``: the cutoffs that hold, with
    the good texts rejected among those held out and the upper bound of that share.

    A NULL stratum is one of its own. Labels of unknown documents, NULL ids and NULL
    labels are left out. Of texts that repeat one counts, since copies would feign
    independent trials. Without labels no cutoff holds.
    """
    counts = checkpointed(histogram(measured, labels, id_col, stratum_col, label_col))
    kind = counts.schema["stratum"].dataType.simpleString()

    def propose(rows: pd.DataFrame) -> pd.DataFrame:
        goal, first = proposed(rows[~rows["held"]]), rows.iloc[0]
        return pd.DataFrame([(first["stratum"], first["rule"], -1 if goal is None else goal)], columns=["stratum", "rule", "goal"])

    goals = counts.groupBy("stratum", "rule").applyInPandas(propose, f"stratum {kind}, rule string, goal int").where("goal >= 0")
    goals = checkpointed(goals)
    walks = max(1, goals.count())
    shares = goals.groupBy(F.col("stratum").alias("_s")).agg(F.count(F.lit(1)).alias("rules"))
    told = goals.join(shares, F.col("stratum").eqNullSafe(F.col("_s"))).select(F.col("stratum").alias("_s"), F.col("rule").alias("_r"), "goal", "rules")
    tested = counts.where("held").join(told, F.col("stratum").eqNullSafe(F.col("_s")) & (F.col("rule") == F.col("_r")))

    def test(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.iloc[0]
        step, k, n = certified(rows, int(first["goal"]), risk / int(first["rules"]), doubt / walks)
        found = [] if step is None else [(first["stratum"], first["rule"], cutoff(first["rule"], step), k, n, upper_bound(k, n, doubt / walks))]
        return pd.DataFrame(found, columns=["stratum", "rule", "cutoff", "rejected", "held_out", "bound"])

    return tested.groupBy("stratum", "rule").applyInPandas(
        test, f"stratum {kind}, rule string, cutoff double, rejected bigint, held_out bigint, bound double"
    )


def judge(measured: DataFrame, cutoffs: DataFrame, stratum_col: str = "lang") -> DataFrame:
    """``measured`` with ``base_failed``, ``rejected_by`` (rules whose cutoff the document
    is above) and ``kept``. Columns of these names are replaced. A stratum without
    cutoffs rejects nothing beyond the base rule."""
    mark = "_" * (1 + max(map(len, measured.columns)))  # no column of measured has names that start so
    by_stratum = cutoffs.groupBy(F.col("stratum").alias(f"{mark}stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias(f"{mark}cutoffs")  # one entry a rule
    )
    joined = measured.join(by_stratum, F.col(f"`{stratum_col}`").eqNullSafe(F.col(f"{mark}stratum")), "left")
    above = [
        F.when(F.col(a) / F.greatest(F.col(b), F.lit(1)) > F.col(f"{mark}cutoffs")[rule], F.lit(rule))
        for rule, (a, b, _) in RULES.items()
    ]
    rejected = F.array_compact(F.array(*above))
    given = [F.col(f"`{c}`") for c in measured.columns if c not in ("base_failed", "rejected_by", "kept")]
    return joined.select(
        *given, base_failed().alias("base_failed"), rejected.alias("rejected_by"),
        (~base_failed() & (F.size(rejected) == 0)).alias("kept"),
    )
