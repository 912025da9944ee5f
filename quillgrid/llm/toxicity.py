"""Toxicity by weak supervision.

1. Terms that mark labelled toxic texts, whole words and word beginnings, are
   shared out among lexicon and pattern voters; a few voters look at the shape
   of the text instead. A voter says "toxic" or abstains.
2. A generative label model tells from the votes on all training texts alone how
   accurate each voter is and which voters depend on each other: a mixture of
   two classes, each a tree of voters, fitted by expectation maximisation. The
   votes take at most ``2 ** VOTERS`` patterns, so their counts are bounded.
3. A linear classifier on words and word beginnings is trained on the model's
   posterior labels, and scores every text, whether a voter knows it or not.

The samples are bounded: ``SAMPLE`` different labelled texts of each class for the
terms, and ``SAMPLE`` different texts of each posterior class for the classifier, both
chosen by a hash over all rows that may be learned from. Vote counts cover all of these.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.llm.common import add_columns, checkpointed, once_per_worker, whole

SAMPLE = 3000
LEXICONS, STEMS = 6, 6
SHAPES = ("shouting", "exclaiming", "repeating")
VOTERS = LEXICONS + STEMS + len(SHAPES)
BEGINNINGS = (4, 5, 6)
MOST_TERMS = 600
WORD = re.compile(r"\w+")


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def beginnings(word: str) -> list[str]:
    """The beginnings of a word, marked so that they are no words."""
    return [word[:n] + "…" for n in BEGINNINGS if len(word) > n]


# ---- voters ----------------------------------------------------------------

class Terms:
    """The words of some texts and their beginnings, as numbers."""

    def __init__(self, texts: list[str]) -> None:
        self.number: dict[str, int] = {}
        number, self.rows = self.number, []
        for text in texts:
            words = words_of(text)
            own = words.union(*map(beginnings, words))
            self.rows.append(np.array([number.setdefault(t, len(number)) for t in sorted(own)], np.int32))

    def counts(self, chosen: np.ndarray) -> np.ndarray:
        """In how many of the chosen texts each term occurs."""
        rows = [r for r, c in zip(self.rows, chosen) if c]
        return np.bincount(np.concatenate(rows) if rows else np.empty(0, np.int32), minlength=len(self.number))


def find_terms(texts: list[tuple[str, int]]) -> tuple[dict[str, int], dict[str, int]]:
    """Words, and beginnings of words, that mark the toxic texts, each with the
    voter that has it."""
    terms, label = Terms([t for t, _ in texts]), np.array([y for _, y in texts])
    seen, other = terms.counts(label == 1), terms.counts(label == 0)
    ratio = (seen / (label == 1).sum()) / ((other + 1) / (label == 0).sum())
    marked = {t: i for t, i in terms.number.items() if seen[i] >= 5 and ratio[i] >= 8}
    best = sorted(marked, key=lambda t: (-seen[marked[t]] * math.log(ratio[marked[t]]), t))[:MOST_TERMS]
    lexicon = {t: zlib.crc32(t.encode()) % LEXICONS for t in best if not t.endswith("…")}
    stems = {t: LEXICONS + zlib.crc32(t.encode()) % STEMS for t in best if t.endswith("…")}
    return lexicon, stems


def shape_votes(text: str) -> list[bool]:
    letters = sum(map(str.isupper, text)), sum(map(str.islower, text))
    n = max(1, len(text))
    return [letters[0] > letters[1], text.count("!") * 50 > n, re.search(r"(\w)\1{3}", text) is not None]


def votes_of(text: str, lexicon: dict[str, int], stems: dict[str, int]) -> int:
    """The votes of all voters as bits."""
    votes = 0
    for word in words_of(text):
        if word in lexicon:
            votes |= 1 << lexicon[word]
        for b in beginnings(word):
            if b in stems:
                votes |= 1 << stems[b]
    for i, says in enumerate(shape_votes(text)):
        votes |= says << (LEXICONS + STEMS + i)
    return votes


# ---- the label model -------------------------------------------------------

class LabelModel:
    """Two classes, each a tree of voters: ``P(vote | class, vote of the parent)``."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, prior: float, known: np.ndarray, rounds: int = 30) -> None:
        """``patterns``: votes as rows of 0 and 1 with their ``counts``; ``known``:
        1 or 0 for the rows whose label is known, which ties the first class of
        the mixture to what is meant, else NaN."""
        self.parents = np.full(patterns.shape[1], -1)
        self.prior, tied = prior, ~np.isnan(known)
        self._estimate(patterns[tied], counts[tied], known[tied])
        for step in range(rounds):
            post = np.where(tied, known, self.posterior(patterns))
            if step == 3:  # classes are told: see which voters depend on each other
                self.parents = self._tree(patterns, counts, post)
            self._estimate(patterns, counts, post)

    @staticmethod
    def _tree(patterns: np.ndarray, counts: np.ndarray, post: np.ndarray) -> np.ndarray:
        """Parents in the tree of largest mutual information within the classes."""
        n = patterns.shape[1]
        told = np.zeros((n, n))
        for weight in (counts * post, counts * (1 - post)):
            total = weight.sum() + 4
            both = (patterns * weight[:, None]).T @ patterns
            one = np.diag(both)
            for a in (0, 1):
                for b in (0, 1):
                    p = both if a and b else one[:, None] - both if a else one[None, :] - both if b else weight.sum() - one[:, None] - one[None, :] + both
                    p = (p + 1) / total
                    pa = ((one if a else weight.sum() - one) + 2) / total
                    pb = ((one if b else weight.sum() - one) + 2) / total
                    told += weight.sum() / counts.sum() * p * np.log(p / (pa[:, None] * pb[None, :]))
        parents, inside = np.full(n, -1), {0}
        while len(inside) < n:
            a, b = max(((i, j) for i in inside for j in range(n) if j not in inside), key=lambda e: (told[e], -e[1]))
            parents[b] = a
            inside.add(b)
        return parents

    def _estimate(self, patterns: np.ndarray, counts: np.ndarray, post: np.ndarray) -> None:
        self.rates = np.zeros((2, 2, patterns.shape[1]))  # class, vote of the parent, voter
        above = np.where(self.parents >= 0, patterns[:, self.parents], 0)
        for label, weight in enumerate((counts * (1 - post), counts * post)):
            for vote in (0, 1):
                w = weight[:, None] * (above == vote)
                self.rates[label, vote] = ((w * patterns).sum(0) + 0.05) / (w.sum(0) + 1)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        above = np.where(self.parents >= 0, patterns[:, self.parents], 0)
        logs = []
        for label in (0, 1):
            rate = np.where(above == 1, self.rates[label, 1], self.rates[label, 0])
            logs.append(np.log(np.where(patterns == 1, rate, 1 - rate)).sum(1))
        odds = logs[1] - logs[0] + math.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def _bits(votes: list[int]) -> np.ndarray:
    return (np.array(votes, np.int64)[:, None] >> np.arange(VOTERS)) & 1


# ---- the classifier --------------------------------------------------------

def fit_linear(texts: list[tuple[str, float]], rounds: int = 150, decay: float = 0.02) -> tuple[dict[str, float], float]:
    """Logistic regression on the words of each text and their beginnings, for
    soft labels. Each term is scaled by its log ratio between the classes, so
    that the many terms common to both, and long texts with them, say little."""
    terms, target = Terms([t for t, _ in texts]), np.array([y for _, y in texts])
    positive, negative = terms.counts(target >= 0.5), terms.counts(target < 0.5)
    # Shares of all terms, not of texts: longer texts in one class must not tilt common terms.
    ratio = np.log((positive + 2) / max(1, positive.sum())) - np.log((negative + 2) / max(1, negative.sum()))
    # Beyond three standard errors: long texts have very many terms that say nothing.
    told = (positive + negative >= 3) & (np.abs(ratio) >= 3 * np.sqrt(1 / (positive + 1) + 1 / (negative + 1)))
    names = [t for t, i in terms.number.items() if told[i]]
    scale, place = ratio[told], np.cumsum(told) - 1
    kept = [place[r[told[r]]] for r in terms.rows]
    row, col = np.repeat(np.arange(len(texts)), [k.size for k in kept]), np.concatenate(kept)
    number = dict(zip(names, range(len(names))))
    weight, bias = np.zeros(len(number)), 0.0
    history, bias_history = np.full(len(number), 1e-8), 1e-8
    for _ in range(rounds):
        odds = np.bincount(row, (weight * scale)[col], len(target)) + bias
        error = (1 / (1 + np.exp(-np.clip(odds, -40, 40))) - target) / len(target)
        slope = np.bincount(col, error[row], len(number)) * scale + decay * weight / len(target)
        history += slope**2
        weight -= 0.05 * slope / np.sqrt(history)
        bias_history += error.sum() ** 2
        bias -= 0.05 * error.sum() / math.sqrt(bias_history)
    return {t: float(weight[i] * scale[i]) for t, i in number.items() if abs(weight[i] * scale[i]) > 1e-3}, bias


class Scorer:
    """Scores texts; remembers what each word adds."""

    def __init__(self, weights: dict[str, float], bias: float) -> None:
        self.weights, self.bias, self.known = weights, bias, {}

    def score(self, text: str) -> float:
        odds = self.bias
        begun: dict[str, float] = {}  # a beginning counts once, however many words have it
        for word in words_of(text):
            known = self.known.get(word)
            if known is None:
                if len(self.known) > 300_000:
                    self.known.clear()
                get = self.weights.get
                begins = {b: get(b) for b in beginnings(word) if b in self.weights}
                known = self.known[word] = (get(word, 0.0), begins)
            odds += known[0]
            if known[1]:
                begun |= known[1]
        odds += sum(begun.values())
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))


# ---- the operator ----------------------------------------------------------

def _sampled(rows: DataFrame, group: str, texts: DataFrame) -> list[tuple[str, int]]:
    """``SAMPLE`` different texts of each group, by hash: copies of a text, empty ones
    among them, take one place. Only hashes are ranked, each with one id, and each task
    cuts its share before the shuffle; what is chosen is at most two samples of
    ids, which are sent to where the texts lie."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy("order"))
    different = rows.groupBy(group, "order").agg(F.min("id").alias("id"))
    chosen = different.withColumn("rank", rank).where(F.col("rank") <= SAMPLE)
    found = texts.join(F.broadcast(chosen.select("id", "order", group)), ["id", "order"]).select("text", group)
    return sorted({(r["text"], r[group]) for r in found.collect()})


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[dict[str, float], float]:
    """The classifier, from the rows of ``docs`` for which ``learnable`` holds
    and their labels. Labels other than 0 and 1 count as none; without labels of
    both kinds every text scores alike, below one half."""
    usable = docs.where(learnable).select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    hashed = usable.withColumn("order", F.xxhash64("text"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label IN (0, 1)")
    labelled = hashed.select("id", "order").join(known, "id")
    sample = _sampled(labelled, "label", hashed)
    share = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len({y for _, y in sample}) < 2:
        return {}, -1.0
    lexicon, stems = find_terms(sample)

    def vote(texts: list[str]) -> list[list]:
        return [[votes_of(t, lexicon, stems) for t in texts]]

    voted = checkpointed(add_columns(hashed, "votes long", "text", vote, ["id", "order"]))
    # At most three rows for each pattern of votes.
    counted = voted.join(known, "id", "left").groupBy("votes", "label").count().collect()
    patterns = sorted((r["votes"], r["count"], -1 if r["label"] is None else r["label"]) for r in counted)
    votes, counts = _bits([v for v, *_ in patterns]), np.array([n for _, n, _ in patterns], float)
    tied = np.array([np.nan if y < 0 else y for *_, y in patterns])
    model = LabelModel(votes, counts, (share[1] + 1) / (share[0] + share[1] + 2), tied)
    posterior = {v: float(p) for (v, *_), p in zip(patterns, model.posterior(votes))}

    likely = F.udf(lambda v: int(posterior.get(v, 0.0) >= 0.5), "int")
    chosen = _sampled(voted.select("id", "order", likely("votes").alias("likely")), "likely", hashed)
    return fit_linear([(t, posterior.get(votes_of(t, lexicon, stems), 0.0)) for t, _ in chosen])


def score(docs: DataFrame, model: tuple[dict[str, float], float], text_col: str = "text") -> DataFrame:
    """Add ``score``, 0 to 1, of the whole text, and ``predicted``, 1 from one
    half on. NULL and empty texts score by the bias alone. Columns of these
    names are replaced, others stay."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = ("toxicity", hash((frozenset(model[0].items()), model[1])))

    def work(texts: list[str | None]) -> list[list]:
        scorer = once_per_worker(key, lambda: Scorer(*sent.value))
        scores = [scorer.score(t or "") for t in texts]
        return [scores, [int(s >= 0.5) for s in scores]]

    return add_columns(docs, "score double, predicted int", text_col, work)
