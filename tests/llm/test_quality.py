import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quillgrid.llm import quality
from quillgrid.llm.quality import COUNTS, RULES, at_most, calibrate, count_text, cutoff, judge, measure, upper_bound
from quillgrid.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")
LABELS = "doc_id long, quality int"


def counts_by_brute_force(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    hit = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 3)}
    lines = text.split("\n")
    dup = sum(bool(WORD.search(line)) and line in lines[:i] for i, line in enumerate(lines))
    full = [line for line in lines if WORD.search(line)]
    return [
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), len(full),
        sum("A" <= c <= "Z" for c in text), text.count("!"),
    ]


def random_texts(seed, n=60):
    r = random.Random(seed)
    parts = ["a", "b", "cc", "É", " x", "#", "a|b", "\n", "\n", " ", "\t", "\x0b", "\r", "LOUD!!", "<p>", " "]
    made = ["".join(r.choice(parts) + r.choice([" ", " ", "", "\n"]) for _ in range(r.randint(0, 80))) for _ in range(n)]
    return [None, "", " \n", "one", "a a a a", "x y z x y z", "l\nl\n\n\nl ", *made]


def test_counts_by_brute_force(docs):
    texts = [*random_texts(1), "w " * 50_000 + "#" * 200_000, " ".join(map(str, range(3000))) + " 1 2 3"]
    found = {r.doc_id: [r[c] for c in COUNTS] for r in measure(docs(texts)).collect()}
    assert found == {i: counts_by_brute_force(t) for i, t in enumerate(texts[:-2])} | {
        len(texts) - 2: [50_001, 250_000, 200_000, 0, 50_000, 1, 0, 0], len(texts) - 1: [3003, len(texts[-1]) - 3002, 0, 0, 6, 1, 0, 0],
    }


def test_many_different_words(monkeypatch):
    words = [str(i).encode() for i in range(2_000_100)] + [b"7", b"8", b"9"]
    assert quality.repeated_words(words) == 6


def test_binomial_tail_and_bound_against_exact_sums():
    for k, n, p in ((0, 10, 0.1), (3, 20, 0.3), (15, 20, 0.3), (7, 7, 0.9), (40, 300, 0.05)):
        q = Fraction(p)
        exact = sum(math.comb(n, j) * q**j * (1 - q) ** (n - j) for j in range(k + 1))
        assert at_most(k, n, p) == pytest.approx(float(exact), rel=1e-10)
        if k < n:
            assert at_most(k, n, upper_bound(k, n, 0.01)) == pytest.approx(0.01, rel=1e-6)
    assert upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05**0.01) and upper_bound(5, 5, 0.1) == 1
    assert at_most(10, 10**9, 1e-8) == pytest.approx(math.exp(-10) * sum(10**j / math.factorial(j) for j in range(11)), rel=1e-6)


def corpus(n=1500, strata=("en", "de"), seed=2):
    """Good and bad texts, which hold more symbols; labels of most."""
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = r.random() < 0.2
        words = [r.choice("abcdefgh") * r.randint(1, 9) for _ in range(r.randint(55, 90))]
        noise = r.choice([2, 20, 30]) if bad else r.choice([0, 0, 0, 1])
        rows.append((i, r.choice(strata), " ".join(words) + "#" * noise))
        if r.random() < 0.9:
            labels.append((i, int(not bad)))
    return rows, labels


def cutoffs_by_brute_force(rows, labels, risk=0.05, doubt=0.05):
    good, of = {}, {i: rest for i, *rest in rows}
    for i, label in labels:
        if i in of and label is not None:
            lang, text = of[i]
            if len(WORD.findall(text or "")) >= 50 and 100 * counts_by_brute_force(text)[4] <= 50 * len(WORD.findall(text)):
                good[lang, text] = good.get((lang, text), False) or label == 1
    rates = {key: dict(zip(COUNTS, counts_by_brute_force(key[1]))) for key in good}
    goals = {}
    for lang in {k[0] for k in good}:
        for rule, (a, b, _) in RULES.items():
            half = [k for k in good if k[0] == lang and int(hashlib.md5(k[1].encode()).hexdigest()[0], 16) < 8]
            best = None
            for step in range(quality.STEPS):
                share = []
                for label in (False, True):
                    own = [k for k in half if good[k] == label]
                    share.append(sum(rates[k][a] / max(rates[k][b], 1) > cutoff(rule, step) for k in own) / len(own) if own else None)
                if None not in share and (best is None or share[0] - quality.WEIGHT * share[1] >= best[0]):
                    best = (share[0] - quality.WEIGHT * share[1], step)
            if best and best[0] >= quality.LEAST_GAIN:
                goals[lang, rule] = best[1]
    found = {}
    for (lang, rule), goal in goals.items():
        a, b, _ = RULES[rule]
        own = [k for k in good if k[0] == lang and good[k] and int(hashlib.md5(k[1].encode()).hexdigest()[0], 16) >= 8]
        for step in range(quality.STEPS - 1, goal - 1, -1):
            k = sum(rates[x][a] / max(rates[x][b], 1) > cutoff(rule, step) for x in own)
            if at_most(k, len(own), risk / sum(x[0] == lang for x in goals)) > doubt / len(goals):
                break
            found[lang, rule] = (pytest.approx(cutoff(rule, step)), k, len(own))
    return found


def test_cutoffs_by_brute_force(spark):
    rows, labels = corpus(strata=("en", "de", None))
    rows += [(5000 + i, "en", rows[0][2]) for i in range(300)]  # copies count once
    labels += [(5000 + i, 0) for i in range(300)] + [(None, 1), (3, None), (10**9, 0)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumn("n_words", F.lit("mine"))
    found = {(r.stratum, r.rule): (r.cutoff, r.rejected, r.held_out) for r in calibrate(measure(df), spark.createDataFrame(labels, LABELS)).collect()}
    want = cutoffs_by_brute_force(rows, labels)
    assert found == want and {k[0] for k in want} == {"en", "de", None} and all(k[1] == "symbols" for k in want)


def test_the_promise_holds_where_good_texts_are_noisy(spark):
    # A tenth of good texts look just like bad ones: no cutoff below their rate may pass.
    rows, labels = corpus(1200, ("en",), 5)
    noisy = [(i, lang, text + "#" * 20 if i % 10 == 0 else text) for i, lang, text in rows]
    df = measure(spark.createDataFrame(noisy, "doc_id long, lang string, text string"))
    known = spark.createDataFrame(labels, LABELS)
    judged = judge(df, calibrate(df, known)).join(known, "doc_id").where("quality = 1 and not base_failed")
    assert judged.where("not kept").count() <= 0.05 * judged.count()


def test_few_labels_and_empty_tables(spark, docs):
    rows, labels = corpus(60)
    df = measure(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    for known in (labels, []):
        judged = judge(df, calibrate(df, spark.createDataFrame(known, LABELS)))
        assert judged.where("kept = base_failed or size(rejected_by) > 0").count() == 0 and judged.count() == 60
    none = measure(docs([]))
    assert judge(none, calibrate(none, spark.createDataFrame([], LABELS))).count() == 0


def test_clashing_names_and_repeated_rows(spark, docs):
    df = docs([(1, "x " * 60), (1, "x " * 60), (None, None)]).withColumn("kept", F.lit("mine")).withColumn("rule", F.lit(1)).withColumn("_cutoffs", F.lit(2))
    measured = measure(df)
    judged = judge(measured, calibrate(measured, spark.createDataFrame([(1, 0)], LABELS)))
    assert [(r.doc_id, r.kept, r.rule) for r in judged.orderBy("doc_id").collect()] == [(None, False, 1), (1, False, 1), (1, False, 1)]


def test_the_query_as_registered(spark, tmp_path):
    rows, labels = corpus(1500)
    rows += [(9000 + i, "en", t) for i, t in enumerate(random_texts(3))]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    found = QUERIES["op13_quality_rules"](spark, str(tmp_path))
    assert found.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    cutoffs = {k: c[0].expected for k, c in cutoffs_by_brute_force(rows, labels).items()}
    assert cutoffs
    want = {}
    for i, lang, text in rows:
        n = dict(zip(COUNTS, counts_by_brute_force(text)))
        failed = n["n_words"] < 50 or 100 * n["n_repeat_words"] > 50 * n["n_words"]
        by = any(n[RULES[r][0]] / max(n[RULES[r][1]], 1) > c for (x, r), c in cutoffs.items() if x == lang)
        want[i] = (*(n[c] for c in COUNTS[:5]), failed, not failed and not by)
    assert {r[0]: tuple(r)[1:8] for r in found.collect()} == want
