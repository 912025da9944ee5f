import re

from pyspark.sql import functions as F

from quillgrid.llm.decontaminate import cut_passages, drop_contaminated, find_passages


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(texts, items, window=13):
    out = {}
    for i, t in enumerate(texts):
        w, hit, named = words(t), set(), set()
        for item, text in items:
            b = words(text)
            n = min(window, len(b))
            wins = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if b else set()
            for k in range(len(w) - n + 1):
                if wins and tuple(w[k : k + n]) in wins:
                    hit |= set(range(k, k + n))
                    named.add(item)
        out[i] = (len(w), len(hit), sorted(named), bool(hit) and 20 * len(hit) >= len(w))
    return out


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def case(prose):
    p = prose(1, 40)
    items = [(1, p), (2, "Short One"), (3, "Short One"), (4, None), (5, "..."), (6, prose(2, 13)), (None, prose(9, 20)), (1, p)]
    texts = [
        None, "", prose(3) + " " + p[20:150] + " " + prose(4), "short, ONE. " + prose(5, 90), "one short", prose(2, 13).upper(),
        prose(9, 20), "Ünï " * 20, prose(6, 3000), prose(7, 900) + " " + prose(2, 13) + " short one short one",
    ]
    return texts, items


def test_against_brute_force_whole_and_in_blocks(spark, docs, prose):
    texts, items = case(prose)
    truth = brute(texts, [x for x in items if x[0] is not None])
    for size in (10**9, 300):
        found = find_passages(docs(texts), bench(spark, items), block_bytes=size).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in found} == truth
    assert any(v[3] for v in truth.values()) and any(v[1] and not v[3] for v in truth.values())


def test_drop_and_cut_keep_columns_and_clean_documents(spark, docs, prose):
    texts, items = case(prose)
    df = docs(texts).withColumn("hits", F.lit("mine")).withColumn("items", F.lit(7))
    left = drop_contaminated(df, bench(spark, items))
    bad = {i for i, v in brute(texts, [x for x in items if x[0] is not None]).items() if v[3]}
    assert left.columns == df.columns and {r.doc_id for r in left.collect()} == set(range(len(texts))) - bad
    cut = {r.doc_id: r for r in cut_passages(df, bench(spark, items)).collect()}
    assert cut[3].text == ". " + prose(5, 90) and cut[8].text == texts[8] and cut[0].text is None and cut[3].hits == "mine"


def test_empty_tables_and_repeated_rows(spark, docs):
    assert find_passages(docs([]), bench(spark, [(1, "a b")])).count() == 0
    none = find_passages(docs(["a b"]), bench(spark, [])).first()
    assert (none.n_words, none.n_hit, none["items"], none.contaminated) == (2, 0, [], False)
    assert [r.n_hit for r in find_passages(docs([(1, "a b"), (1, "a b")]), bench(spark, [(1, "a b")])).collect()] == [2, 2]


def test_a_full_block_takes_little_memory():
    import subprocess
    import sys

    code = """
import random, resource, sys
sys.path.insert(0, %r)
from quillgrid.llm.decontaminate import BLOCK_BYTES, Windows
r = random.Random(1)
def peak():
    return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
items = [(i, " ".join("%%010x" %% r.getrandbits(40) for _ in range(1000))) for i in range(BLOCK_BYTES // 11000)]
before = peak()
windows = Windows(items, 13)
words = [w.encode() for w in items[7][1].split()]
mask, found = windows.scan([b"x", *words[:20], b"y"])
assert found == {7} and mask.tolist() == [False] + [True] * 20 + [False]
print(peak() - before)
"""
    import os

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code % root], capture_output=True, text=True, timeout=300)
    assert float(done.stdout) < 200, (done.stdout, done.stderr[-500:])
