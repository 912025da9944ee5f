import hashlib

from pyspark.sql import functions as F

from quillgrid.llm.exact_dedup import drop_duplicates, exact_groups

TEXTS = ["Same", "same", None, "", "ÄB", "äb", "ÄB", "x" * 300_000, "X" * 300_000, "other"]


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def expected(texts, pick):
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(lower(t), []).append(i)
    return {
        (i, pick(g), len(g), i == pick(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g
    }


def test_groups_by_brute_force(docs):
    for keep, pick in (("smallest", min), ("largest", max)):
        assert {tuple(r) for r in exact_groups(docs(TEXTS), keep=keep).collect()} == expected(TEXTS, pick)


def test_a_weak_hash_gives_the_same_groups(docs):
    weak = exact_groups(docs(TEXTS), hash_of=lambda t: F.length(t) % 2)
    assert {tuple(r) for r in weak.collect()} == expected(TEXTS, min)


def test_repeated_rows_ids_and_empty_table(docs):
    twice = docs([(1, "a"), (1, "a"), (2, "A"), (None, "a")])
    found = exact_groups(twice, keep="largest").collect()
    assert len(found) == 4 and {r.keep_id for r in found} == {2} and sum(r.kept for r in found) == 1
    assert exact_groups(docs([])).count() == 0 and drop_duplicates(docs([])).count() == 0


def test_drop_keeps_all_columns_and_clashing_names(docs):
    df = docs(TEXTS).withColumn("keep_id", F.lit("mine")).withColumn("_hash", F.lit(1)).withColumn("_row", F.lit(2))
    left = drop_duplicates(df)
    assert left.columns == df.columns and {r.keep_id for r in left.collect()} == {"mine"}
    assert {r.doc_id for r in left.collect()} == {0, 2, 4, 5, 7, 9}
