import random

import pytest
from pyspark.sql import functions as F

from quillgrid.llm import jaccard
from quillgrid.llm.components import components
from quillgrid.llm.jaccard import drop_near_duplicates, near_classes


def brute(pairs, percent, width):
    sets = {}
    for i, t in pairs:
        w = (t or "").encode().lower().split()
        n = min(width, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(prose):
    r, texts = random.Random(8), [None, "", " \t", "one", "One", "one two", "ONE  two", " ", "a b c", "a b c d"]
    passage = prose(77, 25)
    for seed in range(14):  # families of drifting copies of all sizes, some around one passage
        words = prose(seed, r.choice([6, 9, 12, 16, 25, 40, 90, 200])).split()
        for _ in range(7):
            texts.append(" ".join(words) + (" " + passage if seed % 4 == 0 else ""))
            for _ in range(r.randint(0, max(1, len(words) // 30))):
                words[r.randrange(len(words))] = r.choice(["new", "other", "word"])
    texts += [texts[20], texts[20], prose(99, 4000), prose(99, 4000) + " end"]
    return texts


@pytest.mark.parametrize("percent, width", [(90, 3), (80, 5), (80, 1)])
def test_classes_by_brute_force(docs, prose, percent, width):
    texts = corpus(prose)
    found = near_classes(docs(texts), percent, width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(list(enumerate(texts)), percent, width)


@pytest.mark.parametrize("boundary", [0, 12, 30])
def test_any_boundary_gives_the_same_classes(docs, prose, monkeypatch, boundary):
    texts = corpus(prose)[:80]
    monkeypatch.setattr(jaccard, "_boundary", lambda *_: boundary)
    found = near_classes(docs(texts), 90, 2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(list(enumerate(texts)), 90, 2)


def test_ids_repeated_rows_and_empty_table(docs, prose):
    t = prose(1)
    found = near_classes(docs([(5, t), (5, t), (3, t), (None, t)])).collect()
    assert sorted((r.doc_id or -1, r.n_shingles > 0, r.component_id) for r in found) == [
        (-1, False, None), (3, True, 3), (5, True, 3), (5, True, 3)
    ]
    assert near_classes(docs([])).count() == 0


def test_one_id_with_several_texts(docs, prose):
    a, b = prose(1, 80), prose(2, 80)
    for rows in ([(1, b), (1, a), (2, a + " tail"), (7, b + " tail")], [(1, a), (1, b), (2, a + " tail"), (7, b + " tail")]):
        found = near_classes(docs([*rows, (9, None), (9, prose(3)), (4, "")])).collect()
        assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (1, 1), (2, 1), (4, 4), (7, 1), (9, 9), (9, 9)]


def test_parities_never_tell_linked_sets_apart():
    import numpy as np

    draw = np.random.default_rng(1)
    for n, changed in ((5, 1), (70, 12), (256, 30), (3000, 400)):
        x = np.unique(draw.integers(0, 2**63, n).astype(np.uint64) << np.uint64(1) | np.uint64(1))
        x ^= x >> np.uint64(7)
        y = np.unique(np.concatenate([x[changed:], draw.integers(0, 2**63, changed + 3).astype(np.uint64)]))
        p, q = jaccard.parity(x), jaccard.parity(y)
        while q.size > p.size:
            q = q[: q.size // 2] ^ q[q.size // 2 :]
        bits = sum(int(v).bit_count() for v in (p ^ q).view(np.uint64))
        differ = np.setxor1d(x, y).size
        assert differ / 2 < bits <= differ


def test_sketches_of_different_lengths_fold(spark):
    import numpy as np
    from quillgrid.llm.jaccard import Threshold, _alike

    draw = np.random.default_rng(2)
    for n, m in ((256, 260), (250, 300), (900, 1030), (70, 80)):
        x = draw.integers(0, 2**63, n).astype(np.uint64)
        y = np.concatenate([x, draw.integers(0, 2**63, m - n).astype(np.uint64)])
        z = draw.integers(0, 2**63, m).astype(np.uint64)
        rows = [(n, jaccard.parity(x).tolist(), m, jaccard.parity(other).tolist()) for other in (y, z)]
        df = spark.createDataFrame(rows, "n int, p array<long>, m int, q array<long>")
        pairs = df.select(F.struct("n", F.col("p").alias("parity")).alias("x"), F.struct(F.col("m").alias("n"), F.col("q").alias("parity")).alias("y"))
        assert [r[0] for r in pairs.select(_alike(Threshold(80))).collect()] == [True, False]


def test_drop_keeps_one_of_each_class_with_its_columns(docs, prose):
    t = prose(1, 100)
    df = docs([None, "", t, t + " more", prose(2), (None, t)]).withColumn("component_id", F.lit("mine"))
    left = drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.component_id) for r in left.collect()) == [
        (-1, "mine"), (0, "mine"), (1, "mine"), (2, "mine"), (4, "mine")
    ]


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(1, 30)]
    links = spark.createDataFrame([*chain, *star, (900, 900), (None, 7)], "a long, b long")
    found = {r.id: r.component for r in components(links).collect()}
    assert all(found[i] == 100 for i in range(100, 141)) and all(found[i] == 1 for i in [*range(1, 30), 500]) and found[900] == 900


def test_empty_blocks_fill_no_lists():
    import numpy as np

    limits, draw = jaccard.Threshold(80), np.random.default_rng(3)
    seen = []
    for n in [500] * 30 + [90] * 30:  # sets with nothing in common have no list in common
        x = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))
        seen += np.unique(jaccard.block_keys(x, limits, 0)).tolist()
    assert len(seen) == len(set(seen))


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linked_sets_have_a_list_in_common(percent):
    import numpy as np

    limits, draw = jaccard.Threshold(percent), np.random.default_rng(4)
    for n in [*range(2, 60), *range(60, 3000, 90)]:
        shift = np.uint64(draw.integers(0, 62))  # hashes that crowd the first blocks leave others empty
        x = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64) >> shift)
        more = draw.integers(0, 2**64, limits.largest_partner(x.size) - x.size, dtype=np.uint64)
        less = x.size - limits.smallest_partner(x.size)
        for y in (np.union1d(x, more), np.delete(x, draw.choice(x.size, less, replace=False)), np.union1d(x[less // 2 :], more[: less // 2])):
            shared = np.intersect1d(x, y).size
            if y.size and 100 * shared >= percent * (x.size + y.size - shared):
                assert np.intersect1d(jaccard.block_keys(x, limits, 0), jaccard.block_keys(y, limits, 0)).size


def test_sets_that_others_hold_too_little_of_need_no_lists(spark):
    r = random.Random(5)
    passage, near = [r.getrandbits(62) for _ in range(200)], [r.getrandbits(62) for _ in range(400)]
    sets = {i: passage + [r.getrandbits(62) for _ in range(3000)] for i in range(5)}  # a passage in common
    sets |= {10: near, 11: near[:-40] + [1, 2, 3], 12: near[:-30] + passage[:20]}
    shingles = spark.createDataFrame(list(sets.items()), "node long, shingles array<long>")
    loose = spark.createDataFrame([(i, len(s), i) for i, s in sets.items()], "node long, n int, part long")
    limits = jaccard.Threshold(80)
    left = jaccard._left_over(shingles, loose, limits)
    assert left.columns == loose.columns and {row.node for row in left.collect()} == {10, 11, 12}
    listed = jaccard._rare_lists(shingles, loose, limits).collect()
    assert {row.node for row in listed} == {10, 11, 12} and len(listed) < 200
    both = {(a, b): {row.shingle for row in listed if row.node == a} & {row.shingle for row in listed if row.node == b} for a, b in ((10, 11), (10, 12), (11, 12))}
    assert all(both.values())
    same = loose.withColumn("part", F.lit(1).cast("long"))  # one part has nothing to be scanned
    assert jaccard._left_over(shingles, same, limits).count() == jaccard._rare_lists(shingles, same, limits).count() == 0


def test_release_waits_until_dropped_objects_are_let_go(spark):
    from quillgrid.llm.common import release

    jvm = spark.sparkContext._jvm
    for _ in range(5):
        dropped = jvm.java.util.ArrayList()
        seen = jvm.java.lang.ref.WeakReference(dropped)
        del dropped
        release(spark)
        assert seen.get() is None


def test_size_guesses_of_joined_checkpoints_do_not_grow(spark):
    from quillgrid.llm.common import checkpointed

    odd = F.when(F.col("id") > 1, F.array("id"))
    first = df = checkpointed(spark.range(3).select("id", odd.alias("list"), F.lit(1).alias("n")))
    for _ in range(6):
        df = checkpointed(df.join(df.select("id", F.col("n").alias("more")), "id").select("id", "list", (F.col("n") + F.col("more")).alias("n")))
    guess = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert guess < 1 << 63  # was 6 times doubled in its digits
    assert df.schema == first.schema and sorted(df.collect()) == [(0, None, 64), (1, None, 64), (2, [2], 64)]


def test_release_lets_go_of_the_last_query(spark):
    from quillgrid.llm.common import checkpointed, release

    jvm = spark.sparkContext._jvm
    for _ in range(3):
        counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        kept = checkpointed(counted)
        seen = jvm.java.lang.ref.WeakReference(counted._jdf.queryExecution())
        del counted
        release(spark)
        assert seen.get() is None and kept.count() == 7
