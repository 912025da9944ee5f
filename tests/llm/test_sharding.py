import zlib

import numpy as np
from pyspark.sql import functions as F

from quillgrid.llm import sharding
from quillgrid.llm.sharding import pack, shard


def held(df, shards):
    rows = df.collect()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return rows, {k: sum(r["size"] for r in own) for k, own in by.items()}


def test_values_slots_and_balance(docs, prose):
    texts = [prose(i, 1 + i * 7 % 90) for i in range(600)] + [None, "", "é" * 9, "x" * 2000]
    rows, sizes = held(shard(docs(texts).withColumn("unit", F.lit(1)), 6), 6)
    assert len(rows) == len(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    assert len(sizes) == 6 and max(sizes.values()) <= 1.01 * min(sizes.values())


def test_equal_texts_stay_together_unless_larger_than_a_shard(docs, prose):
    texts = [prose(i) for i in range(100)] * 2 + ["hot text " * 20] * 150
    rows, sizes = held(shard(docs(texts), 4), 4)
    place = {}
    for r in rows:
        place.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(p) == 1 for t, p in place.items() if not t.startswith("hot"))
    assert len(place["hot text " * 20]) > 1 and max(sizes.values()) <= 1.15 * min(sizes.values())


def test_bundles_of_many_small_groups(docs, monkeypatch):
    monkeypatch.setattr(sharding, "FINE", 1)
    _, sizes = held(shard(docs([f"t{i} " * (1 + i % 5) for i in range(3000)]), 5), 5)
    assert max(sizes.values()) <= 1.1 * min(sizes.values())


def test_many_blocks_ties_and_empty_table(docs, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 7)
    rows, _ = held(shard(docs([(i % 3 or None, "same") for i in range(200)]), 2), 2)
    assert len(rows) == 200
    assert shard(docs([]), 3).count() == 0
    assert len(held(shard(docs(["one"]), 3), 3)[0]) == 1


def test_pack_balances_all_dimensions():
    r = np.random.default_rng(1)
    vectors = np.column_stack([r.integers(1, 100, 900), r.integers(1, 30, 900), np.ones(900)])
    placed = pack(vectors, 7)
    loads = np.array([vectors[placed == k].sum(0) for k in range(7)])
    assert (loads.max(0) / loads.min(0) < [1.01, 1.12, 1.12]).all()
