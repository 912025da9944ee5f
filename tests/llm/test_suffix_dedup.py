import random

import pytest
from pyspark.sql import functions as F

from quillgrid.llm import suffix_dedup
from quillgrid.llm.suffix_dedup import GRAM, agreements, common, deep_shallow, repeated_spans, segments

LENGTH = 200


def brute(texts, length=LENGTH):
    raws, seen = [(t or "").encode() for t in texts], {}
    for raw in raws:
        for i in range(len(raw) - length + 1):
            seen[raw[i : i + length]] = seen.get(raw[i : i + length], 0) + 1
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans, k = [], 0
        while k < len(raw):
            end = k
            while end < len(raw) and gone[end]:
                end += 1
            if end > k:
                spans.append((k, end))
            k = max(end, k + 1)
        out.append((len(raw), spans, bytes(c for c, g in zip(raw, gone) if not g)))
    return out


def corpus(prose):
    a, b = prose(1, 90), prose(2, 60)
    texts = [None, "", "short", prose(3, 30) + a + prose(4, 30), a, a + b, b[5:] + prose(5, 20), prose(6) + b[:199] + "é", "é" + b[:201] + "x"]
    texts += ["z" * 199, "y" * 200, "y" * 450, "w" * 201, prose(7, 400) + prose(7, 400), prose(8), prose(8), prose(9, 50) + "ü" * 150]
    r = random.Random(4)
    for _ in range(25):  # one passage among others, cut at either side, with a changed byte now and then
        p = list(prose(50, 110)[r.randrange(60) :])
        for _ in range(r.randrange(3)):
            p[r.randrange(len(p))] = "#"
        texts.append(prose(r.random(), r.randrange(30)) + "".join(p) + prose(r.random(), r.randrange(30)))
    return texts


@pytest.mark.parametrize("group", [1000, 3])
def test_spans_by_brute_force(docs, prose, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    texts = corpus(prose)
    df = docs(texts).withColumn("spans", F.lit("mine")).withColumn("kept", F.lit(1))
    found = {r.doc_id: (r.n_bytes, [(s.begin, s.end) for s in r.spans], bytes(r.kept)) for r in repeated_spans(df).collect()}
    truth = brute(texts)
    assert [found[i] for i in range(len(texts))] == truth
    assert sum(bool(s) for _, s, _ in truth) > 20


def test_rows_without_id_repeated_rows_and_empty_table(docs, prose):
    t = prose(1, 90)
    found = repeated_spans(docs([(1, t), (1, t), (None, t), (None, "other")])).collect()
    assert sorted(len(r.kept) for r in found) == [0, 0, 0, 5]
    assert repeated_spans(docs([])).count() == 0


def test_segments_hold_every_string_once_in_chunks_too(prose, monkeypatch):
    raw = (prose(1, 900) + "q" * 700 + prose(2, 300)).encode()
    for chunk in (1 << 22, 1000):
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        places = [i for _, first, stop, _ in segments(raw) for i in range(first, stop - LENGTH + 1)]
        assert places == list(range(len(raw) - LENGTH + 1))
        assert all(first <= at and at + GRAM <= stop and at - first < 512 for _, first, stop, at in segments(raw))


def test_deep_shallow_orders_like_sorting():
    r = random.Random(2)
    for _ in range(300):
        texts = [bytes(r.choices(b"ab", k=r.randint(0, 30))) for _ in range(r.randint(1, 25))]
        texts += r.choices(texts, k=3)
        head = b"same" * r.randint(0, 2)
        texts = [head + t for t in texts]
        order, shared = deep_shallow(texts, len(head))
        assert [texts[i] for i in order] == sorted(texts) and sorted(order) == list(range(len(texts)))
        assert shared[1:] == [common(texts[a], texts[b]) for a, b in zip(order, order[1:])]


def test_agreements_by_brute_force():
    r = random.Random(6)
    for _ in range(60):
        cases = []
        for _ in range(r.randint(2, 9)):
            left, right = bytes(r.choices(b"ab", k=r.randint(0, 9))), bytes(r.choices(b"ab", k=r.randint(0, 9)))
            cases.append((left + b"anchor" + right, len(left)))
        found = agreements(cases, 10)
        for x, (text, at) in enumerate(cases):
            covered = set()
            for y, (other, there) in enumerate(cases):
                if x != y:
                    l, rgt = common(text[:at][::-1], other[:there][::-1]), common(text[at:], other[there:])
                    if l + rgt >= 10:
                        covered |= set(range(at - l, at + rgt))
            assert {k for a, b in found[x] for k in range(a, b)} == covered


@pytest.mark.parametrize("length", [96, 279, 280, 300, 400, 535])
def test_lengths_up_to_the_bound(docs, prose, length):
    same, shared = prose(5, 400), prose(6, 200)
    texts = [same[:1199], same[:1199], prose(7, 60) + shared + prose(8, 60), shared[: length + 7] + prose(9, 90), prose(10, 90)]
    found = {r.doc_id: r for r in repeated_spans(docs(texts), length=length).collect()}
    want = [kept for *_, kept in brute(texts, length)]
    assert [bytes(found[i].kept) for i in range(len(texts))] == want


def test_lengths_beyond_the_bound(docs):
    for length in (95, 536):
        with pytest.raises(ValueError, match="length from 96 to 535"):
            repeated_spans(docs(["a"]), length=length)
