import hashlib
import random
import sys
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from quillgrid.llm.conversations import chain, cheapest, estimates, repair, report
from quillgrid.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
WANTED = {"": "user", "s": "user", "u": "assistant", "a": "user"}


sys.setrecursionlimit(10_000)


def best(turns, state="", goal=None):
    """The least (cost, edits) by trying every edit at every turn, with up to two
    insertions before each; turns are (letter, fault)."""

    @lru_cache(None)
    def at(i, state, inserted):
        found = []
        if i == len(turns) and (state in ("", "a") if goal is None else state == goal):
            found.append((0, ""))
        if inserted < 2 and (i < len(turns) or goal is None):
            cost, rest = at(i, WANTED[state][0], inserted + 1)
            found.append((cost + 5, "I" + rest))
        if i < len(turns):
            letter, fault = turns[i]
            extra = 5 if fault == "truncated" else 0
            cost, rest = at(i + 1, state, 0)
            found.append((cost + 2, "D" + rest))
            if fault not in ("blank", "duplicate"):
                cost, rest = at(i + 1, WANTED[state][0], 0)
                found.append((cost + 1 + extra, "R" + rest))
                if (state, letter) in STEP:
                    cost, rest = at(i + 1, STEP[state, letter], 0)
                    found.append((cost + extra, "K" + rest))
        return min(found, default=(10**9, ""))

    return at(0, state, 0)


def expected(rows):
    """The contract's row for turns (turn, role, text) of one conversation."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(r[2].encode()).hexdigest()))
    seen, turns = set(), []
    for _, role, text in order:
        core = text.rstrip(WHITE)
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
        seen.add((role, text))
        turns.append((role[:1], fault))
    cost, audit = best(tuple(turns))
    state, lines, left = "", [], [(r, t) for _, r, t in order]
    for edit in audit:
        if edit == "I":
            role, text = WANTED[state], ""
        else:
            role, text = left.pop(0)
            if edit == "D":
                continue
            role = WANTED[state] if edit == "R" else role
        state = role[0]
        lines.append(f"{role}:{text}")
    numbers = [t for t, _, _ in order if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    count = lambda fault: sum(f == fault for _, f in turns)
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, digest), lines


def sample(seed, conversations=40, most=9):
    r = random.Random(seed)
    roles, texts = ["user", "assistant", "user", "assistant", "system", "tool", " "], ["a.", "b!", "c", " \n", "d?  ", "e.f", "", "g.", "h."]
    return [
        (c, r.choice([None, *range(7)]), r.choice(roles), r.choice(texts)) for c in [*range(conversations), None] for _ in range(r.randint(0, most))
    ]


def grouped(rows):
    groups = {}
    for c, *turn in rows:
        groups.setdefault(c, []).append(tuple(turn))
    return groups


@pytest.mark.parametrize("longest", [500, 3])
def test_reports_against_trying_all_edits(spark, longest):
    rows = sample(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7).withColumn("audit", F.lit("mine")).withColumn("c", F.lit(0))
    found = {r[0]: tuple(r)[1:] for r in report(df, longest=longest).collect()}
    assert found == {c: expected(turns)[0] for c, turns in grouped(rows).items()}


@pytest.mark.parametrize("longest", [500, 4])
def test_repaired_turns(spark, longest):
    rows = sample(2)
    found = {}
    for r in repair(spark.createDataFrame(rows, SCHEMA), longest=longest).orderBy("position").collect():
        found.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert r.position == len(found[r.conv_id])
    want = {c: expected(turns)[1] for c, turns in grouped(rows).items()}
    assert found == {c: lines for c, lines in want.items() if lines}


def test_a_long_conversation_lies_on_many_stretches(spark):
    r = random.Random(3)
    rows = [(1, i // 2, r.choice(["user", "assistant", "system"]), r.choice(["x", f"{i}.", f"{i % 40}.", ""])) for i in range(400)]
    rows += [(2, 0, "user", "x" * 300_000 + "."), (2, 1, "assistant", "y.")] + [(3, 5, "user", "same.")] * 60
    found = {x[0]: tuple(x)[1:] for x in report(spark.createDataFrame(rows, SCHEMA).repartition(5), longest=16).collect()}
    assert found == {c: expected(turns)[0] for c, turns in grouped(rows).items()}


def test_empty_tables_and_conversations_without_turns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert report(none).count() == 0 and repair(none).count() == 0
    nil = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert [tuple(r) for r in report(none, spark.createDataFrame([(4,), (4,)], "conv_id long")).collect()] == [(4, *nil)]
    nulls = spark.createDataFrame([(1, None, None, None), (1, None, None, "x."), (1, None, "assistant", "y.")], SCHEMA)
    assert report(nulls).first()[1:8] == expected([(None, " ", " "), (None, " ", "x."), (None, "assistant", "y.")])[0][:7]


def test_search_from_each_state_to_each_state():
    names = ["", "s", "u", "a"]
    r = random.Random(4)
    for _ in range(200):
        turns = [(r.choice("usa x"), r.choice(["", "", "", "blank", "truncated"])) for _ in range(r.randint(1, 7))]
        nodes = [(None, 1, False) if f == "blank" else (letter, 1, f == "truncated") for letter, f in turns]
        for entry in range(4):
            for goal in range(4):
                cost, audit = best(tuple(turns), names[entry], names[goal])
                assert cheapest(nodes, entry, goal) == ((cost, audit) if cost < 10**9 else None)
        cost, audit = best(tuple(turns))
        assert cheapest(nodes) == (cost, audit) and estimates(nodes, -1)[0] <= cost


def test_chain_prefers_the_least_text():
    # Both ways cost 4; the second stretch ends where a well-formed conversation may.
    costs, ranks = [-1] * 16, [0] * 16
    costs[2], costs[3], ranks[2], ranks[3] = 1, 3, 1, 0
    costs[2 * 4 + 3], costs[3 * 4 + 3] = 3, 1
    assert chain([(costs, ranks), (costs, ranks)]) == [3, 15]


def test_the_query_as_registered(spark, tmp_path):
    r = random.Random(5)
    rows = [(c, t, r.choice(["user", "assistant", "system", None]), r.choice(["One. Two!", "no end", None, "ok?"])) for c in range(60) for t in range(r.randint(1, 6))]
    rows += [(None, 1, "user", "a."), (9, None, "user", "b.")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    groups = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        case = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", " " if text is None else text
        text = "" if case == 1 else text.translate({ord(x): None for x in ".!?"}) if case == 2 else text
        groups[c] += [(t, "user" if case == 4 else role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    found = QUERIES["op12_conversation_repair"](spark, str(tmp_path))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {x[0]: tuple(x)[1:] for x in found.collect()} == {c: expected(turns)[0] for c, turns in groups.items()}
