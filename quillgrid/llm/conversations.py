"""Conversation structure: faults of turns, and the cheapest edits that mend the roles.

A conversation is well formed if its roles, told by their first letters, read
``(s?(ua)+)?``. Turns are kept (K), get another role (R), are deleted (D), or an
empty turn is inserted (I). Iterative-deepening A* finds the cheapest edits: a
depth-first search takes edits in ASCII order under a bound on the cost, which rises
to the least cost that was cut off. States that failed stay in a table with the
cost that they take at least. The first path to the end is the answer: of the
cheapest ones it is the least as a text.

Faults and edits are worked out on narrow rows, without texts. These are sorted by
range, so that a conversation of any length lies on as many tasks as it needs. A
stretch of a conversation is searched from each state to each state; stretches
are then chained. Edits that end by consuming the last row of a stretch are never
the beginning of one another, so that the least text of the whole is made of the
least texts of its stretches. Texts are moved once, to read each conversation in
order; a digest of a whole conversation cannot be had otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quillgrid.llm.common import checkpointed, slices

BLANKS = " \t\n\v\f\r"
ENDS = (".", "!", "?")
USER, ASSISTANT = "user", "assistant"
LEGAL = {"su", "ua", "au"}
# Costs of edits, and what a truncated turn adds unless it is deleted: fixed values.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

STRETCH = 500
"""Turns that are searched at once; more are several stretches."""
PREFIX = 64
"""Characters of a text by which turns of one number and role are ordered, before its hash."""

# States: nothing yet, after a system turn, after a user, after an assistant.
KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEXT = (2, 2, 3, 2)  # the state an inserted or renamed turn leads to
ROLE_OF = {2: USER, 3: ASSISTANT}
WHOLE = -1
TAIL = {0: "", 1: "II", 2: "I", 3: ""}  # what completes a conversation that ends in a state
STATES = range(4)
NEVER = 1 << 60


# ---- search -----------------------------------------------------------------

Node = tuple[str | None, int, bool]
"""The first letter of a role, or None for turns that must go; their number; truncated."""


def estimates(nodes: list[Node], goal: int) -> list[int]:
    """What the turns from each place on cost at least: the faulty ones are deleted,
    and of two neighbours among the others that may not meet, one is edited or a turn
    comes between. Each turn is counted in one such pair only."""
    pairs = [0, 0]  # most such pairs from the next turn without fault on, and from the one after it
    following: str | None = "end" if goal == WHOLE else None
    cost, out = 0, [0]
    for letter, count, truncated in reversed(nodes):
        if letter is None:
            cost += DELETE * count
        elif truncated:
            cost += DELETE
        else:
            clash = following is not None and (letter != "a" if following == "end" else letter + following not in LEGAL)
            pairs = [max(pairs[0], clash + pairs[1]), pairs[0]]
            following = letter
        out.append(cost + pairs[0])
    return out[::-1]


def reachable(nodes: list[Node], entry: int, goal: int) -> bool:
    if goal == 0:
        return entry == 0
    return goal != 1 or entry == 1 or entry == 0 and any(letter == "s" for letter, _, _ in nodes)


def cheapest(nodes: list[Node], entry: int = 0, goal: int = WHOLE) -> tuple[int, str] | None:
    """Cost and edits that lead from the state ``entry`` past all turns: to a well
    formed end, or to the state ``goal`` with the last turn dealt with as the last
    edit. None if no edits do."""
    if not reachable(nodes, entry, goal):
        return None
    n, whole = len(nodes), goal == WHOLE
    least = estimates(nodes, goal)
    failed: dict[tuple[int, int], int] = {}
    made: dict[tuple[int, int], list[tuple[str, int, tuple[int, int]]]] = {}

    def moves(place: tuple[int, int]) -> list[tuple[str, int, tuple[int, int]]]:
        if place not in made:
            at, state = place
            out = []
            if at < n:
                letter, count, truncated = nodes[at]
                out.append(("D" * count, DELETE * count, (at + 1, state)))
            if at < n or whole:
                out.append(("I", INSERT, (at, NEXT[state])))
            if at < n and letter is not None:
                extra = TRUNCATED if truncated else 0
                if letter in KEEP[state]:
                    out.append(("K", extra, (at + 1, KEEP[state][letter])))
                out.append(("R", REROLE + extra, (at + 1, NEXT[state])))
            made[place] = out
        return made[place]

    def ends(place: tuple[int, int]) -> bool:
        return place[0] == n and (place[1] in (0, 3) if whole else place[1] == goal)

    first, bound = (0, entry), least[0]
    while bound < NEVER:
        path: list[str] = []
        stack = [[first, bound, 0, NEVER]]  # place, what is left of the bound, next move, least cost seen
        while stack:
            frame = stack[-1]
            place, left, move, low = frame
            if move == 0 and ends(place):
                return bound, "".join(path)
            options = moves(place)
            if move == len(options):
                failed[place] = low
                stack.pop()
                if stack:
                    path.pop()
                    above = stack[-1]
                    above[3] = min(above[3], moves(above[0])[above[2] - 1][1] + low)
                continue
            frame[2] += 1
            letter, cost, to = options[move]
            rest = cost + failed.get(to, least[to[0]])
            if rest > left:
                frame[3] = min(low, rest)
            else:
                path.append(letter)
                stack.append([to, left - cost, 0, NEVER])
        bound = failed[first]
    return None


# ---- faults -------------------------------------------------------------------

def _in_order(turn: Column, role: Column, text: Column) -> list[Column]:
    return [
        turn.alias("t"), role.alias("r"), F.substring(text, 1, PREFIX).alias("p"), F.md5(text.cast("binary")).alias("k"),
    ]


ORDER = ["t", "r", "p", "k"]


def narrow_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(c, t, r, p, k, n, blank, truncated, first)``: the different turns of each
    conversation with the number of their copies. ``first`` says that role and text
    do not come in an earlier turn."""
    role_, text_ = F.coalesce(F.col(role), F.lit(" ")), F.coalesce(F.col(text), F.lit(" "))
    trimmed = F.rtrim(text_, F.lit(BLANKS))
    told = rows.select(
        F.col(conv).alias("c"), *_in_order(F.col(turn), role_, text_), (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(*ENDS)).alias("truncated"),
    )
    turns = told.groupBy("c", *ORDER, "blank", "truncated").agg(F.count(F.lit(1)).alias("n"))
    firsts = turns.groupBy(F.col("c").alias("_c"), F.col("r").alias("_r"), F.col("k").alias("_k")).agg(
        F.min(F.struct("t")).alias("_first")
    )
    same = F.col("c").eqNullSafe(F.col("_c")) & (F.col("r") == F.col("_r")) & (F.col("k") == F.col("_k"))
    joined = turns.join(firsts, same)
    return joined.select("c", *ORDER, "n", "blank", "truncated", F.col("t").eqNullSafe(F.col("_first.t")).alias("first"))


class Stretch:
    """Turns of a conversation that follow one another, and what is told about them."""

    def __init__(self, start: tuple) -> None:
        self.start = start
        self.nodes: list[Node] = []
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.rows = 0
        self.head = self.tail = None

    def _gone(self, count: int) -> None:
        if self.nodes and self.nodes[-1][0] is None:
            count += self.nodes.pop()[1]
        self.nodes.append((None, count, False))

    def add(self, turn: int | None, role: str, count: int, blank: bool, truncated: bool, first: bool) -> None:
        """Turns that are all alike; of several, the later ones are duplicates."""
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        letter = role[:1]
        if self.rows:
            self.illegal += self.tail + letter not in LEGAL
        else:
            self.head = letter
        self.illegal += count - 1
        self.tail, self.rows = letter, self.rows + count
        if blank:
            self.blank += count
            self._gone(count)
            return
        if first:
            self.truncated += truncated
            self.nodes.append((letter, 1, truncated))
        copies = count - first
        self.duplicate += copies
        if copies:
            self._gone(copies)

    def told(self) -> list:
        return [self.low, self.high, self.turns, self.blank, self.duplicate, self.truncated, self.illegal, self.head, self.tail]


STATS = (
    "low bigint, high bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, head string, tail string"
)
_STATS = [f.split()[0] for f in STATS.split(", ")]


def _schema(conv: T.DataType, turn: T.DataType, more: str) -> T.StructType:
    given = T.StructType().add("c", conv).add("t", turn).add("r", "string").add("p", "string").add("k", "string")
    return T.StructType([*given.fields, *T.StructType.fromDDL(more).fields])


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def stretches(turns: DataFrame, longest: int = STRETCH) -> DataFrame:
    """One row per stretch: where it starts, its counts, and edits. A conversation
    that lies within one task and is no longer than ``longest`` has one, with its
    cheapest edits. The others are ``open``: for each pair of states, told by
    ``4 * entry + exit``, their edits have a cost (-1: none), a rank among those of
    the same entry, and a text."""
    schema = _schema(
        turns.schema["c"].dataType, turns.schema["t"].dataType,
        f"{STATS}, id bigint, open boolean, costs array<bigint>, ranks array<int>, audits array<string>",
    )
    arrow = to_arrow_schema(schema)

    def row(stretch: Stretch, number: int, is_open: bool) -> list:
        if not is_open:
            cost, audit = cheapest(stretch.nodes)
            costs, ranks, audits = [cost], [0], [audit]
        else:
            costs, ranks, audits = [-1] * 16, [0] * 16, [""] * 16
            for entry in STATES:
                found = {goal: cheapest(stretch.nodes, entry, goal) for goal in STATES}
                there = sorted((x[1], x[0], goal) for goal, x in found.items() if x)
                for rank, (audit, cost, goal) in enumerate(there):
                    at = 4 * entry + goal
                    costs[at], ranks[at], audits[at] = cost, rank, audit
        return [*stretch.start, *stretch.told(), number, is_open, costs, ranks, audits]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        current, is_open, out = None, True, []  # the first conversation may have begun in another task
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for c, t, r, p, k, n, blank, truncated, first in zip(*columns):
                other = current is not None and current.start[0] != c
                if current is not None and (other or len(current.nodes) >= longest):
                    is_open = is_open or not other
                    out.append(row(current, number, is_open))
                    number, current, is_open = number + 1, None, is_open and not other
                if current is None:
                    current = Stretch((c, t, r, p, k))
                current.add(t, r, n, blank, truncated, first)
            if len(out) > 1000:
                yield _batch(out, arrow)
                out = []
        if current is not None:
            out.append(row(current, number, True))  # the last one may go on
        if out:
            yield _batch(out, arrow)

    keys = ["c", *ORDER]
    return turns.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def chain(parts: list[tuple[list[int], list[int]]]) -> list[int]:
    """Which pair of states each stretch of one conversation takes, given costs and ranks."""
    rest = [{s: INSERT * len(TAIL[s]) for s in STATES}]
    for costs, _ in reversed(parts):
        after = rest[-1]
        rest.append({
            s: min((costs[4 * s + to] + after[to] for to in STATES if costs[4 * s + to] >= 0), default=NEVER) for s in STATES
        })
    rest.reverse()
    state, out = 0, []
    for i, (costs, ranks) in enumerate(parts):
        fitting = [
            (ranks[4 * state + to], to) for to in STATES
            if costs[4 * state + to] >= 0 and costs[4 * state + to] + rest[i + 1][to] == rest[i][state]
        ]
        to = min(fitting)[1]
        out.append(4 * state + to)
        state = to
    return out


def chained(pieces: DataFrame) -> DataFrame:
    """``(id, at, more)`` of open stretches: the pair of states each takes, and the
    edits after the last one. Rows of a long conversation are narrow here."""
    keys = ["c", *ORDER]
    narrow = pieces.where("open").select(*keys, "id", "costs", "ranks")

    def done(ids: list[int], parts: list) -> list[list]:
        found = chain(parts)
        return [[i, at, TAIL[at % 4] if i == ids[-1] else ""] for i, at in zip(ids, found)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("at", pa.int32()), ("more", pa.string())])
        conv, ids, parts = None, [], []
        for batch in batches:
            out = []
            for c, i, costs, ranks in zip(*(batch.column(x).to_pylist() for x in ("c", "id", "costs", "ranks"))):
                if ids and c != conv:
                    out += done(ids, parts)
                    ids, parts = [], []
                conv = c
                ids.append(i)
                parts.append((costs, ranks))
            if out:
                yield _batch(out, schema)
        if ids:
            yield _batch(done(ids, parts), schema)

    return narrow.repartition("c").sortWithinPartitions(*keys).mapInArrow(run, "id bigint, at int, more string")


def edited(pieces: DataFrame) -> DataFrame:
    """The stretches with the ``cost`` and the ``audit`` of the edits they take."""
    keys = ["c", *ORDER, *_STATS]
    closed = pieces.where(~F.col("open")).select(*keys, F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"))
    taken = pieces.where("open").join(chained(pieces), "id")
    at = F.col("at")
    open_ = taken.select(
        *keys, (F.get("costs", at) + INSERT * F.length("more")).alias("cost"), F.concat(F.get("audits", at), "more").alias("audit")
    )
    return closed.unionByName(open_)


# ---- repaired conversations ---------------------------------------------------

class Conversation:
    """Takes the stretches of a conversation, then its turns in order."""

    def __init__(self, conv: object) -> None:
        self.conv = conv
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.tail = None
        self.audits: list[str] = []
        self.part = self.place = self.state = 0

    def take(self, told: dict, audit: str, cost: int) -> None:
        if self.tail is not None:
            self.illegal += self.tail + told["head"] not in LEGAL
        self.turns += told["turns"] - (told["turns"] > 0 and told["low"] == self.high)
        if told["low"] is not None:
            self.low, self.high = told["low"] if self.low is None else self.low, told["high"]
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + told[name])
        self.tail, self.cost = told["tail"], self.cost + cost
        self.audits.append(audit)

    def _edit(self) -> str:
        while self.part < len(self.audits) and self.place == len(self.audits[self.part]):
            self.part, self.place = self.part + 1, 0
        if self.part == len(self.audits):
            return ""
        self.place += 1
        return self.audits[self.part][self.place - 1]

    def _to_next(self) -> str:
        self.state = NEXT[self.state]
        return ROLE_OF[self.state]

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """The repaired turns up to this one."""
        while (edit := self._edit()) == "I":
            yield self._to_next(), ""
        if edit == "K":
            self.state = KEEP[self.state][role[:1]]
            yield role, text
        elif edit == "R":
            yield self._to_next(), text

    def rest(self) -> Iterator[tuple[str, str]]:
        while self._edit() == "I":
            yield self._to_next(), ""

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def in_order(
    rows: DataFrame, conversations: DataFrame, conv: str, turn: str, role: str, text: str, longest: int
) -> DataFrame:
    """Everything about a conversation in one task, in this order: a mark that it
    exists, its edited stretches, its turns with their texts."""
    pieces = edited(checkpointed(stretches(narrow_turns(rows, conv, turn, role, text), longest)))
    role_, text_ = F.coalesce(F.col(role), F.lit(" ")), F.coalesce(F.col(text), F.lit(" "))
    told = rows.select(F.col(conv).alias("c"), F.lit(2).alias("kind"), *_in_order(F.col(turn), role_, text_), text_.alias("text"))
    marks = conversations.select(F.col(conv).alias("c")).distinct().withColumn("kind", F.lit(0))
    stream = marks.unionByName(pieces.withColumn("kind", F.lit(1)), allowMissingColumns=True).unionByName(told, allowMissingColumns=True)
    return stream.repartition("c").sortWithinPartitions("c", "kind", *ORDER)


def read_conversations(
    batches: Iterator[pa.RecordBatch], turns: Callable[[Conversation, Iterator[tuple[str, str]]], list],
    end: Callable[[Conversation], list], schema: pa.Schema,
) -> Iterator[pa.RecordBatch]:
    """Walk through ``in_order``: ``turns`` makes rows of repaired turns, ``end`` of a
    conversation that is over."""
    current, out = None, []
    for batch in batches:
        for rows in slices(batch, "text"):
            columns = {n: rows.column(n).to_pylist() for n in ("c", "kind", "r", "text", "cost", "audit", *_STATS)}
            for i, kind in enumerate(columns["kind"]):
                if current is None or columns["c"][i] != current.conv:
                    if current is not None:
                        out += turns(current, current.rest()) + end(current)
                    current = Conversation(columns["c"][i])
                if kind == 1:
                    current.take({n: columns[n][i] for n in _STATS}, columns["audit"][i], columns["cost"][i])
                elif kind == 2:
                    out += turns(current, current.turn(columns["r"][i], columns["text"][i]))
            if len(out) > 1000:
                yield _batch(out, schema)
                out = []
    if current is not None:
        out += turns(current, current.rest()) + end(current)
    if out:
        yield _batch(out, schema)


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", longest: int = STRETCH,
) -> DataFrame:
    """``(conv, position, role, text)``: the repaired turns, numbered from 1.

    NULL roles and texts are one blank, so such a role is never kept and such a text
    is blank. Turns come by number, NULL first; turns of one number by role, the
    first 64 characters of their text and its hash. Rows that repeat are duplicates
    of one another. Conversations of which nothing is left have no rows. An empty
    role has no letter and is never kept. A NULL conversation is one like any other.
    Other columns of ``rows`` are not read.
    """
    kind = rows.schema[conv].dataType
    schema = T.StructType().add(conv, kind).add("position", "long").add("role", "string").add("text", "string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        position: dict[int, int] = {}

        def turns(current: Conversation, made: Iterator[tuple[str, str]]) -> list:
            out = []
            for role, text in made:
                position["at"] = position.get("at", 0) + 1
                out.append([current.conv, position["at"], role, text])
            return out

        def end(current: Conversation) -> list:
            position.clear()
            return []

        yield from read_conversations(batches, turns, end, arrow)

    return in_order(rows, rows, conv, turn, role, text, longest).mapInArrow(run, schema)


def report(
    rows: DataFrame, conversations: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", longest: int = STRETCH,
) -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``
    of each conversation in ``conversations`` (those of ``rows`` unless given): turn
    numbers that are missing, turns by their first fault, neighbours whose roles may
    not meet, the cheapest edits and their cost, and a digest of what ``repair`` gives,
    as lines ``role:text``.

    Order, NULLs and repeats are as in ``repair``. A conversation without turns has
    zeros, no edits and the digest of the empty text. An empty table gives an empty one.
    """
    kind = rows.schema[conv].dataType
    schema = T.StructType().add(conv, kind)
    for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
        schema = schema.add(name, "long")
    schema = schema.add("audit", "string").add("repaired_sha256", "string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {"hash": hashlib.sha256(), "lines": 0}

        def turns(current: Conversation, made: Iterator[tuple[str, str]]) -> list:
            for role, text in made:
                state["hash"].update(f"{chr(10) if state['lines'] else ''}{role}:{text}".encode())
                state["lines"] += 1
            return []

        def end(current: Conversation) -> list:
            digest = state["hash"].hexdigest()
            state.update(hash=hashlib.sha256(), lines=0)
            counts = [current.blank, current.duplicate, current.truncated, current.illegal, current.cost]
            return [[current.conv, current.gaps(), *counts, "".join(current.audits), digest]]

        yield from read_conversations(batches, turns, end, arrow)

    told = rows if conversations is None else conversations
    return in_order(rows, told, conv, turn, role, text, longest).mapInArrow(run, schema)
