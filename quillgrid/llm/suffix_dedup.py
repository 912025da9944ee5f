"""Repeated strings of a fixed length, found by sorting suffixes at anchors.

Every string of ``LENGTH`` bytes has an anchor: of the grams in it, the one with
the smallest hash, the last of equals. Equal strings have equal anchors at the
same place, so only suffixes that begin at anchors are compared, about one in
seventy, and only with those of the same gram. The strings with one anchor lie
side by side and make one segment of text.

Anchors that occur once are done. Segments that occur twice as a whole are
repeated, as counted by hash. What is left are segments that share an anchor but
differ somewhere, at the borders of longer repeats. Their text is fetched, and
for each anchor the text to the right of it is put in order by deep-shallow
sorting, the text to the left likewise: multikey quicksort down to a shallow
depth, then a blind trie for each group whose common prefix goes on. From the
two orders follows, without comparing all pairs, how far each segment agrees
with any other.

An anchor may be as frequent as there are documents. Counts are aggregated before
they are shuffled, joins on hot anchors are cut by adaptive execution, and an
anchor with more than ``GROUP`` different segments is not sorted in one task:
its strings are counted by hash, in parallel, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.llm.common import add_columns, shared_path

LENGTH, GRAM = 200, 48
SHALLOW = 8
"""Bytes beyond the common start that quicksort looks at before tries take over."""
GROUP = 1000
"""Different segments of one anchor that one task sorts."""
BITS = 10
MOST = (1 << BITS) - 1
"""A segment is shorter than this: it has at most 2 * length - GRAM bytes."""
LONGEST = (MOST + GRAM) // 2
CHUNK = 1 << 22
"""Bytes of a text that are hashed at a time."""

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]
_LOW = np.uint64((1 << 24) - 1)


# ---- anchors ---------------------------------------------------------------

def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``GRAM`` bytes, by doubling: 1, 2, 4 … 32, then 32 + 16."""
    with np.errstate(over="ignore"):
        part = (data.astype(np.uint64) + _MIX[3]) * _MIX[0]
        held, size = part, 1
        while size < 32:
            held = (held[:-size] ^ (held[:-size] >> np.uint64(29))) * _MIX[1] + held[size:]
            size *= 2
            if size == 16:
                part = held
        n = data.size - GRAM + 1
        held = (held[:n] ^ (held[:n] >> np.uint64(31))) * _MIX[2] + part[32 : 32 + n]
        held = (held ^ (held >> np.uint64(30))) * _MIX[1]
        return held ^ (held >> np.uint64(31))


def segments(text: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """``(anchor hash, first byte, end, place of the anchor)`` of each segment:
    the text of all strings that have one anchor."""
    wide = length - GRAM + 1
    for base in range(0, len(text) - length + 1, CHUNK):
        data = np.frombuffer(text, np.uint8, min(CHUNK + length - 1, len(text) - base), base)
        hashes = gram_hashes(data)
        n = hashes.size
        # The hash decides, then the place: of equal hashes the last is smallest.
        keys = (hashes & ~_LOW) | (_LOW - np.arange(n, dtype=np.uint64))
        padded = np.concatenate([keys, np.full(-n % wide, np.uint64(2**64 - 1))]).reshape(-1, wide)
        ahead = np.minimum.accumulate(padded, axis=1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[: n - wide + 1], ahead[wide - 1 : n])
        place = (_LOW - (least & _LOW)).astype(np.int64)
        start = np.flatnonzero(np.diff(place, prepend=-1))
        stop = np.append(start[1:], place.size) + length - 1
        at = place[start]
        anchor = hashes[at].view(np.int64).tolist()
        yield from zip(anchor, (start + base).tolist(), (stop + base).tolist(), (at + base).tolist())


def _packed(first: int, stop: int, at: int) -> int:
    """A place in one number: ``BITS`` bits each for the length and for the way to the anchor."""
    return first << 2 * BITS | (stop - first) << BITS | (at - first)


# ---- deep-shallow sorting --------------------------------------------------

def common(a: bytes, b: bytes, known: int = 0) -> int:
    """The length of the common prefix, of which ``known`` bytes are known."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def deep_shallow(texts: list[bytes], known: int) -> tuple[list[int], list[int]]:
    """The order of the texts, and for each in order its common prefix with the
    one before (0 for the first). All agree in their first ``known`` bytes.
    Equal texts are ordered by number."""
    order: list[int] = []
    shared: list[int] = []
    # Parts to do, in reverse; each with the depth that it shares with what is before.
    todo = [(list(range(len(texts))), known, 0)]
    while todo:
        part, depth, before = todo.pop()
        if len(part) == 1:
            order.append(part[0])
            shared.append(before)
        elif depth >= known + SHALLOW:
            trie_order, trie_shared = blind_trie(texts, part, depth)
            order += trie_order
            shared += [before, *trie_shared[1:]]
        else:
            letters = [texts[i][depth] if depth < len(texts[i]) else -1 for i in part]
            pivot = letters[len(letters) // 2]
            less = [i for i, c in zip(part, letters) if c < pivot]
            same = [i for i, c in zip(part, letters) if c == pivot]
            more = [i for i, c in zip(part, letters) if c > pivot]
            if pivot < 0:  # these have ended: they are equal
                ended, same = same, []
            else:
                ended = []
            if more:
                todo.append((more, depth, depth if less or same or ended else before))
            if same:
                todo.append((same, depth + 1, depth if less else before))
            if ended:
                order += ended
                shared += [before, *[depth] * (len(ended) - 1)]
            if less:
                todo.append((less, depth, before))
    return order, shared


def blind_trie(texts: list[bytes], part: list[int], known: int) -> tuple[list[int], list[int]]:
    """Order of a group that agrees in ``known`` bytes. Inner nodes hold only the
    depth where their texts part; a text goes down by the bytes there without
    looking at the rest, is compared once with the leaf it meets, and hangs in
    where the two part."""
    # A leaf is [None, numbers of equal texts]; an inner node [depth, {byte: child}].
    root: list = [None, [part[0]]]
    for i in part[1:]:
        text, node = texts[i], root
        while node[0] is not None:
            letter = text[node[0]] if node[0] < len(text) else -1
            node = node[1].get(letter) or next(iter(node[1].values()))
        other = texts[node[1][0]]
        depth = common(text, other, known)
        if depth == len(text) == len(other):
            node[1].append(i)
            continue
        letter = text[depth] if depth < len(text) else -1
        node = root
        while node[0] is not None and node[0] < depth:
            node = node[1][text[node[0]] if node[0] < len(text) else -1]
        if node[0] == depth:
            node[1][letter] = [None, [i]]
        else:
            # Any text below shares ``depth`` bytes and goes on with one byte.
            theirs = other[depth] if depth < len(other) else -1
            node[:] = [depth, {theirs: list(node), letter: [None, [i]]}]
    order, shared, todo = [], [], [(root, known)]
    while todo:
        node, before = todo.pop()
        if node[0] is None:
            size = len(texts[node[1][0]])
            order += node[1]
            shared += [before, *[size] * (len(node[1]) - 1)]
        else:
            children = [node[1][c] for c in sorted(node[1])]
            todo += [(c, node[0]) for c in reversed(children[1:])] + [(children[0], before)]
    return order, shared


def agreements(segments: list[tuple[bytes, int]], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For segments ``(text, place of the anchor)`` with one anchor: the parts
    ``(begin, end)`` of each that strings of ``length`` bytes cover which another
    segment holds at the same place to the anchor."""
    found: list[list[tuple[int, int]]] = [[] for _ in segments]
    right = [text[at:] for text, at in segments]
    left = [text[:at][::-1] for text, at in segments]
    # The anchor itself agrees, as long as its 64-bit hash does not deceive.
    known = min(common(right[0], r) for r in right[1:])
    order, shared = deep_shallow(right, known)
    left_order, left_shared = deep_shallow(left, 0)
    rank = {x: i for i, x in enumerate(left_order)}

    # Stretches of the right order that share a prefix, longest prefixes first inside.
    open_at: list[tuple[int, int]] = []
    for i in range(1, len(order) + 1):
        depth, start = (shared[i] if i < len(order) else -1), i - 1
        while open_at and open_at[-1][0] > depth:
            there, start = open_at.pop()
            members = sorted(rank[x] for x in order[start:i])
            agree = [min(left_shared[a + 1 : b + 1]) for a, b in zip(members, members[1:])]
            for j, r in enumerate(members):
                best = max(agree[j - 1] if j else -1, agree[j] if j < len(agree) else -1)
                if best + there >= length:
                    x = left_order[r]
                    at = segments[x][1]
                    found[x].append((at - best, at + there))
        if depth >= 0 and (not open_at or open_at[-1][0] < depth):
            open_at.append((depth, start))
    return found


# ---- the operator ----------------------------------------------------------

def _stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as Parquet in the shared folder; narrow and packed."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for begin, end in sorted(spans):
        if merged and begin <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([begin, end])
    return [tuple(s) for s in merged]


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``(id_col, n_bytes, spans, kept)`` of every row.

    ``spans`` are the maximal runs ``begin`` to ``end`` (exclusive) of UTF-8 bytes
    that are covered by strings of ``length`` bytes which start anywhere else
    too, in the same document or another; overlaps count, and all is judged on
    the input. ``kept`` are the other bytes, in order. NULL is an empty text;
    shorter texts keep everything; rows that repeat a text of ``length`` bytes
    lose all of it. Ids name documents: rows that repeat an id must repeat the
    text. A row without an id counts like any other. An empty table gives an
    empty result; other columns are not read.
    """
    if not 2 * GRAM <= length <= LONGEST:
        raise ValueError(f"length from {2 * GRAM} to {LONGEST}")
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text))
    rows = docs.select(F.col(id_col).alias("id"), key.alias("doc"), text.alias("text"))

    def listed(texts: list[str]) -> list[list]:
        out = []
        for text in texts:
            raw = text.encode()
            view = memoryview(raw)
            out.append([
                {"anchor": a, "segment": xxhash.xxh3_64_intdigest(view[f:s]) - (1 << 63), "place": _packed(f, s, at)}
                for a, f, s, at in segments(raw, length)
            ])
        return [out]

    def anchors(texts: list[str]) -> list[list]:
        return [[np.fromiter((x[0] for x in segments(t.encode(), length)), np.int64) for t in texts]]

    # Anchors that occur more than once; eight bytes each, aggregated before the shuffle.
    seen = add_columns(rows, "anchors array<long>", "text", anchors, [])
    often = seen.select(F.explode("anchors").alias("anchor")).groupBy("anchor").count().where("count > 1").select("anchor")
    listing = "found array<struct<anchor:long,segment:long,place:long>>"
    places = add_columns(rows, listing, "text", listed, ["doc"]).select("doc", F.explode("found").alias("f"))
    places = places.select("f.anchor", "f.segment", "doc", "f.place")
    places = _stored(places.join(often, "anchor", "left_semi"), "anchors")

    kinds = places.groupBy("anchor", "segment").agg(
        F.count(F.lit(1)).alias("n"), F.first("doc").alias("doc"), F.first("place").alias("place")
    )
    kinds = _stored(kinds, "segments")
    whole_segments = places.join(kinds.where("n > 1").select("anchor", "segment"), ["anchor", "segment"], "left_semi")
    first = F.shiftright("place", 2 * BITS)
    size = F.shiftright("place", BITS).bitwiseAND(F.lit(MOST))
    covered = whole_segments.select("doc", first.alias("begin"), (first + size).alias("end"))

    mixed = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    mixed = mixed.where("kinds > 1 AND least = 1").select("anchor", "kinds")
    border = kinds.join(mixed, "anchor")
    packed = add_columns(rows, "packed binary", "text", lambda t: [[zstandard.compress(x.encode(), 3) for x in t]], ["id", "doc"])
    fetched = _stored(_fetch(packed, border), "borders")
    covered = covered.union(_sorted(fetched.where(F.col("kinds") <= GROUP), length))
    covered = covered.union(_counted(fetched.where(F.col("kinds") > GROUP), length))

    # A document's spans are no more than its bytes.
    spans = covered.groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("covered"))
    joined = packed.join(spans, "doc", "left").select("id", F.struct("packed", "covered").alias("_read"), "packed")

    def cut(rows: list[dict]) -> list[list]:
        sizes, spans, kept = [], [], []
        for row in rows:
            raw = zstandard.decompress(row["packed"])
            merged = _merge([(s["begin"], s["end"]) for s in row["covered"] or ()])
            edges = [0, *[e for s in merged for e in s], len(raw)]
            sizes.append(len(raw))
            spans.append([{"begin": a, "end": b} for a, b in merged])
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
        return [sizes, spans, kept]

    out = add_columns(joined, "n_bytes long, spans array<struct<begin:long,end:long>>, kept binary", "_read", cut, ["id"], "packed")
    return out.withColumnRenamed("id", id_col)


def _fetch(packed: DataFrame, border: DataFrame) -> DataFrame:
    """The text of one example of each segment."""
    wanted = border.groupBy("doc").agg(F.collect_list(F.struct("anchor", "kinds", "n", "place")).alias("wanted"))
    joined = packed.drop("id").join(wanted, "doc").select("doc", F.struct("packed", "wanted").alias("_read"), "packed")

    def take(rows: list[dict]) -> list[list]:
        out = []
        for row in rows:
            raw, taken = zstandard.decompress(row["packed"]), []
            for w in row["wanted"]:
                begin, size, at = w["place"] >> 2 * BITS, w["place"] >> BITS & MOST, w["place"] & MOST
                taken.append({**w, "text": raw[begin : begin + size], "at": at})
            out.append(taken)
        return [out]

    taken = "taken array<struct<anchor:long,kinds:long,n:long,place:long,text:binary,at:int>>"
    return add_columns(joined, taken, "_read", take, ["doc"], "packed").select("doc", F.inline("taken"))


def _sorted(fetched: DataFrame, length: int) -> DataFrame:
    """Covered parts by deep-shallow sorting, anchor by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done() -> list[tuple[int, int, int]]:
            out = []
            if len(held) > 1:
                for (_, doc, n, place, *_), parts in zip(held, agreements([(h[4], h[5]) for h in held], length)):
                    if n == 1:  # the others are covered as a whole
                        out += [(doc, (place >> 2 * BITS) + a, (place >> 2 * BITS) + b) for a, b in parts]
            return out

        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    out += done()
                    held = []
                if not held or (row[1], row[3]) != (held[-1][1], held[-1][3]):  # else a row of a repeated id
                    held.append(row)
            yield _spans_batch(out)
        yield _spans_batch(done())

    cut = fetched.select("anchor", "doc", "n", "place", "text", "at").repartition("anchor")
    return cut.sortWithinPartitions("anchor", "doc", "place").mapInArrow(run, "doc long, begin long, end long")


def _spans_batch(spans: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*spans)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "begin", "end"])


def _counted(fetched: DataFrame, length: int) -> DataFrame:
    """Covered parts of anchors with very many segments: each string by its
    128-bit hash, counted over different segments."""

    def hashed(texts: list[bytes]) -> list[list]:
        return [[[xxhash.xxh3_128_digest(t[i : i + length]) for i in range(len(t) - length + 1)] for t in texts]]

    strings = add_columns(fetched, "hashes array<binary>", "text", hashed, ["doc", "n", "place"])
    strings = strings.select("doc", "n", "place", F.posexplode("hashes").alias("i", "hash"))
    often = strings.groupBy("hash").count().where("count > 1").select("hash")
    begin = F.shiftright("place", 2 * BITS) + F.col("i")
    return strings.where("n = 1").join(often, "hash", "left_semi").select("doc", begin.alias("begin"), (begin + length).alias("end"))
