"""Benchmark passages in documents, found word for word.

The benchmark is cut into windows of consecutive words. Its windows are the
broadcast side: the driver measures the benchmark first and reads it in blocks
of at most ``BLOCK_BYTES`` of text, each of which scans all documents once, so a
large benchmark means more passes, never a larger broadcast. Documents are not
moved. Windows are looked up by a rolling hash of their words, and each hit is
verified word by word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgrid.llm.common import add_columns, checkpointed, once_per_worker, own_names, whole

WINDOW = 13
BLOCK_BYTES = 16_000_000
MAYBE = 1 << 22
"""Entries of the table that tells at one look of most windows that they are none."""
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
"""A word of text whose A-Z are in lower case: digits, letters and all beyond ASCII."""

FOUND = "n_words long, hits array<struct<begin:int,end:int>>, items array<long>"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive words, from theirs."""
    n = hashes.size - size + 1
    found, factor = np.zeros(n, np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(size):
            factor = factor * _STEP + np.uint64(2 * j + 1)
            found += hashes[j : j + n] * factor
        return found ^ (found >> np.uint64(29))


class Windows:
    """The windows of one block of benchmark items, as arrays: sixteen bytes for each
    beside the words of the block, so a full block takes less than 200 MB."""

    def __init__(self, items: list[tuple[int, str]], window: int) -> None:
        self.ids = np.array([item for item, _ in items], np.int64)
        kept: list[bytes] = []
        starts: list[np.ndarray] = []
        by_size: dict[int, list[tuple[np.ndarray, np.ndarray, int]]] = {}
        length = count = 0
        for number, (_, text) in enumerate(items):
            words = words_of(text)
            if not words:
                continue
            size = min(window, len(words))
            found = _rolling(_hashes(words), size)
            by_size.setdefault(size, []).append((found, np.arange(count, count + found.size, dtype=np.int32), number))
            sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
            starts.append((length + np.cumsum(sizes) - sizes).astype(np.int32))
            kept.append(b" ".join(words) + b" ")
            length, count = length + len(kept[-1]), count + len(words)
        self.text, self.starts = b"".join(kept), np.append(np.concatenate(starts) if starts else np.empty(0, np.int32), length)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for size, parts in by_size.items():
            hashes = np.concatenate([h for h, _, _ in parts])
            order = np.argsort(hashes, kind="stable")
            hashes = hashes[order]
            place = np.concatenate([p for _, p, _ in parts])[order]
            item = np.concatenate([np.full(h.size, n, np.int32) for h, _, n in parts])[order]
            maybe = np.zeros(MAYBE, bool)  # most windows of a document are told to be none by one look
            maybe[hashes & np.uint64(MAYBE - 1)] = True
            self.tables[size] = hashes, place, item, maybe

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words lie in a window, and the items whose windows occur."""
        own, hit, items = _hashes(words), np.zeros(len(words) + 1, np.int64), set()
        for size, (hashes, place, item, maybe) in self.tables.items():
            if len(words) < size:
                continue
            there = _rolling(own, size)
            start = np.flatnonzero(maybe[there & np.uint64(MAYBE - 1)])
            if not start.size:
                continue
            low, high = np.searchsorted(hashes, there[start]), np.searchsorted(hashes, there[start], "right")
            told: dict[bytes, bool] = {}
            for i, a, b in zip(start.tolist(), low.tolist(), high.tolist()):
                if a == b:
                    continue
                said = b" ".join(words[i : i + size])
                if said not in told:  # the words decide, not their hashes
                    same = [k for k in range(a, b) if self._window(place[k], size) == said]
                    told[said] = bool(same)
                    items.update(self.ids[item[same]].tolist())
                if told[said]:
                    hit[i] += 1
                    hit[i + size] -= 1
        return np.cumsum(hit)[:-1] > 0, items

    def _window(self, place: int, size: int) -> bytes:
        return self.text[self.starts[place] : self.starts[place + size] - 1]


def _spans(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items, in lists of about ``block_bytes`` of text."""
    items = benchmark.select(F.col(id_col).alias("i"), whole(text_col).alias("t")).where(F.col("i").isNotNull())
    size = items.agg(F.coalesce(F.sum(F.octet_length("t") + 64), F.lit(0))).first()[0]
    n = max(1, -(-size // block_bytes))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k) if n > 1 else items
        yield [(r["i"], r["t"]) for r in part.collect()]


def find_passages(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add to each document ``n_words``, ``hits`` (the runs of words that lie in
    a window of an item, as word numbers ``begin`` to ``end``, exclusive),
    ``items`` (their item ids, sorted), ``n_hit`` and ``contaminated`` (at least
    one word in twenty is hit).

    A window is ``window`` consecutive words; an item of fewer words, but not
    none, is one window. NULL has no words. Items without an id are no items,
    and repeated ids count once. Columns of these names are replaced, all others
    stay; an empty table on either side gives no hits.
    """
    added = ["n_words", "hits", "items", "n_hit", "contaminated"]
    kept = [c for c in docs.columns if c not in added]
    found = docs.select(
        *[F.col(f"`{c}`") for c in kept], F.lit(None).cast("array<struct<begin:int,end:int>>").alias("hits"),
        F.lit(None).cast("array<long>").alias("items"),
    )
    for block, items in enumerate(_blocks(benchmark, item_col, item_text_col, block_bytes)):
        if block:
            found = checkpointed(found)
        found = _scan(found, items, window, text_col)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    found = found.withColumn("n_hit", n_hit)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _scan(found: DataFrame, items: list[tuple[int, str]], window: int, text_col: str) -> DataFrame:
    """One block of items against all documents; earlier hits are joined to its own."""
    sent = found.sparkSession.sparkContext.broadcast(items)
    key = ("windows", window, hash(tuple(items)))
    read = F.struct(F.col(f"`{text_col}`").alias("text"), F.col("hits").alias("hits"), F.col("items").alias("items"))

    def work(rows: list[dict]) -> list[list]:
        windows = once_per_worker(key, lambda: Windows(sent.value, window))
        counts, hits, named = [], [], []
        for row in rows:
            words = words_of(row["text"] or "")
            mask, here = windows.scan(words)
            for span in row["hits"] or ():
                mask[span["begin"] : span["end"]] = True
            counts.append(len(words))
            hits.append([{"begin": a, "end": b} for a, b in _spans(mask)])
            named.append(sorted({*(row["items"] or ()), *here}))
        return [counts, hits, named]

    keep = [c for c in found.columns if c not in ("hits", "items")]
    return add_columns(found.withColumn("_read", read), FOUND, "_read", work, keep, text_col)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    own, new, old = own_names(docs)
    found = find_passages(own, benchmark, text_col=new[options.pop("text_col", "text")], **options)
    return found.where(~F.col("contaminated")).select(*old)


def cut_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All documents, their hit words (and what stands between hit words of one
    run) taken out of the text."""
    own, new, old = own_names(docs)
    text = new[text_col]
    found = find_passages(own, benchmark, text_col=text, **options)

    @F.pandas_udf(T.StringType())
    def cut(text: pd.Series, hits: pd.Series) -> pd.Series:
        def one(t, spans):
            if t is None or not len(spans):
                return t
            raw = t.encode()
            at = [m.span() for m in WORD.finditer(raw.lower())]
            out, last = [], 0
            for s in spans:
                out.append(raw[last : at[s["begin"]][0]])
                last = at[s["end"] - 1][1]
            return b"".join([*out, raw[last:]]).decode()

        return pd.Series([one(t, s) for t, s in zip(text, hits)], text.index, dtype=object)

    return found.withColumn(text, cut(F.col(text), F.col("hits"))).select(*old)
