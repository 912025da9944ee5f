"""Byte-level BPE: exact merges by backtracking, and decoding by offset table.

A greedy reading of the longest token at each place is not what the merges
yield. It is, when every two neighbouring tokens are *compatible*: merging the
bytes of the two together ends with just these two. So the encoder reads the
longest match, which an Aho-Corasick automaton has found for every place of the
word in one pass; when that is not compatible with the token before, it tries
the next shorter prefix token, and when none is left it takes the last token
back. Places found dead are marked, so that each is tried once and the work is
linear in the word, however long it is.

Words repeat, so a worker keeps the tokens of words it has met. The vocabulary
is a parameter; it reaches executors as a broadcast of the file's text, whose
size the tokenizer fixes.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from itertools import chain

import ahocorasick
import numpy as np
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from quillgrid.llm.common import add_columns, once_per_worker

# The pattern that splits text before the merges, a fixed value; \s is spelled
# out as the Unicode property, which regular expression libraries agree on.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# The characters of the Unicode property White_Space, fixed values.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# No word crosses from one of these chunks into the next, so text is cut into
# chunks first, which takes a far simpler pattern, and words are sought in new chunks only.
CHUNKS = f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
KEPT = 300_000
"""Entries of the worker's memories; full ones start anew."""
PAIR_SLOTS = 1 << 21
"""Slots of the table of compatible pairs. Pairs that share a slot displace each
other and are worked out again."""
SHORT = 400
"""Bytes of the words that are encoded many at a time."""


def byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable
    bytes stand for themselves, the others for letters from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """The tables of one tokenizer file."""

    def __init__(self, text: str) -> None:
        said = json.loads(text)
        model, before = said["model"], said["pre_tokenizer"] or {}
        fits = (
            model["type"] == "BPE" and said["normalizer"] is None and not model.get("ignore_merges")
            and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        )
        added = said["added_tokens"]
        if not fits or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("only byte-level BPE with plain added tokens is known")
        letters = byte_of_letter()
        ids: dict[str, int] = model["vocab"]
        # A token's rank is its place in the order of merges; bytes come first.
        names = sorted(letters, key=letters.get)
        rank = {name: i for i, name in enumerate(names)}
        halves = [(i, i) for i in range(len(names))]
        for pair in model["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            if rank.setdefault(left + right, len(halves)) != len(halves):
                raise ValueError("two merges make one token")
            halves.append((rank[left], rank[right]))
        self.halves = halves
        self.merged = {pair: i for i, pair in enumerate(halves) if pair[0] != i}
        self.ids = np.array([ids[name] for name in rank], np.int32)
        raw = ["".join(chr(letters[c]) for c in name) for name in rank]
        self.size = [len(r) for r in raw]
        at = {r: i for i, r in enumerate(raw)}
        self.shorter = [next((at[r[:n]] for n in range(len(r) - 1, 0, -1) if r[:n] in at), -1) for r in raw]
        self.sizes, self.shorters = np.array(self.size), np.array(self.shorter)
        self.automaton = ahocorasick.Automaton()
        for i, r in enumerate(raw):
            self.automaton.add_word(r, i)
        self.automaton.make_automaton()
        self.words, self.chunks = regex.compile(WORDS), re.compile(CHUNKS)
        self.added = {t["content"]: np.int32(t["id"]).tobytes() for t in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if added else None
        self.pair_keys, self.pair_fits = np.full(PAIR_SLOTS, -1, np.int64), np.zeros(PAIR_SLOTS, bool)
        self.kept: dict[str, bytes] = {}
        self.kept_words: dict[str, bytes] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes end with these two tokens.

        Walks back through the merges along the border, latest first: none of
        the pairs that face each other there may have merged earlier.
        """
        bound = len(self.halves)
        while True:
            if self.merged.get((left, right), bound) < bound:
                return False
            if left > right:
                bound, left = left, self.halves[left][1]
                if left == bound:
                    bound, right = right + 1, self.halves[right][0]
                    if right + 1 == bound:
                        return True
            else:
                bound, right = right + 1, self.halves[right][0]
                if right + 1 == bound:
                    bound, left = left, self.halves[left][1]
                    if left == bound:
                        return True

    def compatible_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``compatible`` for many pairs, with a table of those met before."""
        keys = left.astype(np.int64) << 32 | right
        slots = (left * 40503 + right * 10007) % PAIR_SLOTS
        for i in np.flatnonzero(self.pair_keys[slots] != keys):
            if self.pair_keys[slots[i]] != keys[i]:
                self.pair_fits[slots[i]] = self.compatible(int(left[i]), int(right[i]))
                self.pair_keys[slots[i]] = keys[i]
        clash = self.pair_keys[slots] != keys  # displaced by a later pair of this call
        fits = self.pair_fits[slots]
        for i in np.flatnonzero(clash):
            fits[i] = self.compatible(int(left[i]), int(right[i]))
        return fits

    def longest_matches(self, text: str) -> list[int]:
        """The longest token that begins at each place, -1 for none."""
        longest, size = [-1] * len(text), self.size
        for last, token in self.automaton.iter(text):
            longest[last + 1 - size[token]] = token  # a later end is longer
        return longest

    def encode_word(self, word: bytes) -> list[int]:
        """The ranks of the tokens of one word, of any length."""
        end, size, shorter = len(word), self.size, self.shorter
        longest = self.longest_matches(word.decode("latin-1"))
        tokens, place, token, dead = [], 0, -1, set()
        while place < end:
            if token < 0:
                token = longest[place]
            after = place + size[token]
            if after not in dead and (not tokens or self.compatible(tokens[-1], token)):
                tokens.append(token)
                place, token = after, -1
                continue
            token = shorter[token]
            if token < 0:  # none fits here: take the last token back, then try a shorter one
                dead.add(place)
                token = tokens.pop()
                place -= size[token]
        return tokens

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of many short words.

        Where the longest matches from left to right are compatible with each
        other they are the answer; the other words go back and forth.
        """
        # The letter between the words occurs in no token.
        text = "\u0100".join(w.decode("latin-1") for w in words)
        matches = np.fromiter(chain.from_iterable(self.automaton.iter_long(text)), np.int64).reshape(-1, 2)
        ends = np.cumsum(np.array([len(w) for w in words]) + 1)
        word = np.searchsorted(ends, matches[:, 0], side="right")
        ranks = matches[:, 1]
        inner = np.flatnonzero(word[1:] == word[:-1])
        fits = self.compatible_pairs(ranks[inner], ranks[inner + 1])
        wrong = np.zeros(len(words), bool)
        wrong[word[inner[~fits]]] = True
        ids, stop = self.ids[ranks].tobytes(), 4 * np.cumsum(np.bincount(word, minlength=len(words)))
        found = [ids[a:b] for a, b in zip([0, *stop[:-1]], stop)]
        again = np.flatnonzero(wrong).tolist()
        if again:
            for i, mended in zip(again, self.backtrack([words[i] for i in again])):
                found[i] = mended
        return found

    def backtrack(self, words: list[bytes]) -> list[bytes]:
        """The ids of many short words; all take their next step at once."""
        text = "\u0100".join(w.decode("latin-1") for w in words)
        longest = np.array(self.longest_matches(text), np.int32)
        sizes = np.array([len(w) for w in words])
        first = np.cumsum(sizes + 1) - sizes - 1
        end, place, token = first + sizes, first.copy(), longest[first].astype(np.int64)
        path = np.zeros(len(text) + 1, np.int64)  # at each place, the token that ends there
        dead = np.zeros(len(text) + 1, bool)
        left = np.arange(len(words))
        while left.size:
            at, now = place[left], token[left]
            after = at + self.sizes[now]
            fits = ~dead[after]
            ask = fits & (at > first[left])
            fits[ask] = self.compatible_pairs(path[at[ask]], now[ask])
            go, new = left[fits], after[fits]
            path[new], place[go] = now[fits], new
            more = new < end[go]
            token[go[more]] = longest[new[more]]
            stay, less = left[~fits], self.shorters[now[~fits]]
            back, here = stay[less < 0], at[~fits][less < 0]
            dead[here] = True
            less[less < 0] = path[here]
            place[back] = here - self.sizes[path[here]]
            token[stay] = less
            left = left[place[left] < end[left]]
        # Read the paths from the ends, then turn them round.
        found, left, step = [], np.arange(len(words)), 0
        while left.size:
            last = path[place[left]]
            found.append((left, np.full(left.size, -step), last))
            place[left] -= self.sizes[last]
            left, step = left[place[left] > first[left]], step + 1
        word, steps, ranks = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((steps, word))
        ids = self.ids[ranks[order]].tobytes()
        ends = 4 * np.cumsum(np.bincount(word, minlength=len(words)))
        return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def learn(self, chunks: set[str]) -> None:
        """Keep the ids of chunks that are new to this worker."""
        if len(self.kept) > KEPT:
            self.kept.clear()
        if len(self.kept_words) > KEPT:
            self.kept_words.clear()
        cut = {c: self.words.findall(c) for c in chunks if c not in self.kept}
        new = list(set().union(*cut.values()).difference(self.kept_words))
        raw = {w: w.encode() for w in new}
        short = [w for w in new if len(raw[w]) <= SHORT]
        if short:
            self.kept_words.update(zip(short, self.encode_words([raw[w] for w in short])))
        for w in new:
            if len(raw[w]) > SHORT:
                self.kept_words[w] = self.ids[self.encode_word(raw[w])].tobytes()
        ids = self.kept_words.__getitem__
        self.kept.update(zip(cut, [b"".join(map(ids, words)) for words in cut.values()]))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of some texts."""
        cut = []
        for text in texts:
            pieces = self.cut.split(text) if self.cut and any(c in text for c in self.added) else [text]
            cut.append([x for p in pieces for x in ([p] if p in self.added else self.chunks.findall(p))])
        self.learn(set().union(*cut).difference(self.added))
        self.kept.update(self.added)
        ids = self.kept.__getitem__
        return [np.frombuffer(b"".join(map(ids, chunks)), np.int32) for chunks in cut]


class Decoder:
    """The bytes of all tokens in a row, and where each begins."""

    def __init__(self, text: str) -> None:
        said = json.loads(text)
        letters = byte_of_letter()
        by_id = {i: bytes(letters[c] for c in name) for name, i in said["model"]["vocab"].items() if set(name) <= letters.keys()}
        by_id |= {t["id"]: t["content"].encode() for t in said["added_tokens"]}
        pieces = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        self.blob = np.frombuffer(b"".join(pieces), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement marks."""
        ids = np.asarray(ids, np.int64)
        if ids.size and not (0 <= ids.min() and ids.max() + 1 < self.offsets.size):
            raise ValueError("an id that the vocabulary does not have")
        start = self.offsets[ids]
        size = self.offsets[ids + 1] - start
        before = np.cumsum(size) - size
        place = np.repeat(start - before, size) + np.arange(size.sum())
        return self.blob[place].tobytes().decode("utf-8", errors="replace")


def _shared(docs: DataFrame, vocabulary: str) -> tuple[Broadcast, str]:
    """The text of a tokenizer file for the executors, and its digest."""
    with open(vocabulary, encoding="utf-8") as file:
        text = file.read()
    return docs.sparkSession.sparkContext.broadcast(text), hashlib.sha256(text.encode()).hexdigest()


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add ``ids_col``, the token ids of the whole text.

    ``vocabulary`` is the path of a tokenizers JSON file, read by the driver.
    NULL and empty texts have no ids. All other columns stay, one of the name
    ``ids_col`` is replaced; an empty table gives an empty one.
    """
    said, key = _shared(docs, vocabulary)

    def work(texts: list[str | None]) -> list[list]:
        tables = once_per_worker(("bpe", key, "tables"), lambda: Vocabulary(said.value))
        gc.disable()  # millions of strings and no cycles
        return [tables.encode([t or "" for t in texts])]

    return add_columns(docs, f"`{ids_col}` array<int>", text_col, work)


def decode(docs: DataFrame, vocabulary: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add ``text_col``, the text that the ids stand for.

    No ids, or NULL, give the empty text. An id that the vocabulary does not
    have stops the job.
    """
    said, key = _shared(docs, vocabulary)

    def work(ids: list[list[int] | None]) -> list[list]:
        decoder = once_per_worker(("bpe", key, "decoder"), lambda: Decoder(said.value))
        return [["" if x is None else decoder.decode(x) for x in ids]]

    return add_columns(docs, f"`{text_col}` string", ids_col, work)


def round_trip(
    docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded",
) -> DataFrame:
    """``encode`` and ``decode`` of what it gives, by one worker in one go: the texts pass
    to Python once, and half as many workers hold a batch of them."""
    said, key = _shared(docs, vocabulary)

    def work(texts: list[str | None]) -> list[list]:
        tables = once_per_worker(("bpe", key, "tables"), lambda: Vocabulary(said.value))
        decoder = once_per_worker(("bpe", key, "decoder"), lambda: Decoder(said.value))
        gc.disable()  # millions of strings and no cycles
        ids = tables.encode([t or "" for t in texts])
        return [ids, [decoder.decode(x) for x in ids]]

    return add_columns(docs, f"`{ids_col}` array<int>, `{decoded_col}` string", text_col, work)
