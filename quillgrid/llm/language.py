"""Language by compression: the dictionary that packs a text smallest names it.

Each language gets a zstandard dictionary of raw content, made of short pieces
of labelled documents. A text is packed once with each; the smallest size wins,
and a narrow margin between the first and the second is a rejection. Labels in
the wild are partly wrong, so the pieces are first packed with dictionaries made
of the other half of the sample, and those that disagree with their label stay
out.

The sample is bounded: ``PIECES`` documents per language, chosen by a hash over
all labelled rows, with ``PIECE`` bytes of each. Predictions read whole texts.
"""

from __future__ import annotations

import math
import re
import zlib

import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.llm.common import add_columns, once_per_worker, own_names, whole

PIECES, PIECE, DICTIONARY, LEVEL = 1500, 200, 110_000, 6
MAX_LANGUAGES = 200
"""Bounds of the sample, hence of the model's broadcast: languages times dictionary bytes. A
dictionary takes pieces by their hash until it is full; more languages stop the job."""
MIN_MARGIN = 0.01
"""Share of the smallest size by which the second must be larger to be accepted. Of 9,950
rows that were told rightly (sf0.1) 6 are below it, all short, and of 50 told wrongly 35."""
NARROW = 3
"""Bytes between first and second within which the half dictionaries are asked, too."""
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")


def plain(text: str) -> bytes:
    """The words of a text in lower case; marks, digits and line ends go."""
    return " ".join(LETTERS.findall(text.lower())).encode()


def piece_of(text: str, length: int = PIECE) -> bytes:
    """A stretch of the text, at a place that its content decides."""
    words = plain(text)
    start = zlib.crc32(words) % max(1, len(words) - length)
    return words[start : start + length]


class Packers:
    """A compressor for each language."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL) -> None:
        how = zstandard.ZstdCompressionParameters.from_level(
            level, write_checksum=False, write_content_size=False, write_dict_id=False
        )
        self.compress = {}
        for name, content in sorted(dictionaries.items()):
            made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(compression_params=how)
            self.compress[name] = zstandard.ZstdCompressor(dict_data=made, compression_params=how).compress

    def sizes(self, words: bytes) -> dict[str, int]:
        return {name: len(compress(words)) for name, compress in self.compress.items()}


class Languages:
    """The model: one dictionary per language of all pieces, and two of half of them."""

    def __init__(self, dictionaries: list[dict[str, bytes]]) -> None:
        self.whole, *self.halves = [Packers(d) for d in dictionaries]

    def predict(self, text: str) -> tuple[str, float, float]:
        """Language, score and relative margin."""
        if not self.whole.compress or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        words = plain(text)
        sizes = self.whole.sizes(words)
        first, second = self._two(sizes)
        if sizes[second] - sizes[first] <= NARROW and len(sizes) > 1:
            for half in self.halves:
                for name, n in half.sizes(words).items():
                    sizes[name] += n
            first, second = self._two(sizes)
        gap = sizes[second] - sizes[first] if first != second else sizes[first]
        score = 1 / (1 + math.exp(-min(40.0, gap / math.sqrt(sizes[first]))))
        return first, score, gap / sizes[first]

    @staticmethod
    def _two(sizes: dict[str, int]) -> tuple[str, str]:
        ordered = sorted(sizes, key=lambda name: (sizes[name], name))
        return ordered[0], ordered[min(1, len(ordered) - 1)]


def learn(docs: DataFrame, learnable: Column, text_col: str = "text", lang_col: str = "lang") -> list[dict[str, bytes]]:
    """The dictionaries, of the rows of ``docs`` for which ``learnable`` holds
    and whose language is not NULL."""
    rows = docs.where(learnable & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), whole(text_col).alias("text"), F.xxhash64(text_col).alias("order")
    )
    # Hashes alone are ranked, and cut in each task before they are shuffled; what
    # is chosen is a bounded number of hashes, sent to where the texts lie.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    chosen = rows.select("lang", "order").distinct().withColumn("rank", rank).where(F.col("rank") <= PIECES).drop("rank")
    names = [r[0] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    cut = F.udf(piece_of, "binary")
    halves: tuple[dict[str, set[bytes]], ...] = ({}, {})
    texts = rows.join(F.broadcast(chosen), ["lang", "order"]).groupBy("lang", "order").agg(F.first("text").alias("text"))
    for row in texts.select("lang", cut("text").alias("piece")).collect():
        piece = bytes(row["piece"])
        if piece:
            halves[zlib.crc32(piece) % 2].setdefault(row["lang"], set()).add(piece)
    made = [{name: b" ".join(sorted(p, key=zlib.crc32))[-DICTIONARY:] for name, p in half.items()} for half in halves]
    agreed: dict[str, list[bytes]] = {}
    for half, other in zip(halves, reversed(made)):
        packers = Packers(other)
        for name, pieces in sorted(half.items()):
            for piece in sorted(pieces):
                sizes = packers.sizes(piece)
                if name not in sizes or sizes[name] == min(sizes.values()):
                    agreed.setdefault(name, []).append(piece)
    everything = {name: b" ".join(sorted(p, key=zlib.crc32))[-DICTIONARY:] for name, p in agreed.items()}
    # A language whose pieces never agree is kept with all of them.
    for half in made:
        for name, content in half.items():
            everything.setdefault(name, content)
    return [everything, *made]


def predict(docs: DataFrame, dictionaries: list[dict[str, bytes]], text_col: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``margin`` to each row.

    A text without a letter, empty or NULL, or any text when nothing was
    learned, is ``und`` with score and margin 0. ``margin`` is the gap between
    the two smallest sizes as a share of the smallest; 0 is a tie, broken by
    name. Columns of these names are replaced, others stay.
    """
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)
    key = ("languages", hash(tuple(frozenset(d.items()) for d in dictionaries)))

    def work(texts: list[str | None]) -> list[list]:
        model = once_per_worker(key, lambda: Languages(sent.value))
        found = [model.predict(t or "") for t in texts]
        return [list(x) for x in zip(*found)] or [[], [], []]

    return add_columns(docs, "lang_pred string, score double, margin double", text_col, work)


def accepted(docs: DataFrame, learnable: Column, min_margin: float = MIN_MARGIN, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose language is told with a margin above ``min_margin``, with
    their own columns. ``und`` rows go; without any label to learn from, all do."""
    own, new, old = own_names(docs)
    found = predict(own, learn(docs, learnable, text_col, lang_col), new[text_col])
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("margin") > min_margin)).select(*old)
