"""Shards by vector bin packing: bytes, tokens and rows balanced together.

Groups of equal texts are placed whole where they fit. A group larger than a
shard's share is cut into pieces, and the many small groups are bundled by hash,
so what is placed one after another is bounded by the number of shards, not by
the data: at most ``3 * FINE * shards`` groups of a size that counts, the pieces of
large ones, and ``LEVELS * COARSE * shards`` bundles. Bundles come in sizes that
shrink by level, like coins, so that the last ones even out what the first left.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.llm.common import checkpointed, whole

FINE = 128
"""A group is placed by itself from 1 / FINE of a shard on, in any dimension."""
COARSE, LEVELS = 8, 4
PIECES = 4
"""Pieces per shard that a group larger than a shard is cut into."""
BLOCK = 200_000
"""Rows that one task numbers, about."""


def _vector(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")
    )


def pack(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each vector (rows: things to place; columns: dimensions).

    Largest first, each goes where the dot product with the residual capacity is
    highest among the shards it fits; if it fits nowhere, to the shard it
    overfills least. Then single things move from the fullest shard in the first
    dimension to the emptiest while that narrows the gap.
    """
    total = vectors.sum(axis=0)
    load = vectors / np.where(total > 0, total, 1) * shards  # a shard's capacity is 1 in each dimension
    residual = np.ones((shards, load.shape[1]))
    placed = np.zeros(len(load), np.int64)
    for i in np.argsort(-load.max(axis=1), kind="stable"):
        after = residual - load[i]
        worst = after.min(axis=1)
        fits = worst >= 0
        score = np.where(fits, residual @ load[i], -np.inf) if fits.any() else worst
        placed[i] = best = int(np.argmax(score))
        residual[best] = after[best]
    level = 1 - residual[:, 0]
    for _ in range(4 * len(load)):
        full, empty = int(np.argmax(level)), int(np.argmin(level))
        gap = level[full] - level[empty]
        here = np.flatnonzero((placed == full) & (load[:, 0] < gap) & (load[:, 0] > 0))
        if not here.size:
            break
        moved = here[np.argmin(np.abs(load[here, 0] - gap / 2))]
        placed[moved] = empty
        level[full] -= load[moved, 0]
        level[empty] += load[moved, 0]
    return placed


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, size, text_crc32, shard, slot)`` of every row.

    ``size`` is the UTF-8 length of the text plus 8; NULL is an empty text.
    Sizes of shards are near equal (the law ``bytes``), tokens (stretches without
    white space) and rows follow as far as the texts allow. ``slot`` numbers the
    rows of a shard from 0 without gaps, ordered by a hash of the id. Rows that
    repeat, also in their id, get slots of their own. An empty table gives an
    empty result; other columns are not read.
    """
    text = whole(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id", (F.octet_length("text") + 8).cast("long").alias("size"), F.crc32(F.col("text").cast("binary")).alias("crc"),
        F.regexp_count("text", F.lit(r"\S+")).cast("long").alias("tokens"), F.md5(F.col("text").cast("binary")).alias("text_id"),
    )
    # Narrow rows, read three times: the texts are hashed once.
    rows = checkpointed(rows)
    groups = _vector(rows, "text_id")
    whole_of = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("bytes", "tokens", "rows")]).first()
    share = F.greatest(*[F.col(c) / F.lit(max(1, whole_of[c])) for c in ("bytes", "tokens", "rows")]) * shards
    # At most 3 * FINE * shards groups are that large.
    large = groups.withColumn("share", share).where(F.col("share") >= 1 / FINE)
    pieces = F.when(F.col("share") > 1, F.ceil(F.col("share") * PIECES)).otherwise(1).cast("int")
    large = large.select("text_id", pieces.alias("pieces"))
    units = checkpointed(_units(rows, large, shards))
    sizes = _vector(units, "unit").collect()
    vectors = np.array([[r["bytes"], r["tokens"], r["rows"]] for r in sizes], float).reshape(-1, 3)
    order = sorted(range(len(sizes)), key=lambda i: sizes[i]["unit"])
    chosen = pack(vectors[order], shards)
    placed = docs.sparkSession.createDataFrame(
        [(sizes[i]["unit"], int(s)) for i, s in zip(order, chosen)], "unit string, shard int"
    )
    out = units.join(F.broadcast(placed), "unit").drop("unit")
    return _slots(out, whole_of["rows"], shards).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", "slot"
    )


def _units(rows: DataFrame, large: DataFrame, shards: int) -> DataFrame:
    """Rows with the ``unit`` they are placed with: a large group, a piece of
    it, or the bundle that the hash of the text names."""
    own = F.xxhash64("text_id")
    piece = F.pmod(F.xxhash64("id", F.lit(1)), F.col("pieces"))
    # A level holds a quarter of the groups that the level before it holds.
    level: Column = F.lit(0)
    for k in range(1, LEVELS):
        level = F.when(F.pmod(own, F.lit(4**k)) == 0, F.lit(k)).otherwise(level)
    bundle = F.pmod(F.xxhash64("text_id", F.lit(7)), F.lit(COARSE * shards))
    named = F.when(F.col("pieces").isNotNull(), F.concat_ws("-", "text_id", piece.cast("string")))
    unit = F.coalesce(named, F.concat_ws("-", F.lit("bundle"), level.cast("string"), bundle.cast("string")))
    joined = rows.join(F.broadcast(large), "text_id", "left")
    return joined.select("id", "size", "crc", "tokens", unit.alias("unit"))


def _slots(rows: DataFrame, n: int, shards: int) -> DataFrame:
    """Number the rows of each shard from 0, in blocks that hold about ``BLOCK`` rows."""
    blocks = max(1, n // (shards * BLOCK) + 1)
    rows = rows.withColumn("order", F.xxhash64("id"))
    # The block rises with the order.
    block = F.floor((F.col("order").cast("double") / F.lit(2.0**64) + 0.5) * blocks).cast("int")
    rows = checkpointed(rows.withColumn("block", block))
    counts = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "block").orderBy("order", "id", "crc"))
    numbered = rows.withColumn("inside", inside).join(starts, ["shard", "block"])
    return numbered.withColumn("slot", (F.col("start") + F.col("inside") - 1).cast("long"))
