"""Order inside a group without ever holding a whole group in one task.

Rows of a group (a file, a conversation) are cut into *blocks*: stretches of
the order column that hold a bounded number of rows. Work inside a block is
done per ``(group, block)``; what crosses block borders is carried by a table
with one row for each block that does not begin its group, which is small, and
empty where all groups are.

Frames read by ``quillgrid.sources`` bring their own ``block`` column (the
start of the file split). Other frames are cut at quantiles of their integer
order column, which Spark's sketch finds, so that blocks are bounded by rows
however the orders lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1_000_000
"""Rows of a block, as far as ``QUANTILES`` can tell them apart."""

QUANTILES, ACCURACY = 2048, 20_000
"""A block is never cut finer than a ``QUANTILES``th of the table; ranks are off by an ``ACCURACY``th of it at most."""

SPLITTERS = 1023
"""Groups that ranges of groups begin at."""

LIMIT_PARTS = 32
"""Parts of a group that are cut to the limit before they meet."""

LIMIT_AT_ONCE = 1_000
"""Limits up to which Spark's own group limit cuts each task before the shuffle."""

_BLOCK, _BOUNDS, _SEEN = "_block", "_bounds", "_seen"


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _below(bounds: Column, value: Column) -> Column:
    """How many of the rising ``bounds`` are below ``value``, by halving."""
    halvings = F.sequence(F.lit(1), F.ceil(F.log2(F.size(bounds) + F.lit(1))).cast("int"))

    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        right = F.get(bounds, middle) < value
        return F.when(span["low"] >= span["high"], span).otherwise(
            F.struct(F.when(right, middle + 1).otherwise(span["low"]).alias("low"),
                     F.when(right, span["high"]).otherwise(middle).alias("high"))
        )

    span = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))
    return F.when(F.size(bounds) == 0, 0).otherwise(F.aggregate(halvings, span, halve)["low"])


def _with_block(df: DataFrame, order: list[str], block: str | None, rows: int) -> DataFrame:
    """Add the block. Without a ready one, the orders of the whole table are cut at
    quantiles, ``rows`` rows apart. These come from a scalar subquery."""
    if block is not None:
        return df.withColumn(_BLOCK, F.col(block))
    at = F.col(order[0]).cast("bigint")
    # One text, since a plan with thousands of numbers is slow to analyse.
    ranks = F.split(F.lit(" ".join(str(i / QUANTILES) for i in range(1, QUANTILES))), " ").cast("array<double>")
    told = df.agg(F.percentile_approx(at, ranks, ACCURACY).alias("quantiles"), F.count(at).alias("n"))
    stride = F.greatest(F.lit(1), F.floor(F.lit(rows) * QUANTILES / F.col("n")))
    taken = F.array_distinct(F.filter("quantiles", lambda q, i: (i + 1) % stride == 0))
    none = F.array().cast("array<bigint>")
    bounds = told.select(F.when(F.col("n") > rows, taken).otherwise(none).alias("bounds")).scalar()
    # A column first, since higher-order functions take no subquery.
    return df.withColumn(_BOUNDS, bounds).withColumn(_BLOCK, _below(F.col(_BOUNDS), at).cast("bigint")).drop(_BOUNDS)


def _inside(group: list[str], *order: str) -> Window:
    window = Window.partitionBy(*group, _BLOCK)
    return window.orderBy(*order) if order else window


def _before(group: list[str]) -> Window:
    return Window.partitionBy(*group).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def _carry(rows: DataFrame, carried: DataFrame, group: list[str]) -> DataFrame:
    """Bring what blocks carry over to their rows, on a key that no single group can
    make hot. Blocks that carry nothing are not in ``carried``."""
    return rows.join(carried, [*group, _BLOCK], "left")


def _present(value: Column, keys: Sequence[str]) -> Column:
    """A row with a NULL group or order has no place. It must not vanish."""
    missing = F.lit(False)
    for key in keys:
        missing |= F.col(key).isNull()
    return F.when(missing, F.raise_error(F.lit("NULL in a group or order column"))).otherwise(value)


def number_rows(
    df: DataFrame,
    group: str | Sequence[str],
    order: str | Sequence[str],
    block: str | None = None,
    rows: int = BLOCK_ROWS,
    name: str = "rn",
) -> DataFrame:
    """Number the rows of each group from 1.

    ``order`` must be unique inside the group, and its first column an integer
    unless ``block`` names a ready block column that rises with the order.
    """
    group, order = _names(group), _names(order)
    cut = _with_block(df, order, block, rows)
    counts = cut.groupBy(*group, _BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(*group, _BLOCK, F.sum("_n").over(_before(group)).alias("_offset")).where("_offset > 0")
    within = F.row_number().over(_inside(group, *order))
    numbered = _carry(cut.withColumn("_within", within), offsets, group)
    rn = _present(F.coalesce("_offset", F.lit(0)) + F.col("_within"), [*group, order[0]]).cast("bigint")
    return numbered.select(*df.columns, rn.alias(name))


def number_all(df: DataFrame, group: str | Sequence[str], order: str, name: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """Number all rows from 1, by group and then by ``order``, which must be an integer
    and unique inside the group.

    Blocks of groups are counted, and the counts added up in ``SPLITTERS + 1`` ranges of
    groups: inside each range by a window, across the ranges from a table with one row
    for each. The ranges begin at the groups with the smallest hashes, a sample of fixed
    size that does not depend on how rows are dealt out.
    """
    group = _names(group)
    cut = _with_block(df, [order], None, rows)
    counts = cut.groupBy(*group, _BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    key = F.struct(*group)
    sample = df.select(key.alias("k")).distinct().orderBy(F.xxhash64("k"), "k").limit(SPLITTERS)
    bounds = sample.agg(F.array_sort(F.collect_list("k")).alias("bounds")).scalar()
    ranged = counts.withColumn(_BOUNDS, bounds).withColumn("_range", _below(F.col(_BOUNDS), key)).drop(_BOUNDS)
    inside = Window.partitionBy("_range").orderBy(*group, _BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # over one row for each range
    totals = ranged.groupBy("_range").agg(F.sum("_n").alias("_total")).select("_range", F.sum("_total").over(across).alias("_base"))
    offsets = ranged.withColumn("_before", F.sum("_n").over(inside)).join(F.broadcast(totals), "_range").select(
        *group, _BLOCK, (F.coalesce("_before", F.lit(0)) + F.coalesce("_base", F.lit(0))).alias("_offset")
    )
    within = F.row_number().over(_inside(group, order))
    placed = _carry(cut.withColumn("_within", within), offsets, group)
    position = _present(F.col("_offset") + F.col("_within"), [*group, order]).cast("bigint")
    return placed.select(*df.columns, position.alias(name))


def split_summary(scan: DataFrame, file: str, block: str, pos: str, marked: Column | None = None) -> DataFrame:
    """One row per split of a file scan: how many rows come before it in its file.

    Returns ``(file, _block, _n, _first, _offset, total, marked, start)``: rows of the
    split and the position of its first one, rows of the splits before, and of the
    whole file its rows, those that are ``marked``, and the number of the first of
    these. One pass over the scan serves numbering, starts and verdicts; the summary
    of a split is the same wherever it is made, and splits are put together by sums.
    """
    mark = F.lit(False) if marked is None else F.coalesce(marked, F.lit(False))
    counts = scan.groupBy(file, F.col(block).alias(_BLOCK)).agg(
        F.count(F.lit(1)).alias("_n"), F.min(pos).alias("_first"), F.count_if(mark).alias("_marked"),
        F.min(F.when(mark, F.col(pos))).alias("_hit"),
    )
    offset = F.coalesce(F.sum("_n").over(_before([file])), F.lit(0))
    whole = Window.partitionBy(file)
    placed = counts.withColumn("_offset", offset)
    return placed.select(
        file, _BLOCK, "_n", "_first", "_offset", F.sum("_n").over(whole).alias("total"), F.sum("_marked").over(whole).alias("marked"),
        F.min(F.col("_offset") + F.col("_hit") - F.col("_first") + 1).over(whole).alias("start"),
    )


def place_rows(
    scan: DataFrame, summary: DataFrame, file: str, block: str, pos: str, few_blocks: bool, name: str = "rn"
) -> DataFrame:
    """Number the rows of a file scan from 1 per file by its ``split_summary``, without
    moving a row, and add ``start``. ``few_blocks`` says the caller has bounded the
    number of splits, so that the summary may be broadcast; otherwise it is joined by
    a shuffle on ``(file, split)``."""
    told = summary.select(file, _BLOCK, "_n", "_first", "_offset", "start", F.lit(True).alias(_SEEN))
    joined = scan.withColumn(_BLOCK, F.col(block)).join(F.broadcast(told) if few_blocks else told, [file, _BLOCK], "left")
    within = F.col(pos) - F.col("_first")
    same_splits = F.col(_SEEN).isNotNull() & within.between(F.lit(0), F.col("_n") - 1)
    rn = F.when(same_splits, F.col("_offset") + within + 1).otherwise(
        F.raise_error(F.lit("the source was split differently between two passes"))
    )
    return joined.select(*scan.columns, rn.cast("bigint").alias(name), "start")


def number_splits(scan: DataFrame, file: str, block: str, pos: str, few_blocks: bool, name: str = "rn") -> DataFrame:
    """Number the rows of a file scan from 1 per file, without moving a row.

    ``pos`` rises by one from row to row inside a split. The first pass counts
    the rows of each split and the second adds the offset, so the text itself is
    never shuffled or sorted.
    """
    return place_rows(scan, split_summary(scan, file, block, pos), file, block, pos, few_blocks, name).drop("start")


def first_rows(df: DataFrame, group: str | Sequence[str], order: str) -> DataFrame:
    """The key ``(group, order)`` of the first row of each group."""
    group = _names(group)
    return df.groupBy(*group).agg(F.min(order).alias(order))


def drop_first(df: DataFrame, group: str | Sequence[str], order: str) -> DataFrame:
    """All rows but the first of each group.

    The first keys come from a partial aggregate and are removed on the full
    ``(group, order)`` key, which is as evenly spread as the rows are. A NULL
    group is a group like any other.
    """
    group = _names(group)
    keys = [*group, order]
    firsts = first_rows(df, group, order).toDF(*(f"_first_{i}" for i in range(len(keys))))
    same = [F.col(k).eqNullSafe(F.col(f"_first_{i}")) for i, k in enumerate(keys)]
    return df.join(firsts, same, "left_anti")


def started(
    df: DataFrame,
    predicate: Column,
    group: str | Sequence[str],
    order: str,
    block: str | None = None,
    rows: int = BLOCK_ROWS,
    name: str = "started",
    few_blocks: bool = False,
) -> DataFrame:
    """Add a flag that is false until ``predicate`` first holds in the group.

    ``few_blocks`` says that the caller has bounded the number of blocks, so that a
    table of them may be broadcast and the rows need not move."""
    group = _names(group)
    cut = _with_block(df, [order], block, rows)
    hit = F.min(F.when(predicate, F.col(order)))
    hits = cut.groupBy(*group, _BLOCK).agg(hit.alias("_hit"))
    if few_blocks:
        starts = hits.select(*group, _BLOCK, F.min("_hit").over(Window.partitionBy(*group)).alias("_start"))
        placed, begun = cut.join(F.broadcast(starts), [*group, _BLOCK], "left"), F.col(order) >= F.col("_start")
    else:
        earlier = hits.select(*group, _BLOCK, F.min("_hit").over(_before(group)).alias("_start")).where("_start IS NOT NULL")
        placed = _carry(cut.withColumn("_hit", hit.over(_inside(group))), earlier, group)
        begun = F.col("_start").isNotNull() | (F.col(order) >= F.col("_hit"))
    flag = _present(F.coalesce(begun, F.lit(False)), [*group, order])
    return placed.select(*df.columns, flag.alias(name))


def group_summary(
    df: DataFrame, predicate: Column, group: str | Sequence[str], order: str, block: str | None = None, rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(group, total, marked, start)``: rows of each group, those that fulfil
    ``predicate``, and the order of the first of these. It is put together from
    summaries of blocks, as ``split_summary`` is."""
    group = _names(group)
    mark = F.coalesce(predicate, F.lit(False))
    blocks = _with_block(df, [order], block, rows).groupBy(*group, _BLOCK).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(mark).alias("_marked"), F.min(F.when(mark, F.col(order))).alias("_hit")
    )
    return blocks.groupBy(*group).agg(
        F.sum("_n").alias("total"), F.sum("_marked").alias("marked"), F.min("_hit").alias("start")
    )


def keep_from_first(
    df: DataFrame,
    predicate: Column,
    group: str | Sequence[str],
    order: str,
    block: str | None = None,
    rows: int = BLOCK_ROWS,
    few_blocks: bool = False,
) -> DataFrame:
    """Drop the rows of a group before the first one that fulfils ``predicate``.

    Later rows stay whether they fulfil it or not.
    """
    flagged = started(df, predicate, group, order, block, rows, "_started", few_blocks)
    return flagged.where("_started").drop("_started")


def previous_value(
    df: DataFrame,
    column: str,
    group: str | Sequence[str],
    order: str,
    name: str,
    block: str | None = None,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the value ``column`` has in the row before, NULL in a group's first."""
    group = _names(group)
    cut = _with_block(df, [order], block, rows)
    # Wrapped in a struct, so that a NULL value is not mistaken for no row.
    held = F.struct(F.col(column).alias("v"))
    tails = cut.groupBy(*group, _BLOCK).agg(F.max_by(held, order).alias("_tail"))
    by_block = Window.partitionBy(*group).orderBy(_BLOCK)
    tails = tails.select(*group, _BLOCK, F.lag("_tail").over(by_block).alias("_tail")).where("_tail IS NOT NULL")
    local = F.lag(held).over(_inside(group, order))
    joined = _carry(cut.withColumn("_local", local), tails, group)
    value = _present(F.coalesce(F.col("_local"), F.col("_tail"))["v"], [*group, order])
    return joined.select(*df.columns, value.alias(name))


def first_n(
    df: DataFrame, n: int, group: str | Sequence[str], order: str, parts: int = LIMIT_PARTS
) -> DataFrame:
    """The first ``n`` rows of each group, by any column that can be sorted. A
    NULL group is a group like any other.

    Up to ``LIMIT_AT_ONCE`` each task cuts its rows of a group to ``n`` before they are
    shuffled. Beyond, each group is first cut to ``n`` rows in each of ``parts`` parts,
    so that no task ranks more than ``parts * n`` rows of a hot group.
    """
    names = _names(group)
    rank = F.row_number().over(Window.partitionBy(*names).orderBy(order))
    if n > LIMIT_AT_ONCE:
        part = F.pmod(F.xxhash64(order), F.lit(parts))
        inside = F.row_number().over(Window.partitionBy(*names, "_part").orderBy(order))
        df = df.withColumn("_part", part).withColumn("_rank", inside).where(F.col("_rank") <= n).drop("_part")
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def first_value(
    df: DataFrame,
    column: str,
    group: str | Sequence[str],
    order: str,
    name: str,
    block: str | None = None,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the value ``column`` has in the first row of the group, and
    ``_is_first`` for that row itself."""
    group = _names(group)
    cut = _with_block(df, [order], block, rows)
    first = F.struct(F.col(column).alias("v"))
    heads = cut.groupBy(*group, _BLOCK).agg(F.min_by(first, order).alias("_head"))
    earlier = heads.select(*group, _BLOCK, F.first("_head").over(_before(group)).alias("_head")).where("_head IS NOT NULL")
    inside = _inside(group, order)
    local = cut.withColumns({"_local": F.first(first).over(inside), "_within": F.row_number().over(inside)})
    joined = _carry(local, earlier, group)
    is_first = _present(F.col("_head").isNull() & (F.col("_within") == 1), [*group, order])
    return joined.select(
        *df.columns, F.coalesce(F.col("_head"), F.col("_local"))["v"].alias(name), is_first.alias("_is_first")
    )
