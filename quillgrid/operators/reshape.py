"""Between wide records, tall elements and cells."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.clean import drop_falsy, element_name, trim_ws
from quillgrid.operators import ordering
from quillgrid.operators.records import POSITION

# Fixed value: the name of the columns that are dropped from self-describing files.
DROPPED = ("xxxx",)


def to_elements(df: DataFrame, keep: Sequence[str] = POSITION, keep_zero: bool = False) -> DataFrame:
    """``(<keep>, ordinal, element, value)``: one row per value of a record that
    does not count as missing, in column order."""
    names = [c for c in df.columns if c not in keep]
    values = F.array(
        *(
            F.struct(
                F.lit(i).alias("ordinal"), F.lit(n).alias("element"),
                drop_falsy(F.col(n).cast("string"), keep_zero).alias("value"),
            )
            for i, n in enumerate(names, 1)
        )
    )
    return df.select(*keep, F.inline(values)).where(F.col("value").isNotNull())


def last_wins(df: DataFrame, key: str | Sequence[str], value: str, order: str) -> DataFrame:
    """The last value of each key."""
    keys = [key] if isinstance(key, str) else list(key)
    # A struct, so that a last value of NULL wins as well.
    last = F.max_by(F.struct(F.col(value).alias("v")), order)
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, F.col("_last")["v"].alias(value))


def promote_header(cells: DataFrame) -> DataFrame:
    """The cells below the header row with their ``element`` name.

    The reader puts the header beside each cell, so no join is needed.
    """
    rows = cells.where(F.col("n") > 1)
    return rows.withColumn("element", element_name("header", F.col("col") + 1)).drop("header")


def promote_first_row(
    df: DataFrame, value: str, group: str | Sequence[str], order: str, name: str = "element",
    block: str | None = None, rows: int = ordering.BLOCK_ROWS,
) -> DataFrame:
    """For rows without a header beside them: the ``value`` of the first row of
    the group becomes the name of the later rows."""
    group = [group] if isinstance(group, str) else list(group)
    named = ordering.first_value(df, value, group, order, name, block, rows)
    return named.where(~F.col("_is_first")).drop("_is_first")


def cells_to_records(cells: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Gather the cells of a row: a map from name to value, or one column per
    name in ``names``. For a repeated name the last column wins.

    A row holds at most as many cells as a sheet has columns. One shuffle by row
    serves both aggregates.
    """
    row = ["file", "sheet_no", "n"]
    by_row = cells.select(*row, "col", "element", "value").repartition(*row)
    unique = last_wins(by_row, [*row, "element"], "value", "col")
    entries = F.collect_list(F.struct("element", "value"))
    records = unique.groupBy(*row).agg(F.map_from_entries(entries).alias("record"))
    if names is None:
        return records
    return records.select(*row, *(F.col("record")[n].alias(n) for n in names))


def rows_to_records(rows: DataFrame, entries: Column, names: Sequence[str] | None = None, keep: Sequence[str] = ("file", "sheet_no", "n")) -> DataFrame:
    """The same from row-shaped data, without moving a row: ``entries`` is an array of
    structs ``(element, value)`` in column order. Values that are NULL are no entries;
    for a repeated name the last one wins.
    """
    told = rows.select(*keep, F.filter(entries, lambda e: e["value"].isNotNull()).alias("_entries"))
    if names is not None:
        def last(name: str) -> Column:
            return F.get(F.reverse(F.filter("_entries", lambda e: e["element"] == name)), F.lit(0))["value"]

        return told.select(*keep, *(last(n).alias(n) for n in names))
    elements = F.transform("_entries", lambda e: e["element"])
    is_last = F.filter("_entries", lambda e, i: ~F.array_contains(F.slice(elements, i + 2, F.size(elements)), e["element"]))
    return told.select(*keep, F.map_from_entries(is_last).alias("record"))


def union_sheets(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames whose columns may differ."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _has_value(c: str) -> Column:
    # Blanks alone are no value: the guards look at what cleaning would leave.
    return F.coalesce(drop_falsy(trim_ws(F.col(c).cast("string"))).isNotNull(), F.lit(False))


def dropped_values(df: DataFrame, names: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """How many values each column that is to be dropped still holds."""
    return df.groupBy(*group).agg(*(F.count_if(_has_value(n)).alias(n) for n in names))


def assert_empty(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same rows; the job stops at a value in one of the columns."""
    for n in names:
        message = F.concat(F.lit(f"dropped column {n} has value "), F.col(n).cast("string"))
        df = df.where(F.when(_has_value(n), F.raise_error(message).cast("boolean")).otherwise(True))
    return df


def drop_columns(df: DataFrame, names: Sequence[str] = DROPPED, guard: bool = True) -> DataFrame:
    """Drop columns; with ``guard`` they must not hold a value."""
    present = [n for n in names if n in df.columns]
    return (assert_empty(df, present) if guard else df).drop(*present)


def drop_elements(elements: DataFrame, names: Sequence[str] = DROPPED) -> DataFrame:
    """The same for tall elements: names in ``names`` must not hold a value."""
    message = F.concat(F.lit("dropped column "), F.col("element"), F.lit(" has value "), F.col("value"))
    listed = F.col("element").isin(*names)
    stop = listed & _has_value("value")
    return elements.where(F.when(stop, F.raise_error(message).cast("boolean")).otherwise(~listed))
