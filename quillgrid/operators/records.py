"""Row-level operators on records: filters, limits, dates, keys.

Frames from ``quillgrid.sources`` carry ``file``, ``block`` and ``rn``; there
the order operators are filters on ``rn`` that move no data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.clean import FALSY, drop_empty_value, drop_falsy
from quillgrid.functions.dates import date_text, leading_int
from quillgrid.functions.provenance import file_name, parse_file_name, volume_name
from quillgrid.operators import ordering

POSITION = ("file", "block", "rn")

# Fixed value: a line number that starts with a digit marks a real record.
NUMERIC_LINE = "\\A[0-9]+"


def _fields(df: DataFrame, keep: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keep]


def drop_header_record(df: DataFrame, group: str | Sequence[str] = "file", order: str = "rn") -> DataFrame:
    """Drop the first record of each file: the header row read as data."""
    if order == "rn":
        return df.where(F.col("rn") > 1)
    return ordering.drop_first(df, group, order)


def limit_per_file(df: DataFrame, n: int, group: str | Sequence[str] = "file", order: str = "rn", skipped: int = 0):
    """The first ``n`` records of each file. On numbered records this is a
    filter; ``skipped`` is how many were dropped before."""
    if order == "rn":
        return df.where(F.col("rn") <= n + skipped)
    return ordering.first_n(df, n, group, order)


def skip_until(
    df: DataFrame, predicate: Column, group="file", order: str = "rn", block: str | None = "block",
    few_blocks: bool = False,
) -> DataFrame:
    """Drop the records of a file before the first that fulfils ``predicate``."""
    return ordering.keep_from_first(df, predicate, group, order, block, few_blocks=few_blocks)


def skip_comments(df: DataFrame, column: str = "line", mark: str = "#") -> DataFrame:
    return df.where(~F.col(column).startswith(mark))


def drop_empty(df: DataFrame, keep: Sequence[str] = POSITION) -> DataFrame:
    """NULL for empty values, so that the sink leaves the element out."""
    return df.select(*keep, *(drop_empty_value(c).alias(c) for c in _fields(df, keep)))


def drop_falsy_values(df: DataFrame, keep: Sequence[str] = POSITION, keep_zero: bool = False) -> DataFrame:
    """NULL for values that count as missing."""
    return df.select(*keep, *(drop_falsy(c, keep_zero).alias(c) for c in _fields(df, keep)))


def carry_previous(df: DataFrame, columns: Sequence[str], group="file", order: str = "rn", block: str | None = "block"):
    """Replace the columns by their value in the record before; the first record
    of a file gets NULL."""
    out = df.withColumn("_carried", F.struct(*columns))
    out = ordering.previous_value(out, "_carried", group, order, "_before", block)
    return out.select(*(F.col("_before")[c].alias(c) if c in columns else F.col(c) for c in df.columns))


def fold_date_columns(
    values: Mapping[str, Column],
    triples: Sequence[tuple[str, str, str, str]],
    date: Callable[[str, str, str], Column],
    keep_parts: bool = False,
) -> list[Column]:
    """The columns of ``fold_dates`` over named expressions; ``date`` makes the
    date of the year, month and day columns of these names."""
    present = [t for t in triples if all(c in values for c in t[1:])]
    dates = {y: date(y, m, d).alias(name) for name, y, m, d in present}
    year_of = {c: y for _, y, m, d in present for c in (m, d)}
    out = []
    for c, value in values.items():
        if c in dates:
            out.append(dates[c])
        elif c not in year_of:
            out.append(value.alias(c))
        elif keep_parts:
            dated = F.coalesce(~values[year_of[c]].isin(*FALSY), F.lit(False))
            out.append(F.when(~dated, value).alias(c))
    return out


def fold_dates(df: DataFrame, triples: Sequence[tuple[str, str, str, str]], keep_parts: bool = False) -> DataFrame:
    """Put a partial date in the place of each year column and drop its parts.

    Triples whose columns are absent are skipped. A record without a year has
    no date; ``keep_parts`` then keeps its day and month.
    """
    # The numbers become columns of their own, so that each text is parsed once
    # however often its number is used.
    parts = sorted({c for t in triples if all(c in df.columns for c in t[1:]) for c in t[1:]})
    numbers = df.withColumns({f"_n_{c}": leading_int(c) for c in parts}) if parts else df

    def date(y: str, m: str, d: str) -> Column:
        return F.when(~F.col(y).isin(*FALSY), date_text(f"_n_{y}", f"_n_{m}", f"_n_{d}"))

    values = {c: F.col(c) for c in df.columns}
    return numbers.select(*fold_date_columns(values, triples, date, keep_parts))


def with_provenance(df: DataFrame, file: str = "file") -> DataFrame:
    """Add ``source`` and what its name says: ``series, volume, expected_n``."""
    name = file_name(file)
    told = parse_file_name(volume_name(name))
    return df.withColumns(
        {"source": name, "series": told["series"], "volume": told["volume"], "expected_n": told["expected_n"]}
    )


def order_by_document(df: DataFrame, group: str | Sequence[str] = "file", order: str = "rn") -> DataFrame:
    """Global document order, by a range-partitioned sort."""
    return df.orderBy(*([group] if isinstance(group, str) else group), order)


def document_position(df: DataFrame, group: str | Sequence[str] = "file", order: str = "rn", name: str = "position") -> DataFrame:
    """Add the position of each record among all records, from 1, in document order.

    Rows are numbered within their group; what comes before a group is added from a
    table with one row per group. Nothing is sorted in one task but the counts of
    blocks of groups.
    """
    return ordering.number_all(df, [group] if isinstance(group, str) else list(group), order, name)
