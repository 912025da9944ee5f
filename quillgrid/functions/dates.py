"""Numbers and partial dates. Dates stay strings, since a part may be unknown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillgrid.functions.clean import FALSY, _col

# The stems of the dates whose parts come as <stem>Dy, <stem>Mo
# and <stem>Yr and are joined into <stem>Date.
DATE_STEMS = ("death", "birth", "birthReg", "marriage")


def date_triples(stems: tuple[str, ...] = DATE_STEMS) -> list[tuple[str, str, str, str]]:
    """``(date, year, month, day)`` column names for each stem."""
    return [(f"{s}Date", f"{s}Yr", f"{s}Mo", f"{s}Dy") for s in stems]


def leading_int(c: Column | str) -> Column:
    """The number a text starts with, 0 when it starts with none."""
    digits = F.regexp_extract(_col(c), "\\A[ \t\n\r\f]*([+-]?[0-9]+)", 1)
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def zpad(c: Column | str, width: int) -> Column:
    """A number with leading zeros. Longer numbers are never cut.

    ``format_string`` goes through a general formatter for every row, so only
    negative numbers, whose sign stands left of the zeros, are left to it.
    """
    n = _col(c).cast("bigint")
    digits = n.cast("string")
    return (
        F.when(n < 0, F.format_string(f"%0{width}d", n))
        .when(F.length(digits) >= width, digits)
        .otherwise(F.lpad(digits, width, "0"))
    )


def date_text(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """``YYYY-MM-DD`` of three numbers."""
    return F.concat_ws("-", zpad(year, 4), zpad(month, 2), zpad(day, 2))


def partial_date(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """``YYYY-MM-DD`` with ``00`` for unknown parts, NULL unless the year counts
    as a value.

    ``fold_dates`` does the same for whole frames at less cost.
    """
    year = _col(year)
    # One formatter call, since padding would evaluate each number repeatedly.
    text = F.format_string("%04d-%02d-%02d", leading_int(year), leading_int(month), leading_int(day))
    return F.when(~year.isin(*FALSY), text)


def as_date(c: Column | str) -> Column:
    """The date of a partial-date text, NULL when a part is unknown."""
    return F.try_to_date(_col(c), "yyyy-MM-dd")
