"""What a file name says about its records, and names derived from it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillgrid.functions.clean import _col
from quillgrid.functions.dates import zpad


@dataclass(frozen=True)
class NameRule:
    """How one naming convention is read.

    ``pattern`` has one group per part of the volume number; ``widths`` are the
    zero-padded widths of these parts. Without widths the volume is the first
    four characters of the first group. ``count`` finds the number of records
    the name promises. ``{0}`` in ``record_type`` is ``series``' text.
    """

    pattern: str
    count: str
    record_type: str
    series_group: int = 0
    series: str = ""
    volume_groups: tuple[int, ...] = ()
    widths: tuple[int, ...] = ()


# The naming conventions, tried in this order.
NAME_RULES = (
    NameRule(r"CON(18)_([0-9]+)_([0-9])", r"_n([0-9]*)", "dlm", 1, "", (2, 3), (2, 2, 1)),
    NameRule(r"CON(19)_([0-9]+)_([0-9])", r"_n([0-9]*)", "dlf", 1, "", (2, 3), (2, 2, 1)),
    NameRule(r"CON([0-9][0-9])_([0-9]+)", r"_n([0-9]+).xml", "c{0}a", 1, "", (2,), (2, 2)),
    NameRule(r"htg_absc_([^_]+)_n([0-9]+)\.x", r"htg_absc_[^_]+_n([0-9]+)\.x", "hga", 0, "hga", (1,)),
    NameRule(r"htg_freedoms_([^_]+)_n([0-9]+)\.x", r"htg_freedoms_[^_]+_n([0-9]+)\.x", "hgf", 0, "hgf", (1,)),
)
# Digits of the line number in a document key, by record type.
KEY_WIDTHS = {"dlm": 3, "hgf": 5}
KEY_WIDTH_DEFAULT = 4
# Names that stand for a file which was never delivered.
STUB_PATTERN = r"MISSINGFILE|_n\.xls"


def file_name(path: Column | str) -> Column:
    """The last part of a file URI as plain text."""
    last = F.regexp_extract(_col(path), "[^/]+\\z", 0)
    return F.url_decode(F.replace(last, F.lit("+"), F.lit("%2B")))


def folder(path: Column | str) -> Column:
    """What stands before the last part of a file URI."""
    return F.regexp_extract(_col(path), "(?s)\\A(.*)/[^/]*\\z", 1)


def parse_file_name(name: Column | str, rules: tuple[NameRule, ...] = NAME_RULES) -> Column:
    """A struct ``(series, volume_no, volume, expected_n, record_type)``; all
    NULL when no rule knows the name."""
    name = _col(name)

    def read(rule: NameRule) -> Column:
        def group(i: int) -> Column:
            return F.regexp_extract(name, rule.pattern, i)

        series = group(rule.series_group) if rule.series_group else F.lit(rule.series)
        if rule.widths:
            first = (rule.series_group,) if rule.series_group else ()
            parts = zip((*first, *rule.volume_groups), rule.widths)
            volume = F.concat(*(zpad(group(g), w) for g, w in parts))
        else:
            volume = F.substring(group(rule.volume_groups[0]), 1, 4)
        before, _, after = rule.record_type.partition("{0}")
        kind = F.concat(F.lit(before), series, F.lit(after)) if "{0}" in rule.record_type else F.lit(before)
        return F.struct(
            series.alias("series"),
            F.concat(*(group(g) for g in rule.volume_groups)).alias("volume_no"),
            volume.alias("volume"),
            F.regexp_extract(name, rule.count, 1).try_cast("bigint").alias("expected_n"),
            kind.alias("record_type"),
        )

    known = [(F.rlike(name, F.lit(rule.pattern)), read(rule)) for rule in rules]
    first, *rest = known
    return reduce(lambda case, pair: case.when(*pair), rest, F.when(*first))


def type_from_name(name: Column | str, rules: tuple[NameRule, ...] = NAME_RULES) -> Column:
    """The record type a file name implies."""
    return parse_file_name(name, rules)["record_type"]


def document_key(volume: Column | str, line: Column | str, record_type: Column | str) -> Column:
    """Volume + zero-padded line number, as text that sorts in document order.

    A line number wider than the pad is kept whole.
    """
    kind, line = _col(record_type), _col(line)
    number = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, width in KEY_WIDTHS.items():
        number = number.when(kind == name, zpad(line, width))
    return F.concat(_col(volume), number.otherwise(zpad(line, KEY_WIDTH_DEFAULT)))


def output_name(name: Column | str, sheet_no: Column | str | None = None, extension: str = ".xml") -> Column:
    """The name of the output made from a file, or from sheet ``sheet_no`` of a
    workbook."""
    name = _col(name)
    plain = F.regexp_replace(name, "\\.xls\\z", extension)
    plain = F.when(plain.endswith(extension), plain).otherwise(F.concat(plain, F.lit(extension)))
    if sheet_no is None:
        return plain
    no = _col(sheet_no)
    suffix = F.when(no == 1, F.lit("")).otherwise(F.concat(F.lit("_"), no.cast("string")))
    stem = F.replace(F.regexp_replace(name, "\\.xlsx\\z", ""), F.lit(" "), F.lit("_"))
    return F.when(name.endswith(".xlsx"), F.concat(stem, suffix, F.lit(extension))).otherwise(plain)


def volume_name(name: Column | str) -> Column:
    """The name under which a file is looked up in ``NAME_RULES``: an exported workbook
    goes by the name of its output."""
    name = _col(name)
    return F.when(name.endswith(".xls"), output_name(name)).otherwise(name)


def is_stub(name: Column | str) -> Column:
    """True for the name of a file that was never delivered."""
    return F.rlike(_col(name), F.lit(STUB_PATTERN))


def column_letter(i: Column | str) -> Column:
    """Spreadsheet letters of a column number: 1 is A, 27 is AA, 16384 is XFD."""
    i = _col(i).cast("int")

    def letter(k: Column) -> Column:
        return F.char(k + 65)

    last = letter(F.pmod(i - 1, F.lit(26)))
    second = F.floor((i - 27) / 26)
    return (
        F.when(i <= 26, last)
        .when(i <= 702, F.concat(letter(F.floor((i - 1) / 26) - 1), last))
        .otherwise(F.concat(letter(F.floor((i - 703) / 676)), letter(F.pmod(second, F.lit(26))), last))
    )
