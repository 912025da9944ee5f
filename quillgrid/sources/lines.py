"""Scans of delimited text, with file, split and line number for every line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.functions.clean import repair_quote, strip_eol, trim_ws
from quillgrid.operators.ordering import number_splits
from quillgrid.session import pin_splits
from quillgrid.sources.files import few_splits

UTF8 = "UTF-8"
# The characters that windows-1252 has where ISO-8859-1 has
# controls, in code order from 0x80 to 0x9F; a blank marks an unused code.
WINDOWS_1252 = "€ ‚ƒ„…†‡ˆ‰Š‹Œ Ž  ‘’“”•–—˜™š›œ žŸ"


def _decoded(raw: Column, charset: str) -> Column:
    """Text of raw bytes. UTF-8 that is not valid gets U+FFFD, never an error."""
    name = charset.upper()
    if name == UTF8:
        return F.make_valid_utf8(raw.cast("string"))
    if name in ("WINDOWS-1252", "CP1252"):
        used = [(chr(0x80 + i), c) for i, c in enumerate(WINDOWS_1252) if c != " "]
        latin = F.decode(raw, "ISO-8859-1")
        return F.translate(latin, "".join(a for a, _ in used), "".join(b for _, b in used))
    return F.decode(raw, charset)


def scan_records(spark: SparkSession, path: str | list[str], separator: str = "\n") -> DataFrame:
    """``(file, block, pos, raw)``: the pieces of text files between separators.

    ``raw`` holds bytes, so any charset can be decoded afterwards while the scan
    stays splittable and keeps blank lines. ``block`` is the start of the split,
    ``pos`` rises by one inside it.
    """
    pin_splits(spark)
    lines = spark.read.option("lineSep", separator).option("recursiveFileLookup", "true").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").cast("binary").alias("raw"),
    )


def number_pieces(spark: SparkSession, path: str | list[str], separator: str = "\n") -> DataFrame:
    """``scan_records`` with ``rn``, from 1 per file. Rows stay as scanned."""
    scan = scan_records(spark, path, separator)
    return number_splits(scan, "file", "block", "pos", few_splits(spark, path)).drop("pos")


def read_lines(spark: SparkSession, path: str | list[str], charset: str = UTF8) -> DataFrame:
    """``(file, block, rn, line)``: every line with its number, from 1 per file."""
    return number_pieces(spark, path).select("file", "block", "rn", _decoded(F.col("raw"), charset).alias("line"))


def repair_bytes(raw: Column, charset: str, correct: bool = False) -> Column:
    """Apply ``repair_quote`` to raw bytes, before they are decoded.

    In UTF-8 a byte 0x92 may be the tail of a longer character; only a stray
    one, which follows an ASCII byte, is touched.
    """
    latin = F.decode(raw, "ISO-8859-1")
    stray = "(?<![\u0080-\u00ff])\u0092"
    if charset.upper() != UTF8:
        fixed = repair_quote(latin, correct)
    elif correct:
        fixed = F.regexp_replace(latin, stray, "'")
    else:
        fixed = F.regexp_replace(latin, f"(?s)\\A(.*?){stray}s", "$1'")
    # Rows without the byte are not decoded at all.
    return F.when(F.contains(raw, F.lit(bytearray([0x92]))), F.encode(fixed, "ISO-8859-1")).otherwise(raw)


def read_fields(
    spark: SparkSession,
    path: str | list[str],
    n_fields: int,
    charset: str = UTF8,
    sep: str = "\t",
    header: bool = True,
    repair: bool = True,
    correct: bool = False,
) -> DataFrame:
    """``(file, block, rn, fields)``: one record per line, as an array of the
    untrimmed fields. The last one keeps whatever was not split off; a blank
    line is a record without values. ``rn`` counts the header line."""
    lines = number_pieces(spark, path)
    if header:
        lines = lines.where(F.col("rn") > 1)
    raw = repair_bytes(F.col("raw"), charset, correct) if repair else F.col("raw")
    fields = F.split(strip_eol(_decoded(raw, charset)), sep, n_fields)
    return lines.select("file", "block", "rn", fields.alias("fields"))


def field_columns(names: Sequence[str], n_fields: int | None = None) -> dict[str, Column]:
    """The trimmed fields of ``read_fields`` by name, NULL where a row is short."""
    named = names if n_fields is None else names[:n_fields]
    return {name: trim_ws(F.get("fields", F.lit(i))) for i, name in enumerate(named)}


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    names: Sequence[str],
    n_fields: int | None = None,
    charset: str = UTF8,
    sep: str = "\t",
    header: bool = True,
    repair: bool = True,
    correct: bool = False,
) -> DataFrame:
    """``(file, block, rn, <names>)``: one trimmed record per line."""
    n = len(names) if n_fields is None else n_fields
    rows = read_fields(spark, path, n, charset, sep, header, repair, correct)
    return rows.select("file", "block", "rn", *(c.alias(name) for name, c in field_columns(names, n).items()))


def dictionary_entries(lines: DataFrame, at: Sequence[str] = ("file", "rn")) -> DataFrame:
    """``(key, description)``: the last description of each key among ``line``s, in the
    order of ``at``. Comment lines are skipped and later tabs belong to the description."""
    from quillgrid.operators.records import skip_comments
    from quillgrid.operators.reshape import last_wins

    parts = F.split(strip_eol(F.col("line")), "\t", 2)
    pairs = skip_comments(lines, "line").select(
        F.struct(*at).alias("at"), F.get(parts, F.lit(0)).alias("key"), F.get(parts, F.lit(1)).alias("description")
    )
    return last_wins(pairs, "key", "description", "at")


def read_dictionary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``dictionary_entries`` of text files."""
    return dictionary_entries(read_lines(spark, path))
