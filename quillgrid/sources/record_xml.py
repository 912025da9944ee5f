"""Record-shaped XML: a root element that holds one element per record."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from xml.parsers import expat

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.operators.ordering import group_summary, number_rows, place_rows, split_summary, started
from quillgrid.session import pin_splits, ship_with_tasks
from quillgrid.sources.files import few_splits, list_files
from quillgrid.sources.lines import UTF8, _decoded, scan_records

ship_with_tasks(__name__)

# Fixed value: the root tag of a record document.
ROOT_TAG = "dataroot"


def _options(row_tag: str, mode: str) -> dict[str, str]:
    return {"rowTag": row_tag, "mode": mode, "ignoreSurroundingSpaces": "false", "nullValue": ""}


def _opened_pieces(spark: SparkSession, path: str | list[str], row_tag: str, charset: str) -> DataFrame:
    """``(file, block, pos, piece)``: cut before each record. What stands before the
    first record is a piece of its own. NULL where a piece is no closed record."""
    scan = scan_records(spark, path, f"<{row_tag}")
    text = _decoded(F.col("raw"), charset)
    rest = f"(?s)\\A(?:(?:\\s[^>]*)?/>|(?:\\s[^>]*)?>.*?</{re.escape(row_tag)}\\s*>)"
    found = scan.select("file", "block", "pos", F.regexp_extract(text, rest, 0).alias("rest"))
    piece = F.when(F.col("rest") != "", F.concat(F.lit(f"<{row_tag}"), "rest"))
    return found.select("file", "block", "pos", piece.alias("piece"))


def _closed_pieces(spark: SparkSession, path: str | list[str], row_tag: str, charset: str) -> DataFrame:
    """The same when elements start with the name of the record: cut behind each
    record. A piece may then hold more records, namely empty ones without a
    closing tag, so they are counted in a window per split."""
    scan = scan_records(spark, path, f"</{row_tag}>")
    tag = re.escape(row_tag)
    empty, opened = f"<{tag}(?:\\s[^>]*)?/>", f"<{tag}(?:\\s[^>]*)?>"
    text = _decoded(F.col("raw"), charset)
    pieces = F.regexp_extract_all(text, F.lit(f"(?s){empty}|{opened}.*"), F.lit(0))
    found = scan.select("file", "block", "pos", F.posexplode(pieces).alias("sub", "piece"))
    numbered = number_rows(found, "file", ["pos", "sub"], block="block")
    whole = F.when(F.rlike("piece", F.lit(f"\\A{empty}\\z")), F.col("piece")).otherwise(
        F.concat("piece", F.lit(f"</{row_tag}>"))
    )
    return numbered.select("file", "block", "rn", whole.alias("piece"))


Mark = tuple[str, Callable[[Column], Column]]
"""A column of a record, and what must hold for it."""


def _numbered(
    spark: SparkSession, path: str | list[str], row_tag: str, columns: Sequence[str], split: bool, charset: str, mode: str,
    mark: Mark | None,
) -> tuple[DataFrame, DataFrame]:
    """Records ``(file, block, rn, started, <columns>)``, and what one pass told about
    their files: ``(file, total, marked, start)``."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    options = _options(row_tag, mode)
    fields = [F.col("r")[c].alias(c) for c in columns]
    column, holds = mark or (columns[0], lambda c: F.lit(False))
    if split and not any(c.startswith(row_tag) for c in columns):
        pieces = _opened_pieces(spark, path, row_tag, charset)
        told = holds(F.from_xml("piece", f"`{column}` string", options)[column]) if mark else None
        # One small row per split. It serves the numbers, the starts and the verdicts, so it is
        # kept once it has been made; a lost executor's part is made again. The mark keeps later
        # calls, before which the files may have changed, from finding it.
        summary = split_summary(pieces, "file", "block", "pos", told).withColumn("_call", F.lit(uuid.uuid4().hex)).cache()
        placed = place_rows(pieces, summary, "file", "block", "pos", few_splits(spark, path)).where("rn > 1")
        message = f"a <{row_tag}> is not closed, or a tag starts with its name: read with split=False"
        piece = F.when(F.col("piece").isNull(), F.raise_error(F.lit(message))).otherwise(F.col("piece"))
        begun = F.coalesce(F.col("rn") >= F.col("start"), F.lit(False))
        # What stands before the first record is the first piece, so piece n + 1 is record n.
        parsed = placed.select(
            "file", "block", (F.col("rn") - 1).alias("rn"), begun.alias("started"), F.from_xml(piece, schema, options).alias("r")
        )
        files = summary.select("file", (F.col("total") - 1).alias("total"), "marked", (F.col("start") - 1).alias("start")).distinct()
        return parsed.select("file", "block", "rn", "started", *fields), files
    if split:
        pieces = _closed_pieces(spark, path, row_tag, charset)
        rows = pieces.select("file", "block", "rn", F.from_xml("piece", schema, options).alias("r")).select("file", "block", "rn", *fields)
    else:
        pin_splits(spark)
        reader = spark.read.options(**options).option("charset", charset)
        rows = reader.option("recursiveFileLookup", "true").schema(schema).xml(path)
        rows = rows.select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"), *columns,
        )
        rows = number_rows(rows, "file", "pos", block="block").select("file", "block", "rn", *columns)
    files = group_summary(rows, holds(F.col(column)), "file", "rn", block="block")
    if mark is None:
        return rows.withColumn("started", F.lit(False)).select("file", "block", "rn", "started", *columns), files
    begun = started(rows, holds(F.col(column)), "file", "rn", block="block", few_blocks=few_splits(spark, path))
    return begun.select("file", "block", "rn", "started", *columns), files


def read_records(
    spark: SparkSession,
    path: str | list[str],
    row_tag: str,
    columns: Sequence[str],
    split: bool = True,
    charset: str = UTF8,
    mode: str = "FAILFAST",
) -> DataFrame:
    """``(file, block, rn, <columns>)``: the records with tag ``row_tag``.

    Empty elements are NULL and values keep their blanks. Attributes are read as
    columns that start with ``_``.

    Spark's XML source gives a whole file to one task. ``split=True`` therefore
    cuts the text at the opening tag of the records, in a scan that can be split
    anywhere, and parses each piece. Rows stay in the order of the scan and are
    not shuffled. It needs records that are neither nested nor commented out;
    a record that is not closed stops the job. ``split=False`` leaves all that
    to the XML source and fits many files of moderate size.
    """
    return _numbered(spark, path, row_tag, columns, split, charset, mode, None)[0].drop("started")


def read_counted_records(
    spark: SparkSession, path: str | list[str], row_tag: str, columns: Sequence[str], mark: Mark | None = None,
    split: bool = True, charset: str = UTF8, mode: str = "FAILFAST",
) -> tuple[DataFrame, DataFrame]:
    """``read_records`` with a flag ``started``, true from the first record on whose
    column fulfils ``mark``, and ``(file, total, marked, start)`` of every file that
    holds any text: its records, those that fulfil ``mark``, and the number of the first.

    Both come from the same pass over the text, so that together they read it twice.
    """
    return _numbered(spark, path, row_tag, columns, split, charset, mode, mark)


# ---- roots ------------------------------------------------------------------

HEAD_BYTES = 65_536
"""Bytes that are read of a file to find its root, and again as often as needed."""
# Schemes of file stores that tasks can open by themselves.
OPENED = ("file", "hdfs", "s3", "gs", "abfs")


def first_element(read: Callable[[int], bytes]) -> tuple[str, dict[str, str]] | None:
    """Name and attributes of the first element of a document, with all references
    decoded, reading no further than its opening tag."""
    found: list[tuple[str, dict[str, str]]] = []
    parser = expat.ParserCreate()
    parser.StartElementHandler = lambda name, attributes: found or found.append((name, attributes))
    while not found and (head := read(HEAD_BYTES)):
        try:
            parser.Parse(head, False)
        except expat.ExpatError:
            break  # what follows the opening tag is not looked at
    return found[0] if found else None


def read_roots(spark: SparkSession, path: str | list[str], root_tag: str = ROOT_TAG) -> DataFrame:
    """``(file, attributes)``: the attributes of the root element of each file that has
    this root, as a map.

    Tasks open the files of a listing and read their heads only, however long the
    files are. Files of stores that tasks cannot open are scanned for their roots.
    """
    files = list_files(spark, path).select("file")
    schemes = {name.partition(":")[0] for name in files.inputFiles()}
    if not schemes <= set(OPENED):
        return _scanned_roots(spark, path, ">", root_tag)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, maps = [], []
            for uri in batch.column(0).to_pylist():
                store, place = fs.FileSystem.from_uri(uri)
                with store.open_input_stream(place, compression=None, buffer_size=0) as stream:
                    found = first_element(stream.read)
                if found and found[0] == root_tag:
                    kept.append(uri)
                    maps.append(list(found[1].items()))
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array(maps, pa.map_(pa.string(), pa.string()))], ["file", "attributes"])

    # A listing is one small row per file; reading heads is what takes time.
    spread = files.repartition(spark.sparkContext.defaultParallelism, "file")
    return spread.mapInArrow(run, "file string, attributes map<string,string>")


def _scanned_roots(spark: SparkSession, path: str | list[str], separator: str, root_tag: str) -> DataFrame:
    text = F.decode("raw", "ISO-8859-1")
    opening = F.regexp_extract(text, f"<{root_tag}(\\s[^>]*|\\z|(?=>))", 0).alias("opening")
    # The root opens in the first split of its file, in any charset with plain ASCII tags.
    roots = scan_records(spark, path, separator).where(F.col("block") == 0).select("file", "raw", opening)
    utf8 = F.make_valid_utf8(F.encode("opening", "ISO-8859-1").cast("string"))
    pairs = F.regexp_extract_all(utf8, F.lit("\\s([A-Za-z_:][^\\s=]*)\\s*=\\s*(\"[^\"]*\"|'[^']*')"), F.lit(0))

    def entry(pair: Column) -> Column:
        name, value = F.trim(F.substring_index(pair, "=", 1)), F.regexp_extract(pair, "(?s)=\\s*(.*)\\z", 1)
        return F.struct(F.btrim(name, F.lit(" \t\n\r")).alias("key"), _decode_references(F.substring(value, F.lit(2), F.length(value) - 2)).alias("value"))

    return roots.where(F.col("opening") != "").select("file", F.map_from_entries(F.transform(pairs, entry)).alias("attributes"))


def _decode_references(c: Column) -> Column:
    """The predefined references of XML, and those of the blanks that a value cannot hold as such."""
    for old, new in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#9;", "\t"), ("&#10;", "\n"), ("&#13;", "\r"), ("&amp;", "&")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def read_root_attributes(
    spark: SparkSession, path: str | list[str], row_tag: str | None = None, root_tag: str = ROOT_TAG
) -> DataFrame:
    """``(file, source, declared_n)`` from the root element of each file.

    Heads alone are read where tasks can open the files. With ``row_tag`` the files
    are scanned in any case, one piece per record.
    """
    roots = read_roots(spark, path, root_tag) if row_tag is None else _scanned_roots(spark, path, f"<{row_tag}", root_tag)
    told = F.col("attributes")
    return roots.select(
        "file", F.nullif(told["source"], F.lit("")).alias("source"), told["n"].try_cast("bigint").alias("declared_n")
    )
