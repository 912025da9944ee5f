"""Workbooks (.xlsx) as a table of rows, or of cells.

A workbook is a zip of XML parts. Small ones are read many to a task; of a large one
each sheet is a task of its own, which the directory of the zip tells. Inside the
task sheets are streamed and parsed once: only the shared strings, the header row and
one batch of rows are held. A row comes as an array of its values, so that what needs
whole rows need not gather cells again.
"""

from __future__ import annotations

import io
import json
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quillgrid.session import ship_with_tasks

ship_with_tasks(__name__)

# Name spaces of the workbook format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

# Fixed value: how the format writes characters that XML cannot hold or would
# normalise, such as the carriage return.
ESCAPED = re.compile("_x([0-9A-Fa-f]{4})_")

ROW_SCHEMA = (
    "file string, sheet_no int, sheet_name string, row int, n int, last boolean, first_col int,"
    " header array<string>, values array<string>, error string"
)
_ARROW = pa.schema([
    ("file", pa.string()), ("sheet_no", pa.int32()), ("sheet_name", pa.string()), ("row", pa.int32()), ("n", pa.int32()),
    ("last", pa.bool_()), ("first_col", pa.int32()), ("header", pa.list_(pa.string())), ("values", pa.list_(pa.string())),
    ("error", pa.string()),
])
BATCH_CELLS = 50_000
HELD_CELLS = 200_000
"""Cells of a sheet that are held until its range is known; a larger sheet is parsed once more."""
SPLIT_BYTES = 32 * 1024 * 1024
"""Bytes of workbooks that one task reads; larger workbooks are read sheet by sheet."""
BROKEN = (zipfile.BadZipFile, ElementTree.ParseError, KeyError, ValueError, IndexError, StopIteration)
# Schemes of file stores that tasks can open by themselves.
OPENED = ("file", "hdfs", "s3", "gs", "abfs")


def _space(tag: str) -> str:
    """The name space of a tag, with its braces. The strict form of the format has other
    ones, so each part tells its own."""
    return tag[: tag.rfind("}") + 1]


def _text(element, space: str) -> str:
    """All text of a string item; phonetic hints are not part of it."""
    if element is None:
        return ""
    t = space + "t"
    runs = [element] if element.find(t) is not None else element.findall(space + "r")
    text = "".join(x.text or "" for run in runs for x in run.findall(t))
    return ESCAPED.sub(lambda found: chr(int(found[1], 16)), text) if "_x" in text else text


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    strings: list[str] = []
    with book.open("xl/sharedStrings.xml") as part:
        space = item = None
        for event, element in ElementTree.iterparse(part, events=("start", "end")):
            if space is None:
                root, space = element, _space(element.tag)
                item = space + "si"
            elif event == "end" and element.tag == item:
                strings.append(_text(element, space))
                root.clear()
    return strings


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = {link.get("Id"): link.get("Target") for link in links}
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    sheets = list(root.iter(_space(root.tag) + "sheet"))
    if not sheets:
        raise ValueError("the workbook lists no sheet")
    relation = [next(v for k, v in s.items() if k.startswith("{") and k.endswith("}id")) for s in sheets]
    return [(s.get("name"), posixpath.join("/xl", target[r]).lstrip("/")) for s, r in zip(sheets, relation)]


def _column(reference: str) -> int:
    column = 0
    for char in reference:
        if char.isdigit():
            return column - 1
        column = column * 26 + ord(char.upper()) - 64
    raise ValueError(f"not a cell reference: {reference}")


def _rows(book: zipfile.ZipFile, part_name: str, strings: list[str]) -> Iterator[tuple[int, dict[int, str]]]:
    """``(row, {col: value})`` of the rows that hold cells, positions from 0. Events of
    rows alone are looked at; their cells are read from the tree of the row."""
    row, space, parent = -1, None, None
    columns: dict[str, int] = {}
    with book.open(part_name) as part:
        for event, element in ElementTree.iterparse(part, events=("start", "end")):
            if space is None:
                space = _space(element.tag)
                data, line, value, inline = (space + t for t in ("sheetData", "row", "v", "is"))
            tag = element.tag
            if event == "start":
                if tag == data:
                    parent = element
            elif tag == line:
                row = int(element.get("r", row + 2)) - 1
                col, cells = -1, {}
                for cell in element:
                    at = cell.get("r")
                    if at:
                        letters = at.rstrip("0123456789")
                        col = columns.get(letters, -1) if at != letters else -1
                        if col < 0:
                            col = columns[letters] = _column(at)
                    else:
                        col += 1
                    kind = cell.get("t", "n")
                    if kind == "inlineStr":
                        cells[col] = _text(cell.find(inline), space)
                    else:
                        stored = cell.findtext(value) or ""
                        cells[col] = strings[int(stored)] if kind == "s" and stored else stored
                if cells:
                    yield row, cells
                parent.remove(element)


def _sheet_rows(book: zipfile.ZipFile, file: str, number: int, strings: list[str], dense: bool) -> Iterator[tuple]:
    """The rows of one sheet as ``ROW_SCHEMA`` has them."""
    name, part = _sheets(book)[number - 1]
    held: list[tuple[int, dict[int, str]]] = []
    size = count = 0
    low, high = 1 << 30, -1
    for row, cells in _rows(book, part, strings):
        low, high, count = min(low, min(cells)), max(high, max(cells)), count + 1
        size += len(cells)
        if size <= HELD_CELLS:
            held.append((row, cells))
    if not count:
        return
    rows = iter(held) if size <= HELD_CELLS else _rows(book, part, strings)
    del held
    first_row = expected = None
    head: dict[int, str] = {}
    seen = 0
    for row, cells in rows:
        seen += 1
        if first_row is None:
            first_row = expected = row
            head = cells
        if dense:
            # A sheet whose range starts left of its header's cells has blank names there.
            header = [head.get(c, "") for c in range(low, high + 1)]
            for gap in range(expected, row):
                yield file, number, name, gap, gap - first_row + 1, False, low, header, [""] * len(header), None
            values = [cells.get(c, "") for c in range(low, high + 1)]
            yield file, number, name, row, row - first_row + 1, seen == count, low, header, values, None
        else:
            left, right = min(cells), max(cells)
            header = [head.get(c, "") for c in range(left, right + 1)]
            yield file, number, name, row, row - first_row + 1, seen == count, left, header, [cells.get(c) for c in range(left, right + 1)], None
        expected = row + 1


def _book_rows(file: str, content, dense: bool, keep_bad: bool, sheet: int | None = None) -> Iterator[tuple]:
    """The rows of a workbook, or of one sheet of it. With ``keep_bad`` its parts are
    parsed beforehand, so that one that breaks off gives its error alone."""
    try:
        with zipfile.ZipFile(content) as book:
            numbers = range(1, len(_sheets(book)) + 1) if sheet is None else [sheet]
            strings = _shared_strings(book)
            if keep_bad:
                for number in numbers:
                    for _ in _rows(book, _sheets(book)[number - 1][1], strings):
                        pass
            for number in numbers:
                yield from _sheet_rows(book, file, number, strings, dense)
    except BROKEN as error:
        if not keep_bad:
            raise ValueError(f"cannot read workbook {file}: {error}") from error
        yield (file, *[None] * (len(_ARROW) - 2), str(error))


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    cells = 0
    for row in rows:
        held.append(row)
        cells += len(row[8] or ())
        if cells >= BATCH_CELLS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _ARROW.types)], schema=_ARROW)
            held, cells = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _ARROW.types)], schema=_ARROW)


# ---- files --------------------------------------------------------------------

class Piece(InputPartition):
    """What one task reads: workbooks, or one sheet of a large one."""

    def __init__(self, files: list[str], sheet: int | None = None) -> None:
        self.files, self.sheet = files, sheet


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.uris = json.loads(options["uris"])
        self.dense, self.keep_bad = options["dense"] == "true", options["keepbad"] == "true"
        self.split_bytes = int(options["splitbytes"])

    def partitions(self) -> list[Piece]:
        """Workbooks are put together up to ``split_bytes``. Of larger ones the directory of
        the zip is read, no more, for their sheets. The listing is the driver's, as that
        of any file source is."""
        out, bundle, size = [], [], 0
        for uri, length in self.uris:
            if length > self.split_bytes:
                out += [Piece([uri], sheet) for sheet in self._sheet_numbers(uri)]
                continue
            if bundle and size + length > self.split_bytes:
                out.append(Piece(bundle))
                bundle, size = [], 0
            bundle, size = [*bundle, uri], size + length
        return [*out, Piece(bundle)] if bundle else out or [Piece([])]

    def _sheet_numbers(self, uri: str) -> list[int | None]:
        try:
            store, place = fs.FileSystem.from_uri(uri)
            with store.open_input_file(place) as file, zipfile.ZipFile(file) as book:
                return list(range(1, len(_sheets(book)) + 1))
        except BROKEN:
            return [None]  # the task that reads it tells what is wrong

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for uri in partition.files:
                store, place = fs.FileSystem.from_uri(uri)
                with store.open_input_file(place) as file:
                    yield from _book_rows(uri, file, self.dense, self.keep_bad, partition.sheet)

        yield from _batches(rows())


class WorkbookSource(DataSource):
    """Format ``workbook_rows``: the workbooks that option ``uris`` lists."""

    @classmethod
    def name(cls) -> str:
        return "workbook_rows"

    def schema(self) -> str:
        return ROW_SCHEMA

    def reader(self, schema) -> WorkbookReader:
        return WorkbookReader(self.options)


def rows_from_content(books: DataFrame, dense: bool = True, keep_bad: bool = False) -> DataFrame:
    """Rows of the workbooks in ``(file, content)``, as ``read_workbook_rows`` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                    yield from _book_rows(file, io.BytesIO(content.as_py()), dense, keep_bad)

        yield from _batches(rows())

    found = books.select("file", "content").mapInArrow(run, ROW_SCHEMA)
    return found if keep_bad else found.drop("error")


def read_workbook_rows(
    spark: SparkSession, path: str | list[str], dense: bool = True, keep_bad: bool = False, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """The rows of every sheet of every workbook under ``path``.

    ``row`` is the position from 0, ``n`` counts the rows of the used range from 1,
    and ``last`` marks its last row. ``values`` are the cells from column ``first_col``
    (from 0) on, ``header`` those of row 1 in the same columns. With ``dense`` each row
    reaches over the used range and absent cells are ``''``; otherwise from its first
    to its last cell, and they are NULL. Values are the stored text; nothing is parsed
    as a number or a date.

    A workbook that cannot be read stops the job, or with ``keep_bad`` gives one row
    that holds the ``error``, and no other. Files of stores that tasks cannot open are
    read whole by Spark, one workbook a task.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    uri = F.col("_metadata.file_path").alias("file")
    if not {name.partition(":")[0] for name in files.inputFiles()} <= set(OPENED):
        return rows_from_content(files.select(uri, "content"), dense, keep_bad)
    listed = sorted((r.file, r.length) for r in files.select(uri, "length").collect())
    spark.dataSource.register(WorkbookSource)
    options = {"uris": json.dumps(listed), "dense": dense, "keepBad": keep_bad, "splitBytes": split_bytes}
    found = spark.read.format("workbook_rows").options(**options).load()
    return found if keep_bad else found.drop("error")


# ---- cells -----------------------------------------------------------------------

def cells_of(rows: DataFrame) -> DataFrame:
    """``(file, sheet_no, sheet_name, row, col, n, header, value)``: one row per cell."""
    error = ["error"] if "error" in rows.columns else []
    pair = F.posexplode_outer(F.arrays_zip("header", "values")).alias("_at", "_cell")
    cells = rows.select("file", "sheet_no", "sheet_name", "row", "n", "first_col", *error, pair)
    present = F.col("_cell.values").isNotNull()
    return cells.where(present | F.col("error").isNotNull() if error else present).select(
        "file", "sheet_no", "sheet_name", "row", (F.col("first_col") + F.col("_at")).alias("col"), "n",
        F.col("_cell.header").alias("header"), F.col("_cell.values").alias("value"), *error,
    )


def cells_from_content(books: DataFrame, dense: bool = True, keep_bad: bool = False) -> DataFrame:
    """Cells of the workbooks in ``(file, content)``.

    ``row`` and ``col`` are positions from 0, ``n`` counts the rows of the used
    range from 1 and ``header`` is the cell of row 1 in the same column. With
    ``dense`` a cell that is absent from the used range has the value ``''``.
    """
    return cells_of(rows_from_content(books, dense, keep_bad))


def read_workbook_cells(
    spark: SparkSession, path: str | list[str], dense: bool = True, keep_bad: bool = False
) -> DataFrame:
    """The cells of every sheet of every workbook under ``path``."""
    return cells_of(read_workbook_rows(spark, path, dense, keep_bad))
