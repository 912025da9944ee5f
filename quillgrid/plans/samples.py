"""Workbooks made from a table, so that the workbook scan can run over the
given tables. Only as much of the format as the scan reads."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Sequence
from xml.sax.saxutils import escape

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.session import ship_with_tasks
from quillgrid.sources.workbook import MAIN, RELATION_ID

ship_with_tasks(__name__)


def workbook_bytes(sheets: Sequence[tuple[str, Sequence[Sequence[object]]]]) -> bytes:
    """A workbook of ``(sheet name, rows)``. Text is stored as shared strings,
    numbers as numbers, and ``None`` is no cell."""
    main, relations = MAIN.strip("{}"), RELATION_ID[1:].split("}")[0]
    numbers: dict[str, int] = {}

    def cell(value: object) -> str:
        if value is None:
            return "<c/>"
        if isinstance(value, str):
            return f'<c t="s"><v>{numbers.setdefault(value, len(numbers))}</v></c>'
        return f"<c><v>{value}</v></c>"

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        tags, links = [], []
        for k, (name, rows) in enumerate(sheets, 1):
            tags.append(f'<sheet name="{escape(name)}" sheetId="{k}" r:id="rId{k}"/>')
            links.append(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>')
            body = "".join(f"<row>{''.join(map(cell, row))}</row>" for row in rows)
            book.writestr(
                f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>'
            )
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{relations}"><sheets>{"".join(tags)}</sheets></workbook>',
        )
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{''.join(links)}</Relationships>")
        texts = (escape(text, {"\r": "_x000D_"}) for text in numbers)
        items = "".join(f'<si><t xml:space="preserve">{text}</t></si>' for text in texts)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{items}</sst>')
    return out.getvalue()


def pack_workbooks(df: DataFrame, key: str, headers: Sequence[str], rows_per_book: int = 500) -> DataFrame:
    """``(file, content)``: workbooks of at most ``rows_per_book`` values of the
    unique integer column ``key``, in its order, below one header row."""
    columns = df.columns

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values(key)[columns].astype(object)
        rows = ordered.where(ordered.notna(), None).values.tolist()
        content = workbook_bytes([("data", [list(headers), *rows])])
        return pd.DataFrame({"file": [f"book_{pdf['_book'].iloc[0]}.xlsx"], "content": [content]})

    book = F.floor(F.col(key) / rows_per_book).alias("_book")
    return df.select("*", book).groupBy("_book").applyInPandas(pack, "file string, content binary")


def write_books(books: DataFrame, path: str) -> None:
    """Write ``(file, content)`` as files below ``path``, each by the task that has it."""

    def write(batches):
        for batch in batches:
            for file, content in zip(batch["file"], batch["content"]):
                store, place = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
                store.create_dir(place, recursive=True)
                with store.open_output_stream(f"{place}/{file}") as out:
                    out.write(content)
            yield batch[["file"]]

    books.mapInPandas(write, "file string").count()
