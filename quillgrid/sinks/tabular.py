"""Tab-separated text and the cell audit."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.clean import clean_cell, normalise_header
from quillgrid.functions.provenance import file_name, folder, output_name
from quillgrid.sinks.order import in_document_order
from quillgrid.sources.workbook import cells_of


def clean_cells(cells: DataFrame) -> DataFrame:
    """Add ``cleaned``; the cells of the header row are made names first."""
    name = clean_cell(normalise_header("value"))
    return cells.withColumn("cleaned", F.when(F.col("n") == 1, name).otherwise(clean_cell("value")))


def cleaned_values(rows: DataFrame) -> Column:
    """The values of row-shaped workbooks, cleaned as ``clean_cells`` does."""
    return F.when(F.col("n") == 1, F.transform("values", lambda v: clean_cell(normalise_header(v)))).otherwise(
        F.transform("values", clean_cell)
    )


def tsv_lines(cells: DataFrame) -> DataFrame:
    """``(file, sheet_no, n, line)``: a line per row, the header included, with
    empty and ``0`` cells kept. A sheet that starts right of the first column
    keeps a leading tab.

    Rows of ``read_workbook_rows`` stay where they are; cells are gathered first."""
    if "values" in cells.columns:
        shown = F.array_compact(cleaned_values(cells))
        rows = cells.select("file", "sheet_no", "n", "first_col", shown.alias("c"))
        indent = F.when(F.col("first_col") > 0, F.lit("\t")).otherwise(F.lit(""))
        return rows.select("file", "sheet_no", "n", F.concat(indent, F.array_join("c", "\t")).alias("line"))
    cell = F.struct("col", "cleaned")
    rows = clean_cells(cells).groupBy("file", "sheet_no", "n").agg(F.sort_array(F.collect_list(cell)).alias("c"))
    text = F.array_join(F.transform("c", lambda x: F.coalesce(x["cleaned"], F.lit(""))), "\t")
    indent = F.when(F.col("c")[0]["col"] > 0, F.lit("\t")).otherwise(F.lit(""))
    return rows.select("file", "sheet_no", "n", F.concat(indent, text).alias("line"))


def write_tsv_cells(cells: DataFrame, path: str, mode: str = "error") -> None:
    """One folder per sheet, named like its source's folder and the sheet's
    output; lines keep their order."""
    output = output_name(file_name("file"), F.col("sheet_no"), ".tab")
    lines = tsv_lines(cells).withColumns({"folder": folder("file"), "output": output})
    ordered = in_document_order(lines, ["file", "sheet_no", "n"], ["folder", "output"])
    ordered = ordered.select("folder", "output", F.col("line").alias("value"))
    ordered.write.mode(mode).partitionBy("folder", "output").text(path)


def write_tsv(
    df: DataFrame, path: str, header: bool = True, order: Sequence[str] = ("file", "rn"),
    drop: Sequence[str] = ("file", "block", "rn"), mode: str = "error",
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Wide records as tab-separated text: nothing is quoted, ``0`` and empties
    stay as they are. ``watch`` may observe the ordered rows."""
    rows = watch(in_document_order(df, order)).drop(*drop)
    # Every escape mechanism of the format is switched off.
    writer = rows.write.mode(mode).options(sep="\t", quote="", escapeQuotes="false", emptyValue="", nullValue="")
    writer.options(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path, header=header)


def audit_cells(cells: DataFrame) -> DataFrame:
    """What each cell held and what became of it."""
    return clean_cells(cells_of(cells) if "values" in cells.columns else cells).select(
        "file", "sheet_no", "sheet_name", "row", "col", F.col("value").alias("raw"), "cleaned"
    )


def write_audit(cells: DataFrame, path: str, mode: str = "error") -> None:
    audit_cells(cells).write.mode(mode).parquet(path)
