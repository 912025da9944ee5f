"""Record XML, registry and dictionary documents."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quillgrid.functions.clean import drop_falsy, element_name, escape_xml, strip_control, unescape_xml
from quillgrid.functions.provenance import file_name, folder, output_name
from quillgrid.operators.guards import stop_if
from quillgrid.operators.reshape import DROPPED, drop_elements
from quillgrid.sinks.order import in_document_order
from quillgrid.sinks.tabular import clean_cells, cleaned_values
from quillgrid.sources.record_xml import ROOT_TAG
from quillgrid.sources import registry as registry_format

DECLARATION = 'version="1.0" encoding="UTF-8"'


def _root(tag: str, attributes: Mapping[str, object]) -> str:
    """The root tag with attributes. The sink cannot take blanks, quotes or
    ``=`` in their values, so these are percent-encoded."""
    return " ".join([tag, *(f'{k}="{quote(str(v), safe="/:.,+-_()@")}"' for k, v in attributes.items())])


def _printable(df: DataFrame) -> DataFrame:
    """Text without the characters XML forbids, on which the sink would fail."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: strip_control(f"`{c}`") for c in text}) if text else df


def write_records(
    df: DataFrame,
    path: str,
    row_tag: str,
    root: Mapping[str, object] | None = None,
    order: Sequence[str] = ("file", "rn"),
    drop: Sequence[str] = ("file", "block", "rn"),
    partition_by: Sequence[str] = (),
    mode: str = "error",
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Write records as XML, one root per part file. NULLs are left out, columns
    that start with ``_`` become attributes, and rows keep document order. ``watch``
    may observe the ordered rows."""
    rows = watch(in_document_order(_printable(df), order, partition_by)).drop(*(c for c in drop if c not in partition_by))
    writer = rows.write.mode(mode).option("rootTag", _root(ROOT_TAG, root or {})).option("rowTag", row_tag)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("declaration", DECLARATION).xml(path)


def _value(c: Column) -> Column:
    """An attribute's value as it is read back: blanks other than the space would be
    read as spaces, so they are written as references."""
    out = F.replace(escape_xml(strip_control(c)), F.lit('"'), F.lit("&quot;"))
    for blank in "\t\n\r":
        out = F.replace(out, F.lit(blank), F.lit(f"&#{ord(blank)};"))
    return out


def _attributes(names: Sequence[str], prefix: str = "") -> Column:
    """The attributes of a tag from columns, NULLs left out."""
    parts = [
        F.when(F.col(f"`{c}`").isNotNull(), F.concat(F.lit(f' {c.removeprefix(prefix)}="'), _value(F.col(f"`{c}`").cast("string")), F.lit('"')))
        for c in names
    ]
    return F.concat_ws("", *parts) if parts else F.lit("")


def record_documents(
    records: DataFrame, row_tag: str, roots: DataFrame, order: str = "rn", drop: Sequence[str] = ("file", "block", "rn"),
) -> DataFrame:
    """``(file, part, at, value)``: the lines of one document per source file. ``part``
    is 0 for its opening, 1 for its records, by ``order``, and 2 for its end.

    ``roots`` has one row per file; its other columns are the attributes of the root.
    Values of any text are read back unchanged. In a record NULLs are left out and
    columns that start with ``_`` are attributes. A file without records has an empty
    document; a record whose file has no root stops the job.

    Opening and end are rows of their own, so that a document may lie on any number
    of tasks and no row need know whether it is the last of its file.
    """
    given = [c for c in records.columns if c not in drop]
    elements = [c for c in given if not c.startswith("_")]
    texts = [
        F.when(F.col(f"`{c}`").isNotNull(), F.concat(F.lit(f"<{c}>"), escape_xml(strip_control(F.col(f"`{c}`").cast("string"))), F.lit(f"</{c}>")))
        for c in elements
    ]
    inner = F.array_compact(F.array(*texts)) if texts else F.array().cast("array<string>")
    start = F.concat(F.lit(f"<{row_tag}"), _attributes([c for c in given if c.startswith("_")], "_"))
    record = F.when(F.size(inner) == 0, F.concat(start, F.lit("/>"))).otherwise(
        F.concat(start, F.lit(">\n"), F.array_join(inner, "\n"), F.lit(f"\n</{row_tag}>"))
    )
    names = [c for c in roots.columns if c != "file"]
    opening = F.concat(F.lit(f"<?xml {DECLARATION}?>\n<{ROOT_TAG}"), _attributes(names), F.lit(">"))
    at = F.lit(None).cast("bigint").alias("at")
    lines = records.select("file", F.lit(1).alias("part"), F.col(order).cast("bigint").alias("at"), record.alias("value"))
    ends = roots.select("file", F.lit(0).alias("part"), at, opening.alias("value")).unionByName(
        roots.select("file", F.lit(2).alias("part"), at, F.lit(f"</{ROOT_TAG}>").alias("value"))
    )
    homeless = records.select("file").distinct().join(roots.select("file"), "file", "left_anti")
    return stop_if(lines.unionByName(ends), homeless, F.concat(F.lit("no root for the records of "), F.col("file")))


def write_documents(
    records: DataFrame, path: str, row_tag: str, roots: DataFrame, order: str = "rn",
    drop: Sequence[str] = ("file", "block", "rn"), mode: str = "error",
) -> None:
    """Write ``record_documents``: one folder per document, named like the source's
    folder and its output. Its part files follow each other in document order and are
    well formed together; a document that one task has written is one file."""
    where = {"folder": F.coalesce(folder("file"), F.lit("")), "output": output_name(file_name("file"))}
    lines = record_documents(records, row_tag, roots, order, drop).withColumns(where)
    ordered = in_document_order(lines, ["file", "part", "at"], list(where))
    ordered.select(*where, "value").write.mode(mode).partitionBy(*where).text(path)


def write_stubs(stubs: DataFrame, path: str, mode: str = "error") -> None:
    """An empty document for each row ``(file, output, declared_n)``, under the
    folder of ``file``. The XML sink would write no root for an empty frame, so
    these are written as text."""
    source = F.replace(escape_xml("output"), F.lit('"'), F.lit("&quot;"))
    text = F.concat(
        F.lit(f"<?xml {DECLARATION}?>\n<{ROOT_TAG} source=\""), source,
        F.lit('" n="'), F.col("declared_n").cast("string"), F.lit(f'">\n</{ROOT_TAG}>'),
    )
    lines = stubs.select(folder("file").alias("folder"), "output", text.alias("value"))
    lines.write.mode(mode).partitionBy("folder", "output").text(path)


def row_documents(cells: DataFrame, root: Mapping[str, object] | None = None, keep_zero: bool = False) -> DataFrame:
    """``(folder, output, n, value)``: the text of one document per sheet, a
    ``<row n="k">`` for each row below the header.

    The names differ from sheet to sheet, which the XML sink could not express
    in one job; a row or a sheet without values keeps its empty element. The
    first and the last row of a document bring its root along. The format bounds
    a sheet, and so a document, to about a million rows.

    Rows of ``read_workbook_rows`` tell which is the last, and stay where they are;
    cells are gathered first.
    """
    if "values" in cells.columns:
        return _row_documents(cells, root, keep_zero)
    below = F.col("n") > 1
    named = clean_cells(cells).withColumn("element", element_name("header", F.col("col") + 1))
    named = drop_elements(named.withColumn("value", F.when(below, F.col("value"))))
    value = escape_xml(strip_control(unescape_xml("cleaned")))
    text = F.concat(F.lit("<"), "element", F.lit(">"), value, F.lit("</"), F.col("element"), F.lit(">"))
    present = below & drop_falsy("cleaned", keep_zero).isNotNull()
    shown = F.when(present, F.struct("col", text.alias("text")))
    where = ["folder", "output"]
    rows = named.groupBy("file", "sheet_no", "n").agg(F.sort_array(F.collect_list(shown)).alias("e")).select(
        F.coalesce(folder("file"), F.lit("")).alias("folder"),
        F.coalesce(output_name(file_name("file"), F.col("sheet_no")), F.lit("")).alias("output"),
        "n", "e",
    )
    document = Window.partitionBy(*where).orderBy("n")
    opening = f"<?xml {DECLARATION}?>\n<{_root(ROOT_TAG, root or {})}>"
    tags = F.concat(F.array(F.concat(F.lit('<row n="'), F.col("n").cast("string"), F.lit('">'))),
                    F.transform("e", lambda x: x["text"]), F.array(F.lit("</row>")))
    return rows.withColumns(
        {"_first": F.row_number().over(document) == 1, "_last": F.lead("n").over(document).isNull()}
    ).select(
        *where, "n",
        F.concat_ws(
            "\n", F.when(F.col("_first"), F.lit(opening)), F.when(below, F.array_join(tags, "\n")),
            F.when(F.col("_last"), F.lit(f"</{ROOT_TAG}>")),
        ).alias("value"),
    ).where(F.col("value") != "")


def _row_documents(rows: DataFrame, root: Mapping[str, object] | None, keep_zero: bool) -> DataFrame:
    below = F.col("n") > 1
    pairs = F.arrays_zip(
        F.transform("header", lambda h, i: element_name(h, F.col("first_col") + i + 1)).alias("element"),
        cleaned_values(rows).alias("cleaned"),
    )
    named = rows.select("file", "sheet_no", "n", "last", F.when(below, pairs).otherwise(F.slice(pairs, 1, 0)).alias("pairs"))
    listed = F.filter("pairs", lambda p: p["element"].isin(*DROPPED) & F.coalesce(drop_falsy(p["cleaned"]).isNotNull(), F.lit(False)))
    message = F.concat(F.lit("dropped column "), F.get(listed, F.lit(0))["element"], F.lit(" has value "), F.get(listed, F.lit(0))["cleaned"])
    guarded = named.where(F.when(F.size(listed) > 0, F.raise_error(message).cast("boolean")).otherwise(True))

    def text(p: Column) -> Column:
        value = escape_xml(strip_control(unescape_xml(p["cleaned"])))
        return F.concat(F.lit("<"), p["element"], F.lit(">"), value, F.lit("</"), p["element"], F.lit(">"))

    def present(p: Column) -> Column:
        return ~p["element"].isin(*DROPPED) & drop_falsy(p["cleaned"], keep_zero).isNotNull()

    tags = F.concat(
        F.array(F.concat(F.lit('<row n="'), F.col("n").cast("string"), F.lit('">'))),
        F.transform(F.filter("pairs", present), text), F.array(F.lit("</row>")),
    )
    opening = f"<?xml {DECLARATION}?>\n<{_root(ROOT_TAG, root or {})}>"
    return guarded.select(
        F.coalesce(folder("file"), F.lit("")).alias("folder"),
        F.coalesce(output_name(file_name("file"), F.col("sheet_no")), F.lit("")).alias("output"), "n",
        F.concat_ws(
            "\n", F.when(F.col("n") == 1, F.lit(opening)), F.when(below, F.array_join(tags, "\n")),
            F.when(F.col("last"), F.lit(f"</{ROOT_TAG}>")),
        ).alias("value"),
    ).where(F.col("value") != "")


def write_rows(
    cells: DataFrame, path: str, root: Mapping[str, object] | None = None, keep_zero: bool = False, mode: str = "error"
) -> None:
    """Write ``row_documents``: one folder and one well-formed file per document.

    A sheet goes to one task for that, in order, as the format bounds it.
    """
    where = ["folder", "output"]
    lines = row_documents(cells, root, keep_zero)
    ordered = lines.repartition(*where).sortWithinPartitions(*where, "n") if "values" in cells.columns else lines
    ordered.drop("n").write.mode(mode).partitionBy(*where).text(path)


def write_registry(registry: DataFrame, path: str, mode: str = "error") -> DataFrame:
    """Write ``(entry_no, record_type, ordinal, column)`` as a registry file and
    return it as read back, which stops at XML that is not well formed.

    A registry is a configuration file, so it is one part file; a type has at
    most as many columns as a sheet.
    """
    spark: SparkSession = registry.sparkSession
    named = F.when(F.col("column").isNotNull(), F.struct("ordinal", "column"))
    lists = registry.groupBy("entry_no", "record_type").agg(F.sort_array(F.collect_list(named)).alias("c"))
    rows = lists.orderBy("entry_no").coalesce(1).select(
        F.col("record_type").alias(f"_{registry_format.ID_ATTRIBUTE}"),
        F.transform("c", lambda x: x["column"]).alias(registry_format.COLUMN_TAG),
    )
    writer = rows.write.mode(mode).option("rootTag", registry_format.ROOT_TAG)
    writer.option("rowTag", registry_format.TYPE_TAG).option("declaration", DECLARATION).xml(path)
    return registry_format.read_registry(spark, path, strict=True)


def write_dictionary(entries: DataFrame, path: str, mode: str = "error") -> None:
    """Write the data dictionary: an element per record type that holds its
    fields in order.

    ``entries`` comes from ``build_dictionary`` joined with ``with_type_meta``.
    A group is one record type, hence bounded by the columns of a sheet.
    """
    field = F.struct(
        F.col("ordinal"),
        F.col("column").alias("_key"),
        F.struct(F.col("column").alias("_VALUE"), F.col("ordinal").alias("_column")).alias("elementName"),
        F.col("letter"),
        F.col("description").alias("desc"),
    )
    kinds = ["record_type", "num_recs", "label", "workflow", "documentation", "archive"]
    lists = _printable(entries).groupBy(*kinds).agg(F.sort_array(F.collect_list(field)).alias("f"))
    ready = lists.select(
        F.col("record_type").alias("_key"),
        F.col("num_recs").alias("_n"),
        F.struct("label", "workflow", F.col("documentation").alias("ref"), F.col("archive")).alias("desc"),
        F.struct(
            F.transform(
                "f",
                lambda x: F.struct(
                    x["_key"].alias("_key"), x["elementName"].alias("elementName"),
                    x["ordinal"].alias("column"), x["letter"].alias("letter"), x["desc"].alias("desc"),
                ),
            ).alias("field")
        ).alias("fieldList"),
    )
    writer = ready.write.mode(mode).option("rootTag", "dictionary").option("rowTag", "record")
    writer.option("declaration", DECLARATION).xml(path)
