"""The conversions, composed of operators. Each is one lazy plan; the sinks put
their records in document order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quillgrid.functions.clean import clean_cell, drop_empty_value, drop_falsy, unescape_xml
from quillgrid.functions.dates import DATE_STEMS, date_triples, partial_date
from quillgrid.functions.provenance import document_key, is_stub, output_name, parse_file_name, volume_name
from quillgrid.operators import dictionary as words
from quillgrid.operators import reconcile as counts
from quillgrid.operators import records
from quillgrid.operators.guards import stop_if
from quillgrid.operators.joins import lookup
from quillgrid.operators.reshape import cells_to_records, drop_elements, promote_header
from quillgrid.operators.schema import HEADER_TYPE, registry_names, with_record_type
from quillgrid.sinks.tabular import clean_cells
from quillgrid.sources.files import few_splits, list_files
from quillgrid.sources.lines import field_columns, read_delimited, read_fields
from quillgrid.sources.record_xml import read_counted_records
from quillgrid.sources.workbook import cells_of, read_workbook_cells, read_workbook_rows


def convert_registered(
    spark: SparkSession, path: str | list[str], registry: DataFrame, record_type: str,
    n_records: int | None = None, split: bool = True,
) -> DataFrame:
    """Records of a registered type: named by the registry, without the header
    record, cut to ``n_records`` per file, empty values NULL. A file without a
    record of the type stops the job."""
    names = registry_names(registry, record_type)
    rows, told = read_counted_records(spark, path, record_type, names, split=split)
    body = records.drop_header_record(rows.drop("started"))
    if n_records is not None:
        body = records.limit_per_file(body, n_records, skipped=1)
    empty = counts.files_without_records(list_files(spark, path), told.where("total > 0"))
    message = F.concat(F.lit(f"no record of type {record_type} in "), F.col("file"))
    return stop_if(records.drop_empty(body), empty, message)


def convert_registered_cells(
    cells: DataFrame, registry: DataFrame, record_type: str, n_records: int | None = None
) -> DataFrame:
    """The same from the cells or rows of workbooks that do not name their columns:
    the i-th column of a sheet has the i-th name of the type. Columns beyond the
    names are left out. ``block`` is the number of the sheet. Rows stay where they
    are; cells are gathered first."""
    names = registry_names(registry, record_type)
    if "values" in cells.columns:
        wanted = F.col("n") > 1 if n_records is None else F.col("n").between(2, n_records + 1)
        values = cells.where(wanted).withColumn("_v", F.transform("values", lambda v: unescape_xml(clean_cell(v))))
        at = [F.get("_v", F.lit(i) - F.col("first_col")) for i in range(len(names))]
        place = (F.col("file"), F.col("sheet_no").cast("bigint").alias("block"), F.col("n").cast("bigint").alias("rn"))
        return values.select(*place, *(drop_empty_value(v).alias(n) for v, n in zip(at, names)))
    wanted = (F.col("n") > 1) & (F.col("col") < len(names))
    if n_records is not None:
        wanted &= F.col("n") <= n_records + 1
    named = clean_cells(cells.where(wanted)).select(
        "file", "sheet_no", "n", "col", F.get(F.array(*map(F.lit, names)), F.col("col")).alias("element"),
        unescape_xml("cleaned").alias("value"),
    )
    rows = cells_to_records(named, names)
    position = (F.col("file"), F.col("sheet_no").cast("bigint").alias("block"), F.col("n").cast("bigint").alias("rn"))
    return records.drop_empty(rows.select(*position, *(F.col(f"`{c}`") for c in names)))


def convert_volumes(
    spark: SparkSession, path: str | list[str], registry: DataFrame, row_tag: str, split: bool = True, fatal: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Records of volumes whose file names tell volume and count.

    Returns the records, with the document key as ``lineNum`` and the parts of
    the key beside it, and the table ``(file, declared_n, actual_n, verdict)``.
    A file whose name tells no volume stops the job, and with ``fatal`` one that
    holds another number of records than it promises.

    Starts, numbers and verdicts come from one pass over the text and the records
    from a second one, whether both tables are used or one.
    """
    names = registry_names(registry, row_tag)

    def numeric(line: Column) -> Column:
        return F.rlike(line, F.lit(records.NUMERIC_LINE))

    rows, found = read_counted_records(spark, path, row_tag, names, ("lineNum", numeric), split)
    # Names are parsed once per file, not per record.
    files = list_files(spark, path)
    told = files.select("file", parse_file_name(volume_name("file_name")).alias("told"))
    body = lookup(rows.where("started").drop("started"), told, "file", small=few_splits(spark, path), salt="rn")
    is_numeric = numeric(F.col("lineNum"))
    marked = body.withColumns(
        {
            "volume": F.col("told.volume"),
            "line": F.when(is_numeric, F.regexp_extract("lineNum", records.NUMERIC_LINE, 0)),
            "record_type": F.coalesce("told.record_type", F.lit(row_tag)),
        }
    ).drop("told")
    unknown = F.raise_error(F.concat(F.lit("no volume in the name of "), "file"))
    volume = F.when(F.col("volume").isNull(), unknown).otherwise(F.col("volume"))
    key = F.when(F.col("line").isNotNull(), document_key(volume, "line", "record_type")).otherwise(F.col("lineNum"))
    marked = marked.withColumn("lineNum", key)
    keep = (*records.POSITION, "record_type", "volume", "line")
    out = records.drop_empty(marked, keep)
    actual = found.select("file", F.col("marked").alias("actual_n"))
    verdicts = counts.reconcile(actual, counts.manifest_from_names(files))
    if fatal:
        wrong = verdicts.where(F.col("verdict") != counts.GOOD)
        out = stop_if(out, wrong, F.concat_ws(" ", F.lit("count differs for"), "file", F.lit("found"), "actual_n"))
    return out, verdicts


def convert_delimited(
    spark: SparkSession, path: str | list[str], registry: DataFrame, record_type: str,
    charset: str | None = None, n_fields: int | None = None, keep_zero: bool = False,
    keep_parts: bool = False, carry: bool = False, correct: bool = False,
) -> DataFrame:
    """Records of a fixed delimited layout: named, trimmed, dates folded, values
    that count as missing NULL.

    ``carry`` dates a marriage with the day and month of the record before when
    the year stands left of them, as the layout's first converter did.
    """
    names = registry_names(registry, record_type)
    charset = charset or counts.DELIMITED[record_type][3]
    triples = date_triples(DATE_STEMS)
    if carry:
        rows = read_delimited(spark, path, names, n_fields, charset, correct=correct)
        at = rows.columns.index
        parts = [t[1:] for t in triples if all(c in rows.columns for c in t[1:])]
        late = [c for y, *others in parts for c in others if at(y) < at(c)]
        dated = records.fold_dates(records.carry_previous(rows, late) if late else rows, triples, keep_parts)
        return records.drop_falsy_values(dated, keep_zero=keep_zero)
    n = len(names) if n_fields is None else n_fields
    rows = read_fields(spark, path, n, charset, correct=correct)
    # One projection from the fields to the result: records are wide, so every
    # further one would copy dozens of columns.
    values = field_columns(names, n)
    dated = {c for t in triples if all(x in values for x in t[1:]) for c in t[1:]}
    cleaned = {c: v if c in dated else drop_falsy(v, keep_zero) for c, v in values.items()}
    columns = records.fold_date_columns(
        cleaned, triples, lambda y, m, d: partial_date(values[y], values[m], values[d]), keep_parts
    )
    out = rows.select(*records.POSITION, *columns)
    return records.drop_falsy_values(out, keep_zero=keep_zero) if keep_parts else out


def check_delimited(df: DataFrame, record_type: str, declared_n: int | None = None, fatal: bool = False) -> DataFrame:
    """The number of records of a delimited layout against the declared one."""
    declared = counts.DELIMITED[record_type][2] if declared_n is None else declared_n
    actual = counts.count_records(with_record_type(df, record_type), "record_type")
    promised = df.sparkSession.createDataFrame([(record_type, declared)], "record_type string, declared_n bigint")
    return counts.reconcile(actual, promised, "record_type", fatal)


def write_and_report(
    df: DataFrame, write: Callable[[DataFrame, Callable[[DataFrame], DataFrame]], None], declared: dict[str, int],
    kind: Column | None = None, fatal: bool = False,
) -> DataFrame:
    """Write records and report on them in one pass: ``(record_type, declared_n, actual_n,
    verdict)``.

    ``write`` gets the records and a function that it applies to them right before they
    are written, behind any sort, as ``watch`` of the sinks does: there the numbers are
    observed, so neither the source nor the output is read again. ``declared`` has the number of records of each
    type and ``kind`` tells the type of a record; without it all are of the one type
    declared. With ``fatal`` a wrong number stops the job, after the write.
    """
    if kind is None and len(declared) != 1:
        raise ValueError("tell the type of a record")
    seen = Observation()
    of = {k: F.count(F.lit(1)) if kind is None else F.count_if(kind == k) for k in declared}
    write(df, lambda rows: rows.observe(seen, *(n.alias(k) for k, n in of.items())))
    rows = [(k, n, seen.get[k]) for k, n in declared.items()]
    found = df.sparkSession.createDataFrame(rows, "record_type string, declared_n bigint, actual_n bigint")
    return counts.check_counts(found, "record_type", fatal)


def convert_workbooks(
    spark: SparkSession, path: str | list[str], keep_zero: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Self-describing workbooks: ``(elements, rows)``.

    ``elements`` has a row for each value under its header's name, as plain
    text; ``rows`` feeds ``write_rows``, ``write_tsv_cells`` and ``write_audit``.
    """
    rows = read_workbook_rows(spark, path)
    named = drop_elements(promote_header(clean_cells(cells_of(rows))))
    value = unescape_xml(drop_falsy("cleaned", keep_zero))
    elements = named.select(
        "file", "sheet_no", "sheet_name", "n", (F.col("col") + 1).alias("ordinal"), "element", value.alias("value")
    )
    return elements.where(F.col("value").isNotNull()), rows


def convert_listing(files: DataFrame, registry: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Split a listing ``(file, file_name, record_type)`` into the routed files
    that hold data and the stubs for those that were never delivered.

    A file that no conversion can read stops the job, and with a ``registry`` one
    whose record type is not in it.
    """
    routed = counts.route_files(files)
    unread = routed.where(F.col("route") == "unsupported")
    held = stop_if(routed.where(~is_stub("file_name")), unread, F.concat_ws(" ", F.lit("unsupported file"), "file", "file_name"))
    if registry is not None:
        named = registry.select("record_type").union(registry.sparkSession.createDataFrame([(HEADER_TYPE,)], "record_type string"))
        unknown = files.join(named.distinct(), "record_type", "left_anti")
        held = stop_if(held, unknown, F.concat_ws(" ", F.lit("unknown record type"), "record_type", F.lit("of"), "file"))
    return held, counts.stubs_for_missing(files)


def file_roots(files: DataFrame) -> DataFrame:
    """``(file, source, n)`` of each file of a listing: the attributes its document has,
    the name of the output and the number of records that the name promises."""
    told = parse_file_name(volume_name("file_name"))
    return files.select("file", output_name("file_name").alias("source"), told["expected_n"].alias("n"))


def build_dictionary(
    registry: DataFrame, dictionary: DataFrame, meta: DataFrame, documentation_url: str = "", archive_url: str = ""
) -> DataFrame:
    """Every column of every type with its description and its type's metadata,
    ready for ``write_dictionary``."""
    return words.with_type_meta(words.build_dictionary(registry, dictionary), meta, documentation_url, archive_url)
