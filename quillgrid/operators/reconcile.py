"""Files and counts: what was promised against what was found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.provenance import file_name, is_stub, output_name, parse_file_name, volume_name

# The verdicts on a count, and the layouts that are fixed
# delimited files with their fields, declared records and charset.
GOOD, BOO = "GOOD", "BOO"
DELIMITED = {
    "kgd": ("deaths.dat", 38, 92885, "UTF-8"),
    "kgb": ("births.dat", 53, 194558, "ISO-8859-1"),
    "kgm": ("marriages.dat", 107, 51131, "ISO-8859-1"),
}
SELF_DESCRIBING = "NEW"


def count_records(df: DataFrame, key: str = "file", counted: Column | None = None) -> DataFrame:
    """``(key, actual_n)``: the records of each file, or those ``counted``."""
    n = F.count(F.lit(1)) if counted is None else F.count_if(counted)
    return df.groupBy(key).agg(n.alias("actual_n"))


def manifest_from_names(files: DataFrame) -> DataFrame:
    """``(file, declared_n)`` as the file names promise it."""
    told = parse_file_name(volume_name(file_name("file")))
    return files.select("file", told["expected_n"].alias("declared_n"))


def check_counts(counts: DataFrame, key: str = "file", fatal: bool = True) -> DataFrame:
    """Add ``verdict`` to ``(key, declared_n, actual_n)``. With ``fatal`` the job
    stops at the first failure."""
    equal = F.coalesce(F.col("actual_n") == F.col("declared_n"), F.lit(False))
    failure = F.lit(BOO)
    if fatal:
        failure = F.raise_error(F.concat_ws(" ", F.lit("count differs for"), F.col(key), F.lit("found"), "actual_n"))
    return counts.withColumn("verdict", F.when(equal, F.lit(GOOD)).otherwise(failure))


def reconcile(actual: DataFrame, manifest: DataFrame, key: str = "file", fatal: bool = False) -> DataFrame:
    """``(key, declared_n, actual_n, verdict)`` for every key of either side.

    A file without records counts 0, and a file nobody declared is a failure.
    """
    joined = manifest.select(key, "declared_n").join(actual.select(key, "actual_n"), key, "full")
    found = F.coalesce("actual_n", F.lit(0)).cast("bigint")
    return check_counts(joined.withColumn("actual_n", found), key, fatal)


def run_report(counts: DataFrame) -> DataFrame:
    """One row per verdict: how many files, declared and found records."""
    return counts.groupBy("verdict").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("declared_n").alias("declared_n"),
        F.sum("actual_n").alias("actual_n"),
    )


def files_without_records(files: DataFrame, records: DataFrame) -> DataFrame:
    """Files in which no record was found: the record type does not fit."""
    return files.join(records.select("file").distinct(), "file", "left_anti")


def route(name: Column | str, record_type: Column | str) -> Column:
    """Which way a file goes: ``stub, delimited, named_export, workbook,
    registered`` or ``unsupported``."""
    name = F.col(name) if isinstance(name, str) else name
    kind = F.col(record_type) if isinstance(record_type, str) else record_type
    new = kind == SELF_DESCRIBING
    return (
        F.when(is_stub(name), "stub")
        .when(kind.isin(*DELIMITED), "delimited")
        .when(new & name.endswith(".xls"), "named_export")
        .when(new & name.endswith(".xlsx"), "workbook")
        .when(new, "unsupported")
        .otherwise("registered")
    )


def route_files(files: DataFrame, name: str = "file_name", record_type: str = "record_type") -> DataFrame:
    """Add ``route``; ``convert_listing`` stops at ``unsupported`` files."""
    return files.withColumn("route", route(name, record_type))


def stubs_for_missing(files: DataFrame, name: str = "file_name") -> DataFrame:
    """``(file, output, declared_n)``: an empty document for each file that was
    never delivered."""
    missing = files.where(is_stub(name))
    return missing.select("file", output_name(name).alias("output"), F.lit(0).cast("bigint").alias("declared_n"))
