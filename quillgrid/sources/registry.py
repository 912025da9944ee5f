"""The registry of record types: which columns a type has, in which order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The tags of a registry file.
TYPE_TAG, ID_ATTRIBUTE, COLUMN_TAG, ROOT_TAG = "RECORD_TYPE", "ID", "C", "CONFIG"


def read_registry_lists(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    """``(entry_no, record_type, columns)``: one row per entry, with its nested
    list; ``entry_no`` rises in document order.

    ``strict`` stops at a file that is not well formed. Otherwise such entries
    come as rows with ``malformed`` set.
    """
    fields = f"_{ID_ATTRIBUTE} string, {COLUMN_TAG} array<string>"
    reader = spark.read.option("rowTag", TYPE_TAG)
    if strict:
        rows = reader.option("mode", "FAILFAST").schema(fields).xml(path)
        malformed = F.lit(None).cast("string")
    else:
        rows = reader.option("mode", "PERMISSIVE").schema(fields + ", _corrupt_record string").xml(path)
        malformed = F.col("_corrupt_record")
    return rows.select(
        F.monotonically_increasing_id().alias("entry_no"),
        F.col(f"_{ID_ATTRIBUTE}").alias("record_type"),
        F.col(COLUMN_TAG).alias("columns"),
        malformed.alias("malformed"),
    )


def read_registry(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    """``(entry_no, record_type, ordinal, column)`` in document order, ordinals from 1. A
    type without columns keeps one row with NULLs."""
    from quillgrid.operators.schema import explode_lists

    rows = read_registry_lists(spark, path, strict)
    if not strict:
        rows = rows.where(F.col("malformed").isNull())
    return explode_lists(rows, "columns", "column", "entry_no", "record_type")
