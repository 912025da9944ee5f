"""Names for columns: the registry as a table and its use."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.functions.provenance import column_letter
from quillgrid.operators.joins import lookup

# Fixed value: the type whose columns come from the header row.
HEADER_TYPE = "NEW"


def explode_lists(df: DataFrame, array: str, name: str, *keys: str) -> DataFrame:
    """One row per entry of a nested list, with its ordinal from 1. An empty
    list keeps one row with NULLs."""
    rows = df.select(*keys, F.posexplode_outer(array).alias("_pos", name))
    return rows.select(*keys, (F.col("_pos") + 1).alias("ordinal"), name)


def registry_names(registry: DataFrame, record_type: str) -> list[str]:
    """The column names of one type, in order. The only registry data that
    reaches the driver."""
    rows = registry.where((F.col("record_type") == record_type) & F.col("column").isNotNull())
    names = [r["column"] for r in rows.orderBy("ordinal").select("column").collect()]
    if not names and record_type != HEADER_TYPE:
        raise ValueError(f"no columns are defined for record type {record_type!r}")
    return names


def apply_schema(df: DataFrame, registry: DataFrame, record_type: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Give the i-th column (``keep`` aside) the i-th name of the type."""
    names = registry_names(registry, record_type)
    data = [c for c in df.columns if c not in keep]
    if len(data) > len(names):
        raise ValueError(f"{len(data)} columns but only {len(names)} names for {record_type!r}")
    return df.select(*keep, *(F.col(c).alias(n) for c, n in zip(data, names)))


def bind_registry(values: DataFrame, registry: DataFrame) -> DataFrame:
    """Name tall values by ``(record_type, ordinal)``."""
    names = registry.where(F.col("column").isNotNull()).select("record_type", "ordinal", "column")
    return lookup(values, names, ["record_type", "ordinal"], "inner")


def with_record_type(df: DataFrame, record_type: str) -> DataFrame:
    return df.withColumn("record_type", F.lit(record_type))


def known_types(df: DataFrame, registry: DataFrame) -> DataFrame:
    """The rows whose record type is in the registry (exact match)."""
    return lookup(df, registry.select("record_type").distinct(), "record_type", "left_semi")


def columns_per_type(registry: DataFrame) -> DataFrame:
    """``(record_type, n_columns, warning)``."""
    counted = registry.groupBy("record_type").agg(F.count("column").alias("n_columns"))
    no_id = F.coalesce(F.col("record_type"), F.lit("")) == ""
    empty = (F.col("n_columns") == 0) & (F.col("record_type") != HEADER_TYPE)
    return counted.withColumn("warning", F.when(no_id, "no id").when(empty, "no columns"))


def missing_ids(registry: DataFrame) -> DataFrame:
    """Registry rows whose entry has no id."""
    return registry.where(F.coalesce(F.col("record_type"), F.lit("")) == "")


def types_without_columns(types: DataFrame, registry: DataFrame) -> DataFrame:
    """The types that have no column in the registry, the header type aside."""
    named = registry.where(F.col("column").isNotNull()).select("record_type").distinct()
    wanted = types.where(F.col("record_type") != HEADER_TYPE)
    return lookup(wanted, named, "record_type", "left_anti")


def qname_list(registry: DataFrame, key: str = "record_type", name: str = "column", order: str = "ordinal") -> DataFrame:
    """``(key, names)``: the ordered comma list of the names of each key."""
    ordered = F.expr(f"listagg(`{name}`, ',') WITHIN GROUP (ORDER BY `{order}`)")
    return registry.groupBy(key).agg(ordered.alias("names"))


def type_list(registry: DataFrame) -> DataFrame:
    """One row: the comma list of all type ids, in the order of the registry."""
    entries = registry.select("record_type", "entry_no").distinct()
    return entries.agg(F.expr("listagg(record_type, ',') WITHIN GROUP (ORDER BY entry_no)").alias("types"))


def describe_types(registry: DataFrame) -> DataFrame:
    """``(record_type, ordinal, letter, column)`` for every column of every type."""
    rows = registry.where(F.col("column").isNotNull())
    return rows.select("record_type", "ordinal", column_letter("ordinal").alias("letter"), "column")


def registry_from_header(cells: DataFrame, record_type) -> DataFrame:
    """A registry made from the header row of each sheet; ``record_type`` is a
    Column over the table of cells or rows."""
    from quillgrid.functions.clean import element_name

    if "values" in cells.columns:
        names = F.transform("values", lambda v, i: element_name(v, F.col("first_col") + i + 1))
        top = cells.where(F.col("n") == 1).select(record_type.alias("record_type"), F.posexplode(names).alias("_at", "column"))
        return top.select("record_type", (F.col("_at") + 1).alias("ordinal"), "column")

    top = cells.where(F.col("n") == 1)
    first = F.min("col").over(Window.partitionBy("file", "sheet_no"))
    return top.select(
        record_type.alias("record_type"),
        (F.col("col") - first + 1).alias("ordinal"),
        element_name("value", F.col("col") + 1).alias("column"),
    )
