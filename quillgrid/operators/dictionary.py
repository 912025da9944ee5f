"""The data dictionary: what each column of each record type means."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.clean import FALSY, _col
from quillgrid.functions.provenance import column_letter
from quillgrid.operators.joins import lookup

# The types that share the metadata of another one.
ALIASES = {"c31s": "crs", "c33s": "crs", "c37s": "crs", "c40s": "crs", "c41s": "crs"}
# The texts of the dictionary.
DOCUMENTATION_PREFIX = "Transcription documentation: "
FIELD_TEXT = 'In original source file type "{type}", column {ordinal} or {letter} is XML element "{column}".'
GENERAL_TEXT = ' Generally for "{column}": {description}'
SPECIFIC_TEXT = ' Specifically for "{type}.{column}": {description}'


def _fill(template: str, **values: Column) -> Column:
    """The template with Columns in place of ``{name}``."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*(values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts)))


def resolve_alias(c: Column | str, aliases: Mapping[str, str] = ALIASES) -> Column:
    """The type an alias stands for, or the type itself. For a handful of
    aliases; ``resolve_aliases`` joins a table."""
    c = _col(c)
    pairs = [F.lit(text) for pair in aliases.items() for text in pair]
    return F.coalesce(F.create_map(*pairs)[c], c) if pairs else c


def resolve_aliases(df: DataFrame, aliases: DataFrame, column: str = "record_type", name: str = "resolved") -> DataFrame:
    """The same by a table ``(<column>, alias_of)``."""
    joined = lookup(df, aliases.select(column, "alias_of"), column, "left")
    return joined.withColumn(name, F.coalesce("alias_of", column)).drop("alias_of")


def describe_fields(
    df: DataFrame, dictionary: DataFrame, record_type: str = "record_type", column: str = "column"
) -> DataFrame:
    """Add ``general`` and ``specific``: the descriptions under ``column`` and
    under ``record_type.column``, NULL when there is none."""
    general = dictionary.select(F.col("key").alias(column), F.col("description").alias("general"))
    specific = dictionary.select(F.col("key").alias("_key"), F.col("description").alias("specific"))
    keyed = df.withColumn("_key", F.concat_ws(".", record_type, column))
    return lookup(lookup(keyed, general, column), specific, "_key").drop("_key")


def extra_description(record_type: Column | str, column: Column | str, general: Column | str, specific: Column | str):
    """The described parts; an absent description leaves its part out."""
    kind, name, general, specific = map(_col, (record_type, column, general, specific))

    def part(template: str, description: Column) -> Column:
        said = _fill(template, type=kind, column=name, description=description)
        # Absent covers NULL, '' and '0'.
        return F.when(~description.isin(*FALSY), said).otherwise(F.lit(""))

    return F.concat(part(GENERAL_TEXT, general), part(SPECIFIC_TEXT, specific))


def field_description(
    record_type: Column | str, column: Column | str, ordinal: Column | str,
    general: Column | str, specific: Column | str,
) -> Column:
    """The full sentence about a column."""
    kind, name, i = map(_col, (record_type, column, ordinal))
    text = _fill(FIELD_TEXT, type=kind, ordinal=i.cast("string"), letter=column_letter(i), column=name)
    return F.concat(text, extra_description(kind, name, general, specific))


def with_type_meta(df: DataFrame, meta: DataFrame, documentation_url: str = "", archive_url: str = "") -> DataFrame:
    """Add the metadata of the (resolved) type.

    ``meta`` has ``record_type, num_recs, desc, source, documentation,
    archive_id``. Links are NULL where the metadata has no entry for them.
    """
    named = meta.select(
        F.col("record_type").alias("_meta_type"), "num_recs", F.col("desc").alias("label"),
        F.col("source").alias("workflow"),
        F.when(
            ~F.col("documentation").isin(*FALSY),
            F.concat(F.lit(DOCUMENTATION_PREFIX + documentation_url), "documentation"),
        ).alias("documentation"),
        F.when(
            ~F.col("archive_id").isin(*FALSY), F.concat(F.lit(archive_url), "archive_id")
        ).alias("archive"),
    )
    keyed = df.withColumn("_meta_type", resolve_alias("record_type"))
    return lookup(keyed, named, "_meta_type").drop("_meta_type")


def build_dictionary(registry: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``(record_type, ordinal, letter, column, description)`` for all types."""
    columns = registry.where(F.col("column").isNotNull())
    told = describe_fields(columns, dictionary)
    return told.select(
        "record_type", "ordinal", column_letter("ordinal").alias("letter"), "column",
        field_description("record_type", "column", "ordinal", "general", "specific").alias("description"),
    )
