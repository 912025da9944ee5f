"""Document order for written rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_document_order(df: DataFrame, order: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Range partitions, each sorted: part files follow each other in document
    order, and one large document is written by many tasks.

    A partitioned write sorts by its partition columns once more, and so loses
    the order of the rows, unless the rows are already sorted by these columns
    and the columns cannot be NULL.

    Whether rows still lie as they were scanned depends on how large the look-ups
    before were, so the order is never taken for granted: frames that carry it are
    sorted. Those with none of the columns have no order to keep.
    """
    if not order:
        raise ValueError("name the columns of the document order")
    keys = [*partition_by, *(c for c in order if c in df.columns)]
    if not keys:
        return df
    for c in partition_by:
        df = df.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit("")))
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)
