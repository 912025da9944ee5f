"""Stops that no caller can forget: they are part of the plan that they guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stop_if(df: DataFrame, problems: DataFrame, message: Column) -> DataFrame:
    """``df``, unless ``problems`` has a row: then the job stops with its ``message``.

    The problems are an uncorrelated subquery, which Spark runs before it hands on a
    row of ``df``, also where ``df`` has none. No action of its own is needed. A
    message that is NULL stops as well.
    """
    told = F.coalesce(message, F.lit("a check failed"))
    return df.where(problems.agg(F.max(F.raise_error(told).cast("string"))).scalar().isNull())
