"""File listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.functions.provenance import file_name
from quillgrid.session import pin_splits


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, file_name, length)`` of every file; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    uri = F.col("_metadata.file_path")
    return found.select(uri.alias("file"), file_name(uri).alias("file_name"), "length")


MAX_BROADCAST_SPLITS, MAX_BROADCAST_BYTES = 1_000_000, 64 * 1024 * 1024
"""Split tables up to this many rows and bytes may be broadcast."""
SPLIT_BYTES = 64
"""Bytes of a row of a split table beside the name of its file."""


def _bytes(setting: str) -> int:
    text = setting.strip().lower().removesuffix("b")
    unit = {"k": 1024, "m": 1024**2, "g": 1024**3, "t": 1024**4}.get(text[-1:], 1)
    return int(text.rstrip("kmgt")) * unit


def _splits(spark: SparkSession, path: str | list[str]) -> tuple[int, int]:
    """Upper bounds for the splits a scan of these files has, and for the bytes of the
    longest file name, from the listing that Spark makes on the driver for any scan
    and the settings that cut files. No job runs."""
    scan = spark.read.option("recursiveFileLookup", "true").text(path)
    names = scan.inputFiles()
    length = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    pin_splits(spark)
    largest, opening = (
        _bytes(spark.conf.get(f"spark.sql.files.{key}")) for key in ("maxPartitionBytes", "openCostInBytes")
    )
    share = length // int(spark.conf.get("spark.sql.files.minPartitionNum"))
    return len(names) + length // max(1, min(largest, max(opening, share))), max(map(len, names), default=0)


def split_bound(spark: SparkSession, path: str | list[str]) -> int:
    """An upper bound for the number of splits a scan of these files has."""
    return _splits(spark, path)[0]


def few_splits(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether a table with one row per split is small enough to broadcast."""
    splits, longest = _splits(spark, path)
    return splits <= MAX_BROADCAST_SPLITS and splits * (longest + SPLIT_BYTES) <= MAX_BROADCAST_BYTES
