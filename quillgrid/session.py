"""Session defaults and the shared folder used for intermediate tables."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def session(app_name: str = "quillgrid", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings: dict[str, object] = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Records are wide. The JVM does not compile methods above this size, so
        # larger ones are better left to split, uncollapsed projections.
        "spark.sql.codegen.hugeMethodLimit": 8000,
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a written intermediate table.

    It lies in the folder that ``spark.checkpoint.dir`` names, which a cluster
    shares among its executors. Only a local session may fall back on a
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="run-")
    return os.path.join(root, f"quillgrid-{label}-{uuid.uuid4().hex}")


def pin_splits(spark: SparkSession) -> None:
    """Fix the way files are cut into splits for the rest of the session.

    Row numbering reads a source twice and needs the same splits both times.
    Unless it is set, Spark derives the number of splits of small inputs from
    the executors alive at that moment.
    """
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))


def ship_with_tasks(module_name: str) -> None:
    """Send the functions of a module along with the tasks that call them, so
    that executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
