"""Helpers that several operators share."""

from __future__ import annotations

import gc
import sys
import tempfile
import time
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, NULL as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is.

    Texts of ASCII alone, told by equal lengths in bytes and in code points,
    take the built-in ``lower``, which does the same for them and is faster.
    """
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


LARGEST_LONG = (1 << 63) - 1


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder that all executors share.

    The folder is that of ``spark.checkpoint.dir``. Only a session without one,
    as in tests, gets a temporary folder, and only a local one.

    A checkpoint keeps the size that the optimizer has guessed for its rows. The guess for
    a join is the product of both sides, so in a chain of joined checkpoints its digits
    double from step to step, up to megabytes of the driver for one number. A guess beyond
    any real size is dropped, and Spark's default, the largest long, stands in for it.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        root = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if root is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(root or tempfile.mkdtemp(prefix="checkpoint-"))
    out = df.checkpoint()
    plan = out._jdf.queryExecution().logical()
    if plan.stats().sizeInBytes() <= LARGEST_LONG:
        return out
    again = df.sparkSession._jsparkSession.internalCreateDataFrame(plan.rdd(), out._jdf.schema(), False)
    return DataFrame(again, df.sparkSession)


LET_GO_S = 10
"""Seconds that ``release`` waits at most."""


def release(spark: SparkSession) -> None:
    """Let Spark delete what is no longer needed: shuffle files of frames that have been
    checkpointed since, and checkpoints no frame refers to (where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set).

    Spark deletes them when the driver's JVM finds them unused. A driver that makes few
    objects would find that late, and disks of executors would fill meanwhile. What Python
    has dropped is let go by a thread of py4j that looks for it once a second, so this waits
    until that thread has nothing left; the JVM would still find all of it in use otherwise.
    Spark's listeners hold the last event they were told, and with it the last query, its plan
    and its shuffles; a job without tasks gives them another.
    """
    gc.collect()
    spark.sparkContext._jsc.emptyRDD().count()
    dropped, end = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None), time.time() + LET_GO_S
    while dropped and time.time() < end:
        time.sleep(0.02)
    time.sleep(0.1)  # for the last one, which is on its way
    spark.sparkContext._jvm.System.gc()


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that all executors share; only a local session
    without ``spark.checkpoint.dir`` gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{root or tempfile.mkdtemp(prefix='shared-')}/{label}-{uuid.uuid4().hex}"


def once_per_worker(key: tuple, build: Callable[[], Any]) -> Any:
    """``build()``, made once in each Python worker and kept for its later tasks, until
    the worker is asked for something whose key begins with two other parts: workers
    outlive the stages of a job, and what these have kept would add up.

    Functions sent by value lose their globals from task to task, so the store
    is a module of its own.
    """
    store = sys.modules.setdefault("_quillgrid_kept", types.ModuleType("_quillgrid_kept"))
    if getattr(store, "owner", None) != key[:2]:
        store.owner, store.found = key[:2], {}
        gc.enable()  # tasks may have turned it off
        gc.collect()
        pa.default_memory_pool().release_unused()
    if key not in store.found:
        store.found[key] = build()
    return store.found[key]


SLICE_BYTES = 2_000_000
"""Bytes of the rows that a worker turns before it hands them on."""


def values_of(array: pa.Array) -> list:
    """The values of an Arrow column; lists of numbers stay numpy arrays."""
    kind = array.type
    if not pa.types.is_list(kind) or not pa.types.is_integer(kind.value_type):
        return array.to_pylist()
    flat, at, there = array.values.to_numpy(zero_copy_only=False), array.offsets.to_numpy(), array.is_valid().to_pylist()
    return [flat[a:b] if v else None for a, b, v in zip(at, at[1:], there)]


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``SLICE_BYTES`` of a text or list column."""
    kind = batch.schema.field(column).type
    text = pa.types.is_string(kind) or pa.types.is_binary(kind)
    size, each = (pc.binary_length, 1) if text else (pc.list_value_length, 8)
    sizes = pc.fill_null(size(batch.column(column)), 0).cast(pa.int64()).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        held += n * each + 64
        if held >= SLICE_BYTES:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < len(sizes):
        yield batch.slice(start)


def add_columns(
    df: DataFrame, added: str, column: str, work: Callable[[list], list[list]], keep: list[str] | None = None,
    sized_by: str | None = None,
) -> DataFrame:
    """``df`` with the columns of the schema ``added``, worked out from the
    values of ``column`` by Python in each task.

    ``work`` gets the values of some rows and returns a list for each new
    column. Other columns pass as Arrow, untouched; ``keep`` names those to
    keep (all of them unless given). Columns of the new names are replaced.
    ``sized_by`` names the text column that rows are counted out by, if it is
    not ``column``.
    """
    new = T.StructType.fromDDL(added)
    names = set(new.fieldNames())
    kept = [f for f in df.schema.fields if f.name not in names and (keep is None or f.name in keep)]
    types = list(to_arrow_schema(new).types)
    schema = T.StructType([*kept, *new.fields])
    kept_names, all_names = [f.name for f in kept], schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, sized_by or column):
                made = work(values_of(rows.column(column)))
                arrays = [rows.column(n) for n in kept_names]
                arrays += [pa.array(values, t) for values, t in zip(made, types)]
                yield pa.RecordBatch.from_arrays(arrays, all_names)

    return df.mapInArrow(run, schema)


def own_names(df: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """``df`` under names that clash with nothing: the frame, the new name of
    each column, and the columns that give the old names back."""
    new = {c: f"_own{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*new.values()), new, [F.col(n).alias(c) for c, n in new.items()]
