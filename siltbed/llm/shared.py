"""Tables that a job writes for itself in the folder that the cluster shares."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; in local mode, where it is unset, one of this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='siltbed-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a table in the shared folder, which cuts their lineage and outlives executors."""
    folder = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


@contextmanager
def rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most so many rows for the Python workers of what is run inside.

    Rows that carry sets of a text's elements are some KB each: the usual 10,000 would be held
    several times over, by the executor, on the way and by the worker.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def give_back() -> None:
    """Return memory that this worker no longer uses to the machine; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator]) -> Callable[[Iterator[pa.RecordBatch]], Iterator]:
    """A function for ``mapInArrow`` that gives back its memory at the end of its task.

    Workers serve the tasks of all stages, and would hold the most that each of them ever took.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied
