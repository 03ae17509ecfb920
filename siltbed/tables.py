"""Small helpers over Spark's own readers for tables that may not exist yet."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet at ``path`` under ``schema``; no rows when nothing was written there yet.

    Files that their writer drops as outdated during the read are left out.
    """
    try:
        return spark.read.option("ignoreMissingFiles", "true").schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, schema)


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)]
    return spark.range(0, 0, 1, 1).select(*nulls)


def one_row(spark: SparkSession, **columns) -> DataFrame:
    """A row of literals in one partition, made without Python workers."""
    return spark.range(0, 1, 1, 1).select(*[F.lit(v).alias(k) for k, v in columns.items()])


def io_tasks(spark: SparkSession) -> int:
    """Task count for work whose cost is in the files named by the rows, not in the rows."""
    return 3 * spark.sparkContext.defaultParallelism


def spread_out(rows: DataFrame) -> DataFrame:
    """Rows that name files, evenly over the cluster.

    They are a few bytes each, so size-based planning (AQE coalescing, scan packing) would
    put thousands of files in one task.
    """
    return rows.repartition(io_tasks(rows.sparkSession))


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Look up many explicit paths in a few tasks; by default Spark makes a task of each."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), io_tasks(spark))))
    try:
        yield
    finally:
        spark.conf.set(key, before)
