"""Which landing files belong to which batch.

A file is known by path, modification time and length, so an overwritten file counts as new.
Entries are needed while their files are in landing; once these are archived they are
dropped, so the manifest does not outgrow landing. The archive log keeps the history.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.files import MOVED_SCHEMA, drop_dir
from ..spec import DatasetSpec
from ..tables import read_or_empty

FILE_KEY = ["file_path", "modified", "length"]
MANIFEST_SCHEMA = "file_path string, modified timestamp, length bigint, batch bigint, first bigint"


def read_manifest(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    return read_or_empty(spark, spec.manifest_dir, MANIFEST_SCHEMA).drop("first")


def new_files(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Listed files the manifest does not hold in this version."""
    return listing.join(manifest, FILE_KEY, "left_anti")


def still_listed(spec: DatasetSpec, pending: DataFrame, listing: DataFrame) -> DataFrame:
    """Pending manifest rows whose file is there in the same version, as a written table.

    Written, because evaluating the listing again while batches move files would change it.
    """
    path = f"{spec.manifest_dir}_found/left_over"
    pending.join(listing, FILE_KEY, "left_semi").write.mode("overwrite").parquet(path)
    return pending.sparkSession.read.schema(pending.schema).parquet(path)


def keep_listing(spec: DatasetSpec, listing: DataFrame) -> DataFrame:
    """The rows of a listing as a written table: what is derived from it is of one look at landing."""
    path = f"{spec.manifest_dir}_found/listing"
    listing.write.mode("overwrite").parquet(path)
    return listing.sparkSession.read.schema(listing.schema).parquet(path)


def keep_folders(spec: DatasetSpec, listing: DataFrame) -> None:
    """Remember the folders of a kept listing, once the manifest holds all of their files."""
    folders = listing.where("file_path is null and digest is not null").select("folder", "digest")
    folders.write.mode("overwrite").parquet(spec.folders_dir)


def add_to_manifest(
    spec: DatasetSpec, files: DataFrame, done: int, files_per_batch: int, bytes_per_batch: int
) -> DataFrame:
    """Assign ``files`` to new batches of about the given size; returns their rows.

    Batch numbers go on after ``done``, the last committed one. The assignment is written before anything is read, so a restart works on the same
    batches. ``files`` is evaluated once.
    """
    spark = files.sparkSession
    last = read_manifest(spark, spec).agg(F.max("batch")).first()[0]
    first = max(done, -1 if last is None else last) + 1
    found = f"{spec.manifest_dir}_found/first={first}"
    files.select(*FILE_KEY).write.mode("overwrite").parquet(found)
    rows = spark.read.schema("file_path string, modified timestamp, length bigint").parquet(found)
    n, size = rows.agg(F.count("*"), F.sum("length")).first()
    if n:
        batches = max(math.ceil(n / files_per_batch), math.ceil(size / bytes_per_batch))
        batch = F.lit(first) + F.pmod(F.xxhash64("file_path"), F.lit(batches))
        rows = rows.withColumn("batch", batch)
        if batches > 1:
            # Scans for one batch skip what others have, so reading them all is no look at everything for each.
            rows = rows.sort("batch")
        rows.write.mode("overwrite").parquet(f"{spec.manifest_dir}/first={first}")
    return read_manifest(spark, spec).where(F.col("batch") >= first)


def forget_archived(spec: DatasetSpec) -> None:
    """Drop the entries, once every file in them is committed and has left landing."""
    drop_dir(spec.folders_dir)
    drop_dir(spec.manifest_dir)
    drop_dir(f"{spec.manifest_dir}_found")


def file_states(spark: SparkSession, spec: DatasetSpec, last_committed: int) -> DataFrame:
    """``file_path, state, raw_file`` of all files ever listed.

    The state is pending, committed or archived; only archived files have a raw file.
    """
    log = read_or_empty(spark, spec.archive_log_dir, MOVED_SCHEMA).where("outcome = 'moved'")
    archived = log.groupBy("source", "not_after").agg(F.min("target").alias("raw_file"))
    there = read_manifest(spark, spec)
    moved = (there.file_path == archived.source) & (F.unix_millis(there.modified) == archived.not_after)
    state = F.when(F.col("batch") <= last_committed, "committed").otherwise("pending")
    left = there.join(archived, moved, "left_anti")
    return left.select("file_path", state.alias("state"), F.lit(None).cast("string").alias("raw_file")).unionByName(
        archived.select(F.col("source").alias("file_path"), F.lit("archived").alias("state"), "raw_file")
    )
