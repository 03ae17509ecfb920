"""Raw archive: consumed landing files move to the raw zone under the same relative path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metadata import raw_file_name
from ..spec import DatasetSpec
from .files import MOVED_SCHEMA, move_files, same_system


def distinct_source_files(df: DataFrame) -> DataFrame:
    """The source files of ``df``, each once; rows without one are left out.

    Rows are reduced per task before the shuffle, so a file that holds most rows costs no more.
    """
    name = F.col("_ingested_filename")
    return df.select(name).where(name.isNotNull() & (name != "")).distinct()


def archive_files(
    spec: DatasetSpec, files: DataFrame, run: str, batch_id: int, *, not_after: Column | None = None
) -> DataFrame:
    """Move the landing files in column ``file_path`` to raw; returns the log of this batch.

    Each move runs in a task; where raw is on another file system it is a proven copy, and sources go once
    the copies are logged. A file changed later than ``not_after`` stays in landing, and
    an older file of the same name in raw is kept beside the new one. The log
    (``source, not_after, outcome, target``) is written once and read back, so evaluating the result
    again moves nothing.
    """
    spark = files.sparkSession
    target = raw_file_name(spec, F.col("file_path"))
    spare = F.regexp_replace(target, r"^(.*?)(\.[^./]*)?$", f"$1.{run[:8]}-{batch_id}$2")
    plan = files.select(
        F.col("file_path").alias("source"),
        target.alias("target"),
        spare.alias("spare"),
        (F.lit(None) if not_after is None else F.unix_millis(not_after)).cast("long").alias("not_after"),
    )
    log = f"{spec.archive_log_dir}/run={run}/batch={batch_id}"
    copies = None if same_system(spec.landing, spec.raw) else f"{spec.archive_log_dir}_copied/run={run}/batch={batch_id}"
    move_files(plan, copies).write.mode("overwrite").parquet(log)
    return spark.read.schema(MOVED_SCHEMA).parquet(log)
