"""Put data into the dated landing tree."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..paths import encoded, qualify
from ..sources.listing import list_files, listing_session
from ..spec import DatasetSpec
from .files import copy_files, drop_dir, move_files

# Text formats keep microseconds only when told to.
TEXT_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
WRITE_OPTIONS = {"json": TEXT_OPTIONS, "csv": {"delimiter": ";", **TEXT_OPTIONS}}

# Task and chunk number in the names Spark gives its output files.
PART = r"/part-(\d+)-[^/]*?(?:-c(\d+))?\.[^/]*$"


def _names(spec: DatasetSpec, now: dt.datetime | None) -> tuple[str, str]:
    """(dated directory, file name stem) for files landed at ``now`` (UTC).

    The time in the stem is in seconds, so it ends in a short unique part.
    """
    now = now or dt.datetime.now(dt.timezone.utc)
    name = f"{spec.datasource}-{spec.dataset}".replace("/", "-")
    return f"{spec.landing_dir}/{now:%Y/%m/%d}", f"{name}-{now:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"


def land_dataframe(
    df: DataFrame,
    spec: DatasetSpec,
    fmt: str,
    *,
    as_parquet: bool = False,
    options: dict[str, str] | None = None,
    now: dt.datetime | None = None,
) -> str:
    """Write ``df`` under ``{landing}/{datasource}/{dataset}/YYYY/MM/DD``; returns that folder.

    Every task lands files of its own, named
    ``{datasource}-{dataset}-{YYYYmmddHHMMSS}-{unique}-{part}.{fmt}``, when all are written.
    ``as_parquet`` writes a Parquet directory, replacing the one of that day.
    """
    spark = df.sparkSession
    folder, stem = _names(spec, now)
    if as_parquet:
        df.write.mode("overwrite").parquet(folder)
        return folder
    staging = f"{spec.landing}/_staging/{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).options(**WRITE_OPTIONS.get(fmt, {})).options(**(options or {})).save(staging)
        _publish(spark, staging, fmt, f"{folder}/{stem}")
    finally:
        drop_dir(staging)
    return folder


def _publish(spark: SparkSession, staged: str, fmt: str, target: str) -> None:
    """Rename the part files of a finished write to their landing names."""
    path = F.col("file_path")
    number = F.concat(F.lit("-"), F.regexp_extract(path, PART, 1), F.regexp_extract(path, PART, 2))
    moved = move_files(
        list_files(listing_session(spark), staged, f"part-*.{fmt}").select(
            path.alias("source"),
            F.concat(F.lit(encoded(target)), number, F.lit(f".{fmt}")).alias("target"),
            F.lit(None).cast("string").alias("spare"),
            F.lit(None).cast("long").alias("not_after"),
        )
    )
    n, failed = moved.agg(F.count("*"), F.count_if(F.col("outcome") != "moved")).first()
    if failed or not n:
        raise FileNotFoundError(f"{failed} of {n} staged .{fmt} files could not be landed")


def land_images(
    spark: SparkSession, source: str, spec: DatasetSpec, fmt: str = "jpg", *, now: dt.datetime | None = None
) -> DataFrame:
    """Copy the images below ``source`` (a file or directory) to dated landing names.

    Returns ``source, target, size`` of every copy. Names are derived from the source path,
    so running a task again replaces its own copy.
    """
    folder, stem = _names(spec, now)
    files = list_files(listing_session(spark), qualify(source), f"*.{fmt}").select(
        F.col("file_path").alias("source"),
        F.concat(
            F.lit(encoded(f"{folder}/{stem}-")), F.sha2("file_path", 256), F.lit(f".{fmt}")
        ).alias("target"),
    )
    log = f"{spec.bronze}/{spec.datasource}/{spec.dataset}_landed/{stem}"
    copy_files(files).write.parquet(log)
    return spark.read.parquet(log)
