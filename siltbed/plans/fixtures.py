"""Landing files and Kafka frames derived from the given tables, for the registered queries."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.files import drop_dir, locate, move_files, put
from ..operators.land import TEXT_OPTIONS
from ..paths import encoded, qualify
from ..sources.listing import list_files
from ..spec import DatasetSpec
from ..tables import spread_out

# Rows per landing file where a query wants files of a known name.
FILE_ROWS = 10_000


def workspace(spark: SparkSession, datasource: str, dataset: str) -> DatasetSpec:
    """Zones and a database of their own below the folder the cluster shares, or its warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    unique = uuid.uuid4().hex[:12]
    root = f"{qualify(shared)}/siltbed-{unique}"
    return DatasetSpec(
        datasource, dataset, f"{root}/landing", f"{root}/raw", f"{root}/bronze", f"bronze_{unique}"
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def type_file(event_type: Column, event_id: Column) -> Column:
    """Name of the landing file of an event: its type and its block of ids."""
    return F.concat(event_type, F.lit("-"), F.floor(event_id / FILE_ROWS).cast("string"))


def land_events_by_type(spec: DatasetSpec, events: DataFrame, day: str = "2024/01/01") -> str:
    """Land JSON files named by :func:`type_file`, replacing files of the same name."""
    spark = events.sparkSession
    folder = f"{spec.landing_dir}/{day}"
    staging = f"{spec.landing}/_staging/{uuid.uuid4().hex}"
    named = events.withColumn("file", type_file(F.col("event_type"), F.col("event_id")))
    named.repartition("file").write.partitionBy("file").options(**TEXT_OPTIONS).json(staging)
    name = F.regexp_extract("file_path", r"/file=([^/]+)/[^/]*$", 1)
    moved = move_files(
        list_files(spark, staging, "part-*.json").select(
            F.col("file_path").alias("source"),
            F.concat(F.lit(encoded(folder) + "/"), name, F.lit(".json")).alias("target"),
            F.lit(None).cast("string").alias("spare"),
            F.lit(None).cast("long").alias("not_after"),
        )
    )
    moved.agg(F.count("*")).collect()
    drop_dir(staging)
    return folder


def grey_jpeg(width: int, height: int) -> bytes:
    """A baseline JPEG of one mid-grey: every block is the two-bit code for 'no change'."""

    def segment(marker: int, body: bytes) -> bytes:
        return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2) + body

    one_code = bytes([1] + [0] * 15) + b"\x00"
    bits = 2 * (-(-width // 8)) * (-(-height // 8))
    scan = bytearray(-(-bits // 8))
    if bits % 8:
        scan[-1] = 0xFF >> (bits % 8)
    frame = b"\x08" + height.to_bytes(2) + width.to_bytes(2) + b"\x01\x01\x11\x00"
    return (
        b"\xff\xd8"
        + segment(0xE0, b"JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00")
        + segment(0xDB, b"\x00" + bytes([1] * 64))
        + segment(0xC0, frame)
        + segment(0xC4, b"\x00" + one_code)
        + segment(0xC4, b"\x10" + one_code)
        + segment(0xDA, b"\x01\x01\x00\x00\x3f\x00")
        + bytes(scan)
        + b"\xff\xd9"
    )


def write_images(images: DataFrame) -> int:
    """Write a JPEG per row of ``path, width, height``; returns how many."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for r in rows.itertuples():
                fs, path = locate(r.path)
                put(fs, path, iter([grey_jpeg(r.width, r.height)]))
            yield pd.DataFrame({"n": [len(rows)]})

    spread = spread_out(images.select("path", "width", "height"))
    return spread.mapInPandas(write, "n long").agg(F.sum("n")).first()[0] or 0


def label_images(labels: DataFrame, folder: str, extension: Column | None = None) -> DataFrame:
    """``path, width, height`` of one picture per label row, sized by its id."""
    extension = F.lit("jpg") if extension is None else extension
    return labels.select(
        F.concat(
            F.lit(encoded(folder) + "/flower_photos/q"), F.col("quality").cast("string"), F.lit("/"),
            F.col("doc_id").cast("string"), F.lit("."), extension,
        ).alias("path"),
        (1 + F.col("doc_id") % 640).cast("int").alias("width"),
        (1 + F.col("doc_id") % 480).cast("int").alias("height"),
    )


def frames(df: DataFrame, topic: str, offset: str, value: Column) -> DataFrame:
    """Rows shaped as the Kafka source gives them."""
    return df.select(
        F.col(offset).cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.col(offset) % 4).cast("int").alias("partition"),
        F.col(offset).cast("long").alias("offset"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def stream_of(df: DataFrame, folder: str) -> DataFrame:
    """``df`` as a stream, by way of a written table."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.readStream.schema(df.schema).parquet(folder)


def age_files(files: DataFrame, days: int) -> int:
    """Set the modification time of files back; returns how many.

    Only local file systems let that be done; anywhere else it raises, so that no query takes
    files for old ones that are not.
    """

    def age(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for r in rows.itertuples():
                path = unquote(re.sub("^file:/+", "/", r.file_path))
                then = os.stat(path).st_mtime - days * 86400
                os.utime(path, (then, then))
            yield pd.DataFrame({"n": [len(rows)]})

    remote = files.where(~F.col("file_path").startswith("file:")).select("file_path").first()
    if remote:
        raise ValueError(f"the modification time of {remote.file_path} cannot be set")
    aged = files.select("file_path").mapInPandas(age, "n long").agg(F.sum("n")).first()[0]
    if not aged:
        raise ValueError("there are no files to set the modification time of")
    return aged
