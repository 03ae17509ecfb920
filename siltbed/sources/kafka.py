"""Kafka topics as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.frames import add_kafka_metadata

METHODS = ("singleplex", "multiplex")
SCHEMA_FORMATS = ("json", "avro")


def read_kafka_stream(
    spark: SparkSession,
    options: dict[str, str],
    *,
    method: str = "singleplex",
    schema_format: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Stream of one topic decoded by ``schema`` (singleplex), or of raw frames (multiplex).

    ``options`` go to the Kafka source unchanged, rate limits and ``minPartitions`` included.
    """
    if method not in METHODS:
        raise ValueError(f"method {method!r} is not supported; choose one of {METHODS}")
    if method == "singleplex" and schema_format not in SCHEMA_FORMATS:
        raise ValueError(f"schema format {schema_format!r} is not supported; choose one of {SCHEMA_FORMATS}")
    frames = spark.readStream.format("kafka").options(**options).load()
    return frames.transform(
        add_kafka_metadata, method=method, schema_format=schema_format, schema=schema
    )
