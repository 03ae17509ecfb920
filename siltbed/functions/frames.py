"""Kafka frames: prefix, decode and flatten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.avro.functions import from_avro

_PAYLOAD = "__payload"


def prefix_columns(df: DataFrame) -> DataFrame:
    """Every column ``c`` as ``_c``."""
    return df.select(*[F.col(f"`{c}`").alias(f"_{c}") for c in df.columns])


def _flatten(df: DataFrame, payload: Column) -> DataFrame:
    # The payload sits under a reserved name, so a payload field of any name survives.
    wide = df.withColumn(_PAYLOAD, payload)
    fields = wide.schema[_PAYLOAD].dataType.fieldNames()
    # Spark compares names without case.
    taken = {c.lower() for c in df.columns}
    clash = sorted(f for f in fields if f.lower() in taken)
    if clash:
        raise ValueError(f"payload fields clash with frame columns: {clash}")
    return wide.select(*[F.col(f"`{c}`") for c in df.columns], f"{_PAYLOAD}.*")


def decode_json(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Payload fields of ``_value``; a payload that is not JSON gives nulls."""
    return _flatten(df, F.from_json(F.col("_value").cast("string"), schema))


def registry_schema_id(value: Column) -> Column:
    """The schema id in bytes 2-5 of a registry-framed value."""
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")


def registry_body(value: Column) -> Column:
    """The bytes behind the 5-byte registry header; raises when byte 1 is not zero."""
    body = F.substring(value, F.lit(6), F.length(value) - 5)
    framed = (F.substring(value, 1, 1) == F.lit(b"\x00")) & (F.length(value) >= 5)
    wrong = F.raise_error(F.lit("value is not registry-framed: first byte is not 0"))
    return F.when(value.isNull() | framed, body).otherwise(wrong.cast("binary"))


def decode_avro(df: DataFrame, schema: str, *, schema_id: bool = False) -> DataFrame:
    """Payload fields of registry-framed Avro in ``_value``; needs Spark's Avro module.

    ``schema_id`` keeps the writer's schema id as ``_schema_id``.
    """
    if schema_id:
        df = df.withColumn("_schema_id", registry_schema_id(F.col("_value")))
    return _flatten(df, from_avro(registry_body(F.col("_value")), schema))


def add_kafka_metadata(
    df: DataFrame,
    *,
    method: str = "singleplex",
    schema_format: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Frame columns with a ``_`` prefix, ingest time, then the payload fields.

    Multiplex frames of several topics stay undecoded.
    """
    frames = prefix_columns(df).withColumn("_ingested_at", F.current_timestamp())
    if method == "multiplex":
        return frames
    if method == "singleplex" and schema_format == "json":
        return decode_json(frames, schema)
    if method == "singleplex" and schema_format == "avro":
        return decode_avro(frames, schema)
    raise ValueError(f"not supported: method {method!r} with schema format {schema_format!r}")
