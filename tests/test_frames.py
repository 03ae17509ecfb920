"""Kafka frames."""

import json

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import siltbed as sb
from siltbed.functions.frames import registry_body, registry_schema_id

FRAME = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
AVRO = json.dumps({"type": "record", "name": "r", "fields": [
    {"name": "id", "type": "long"}, {"name": "value", "type": ["null", "string"]},
]})
PREFIXED = ["_key", "_value", "_topic", "_partition", "_offset", "_timestamp", "_timestampType", "_ingested_at"]


def frames(spark, *values, topic="t"):
    data = [(b"k", v and bytearray(v), topic, 0, i, None, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(data, FRAME)


def test_json_columns_and_value_field(spark):
    df = sb.add_kafka_metadata(
        frames(spark, b'{"id":1,"value":"v"}'), schema_format="json", schema="id long, value string"
    )
    assert df.columns == [*PREFIXED, "id", "value"]
    assert rows(df, "id", "value") == [(1, "v")]


def test_json_bad_payload(spark):
    df = sb.add_kafka_metadata(frames(spark, b"bad", None), schema_format="json", schema="id long")
    assert rows(df, "_offset", "id") == [(0, None), (1, None)]
    assert bytes(df.where("_offset = 0").first()["_value"]) == b"bad"


def test_json_clash(spark):
    with pytest.raises(ValueError, match="_topic"):
        sb.add_kafka_metadata(frames(spark, b"{}"), schema_format="json", schema="_topic string")


def test_json_clash_is_without_case(spark):
    with pytest.raises(ValueError, match="_TOPIC"):
        sb.add_kafka_metadata(frames(spark, b"{}"), schema_format="json", schema="_TOPIC string")


def test_registry_frame(spark):
    df = sb.prefix_columns(frames(spark, b"\0\0\0\1\7body", b"\0\0\0\0\0", None))
    got = df.select("_offset", registry_schema_id(F.col("_value")).alias("id"), registry_body(F.col("_value")).alias("body"))
    assert [(o, i, b and bytes(b)) for o, i, b in rows(got, "_offset", "id", "body")] == [(0, 263, b"body"), (1, 0, b""), (2, None, None)]


@pytest.mark.parametrize("value", [b"\x01\0\0\0\7\2", b"", b"\0\0"])
def test_registry_magic(spark, value):
    with pytest.raises(Exception, match="not registry-framed"):
        sb.prefix_columns(frames(spark, value)).select(registry_body(F.col("_value"))).collect()


def test_avro_asks_spark_for_its_module(spark):
    """Without the Avro module Spark says so."""
    with pytest.raises(Exception, match="(?i)avro"):
        sb.add_kafka_metadata(frames(spark, b"\0\0\0\0\7x"), schema_format="avro", schema=AVRO).collect()


def test_multiplex(spark):
    both = frames(spark, b"1", topic="a").unionByName(frames(spark, b"2", topic="b"))
    df = sb.add_kafka_metadata(both, method="multiplex")
    assert df.columns == PREFIXED
    assert [(t, bytes(v)) for t, v in rows(df, "_topic", "_value")] == [("a", b"1"), ("b", b"2")]


@pytest.mark.parametrize("args", [
    {"method": "other"}, {"schema_format": "xml"}, {"method": "singleplex"},
])
def test_unsupported(spark, args):
    with pytest.raises(ValueError, match="not supported"):
        sb.read_kafka_stream(spark, {}, **args)
    with pytest.raises(ValueError, match="not supported"):
        sb.add_kafka_metadata(frames(spark, b"{}"), **args)


def test_reader_asks_spark_for_kafka(spark):
    """Without the Kafka module Spark says so; with it there is no broker to reach here."""
    with pytest.raises(AnalysisException, match="kafka"):
        sb.read_kafka_stream(spark, {"subscribe": "t"}, schema_format="json", schema="id long")


def test_decoding_stays_in_generated_code(spark, capsys):
    df = sb.add_kafka_metadata(frames(spark, b"{}"), schema_format="json", schema="id long")
    df.explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan.replace("PythonRDD", "")
