"""Streams into bronze: faults, archive, evolution."""

import itertools
import os
import time

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import siltbed as sb
from siltbed.operators.bronze import BronzeTable
from siltbed.streaming import sink as module

SCHEMA = "id long"


def run(spark, spec, **options):
    stream = sb.read_landing_stream(spark, spec, "json", schema=SCHEMA, max_files=2)
    sb.start_bronze_query(stream, spec, **options).awaitTermination()


@pytest.mark.parametrize("cache", [False, True])
@pytest.mark.parametrize("point", ["write", "commit", "archive", "archived"])
@pytest.mark.parametrize("nth", [0, 1])
def test_fault_and_restart(spark, spec, drop_file, tmp_path, monkeypatch, point, nth, cache):
    for i in range(5):
        drop_file(f"{i}.json", f'{{"id":{i}}}\n')
    calls = itertools.count()
    owner, name = {
        "write": (BronzeTable, "write"), "commit": (BronzeTable, "commit"),
        "archive": (module, "archive_files"), "archived": (module, "archive_files"),
    }[point]
    real = getattr(owner, name)

    def stop(*args, **kwargs):
        if next(calls) == nth:
            if point == "archived":
                real(*args, **kwargs)
            raise RuntimeError("stopped")
        return real(*args, **kwargs)

    monkeypatch.setattr(owner, name, stop)
    with pytest.raises(StreamingQueryException):
        run(spark, spec, cache=cache)
    run(spark, spec, cache=cache)
    assert rows(sb.read_bronze(spark, spec), "id") == [(i,) for i in range(5)]
    assert not list((tmp_path / "landing").rglob("*.json"))
    assert len(list((tmp_path / "raw").rglob("*.json"))) == 5


def test_write_error_is_raised_and_nothing_is_archived(spark, spec, drop_file):
    path = drop_file("a.json", '{"id":1}\n')
    BronzeTable(spark, spec).append(spark.sql("SELECT 'x' AS id"), "r", 0)
    with pytest.raises(StreamingQueryException, match="SchemaMismatch"):
        run(spark, spec)
    assert path.exists()


def test_names_and_checkpoint(spark, spec, drop_file, tmp_path):
    drop_file("a.json", '{"id":1}\n')
    stream = sb.read_landing_stream(spark, spec, "json", schema=SCHEMA)
    query = sb.start_bronze_query(stream, spec)
    query.awaitTermination()
    assert query.name == "bronze-crm-events"
    assert (tmp_path / "bronze/crm/events_checkpoint/commits").exists()


def test_kafka_rows_are_not_archived(spark, spec, monkeypatch, tmp_path):
    frame = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
    data = [(None, bytearray(b'{"id":1}'), "t", 0, 0, None, 0)]
    spark.createDataFrame(data, frame).write.parquet(str(tmp_path / "frames"))
    frames = spark.readStream.schema(frame).parquet(str(tmp_path / "frames"))
    monkeypatch.setattr(module, "archive_files", lambda *a, **k: pytest.fail("archived"))
    stream = sb.add_kafka_metadata(frames, schema_format="json", schema=SCHEMA)
    sb.start_bronze_query(stream, spec, archive=False).awaitTermination()
    assert rows(sb.read_bronze(spark, spec), "_topic", "_offset", "id") == [("t", 0, 1)]


def test_column_that_arrives_while_the_stream_runs(spark, spec, drop_file):
    """The first reader does not know the column of the second micro-batch."""
    drop_file("a.json", '{"id":1}\n')
    sb.ingest_stream(spark, spec, "json", merge_schema=True, archive=False)
    for i, text in enumerate(['{"id":2}\n', '{"id":3,"n":"x"}\n', '{"id":4,"m":true}\n']):
        drop_file(f"b{i}.json", text)
    sb.ingest_stream(spark, spec, "json", merge_schema=True, max_files=1)
    got = rows(sb.read_bronze(spark, spec), "id", "n", "m")
    assert got == [(1, None, None), (2, None, None), (3, "x", None), (4, None, True)]


def test_first_schema_comes_from_all_files(spark, spec, drop_file):
    """Columns and wider types that only later files have are there from the first batch on."""
    for i, text in enumerate(['{"id":1}\n', '{"id":2,"n":"x"}\n', '{"id":2.5}\n']):
        drop_file(f"{i}.json", text)
    sb.ingest_stream(spark, spec, "json", merge_schema=True, max_files=1)
    assert rows(sb.read_bronze(spark, spec), "id", "n") == [(1.0, None), (2.0, "x"), (2.5, None)]


def test_nothing_to_read(spark, spec):
    assert sb.ingest_stream(spark, spec, "json") is None


def test_file_written_again_and_late_file(spark, spec, drop_file, tmp_path):
    """The stream reads a name again after its file was archived, and a file of any age."""
    for text in ('{"id":1}\n', '{"id":2}\n'):
        drop_file("a.json", text)
        sb.ingest_stream(spark, spec, "json", schema=SCHEMA)
    late = drop_file("late.json", '{"id":3}\n')
    os.utime(late, (time.time() - 40 * 86400,) * 2)
    sb.ingest_stream(spark, spec, "json", schema=SCHEMA)
    assert rows(sb.read_bronze(spark, spec), "id") == [(1,), (2,), (3,)]
    assert not list((tmp_path / "landing").rglob("*.json"))


def test_stream_and_batch_read_nothing_twice(spark, spec, drop_file):
    drop_file("a.json", '{"id":1}\n')
    sb.ingest_stream(spark, spec, "json", schema=SCHEMA, archive=False)
    assert sb.ingest(spark, spec, "json", schema=SCHEMA, archive=False) == 0
    drop_file("b.json", '{"id":2}\n')
    assert sb.ingest(spark, spec, "json", schema=SCHEMA, archive=False) == 1
    assert sb.ingest_stream(spark, spec, "json", schema=SCHEMA, archive=False) is None
    assert rows(sb.read_bronze(spark, spec), "id") == [(1,), (2,)]


def test_files_without_rows_are_archived(spark, spec, drop_file, tmp_path):
    drop_file("a.json", '{"id":1}\n')
    drop_file("blank.json", "\n\n")
    sb.ingest_stream(spark, spec, "json", schema=SCHEMA)
    assert rows(sb.read_bronze(spark, spec), "id") == [(1,)]
    assert not list((tmp_path / "landing").rglob("*.json"))


@pytest.mark.parametrize("point", ["write", "commit"])
def test_stopped_manifest_stream_goes_on(spark, spec, drop_file, monkeypatch, point):
    for i in range(5):
        drop_file(f"{i}.json", f'{{"id":{i}}}\n')
    real = getattr(BronzeTable, point)
    calls = itertools.count()

    def stop(*args):
        if next(calls) == 1:
            raise RuntimeError("stopped")
        return real(*args)

    monkeypatch.setattr(BronzeTable, point, stop)
    with pytest.raises(StreamingQueryException):
        sb.ingest_stream(spark, spec, "json", schema=SCHEMA, max_files=1)
    sb.ingest_stream(spark, spec, "json", schema=SCHEMA, max_files=1)
    assert rows(sb.read_bronze(spark, spec), "id") == [(i,) for i in range(5)]


def test_new_column_without_merging_stops_the_stream(spark, spec, drop_file):
    drop_file("a.json", '{"id":1}\n')
    sb.ingest_stream(spark, spec, "json")
    path = drop_file("b.json", '{"id":2,"n":"x"}\n')
    with pytest.raises(StreamingQueryException, match="merge_schema is off"):
        sb.ingest_stream(spark, spec, "json")
    assert path.exists()
    assert rows(sb.read_bronze(spark, spec), "id") == [(1,)]


def test_batch_is_evaluated_once(spark, spec, drop_file):
    """File names for the archive come from the table, not from the batch."""
    for i in range(3):
        drop_file(f"{i}.json", f'{{"id":{i}}}\n')
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def count(x):
        seen.add(1)
        return x

    stream = sb.read_landing_stream(spark, spec, "json", schema=SCHEMA)
    counted = stream.withColumn("id", count("id"))
    sb.start_bronze_query(counted, spec).awaitTermination()
    assert seen.value == 3


def test_partitioned_stream(spark, spec, drop_file):
    drop_file("a.json", '{"id":1}\n{"id":2}\n')
    stream = sb.read_landing_stream(spark, spec, "json", schema=SCHEMA).withColumn("c", F.col("id") % 2)
    sb.start_bronze_query(stream, spec, partition_by="c").awaitTermination()
    assert rows(sb.read_bronze(spark, spec).where("c = 1"), "id") == [(1,)]
