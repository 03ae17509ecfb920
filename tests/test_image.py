"""Image source and the header reader."""

import pytest
from conftest import rows

import siltbed as sb
from siltbed.functions import image
from siltbed.plans.fixtures import grey_jpeg
from siltbed.sources import landing
from siltbed.tables import io_tasks

FOLDER = "flower_photos/daisy"


def test_jpg_contract(spark, spec, drop_file):
    drop_file("a.jpg", grey_jpeg(40, 30), FOLDER)
    drop_file("b.jpg", grey_jpeg(7, 9), FOLDER)
    drop_file("x.jpg", b"notjpeg", FOLDER)
    drop_file("c.png", grey_jpeg(1, 1), FOLDER)
    df = sb.read_landing_files(spark, spec, "jpg")
    assert df.columns == [
        "_ingested_at", "_ingested_filename", "_label", "_size",
        "path", "modificationTime", "length", "content",
    ]
    assert df.schema["_size"].dataType.simpleString() == "struct<width:int,height:int>"
    assert rows(df, "_label", "_size.width", "_size.height") == [
        ("daisy", 40, 30), ("daisy", 7, 9), ("daisy", None, None)
    ]


@pytest.mark.parametrize("size", [(1, 1), (8, 8), (9, 17), (640, 480), (33, 65)])
def test_header_agrees_with_image_source(spark, tmp_path, size):
    (tmp_path / "a.jpg").write_bytes(grey_jpeg(*size))
    seen = spark.read.format("image").load(str(tmp_path)).select("image.width", "image.height").first()
    assert tuple(seen) == size == image.frame_size(grey_jpeg(*size))


@pytest.mark.parametrize("cut", range(0, 700, 7))
def test_truncated_header_gives_none(cut):
    data = grey_jpeg(40, 30)
    assert image.frame_size(data[:cut]) in (None, (40, 30))


def test_header_behind_large_segments(spark):
    """The frame header may lie behind the part that is looked at first."""
    data = grey_jpeg(40, 30)
    extra = b"\xff\xe2" + (65535).to_bytes(2) + b"\x00" * 65533
    far = data[:2] + extra * 3 + data[2:]
    assert len(far) > image.HEAD_BYTES * 4
    df = spark.createDataFrame([(1, bytearray(far)), (2, bytearray(data)), (3, None)], "id int, content binary")
    got = rows(df.withColumn("s", sb.jpeg_size(df.content)), "id", "s.width", "s.height")
    assert got == [(1, 40, 30), (2, 40, 30), (3, None, None)]


def test_fill_bytes_and_bare_markers():
    data = grey_jpeg(40, 30)
    assert image.frame_size(data[:2] + b"\xff\xff" + data[3:]) == (40, 30)
    assert image.frame_size(data[:2] + b"\xff\x01" + data[2:]) == (40, 30)
    assert image.frame_size(None) is None


def test_ingested_pictures_are_what_the_reader_gives(spark, spec, drop_file, monkeypatch):
    """The driver hands no file names to a reader, whatever the names and sizes are."""
    for k, name in enumerate(("a.jpg", "b c.jpg", "50%25.jpg", "[d]{e}.jpg", "\u00fc#?.jpg")):
        drop_file(name, grey_jpeg(8 + k, 9), FOLDER)
    drop_file("broken.jpg", b"\xff\xd8\xff", FOLDER)
    drop_file("large.jpg", grey_jpeg(5, 6) + bytes(3 << 20), "flower_photos/rose")
    # A frame header behind more bytes than the head of a picture has.
    late = b"\xff\xd8" + (b"\xff\xe1\xff\xff" + bytes(65533)) * 2 + grey_jpeg(70, 80)[2:]
    drop_file("late.jpg", late, "flower_photos/rose")
    drop_file("c.png", grey_jpeg(1, 1), FOLDER)
    columns = ["_ingested_filename", "_label", "_size", "path", "modificationTime", "length", "content"]
    seen = rows(sb.read_landing_files(spark, spec, "jpg"), *columns)
    assert len(seen) == 8
    schema = sb.read_landing_files(spark, spec, "jpg").schema
    monkeypatch.setattr(landing, "load_path", None)
    monkeypatch.setattr(landing, "NAMED_ROWS", 3)
    monkeypatch.setattr(landing, "NAMED_BYTES", 1000)
    sb.ingest(spark, spec, "jpg", files_per_batch=3, archive=False)
    made = sb.read_bronze(spark, spec)
    assert rows(made, *columns) == seen
    assert [(f.name, f.dataType) for f in made.schema] == [(f.name, f.dataType) for f in schema]


def test_small_pictures_take_few_tasks(spark, spec, drop_file):
    """As many files of bronze as tasks that names are dealt to, not one for some dozen pictures."""
    most = io_tasks(spark)
    for k in range(40 * most):
        drop_file(f"{k}.jpg", grey_jpeg(8, 8), FOLDER)
    sb.ingest_stream(spark, spec, "jpg", archive=False)
    made = sb.read_bronze(spark, spec)
    assert made.count() == 40 * most
    assert made.select("_metadata.file_path").distinct().count() <= most


def test_batches_are_apart_in_the_manifest(spark, spec, drop_file):
    """A scan for one batch can skip the others."""
    for k in range(200):
        drop_file(f"{k}.jpg", grey_jpeg(8, 8), FOLDER)
    sb.ingest(spark, spec, "jpg", files_per_batch=20, archive=False)
    entries = spark.read.parquet(spec.manifest_dir).select("batch", "_metadata.file_path")
    batches = [r.batch for r in entries.coalesce(1).collect()]
    assert len(set(batches)) == 10
    assert sum(a != b for a, b in zip(batches, batches[1:])) == 9
