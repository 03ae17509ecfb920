"""Landing writers and file moves."""

import datetime as dt
import re

import pytest
from conftest import rows

import siltbed as sb
from siltbed.operators import files

NOW = dt.datetime(2024, 5, 6, 7, 8, 9, tzinfo=dt.timezone.utc)


def names(folder):
    from pathlib import Path

    return sorted(p.name for p in Path(folder.removeprefix("file:")).iterdir() if p.name[0] not in "._")


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_part_files_with_dated_names(spark, spec, fmt, tmp_path):
    folder = sb.land_dataframe(spark.range(0, 100, 1, 5), spec, fmt, now=NOW)
    assert folder == f"{spec.landing_dir}/2024/05/06"
    landed = names(folder)
    assert len(landed) == 5
    assert all(re.fullmatch(rf"crm-events-20240506070809-[0-9a-f]{{8}}-\d{{5}}\d*\.{fmt}", n) for n in landed)
    assert sb.read_landing_files(spark, spec, fmt).count() == 100
    assert not list((tmp_path / "landing/_staging").iterdir())


def test_same_second_does_not_collide(spark, spec):
    for _ in range(2):
        folder = sb.land_dataframe(spark.range(3), spec, "json", now=NOW)
    assert len({n.rsplit('-', 1)[0] for n in names(folder)}) == 2


def test_parquet_directory_replaces_that_day(spark, spec):
    sb.land_dataframe(spark.range(9), spec, "json", as_parquet=True, now=NOW)
    folder = sb.land_dataframe(spark.range(3), spec, "json", as_parquet=True, now=NOW)
    assert spark.read.parquet(folder).count() == 3


def test_csv_keeps_microseconds_and_delimiter(spark, spec, tmp_path):
    df = spark.sql("SELECT 1 AS a, TIMESTAMP_NTZ'2024-01-01 00:00:00.123456' AS t")
    sb.land_dataframe(df, spec, "csv")
    (file,) = (tmp_path / "landing").rglob("*.csv")
    assert file.read_text() == "1;2024-01-01T00:00:00.123456\n"
    assert rows(sb.read_landing_files(spark, spec, "csv", schema="a int, t timestamp_ntz"), "a", "t") == rows(df, "a", "t")


def test_unknown_format_is_raised(spark, spec):
    with pytest.raises(Exception, match="nosuch"):
        sb.land_dataframe(spark.range(1), spec, "nosuch")


def test_nothing_to_land_is_raised(spark, spec):
    with pytest.raises(FileNotFoundError):
        sb.land_dataframe(spark.range(3), spec, "json", options={"compression": "gzip"})


def test_images(spark, spec, tmp_path):
    source = tmp_path / "camera one/x"
    source.mkdir(parents=True)
    (source / "a b.jpg").write_bytes(b"one")
    (source / "c.jpg").write_bytes(b"three")
    (source / "d.png").write_bytes(b"no")
    copies = sb.land_images(spark, str(tmp_path / "camera one"), spec, now=NOW)
    assert rows(copies, "size") == [(3,), (5,)]
    landed = names(f"{spec.landing_dir}/2024/05/06")
    assert len(landed) == 2
    assert all(re.fullmatch(r"crm-events-20240506070809-[0-9a-f]{8}-[0-9a-f]{64}\.jpg", n) for n in landed)
    assert copies.count() == 2 and (source / "a b.jpg").exists()


def test_one_image(spark, spec, tmp_path):
    (tmp_path / "a.jpg").write_bytes(b"one")
    assert sb.land_images(spark, str(tmp_path / "a.jpg"), spec).count() == 1


def test_move_twice(tmp_path):
    (tmp_path / "a").write_text("x")
    source, target = f"file:{tmp_path}/a", f"file:{tmp_path}/deep/er/b"
    assert files.move_file(source, target) == ("moved", target)
    assert files.move_file(source, target) == ("moved", target)
    assert (tmp_path / "deep/er/b").read_text() == "x"


def test_move_missing_and_changed(tmp_path):
    missing = f"file:{tmp_path}/none"
    assert files.move_file(missing, f"file:{tmp_path}/x")[0] == "missing"
    (tmp_path / "a").write_text("x")
    assert files.move_file(f"file:{tmp_path}/a", f"file:{tmp_path}/b", not_after=1)[0] == "changed"
    assert (tmp_path / "a").exists()


def test_move_to_spare_name(tmp_path):
    (tmp_path / "a").write_text("new")
    (tmp_path / "b").write_text("old")
    args = f"file:{tmp_path}/a", f"file:{tmp_path}/b", f"file:{tmp_path}/b.2"
    assert files.move_file(*args) == files.move_file(*args) == ("moved", args[2])
    assert (tmp_path / "b").read_text() == "old" and (tmp_path / "b.2").read_text() == "new"
