"""Moves between file systems: proven copies, and sources that go after the log."""

import os
import time

import pandas as pd
import pyarrow.fs as pafs
import pytest

from siltbed.operators import files


@pytest.fixture
def two_systems(monkeypatch, tmp_path):
    """``file:`` URIs, and ``other:`` ones in a file system of its own."""
    plain = files.locate
    (tmp_path / "other").mkdir()
    other = pafs.SubTreeFileSystem(str(tmp_path / "other"), pafs.LocalFileSystem())
    monkeypatch.setattr(files, "locate", lambda uri: (other, uri.removeprefix("other:/")) if uri.startswith("other:") else plain(uri))
    path = tmp_path / "a.json"
    path.write_bytes(b"0123456789" * 1000)
    return f"file:{path}", "other:/raw/a.json", tmp_path / "other/raw/a.json"


def moved(source, target, spare=None, not_after=None):
    """Both steps, as the tasks do them."""
    plan = pd.DataFrame([(source, target, spare, not_after)], columns=["source", "target", "spare", "not_after"])
    log = next(files._move_batches(iter([plan])))
    return log, next(files._drop_batches(iter([log]))).outcome[0]


def test_source_goes_after_the_log(two_systems):
    source, target, path = two_systems
    assert files.move_file(source, target) == ("copied", target)
    assert os.path.exists(source[5:]) and path.read_bytes() == b"0123456789" * 1000
    log, outcome = moved(source, target)
    assert outcome == "moved" and log["size"][0] == 10_000 and not os.path.exists(source[5:])
    # Again, as a task does that is tried twice, with the log and without.
    assert next(files._drop_batches(iter([log]))).outcome[0] == "moved"
    assert moved(source, target)[1] == "moved"


def test_copy_that_is_cut_short(two_systems, monkeypatch):
    source, target, path = two_systems
    plain, calls = files._chunks, []

    def short(fs, name):
        calls.append(name)
        yield next(plain(fs, name))[:5]

    with monkeypatch.context() as patch:
        patch.setattr(files, "_chunks", short)
        with pytest.raises(OSError, match="cut short"):
            files.move_file(source, target)
    assert os.path.exists(source[5:])
    # What the attempt left is no copy: the file goes under its other name, or in place without one.
    assert files.move_file(source, target, "other:/raw/a.2.json") == ("copied", "other:/raw/a.2.json")
    assert files.move_file(source, target) == ("copied", target) and path.stat().st_size == 10_000


def test_target_that_lost_bytes(two_systems, monkeypatch):
    source, target, path = two_systems
    plain = files.put
    with monkeypatch.context() as patch:
        patch.setattr(files, "put", lambda fs, to, chunks: plain(fs, to, (bytes(c[:-1]) + b"x" for c in chunks)))
        with pytest.raises(OSError, match="not the 10000"):
            files.move_file(source, target)
    assert os.path.exists(source[5:])
    log, outcome = moved(source, target)
    assert outcome == "moved"


def test_target_gone_or_source_changed_before_the_drop(two_systems):
    source, target, path = two_systems
    plan = pd.DataFrame([(source, target, None, None)], columns=["source", "target", "spare", "not_after"])
    log = next(files._move_batches(iter([plan])))
    path.rename(path.with_name("elsewhere"))
    assert next(files._drop_batches(iter([log]))).outcome[0] == "copied" and os.path.exists(source[5:])
    path.with_name("elsewhere").rename(path)
    with open(source[5:], "r+b") as f:  # the same length, other bytes
        f.write(b"x")
    assert next(files._drop_batches(iter([log]))).outcome[0] == "changed" and os.path.exists(source[5:])


def test_changed_and_missing_files(two_systems):
    source, target, path = two_systems
    assert moved(source, target, not_after=int(time.time() * 1000) - 10_000_000)[1] == "changed"
    assert not path.exists()
    assert moved("file:/nowhere/x", "other:/raw/x")[1] == "missing"


def test_other_file_of_the_name(two_systems):
    source, target, path = two_systems
    path.parent.mkdir()
    path.write_text("old")
    log, outcome = moved(source, target, "other:/raw/a.spare.json")
    assert outcome == "moved" and log.target[0] == "other:/raw/a.spare.json" and path.read_text() == "old"


def test_archive_between_systems(spark, spec, drop_file, monkeypatch, tmp_path):
    """The whole way, with the two steps of another file system on one."""
    import siltbed as sb
    from conftest import rows
    from siltbed.operators import archive

    monkeypatch.setattr(archive, "same_system", lambda *_: False)
    for k in range(5):
        drop_file(f"{k}.json", f'{{"id":{k}}}\n')
    sb.ingest(spark, spec, "json", schema="id long")
    assert rows(sb.read_bronze(spark, spec), "id") == [(k,) for k in range(5)]
    assert len(list((tmp_path / "raw").rglob("*.json"))) == 5 and not list((tmp_path / "landing").rglob("*.json"))


def test_systems():
    assert files.same_system("s3a://b/x", "s3a://b/y") and files.same_system("file:/a", "file:///b")
    assert not files.same_system("s3a://b/x", "s3a://c/x") and not files.same_system("file:/a", "hdfs://nn/a")
