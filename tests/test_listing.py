"""Discovery in tasks: the same files as Spark's own listing, and folders that are left alone."""

import os
import time

import pytest
from conftest import rows

import siltbed as sb
from siltbed.plans.fixtures import age_files
from siltbed.sources.listing import _name_pattern, list_files, list_tree, listed_folders, listing_session

NAMES = [
    "2024/01/01/a.json", "2024/01/01/b c[1]%.json", "2024/01/02/deep/er/d.json", "2024/01/02/_hidden.json", "2024/01/02/.dot.json",
    "2024/01/02/_part=1/e.json", "2024/01/_staging/x.json", "2024/1.json", "top.json", "2025/12/31/é{1}.json", "2025/12/31/g.txt", "2025/12/31/h._COPYING_",
]


def files_of(tree):
    return rows(tree.where("file_path is not null"), "file_path", "modified", "length")


def test_the_same_files_as_spark(spark, spec, tmp_path):
    for k, name in enumerate(NAMES):
        path = tmp_path / "landing/crm/events" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x" * (k + 1))
    (tmp_path / "landing/crm/events/2024/01/01/empty.json").touch()
    for glob in (None, "*.json", "[a-d]*.{json,txt}", "?.txt"):
        want = rows(list_files(spark, spec.landing_dir, glob).where("length > 0"), "file_path", "modified", "length")
        assert files_of(list_tree(spark, spec.landing_dir, glob)) == want
    folders = list_tree(spark, spec.landing_dir).where("file_path is null")
    assert sorted(r.folder.split("events/")[1] for r in folders.collect()) == ["2024/01/01", "2024/01/02", "2025/12/31"]
    one = f"{spec.landing_dir}/top.json"
    assert files_of(list_tree(spark, one)) == rows(list_files(spark, one), "file_path", "modified", "length")


def test_no_root_and_unknown_scheme(spark, spec):
    assert list_tree(spark, spec.landing_dir).count() == 0
    assert list_tree(spark, f"{spec.landing_dir}/nothing", "*.json").columns == ["file_path", "modified", "length", "folder", "digest"]


def test_unchanged_folders_give_no_files(spark, spec, drop_file):
    for day in ("2024/01/01", "2024/01/02", "2024/01/03"):
        drop_file("a.json", '{"id":1}\n', day)
    known = spark.createDataFrame(
        [(r.folder, r.digest) for r in list_tree(spark, spec.landing_dir).where("file_path is null").collect()], "folder string, digest string"
    )
    assert files_of(list_tree(spark, spec.landing_dir, unchanged=known)) == []
    # One folder gets a file, in another a file is written again with the same length.
    drop_file("b.json", '{"id":2}\n', "2024/01/02")
    again = drop_file("a.json", '{"id":7}\n', "2024/01/03")
    os.utime(again, (time.time() + 5, time.time() + 5))
    found = list_tree(spark, spec.landing_dir, unchanged=known)
    assert sorted(r[0].split("2024/01/")[1] for r in files_of(found)) == ["02/a.json", "02/b.json", "03/a.json"]
    # Another name pattern is another listing.
    assert len(files_of(list_tree(spark, spec.landing_dir, "*.json", known))) == 4


@pytest.mark.parametrize("call", [sb.ingest, sb.ingest_stream])
def test_ingest_remembers_folders_while_files_stay(spark, spec, drop_file, call):
    drop_file("a.json", '{"id":1}\n', "2024/01/01")
    drop_file("b.json", '{"id":2}\n', "2024/01/02")
    call(spark, spec, "json", schema="id long", archive=False)
    assert listed_folders(spark, spec.folders_dir).count() == 2
    drop_file("c.json", '{"id":3}\n', "2024/01/02")
    call(spark, spec, "json", schema="id long", archive=False)
    call(spark, spec, "json", schema="id long", archive=False)
    assert rows(sb.read_bronze(spark, spec), "id") == [(1,), (2,), (3,)]
    # Archiving looks at all folders again, and forgets them.
    call(spark, spec, "json", schema="id long")
    assert listed_folders(spark, spec.folders_dir).count() == 0 and list_tree(spark, spec.landing_dir).where("file_path is not null").count() == 0
    assert rows(sb.read_bronze(spark, spec), "id") == [(1,), (2,), (3,)]


def test_a_file_that_comes_after_the_listing_is_not_lost(spark, spec, drop_file, monkeypatch):
    """Digests and manifest are of one look at landing, however long the call takes."""
    from siltbed.plans import ingest as module

    drop_file("a.json", '{"id":1}\n')
    plain = module.add_to_manifest

    def late(*args):
        drop_file("late.json", '{"id":2}\n')
        return plain(*args)

    monkeypatch.setattr(module, "add_to_manifest", late)
    sb.ingest(spark, spec, "json", schema="id long", archive=False)
    monkeypatch.setattr(module, "add_to_manifest", plain)
    sb.ingest(spark, spec, "json", schema="id long", archive=False)
    assert rows(sb.read_bronze(spark, spec), "id") == [(1,), (2,)]


def test_listing_runs_in_tasks(spark, spec, drop_file):
    drop_file("a.json", "{}")
    plan = list_tree(listing_session(spark), spec.landing_dir)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and plan.count("MapInArrow") == 2


def test_ages_or_raises(spark, spec, drop_file):
    files = list_files(spark, spec.landing_dir)
    with pytest.raises(ValueError, match="no files"):
        age_files(files, 3)
    with pytest.raises(ValueError, match="cannot be set"):
        age_files(spark.createDataFrame([("hdfs://nn/a",)], "file_path string"), 3)
    path = drop_file("a.json", "{}")
    assert age_files(list_files(spark, spec.landing_dir), 3) == 1 and path.stat().st_mtime < time.time() - 2 * 86400


@pytest.mark.parametrize("glob, name, same", [("*.json", "a.json", True), ("*.json", "a.json.gz", False), ("a?c", "abc", True), ("a.c", "abc", False), ("{a,b*}.x", "bcd.x", True), ("[a-c]", "d", False)])
def test_name_patterns(glob, name, same):
    import re

    assert bool(re.search(_name_pattern(glob), name)) == same
