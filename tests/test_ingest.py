"""Incremental ingestion with a manifest."""

import itertools
import os
import time
from collections import Counter

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import siltbed as sb
from siltbed.operators.bronze import BronzeTable
from siltbed.plans.ingest import RUN
from siltbed.sources import manifest

SCHEMA = "id long, x double"


def states(spark, spec):
    last = BronzeTable(spark, spec).committed.get(RUN, -1)
    df = manifest.file_states(spark, spec, last)
    return Counter(r.state for r in df.collect())


def later(path):
    """Make a rewrite visible on file systems with coarse times."""
    now = time.time() + 2
    os.utime(path, (now, now))


def test_only_new_files(spark, spec, drop_file):
    drop_file("a.json", '{"id":1}\n')
    assert sb.ingest(spark, spec, "json", schema=SCHEMA, archive=False) == 1
    assert sb.ingest(spark, spec, "json", schema=SCHEMA, archive=False) == 0
    drop_file("b.json", '{"id":2}\n')
    assert sb.ingest(spark, spec, "json", schema=SCHEMA, archive=False) == 1
    assert rows(sb.read_bronze(spark, spec), "id") == [(1,), (2,)]
    assert states(spark, spec) == {"committed": 2}


def test_overwritten_file_is_appended_again(spark, spec, drop_file):
    drop_file("a.json", '{"id":1,"x":1}\n{"id":2,"x":2}\n')
    sb.ingest(spark, spec, "json", schema=SCHEMA, archive=False)
    later(drop_file("a.json", '{"id":1,"x":99}\n'))
    sb.ingest(spark, spec, "json", schema=SCHEMA, archive=False)
    assert rows(sb.read_bronze(spark, spec), "id", "x") == [(1, 1.0), (1, 99.0), (2, 2.0)]


def test_landing_that_does_not_exist(spark, spec):
    assert sb.ingest(spark, spec, "json", schema=SCHEMA) == 0


def test_many_batches_with_archive(spark, spec, drop_file, tmp_path):
    for i in range(12):
        drop_file(f"{i}.json", f'{{"id":{i}}}\n', f"2024/01/{i + 1:02d}")
    n = sb.ingest(spark, spec, "json", schema=SCHEMA, files_per_batch=3)
    assert n > 1
    assert rows(sb.read_bronze(spark, spec), "id") == sorted(((i,) for i in range(12)), key=repr)
    assert states(spark, spec) == {"archived": 12}
    assert len(list((tmp_path / "raw").rglob("*.json"))) == 12
    assert not list((tmp_path / "landing").rglob("*.json"))


def test_bookkeeping_does_not_grow(spark, spec, drop_file, tmp_path):
    """The manifest holds files in landing only, the commit records the last two batches."""
    for i in range(5):
        drop_file(f"{i}.json", f'{{"id":{i}}}\n')
        sb.ingest(spark, spec, "json", schema=SCHEMA)
    assert manifest.read_manifest(spark, spec).isEmpty()
    records = sorted(p.name for p in (tmp_path / "bronze/crm/events_commits/run=ingest").iterdir())
    assert records == ["batch=3", "batch=4"]
    assert rows(sb.read_bronze(spark, spec), "id") == [(i,) for i in range(5)]
    assert states(spark, spec) == {"archived": 5}


def test_empty_file_is_left_alone(spark, spec, drop_file):
    """Spark's scans skip files without bytes, so there is nothing to ingest or archive."""
    drop_file("a.json", '{"id":1}\n')
    empty = drop_file("empty.json", "")
    assert sb.ingest(spark, spec, "json", schema=SCHEMA) == 1
    assert sb.ingest(spark, spec, "json", schema=SCHEMA) == 0
    assert empty.exists()


def test_same_name_again_after_archive(spark, spec, drop_file, tmp_path):
    for x in (1, 2):
        later(drop_file("a.json", f'{{"id":1,"x":{x}}}\n'))
        sb.ingest(spark, spec, "json", schema=SCHEMA)
    assert rows(sb.read_bronze(spark, spec), "x") == [(1.0,), (2.0,)]
    kept = sorted(p.name for p in (tmp_path / "raw/crm/events/2024/01/01").iterdir())
    assert kept == ["a.ingest-1.json", "a.json"]
    assert states(spark, spec) == {"archived": 2}


class Stop(Exception):
    pass


@pytest.mark.parametrize("point", ["read", "write", "commit", "archive"])
@pytest.mark.parametrize("nth", [0, 1])
def test_interrupted_call_is_finished_by_the_next(spark, spec, drop_file, tmp_path, monkeypatch, point, nth):
    """Stopped anywhere, then called again: every row once, every file archived."""
    for i in range(8):
        drop_file(f"{i}.json", f'{{"id":{i}}}\n')
    calls = itertools.count()

    def stop_at(owner, name):
        real = getattr(owner, name)

        def wrapped(*args, **kwargs):
            if next(calls) == nth:
                raise Stop
            return real(*args, **kwargs)

        monkeypatch.setattr(owner, name, wrapped)

    from siltbed.plans import ingest as module

    owner, name = {
        "read": (module, "read_landing_files"),
        "write": (BronzeTable, "write"),
        "commit": (BronzeTable, "commit"),
        "archive": (module, "archive_files"),
    }[point]
    stop_at(owner, name)
    with pytest.raises(Stop):
        sb.ingest(spark, spec, "json", schema=SCHEMA, files_per_batch=3)
    drop_file("late.json", '{"id":8}\n')
    sb.ingest(spark, spec, "json", schema=SCHEMA, files_per_batch=3)
    assert rows(sb.read_bronze(spark, spec), "id") == [(i,) for i in range(9)]
    assert not list((tmp_path / "landing").rglob("*.json"))
    assert len(list((tmp_path / "raw").rglob("*.json"))) == 9


def test_file_changed_before_its_pending_batch_is_read(spark, spec, drop_file, monkeypatch):
    drop_file("a.json", '{"id":1}\n')
    drop_file("b.json", '{"id":2}\n')
    with monkeypatch.context() as patch:
        patch.setattr(BronzeTable, "write", lambda *a: (_ for _ in ()).throw(Stop))
        with pytest.raises(Stop):
            sb.ingest(spark, spec, "json", schema=SCHEMA)
    later(drop_file("a.json", '{"id":100}\n'))
    sb.ingest(spark, spec, "json", schema=SCHEMA)
    assert rows(sb.read_bronze(spark, spec), "id") == [(100,), (2,)]


def test_file_changed_before_archive_stays_in_landing(spark, spec, drop_file, tmp_path, monkeypatch):
    path = drop_file("a.json", '{"id":1}\n')
    real = BronzeTable.commit

    def overwrite_then_commit(self, run, batch):
        drop_file("a.json", '{"id":2}\n')
        later(path)
        real(self, run, batch)

    with monkeypatch.context() as patch:
        patch.setattr(BronzeTable, "commit", overwrite_then_commit)
        sb.ingest(spark, spec, "json", schema=SCHEMA)
    assert path.exists()
    sb.ingest(spark, spec, "json", schema=SCHEMA)
    assert rows(sb.read_bronze(spark, spec), "id") == [(1,), (2,)]


def test_discovery_lists_only(spark, spec, drop_file, capsys):
    from siltbed.sources.listing import list_files, listing_session

    drop_file("a.json", '{"id":1}\n')
    sb.ingest(spark, spec, "json", schema=SCHEMA, archive=False)
    session = listing_session(spark)
    known = manifest.read_manifest(session, spec)
    manifest.new_files(list_files(session, spec.landing_dir), known).explain("formatted")
    plan = capsys.readouterr().out
    scan = plan.split("Scan binaryFile", 2)[2].split("Scan parquet")[0]
    assert "ReadSchema: struct<>" in scan and "LeftAnti" in plan


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=3), st.integers(1, 3))
def test_any_split_gives_all_rows(spark, tmp_path_factory, drops, files_per_batch):
    """Rows split over drops and files at random arrive once each."""
    root = tmp_path_factory.mktemp("split")
    spec = sb.DatasetSpec("s", "d", f"{root}/l", f"{root}/r", f"{root}/b", f"bronze_{root.name}")
    expect = []
    for d, drop in enumerate(drops):
        folder = root / f"l/s/d/2024/01/{d + 1:02d}"
        folder.mkdir(parents=True)
        for i, file in enumerate(drop):
            with open(folder / f"{file}.json", "a") as out:
                out.write(f'{{"id":{d * 1000 + i}}}\n')
            expect.append((d * 1000 + i,))
        sb.ingest(spark, spec, "json", schema=SCHEMA, files_per_batch=files_per_batch)
    if expect:
        assert rows(sb.read_bronze(spark, spec), "id") == sorted(expect, key=repr)
