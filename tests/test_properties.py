"""Random landing contents against plain Python."""

import csv
import io
import json

import pytest
from conftest import rows
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

import siltbed as sb

# No shrinking: an example takes seconds.
FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.generate]
)

# One type per name, so that nothing clashes and every value must arrive.
VALUES = {
    "a": st.integers(-(2**40), 2**40),
    "b": st.text(st.characters(codec="utf-8", exclude_characters="\r\n\x00"), max_size=5),
    "c": st.booleans(),
    "d": st.lists(st.integers(0, 9), min_size=1, max_size=3),
    "e": st.fixed_dictionaries({}, optional={"x": st.integers(0, 9), "y": st.text("pq", max_size=2)}).filter(bool),
}
RECORD = st.fixed_dictionaries({}, optional=VALUES)
DROPS = st.lists(st.lists(st.lists(RECORD, min_size=1, max_size=4), min_size=1, max_size=3), min_size=1, max_size=3)


@pytest.fixture
def fresh(tmp_path_factory):
    def make():
        root = tmp_path_factory.mktemp("any")
        return root, sb.DatasetSpec("s", "d", f"{root}/l", f"{root}/r", f"{root}/b", f"bronze_{root.name}")

    return make


def plain(value):
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items() if v is not None} or None
    return value


@pytest.mark.parametrize("how", ["stream", "manifest"])
@FEW
@given(drops=DROPS)
def test_json_of_any_shape_arrives_whole(spark, fresh, how, drops):
    root, spec = fresh()
    expect = []
    for d, files in enumerate(drops):
        folder = root / f"l/s/d/2024/01/{d + 1:02d}"
        folder.mkdir(parents=True)
        for f, records in enumerate(files):
            lines = [{"n": len(expect) + i, **r} for i, r in enumerate(records)]
            (folder / f"{f}.json").write_text("".join(json.dumps(r) + "\n" for r in lines))
            expect += lines
        if how == "stream":
            sb.ingest_stream(spark, spec, "json", merge_schema=True, max_files=2)
        else:
            sb.ingest(spark, spec, "json", merge_schema=True, files_per_batch=2)
    got = sb.read_bronze(spark, spec).drop("_ingested_at", "_ingested_filename").collect()
    assert sorted((plain(r.asDict(recursive=True)) for r in got), key=lambda r: r["n"]) == expect
    assert not list((root / "l").rglob("*.json"))


CELL = st.text("ab1;\"é .", min_size=1, max_size=4).map(lambda s: "x" + s)

RECORDS = st.lists(st.lists(CELL, min_size=4, max_size=4), min_size=1, max_size=4)
FILES = st.lists(st.tuples(st.integers(1, 4), RECORDS), min_size=1, max_size=4)


@FEW
@given(files=FILES)
def test_csv_of_any_width_arrives_whole(spark, fresh, files):
    root, spec = fresh()
    folder = root / "l/s/d/2024/01/01"
    folder.mkdir(parents=True)
    expect, n = [], 0
    for f, (width, records) in enumerate(files):
        out = io.StringIO()
        for record in records:
            row = [str(n), *record[: width - 1]]
            csv.writer(out, delimiter=";", quotechar='"', escapechar="\\", doublequote=False,
                       quoting=csv.QUOTE_ALL, lineterminator="\n").writerow(row)
            expect.append(tuple(row))
            n += 1
        (folder / f"{f}.csv").write_text(out.getvalue())
    sb.ingest(spark, spec, "csv")
    df = sb.read_bronze(spark, spec)
    columns = [c for c in df.columns if c.startswith("_c") and c[2:].isdigit()]
    got = [tuple(str(v) for v in r if v is not None) for r in df.select(columns).collect()]
    assert sorted(got) == sorted(expect)


@FEW
@given(
    ids=st.lists(st.tuples(st.integers(0, 2**31 - 1), st.sampled_from("ABC")), max_size=30),
    cuts=st.lists(st.integers(0, 30), max_size=3),
)
def test_partitioned_batches_add_up(spark, fresh, ids, cuts):
    _, spec = fresh()
    table = sb.BronzeTable(spark, spec, partition_by="p")
    bounds = [0, *sorted(min(c, len(ids)) for c in cuts), len(ids)]
    for batch, (a, b) in enumerate(zip(bounds, bounds[1:])):
        part = spark.createDataFrame(ids[a:b], "id int, p string")
        table.append(part, "r", batch)
        table.append(part, "r", batch)
    assert rows(sb.read_bronze(spark, spec), "id", "p") == sorted(ids, key=repr)
