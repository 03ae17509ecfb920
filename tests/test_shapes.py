"""CSV files with header lines, records as Spark reads them, and Parquet files of other types."""

import gzip
import itertools

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

import siltbed as sb
from siltbed.sources import shapes
from siltbed.sources.landing import infer_schema
from siltbed.sources.schema_store import common_type, reads_natively, widen

HEADER = {"header": "true"}
THREE = "a;b;c\n1;x;2024-01-01\n2;y;2024-01-02\n"
FIVE = "a;b;c;d;e\n3;z;2024-01-03;1.5;true\n"
TURNED = "c;a;f;b\n2024-02-02;9;007;q\n"


@pytest.mark.parametrize("order", list(itertools.permutations([THREE, FIVE, TURNED]))[::2])
def test_header_files_in_any_order(spark, spec, drop_file, order):
    for name, text in zip("xyz", order):
        drop_file(f"{name}.csv", text)
    assert sb.ingest(spark, spec, "csv", reader_options=HEADER, merge_schema=True) == 1
    back = sb.read_bronze(spark, spec)
    assert back.columns[2:] == ["a", "b", "c", "d", "e", "f"]
    assert [t for _, t in back.dtypes[2:]] == ["int", "string", "date", "double", "boolean", "int"]
    got = sorted((r.a, r.b, str(r.c), r.d, r.e, r.f) for r in back.collect())
    assert got == [
        (1, "x", "2024-01-01", None, None, None), (2, "y", "2024-01-02", None, None, None),
        (3, "z", "2024-01-03", 1.5, True, None), (9, "q", "2024-02-02", None, None, 7),
    ]


def test_headers_through_the_stream_and_later(spark, spec, drop_file):
    """A later file with the columns turned round and a new one, and a value that no longer fits."""
    drop_file("a.csv", THREE)
    sb.ingest_stream(spark, spec, "csv", reader_options=HEADER, merge_schema=True)
    drop_file("b.csv", TURNED + "2024-02-03;word;8;r\n")
    sb.ingest_stream(spark, spec, "csv", reader_options=HEADER, merge_schema=True)
    got = sb.read_bronze(spark, spec)
    assert sorted((r.a or 0, r.b, r.f) for r in got.collect()) == [(0, "r", 8), (1, "x", None), (2, "y", None), (9, "q", 7)]
    assert [r[0] for r in rows(got.where("_corrupt_record is not null"), "_corrupt_record")] == ["2024-02-03;word;8;r"]


def test_one_scan_for_files_of_one_header(spark, spec, drop_file, monkeypatch):
    for k in range(5):
        drop_file(f"{k}.csv", THREE)
    plan = sb.read_landing_files(spark, spec, "csv", options=HEADER)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    monkeypatch.setattr(shapes, "FILES_PER_SCAN", 2)
    assert sb.read_landing_files(spark, spec, "csv", options=HEADER).count() == 10


def test_given_schema_is_read_by_name(spark, spec, drop_file):
    drop_file("a.csv", TURNED)
    drop_file("b.csv", THREE)
    got = sb.read_landing_files(spark, spec, "csv", schema="b string, missing int, a long", options=HEADER)
    assert got.columns[2:] == ["b", "missing", "a"]
    assert rows(got, "b", "missing", "a") == [("q", None, 9), ("x", None, 1), ("y", None, 2)]


def test_odd_headers(spark, spec, drop_file):
    """No file content, names left out or given twice, a byte order mark, and files in gzip."""
    drop_file("empty.csv", "")
    drop_file("blank.csv", "\n\n")
    drop_file("a.csv", "\ufeffid;ID2;;id\n1;2;3;4\n")
    drop_file("z.csv.gz", gzip.compress(b"id0;zip\n5;6\n"))
    schema = infer_schema(spark, "csv", spec.landing_dir, HEADER)
    assert schema.fieldNames() == ["id0", "ID2", "_c2", "id3", "zip"]
    got = sb.read_landing_files(spark, spec, "csv", options=HEADER)
    assert rows(got, "id0", "id3", "zip") == [(1, 4, None), (5, None, 6)]


def test_names_that_differ_in_case_only(spark, spec, drop_file):
    drop_file("a.csv", "id;x\n1;2\n")
    drop_file("b.csv", "ID;x;y\n1;2;3\n")
    with pytest.raises(ValueError, match="only in case"):
        infer_schema(spark, "csv", spec.landing_dir, HEADER)


def test_file_stream_stops_at_another_header(spark, spec, drop_file):
    drop_file("a.csv", THREE)
    stream = sb.read_landing_stream(spark, spec, "csv", options=HEADER)
    sb.start_bronze_query(stream, spec, archive=False).awaitTermination()
    drop_file("b.csv", TURNED)
    with pytest.raises(StreamingQueryException):
        sb.start_bronze_query(sb.read_landing_stream(spark, spec, "csv", schema="a int, b string, c date", options=HEADER), spec, archive=False).awaitTermination()


@pytest.mark.parametrize(
    "lines, options, want",
    [
        (["a;b\n", "1;2\n"], {}, "a;b"),
        (["\n", "  \n", "#x;y;z\n", "a;b\r\n"], {"comment": "#"}, "a;b"),
        (['"a\n', ' b";c\n', "1;2\n"], {"multi_line": True}, '"a\n b";c'),
        (['"a\n', ' b";c\n'], {}, '"a'),
        (['"a \\" b";"\n', '";c\n'], {"multi_line": True}, '"a \\" b";"\n";c'),
        (["#only\n"], {"comment": "#"}, None), ([], {}, None),
    ],
)
def test_first_record(lines, options, want):
    plain = {"comment": "", "quote": '"', "escape": "\\", "multi_line": False}
    assert shapes.first_record(iter(lines), **{**plain, **options}) == want


@pytest.mark.parametrize(
    "text, options, want",
    [
        ('1;"q\nr;s";3\n2;b;4\n', {"multiLine": "true"}, "struct<_c0:int,_c1:string,_c2:int>"),
        ("#one;two;three\n1;x\n", {"comment": "#"}, "struct<_c0:int,_c1:string>"),
        ("1;05/01/2024\n2;31/12/2024\n", {"dateFormat": "dd/MM/yyyy"}, "struct<_c0:int,_c1:date>"),
        ("1;2024|01\n2;2024|02\n", {"timestampFormat": "yyyy|MM"}, "struct<_c0:int,_c1:timestamp>"),
        ("1;2024-01-05\n", {"dateFormat": "dd/MM/yyyy"}, "struct<_c0:int,_c1:timestamp>"),
        ('1;"a "";"" b";2.5\n', {"escape": '"'}, "struct<_c0:int,_c1:string,_c2:double>"),
        ("1|x;y|2\n", {"sep": "|"}, "struct<_c0:int,_c1:string,_c2:int>"),
        ("1;;\n\n;;\n", {}, "struct<_c0:int,_c1:string,_c2:string>"),
        (";".join(["1"] * 300) + "\n", {}, "struct<" + ",".join(f"_c{k}:int" for k in range(300)) + ">"),
        ("N/A;1\n2;N/A\n", {"nullValue": "N/A"}, "struct<_c0:int,_c1:int>"),
        ("\n\n", {}, "struct<>"),
    ],
)
def test_records_as_spark_reads_them(spark, spec, drop_file, text, options, want):
    drop_file("a.csv", text)
    # Python prints long structs in short; the columns are compared one by one.
    got = infer_schema(spark, "csv", spec.landing_dir, options)
    assert "struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in got.fields) + ">" == want


def test_multi_line_records_to_bronze(spark, spec, drop_file):
    options = {"multiLine": "true", "comment": "#", "dateFormat": "dd.MM.yyyy"}
    drop_file("a.csv", '#c;d;e;f\n1;"x\ny;z";05.01.2024\n')
    drop_file("b.csv", '2;"w";06.01.2024;9\n')
    sb.ingest(spark, spec, "csv", reader_options=options, merge_schema=True)
    got = sb.read_bronze(spark, spec)
    assert sorted((r._c0, r._c1, str(r._c2), r._c3) for r in got.collect()) == [(1, "x\ny;z", "2024-01-05", None), (2, "w", "2024-01-06", 9)]


def test_parquet_types_widen(spark, spec):
    folder = f"{spec.landing_dir}/2024/01/01"
    for k, kind in enumerate(["int", "bigint", "float", "smallint"]):
        spark.range(1).selectExpr(f"cast({k} AS {kind}) AS id", f"named_struct('x', cast({k} AS {kind})) AS s", f"'{kind}' AS kind").write.parquet(f"{folder}/{k}")
    assert sb.ingest(spark, spec, "parquet") == 1
    got = sb.read_bronze(spark, spec)
    assert got.dtypes[2:] == [("id", "double"), ("s", "struct<x:double>"), ("kind", "string")]
    assert sorted((r.id, r.s.x, r.kind) for r in got.collect()) == [(0, 0, "int"), (1, 1, "bigint"), (2, 2, "float"), (3, 3, "smallint")]


def test_parquet_is_one_scan_where_the_reader_widens(spark, spec):
    folder = f"{spec.landing_dir}/2024/01/01"
    spark.range(2).selectExpr("cast(id AS int) AS id").write.parquet(f"{folder}/a")
    spark.range(2, 4).selectExpr("id", "'n' AS more").write.parquet(f"{folder}/b")
    got = sb.read_landing_files(spark, spec, "parquet")
    assert "Union" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert dict(got.dtypes)["id"] == "bigint" and rows(got, "id", "more") == [(0, None), (1, None), (2, "n"), (3, "n")]


def test_parquet_types_without_a_common_one(spark, spec):
    spark.range(1).write.parquet(f"{spec.landing_dir}/a")
    spark.range(1).selectExpr("cast(id AS string) AS id").write.parquet(f"{spec.landing_dir}/b")
    with pytest.raises(ValueError, match="cannot be widened"):
        infer_schema(spark, "parquet", spec.landing_dir)


def test_common_types():
    kinds = ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(5,2)", "decimal(38,2)", "date", "timestamp_ntz", "timestamp", "string", "boolean", "void"]
    types = [T.NullType() if k == "void" else T.StructType.fromDDL(f"c {k}")[0].dataType for k in kinds]
    for a, b in itertools.product(types, types):
        both = common_type(a, b)
        assert both == common_type(b, a)
        if both is not None:
            assert common_type(a, both) == both
        if reads_natively(a, b):
            assert both == b
    assert common_type(types[3], types[6]) == T.DecimalType(21, 2) and common_type(types[3], types[7]) == T.DecimalType(38, 2) or common_type(types[3], types[7]) is None
    assert common_type(types[10], types[9]) is None and common_type(types[11], types[2]) is None


def test_widen_within_structs():
    a, b = (T.StructType.fromDDL(f"s struct<x {k}, l array<{k}>, m map<string, {k}>>") for k in ("int", "bigint"))
    assert widen(a, b, types=True) == (b, False) and widen(b, a, types=True) == (b, False)
    assert widen(a, b)[1]
