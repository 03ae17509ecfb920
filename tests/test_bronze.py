"""The bronze table: layout, schema rules, idempotent batches."""

import shutil

import pytest
from conftest import rows

import siltbed as sb
from siltbed.operators.bronze import SchemaMismatch


def test_append_and_skip_committed(spark, spec):
    table = sb.BronzeTable(spark, spec)
    assert table.append(spark.range(3), "r", 0)
    assert not table.append(spark.range(9), "r", 0)
    assert table.append(spark.range(3, 5), "r", 1)
    assert rows(sb.read_bronze(spark, spec), "id") == [(0,), (1,), (2,), (3,), (4,)]


def test_uncommitted_rows_do_not_show(spark, spec):
    table = sb.BronzeTable(spark, spec)
    table.append(spark.range(2), "r", 0)
    table.write(spark.range(100), "r", 1)
    assert sb.read_bronze(spark, spec).count() == 2
    again = sb.BronzeTable(spark, spec)
    assert again.append(spark.range(5, 6), "r", 1)
    assert rows(sb.read_bronze(spark, spec), "id") == [(0,), (1,), (5,)]


def test_catalog_table(spark, spec):
    sb.BronzeTable(spark, spec).append(spark.range(2), "r", 0)
    assert spark.table(spec.table).count() == 2
    assert spec.table.endswith("`.`crm_events`")
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {spec.table}").collect()}
    assert about["Location"] == spec.table_dir and about["Type"] == "EXTERNAL"


def test_catalog_that_lost_the_table(spark, spec):
    def batch(start, end):
        return spark.range(start, end).selectExpr("id", "if(id = 2, null, concat('v/', id % 2)) AS c")

    table = sb.BronzeTable(spark, spec, partition_by="c")
    table.append(batch(0, 3), "r", 0)
    table.write(batch(50, 60), "r", 1)
    spark.sql(f"DROP TABLE {spec.table}")
    assert rows(sb.read_bronze(spark, spec), "id") == [(0,), (1,), (2,)]
    assert rows(spark.table(spec.table), "id") == [(0,), (1,), (2,)]
    sb.BronzeTable(spark, spec).append(batch(3, 5), "r", 1)
    assert rows(spark.table(spec.table), "id") == [(0,), (1,), (2,), (3,), (4,)]


def test_two_datasets_cannot_share_a_table(spark, spec, tmp_path):
    sb.BronzeTable(spark, spec).append(spark.range(1), "r", 0)
    other = sb.DatasetSpec("crm", "events", spec.landing, spec.raw, str(tmp_path / "other"), spec.database)
    with pytest.raises(ValueError, match="is at"):
        sb.BronzeTable(spark, other).append(spark.range(1), "r", 0)


def test_partition_text_and_order(spark, spec):
    df = spark.createDataFrame([("01", 1), ("a/b='q", 2), (None, 3)], "c string, id int")
    sb.BronzeTable(spark, spec, partition_by="c").append(df, "r", 0)
    back = sb.read_bronze(spark, spec)
    assert back.columns == ["c", "id"]
    assert rows(back, "c", "id") == rows(df, "c", "id")


def test_partition_is_pruned(spark, spec, capsys):
    df = spark.range(100).selectExpr("id", "cast(id % 4 AS int) AS c")
    sb.BronzeTable(spark, spec, partition_by="c").append(df, "r", 0)
    sb.read_bronze(spark, spec).where("c = 2 AND id > 10").select("id").explain()
    plan = capsys.readouterr().out
    assert "(c#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<id:bigint>" in plan and "GreaterThan(id,10)" in plan
    assert "Exchange" not in plan


def test_partition_columns_are_fixed(spark, spec):
    df = spark.range(3).selectExpr("id", "id AS c")
    sb.BronzeTable(spark, spec, partition_by="c").append(df, "r", 0)
    with pytest.raises(SchemaMismatch, match="partitioned by"):
        sb.BronzeTable(spark, spec, partition_by="other")


def test_unknown_partition_column(spark, spec):
    with pytest.raises(SchemaMismatch, match="nope"):
        sb.BronzeTable(spark, spec, partition_by="nope").append(spark.range(3), "r", 0)


def test_partitioned_write_is_rebalanced(spark, spec, tmp_path):
    """Many tasks and few values: the files stay few although every task has every value."""
    df = spark.range(0, 4000, 1, 40).selectExpr("id", "cast(id % 3 AS int) AS c")
    sb.BronzeTable(spark, spec, partition_by="c").append(df, "r", 0)
    files = list((tmp_path / "bronze/crm/events").rglob("*.parquet"))
    assert len(files) <= 6


def test_merge_schema(spark, spec):
    sb.BronzeTable(spark, spec).append(spark.range(1), "r", 0)
    wide = spark.range(1, 2).selectExpr("'n' AS extra", "id")
    with pytest.raises(SchemaMismatch, match="extra"):
        sb.BronzeTable(spark, spec, merge_schema="false").append(wide, "r", 1)
    table = sb.BronzeTable(spark, spec, merge_schema="true")
    table.append(wide, "r", 1)
    table.append(spark.range(2, 3), "r", 2)
    back = sb.read_bronze(spark, spec)
    assert back.columns == ["id", "extra"]
    assert rows(back, "*") == [(0, None), (1, "n"), (2, None)]


def test_narrow_struct_is_filled(spark, spec):
    table = sb.BronzeTable(spark, spec, merge_schema=True)
    table.append(spark.sql("SELECT named_struct('a', 1, 'b', 'x') AS s, map('k', named_struct('p', 1)) AS m"), "r", 0)
    table.append(spark.sql("SELECT named_struct('b', 'y') AS s, map('k', named_struct('q', 2)) AS m"), "r", 1)
    got = [r.asDict(recursive=True) for r in sb.read_bronze(spark, spec).orderBy("s.b").collect()]
    assert got == [
        {"s": {"a": 1, "b": "x"}, "m": {"k": {"p": 1, "q": None}}},
        {"s": {"a": None, "b": "y"}, "m": {"k": {"p": None, "q": 2}}},
    ]


@pytest.mark.parametrize("kind, merge", [("string", True), ("string", False), ("int", False), ("double", False), ("boolean", True), ("date", True)])
def test_type_change_is_refused(spark, spec, kind, merge):
    sb.BronzeTable(spark, spec).append(spark.range(1), "r", 0)
    with pytest.raises(SchemaMismatch, match="types differ"):
        sb.BronzeTable(spark, spec, merge_schema=merge).append(spark.range(1).selectExpr(f"try_cast(cast(id as string) AS {kind}) AS id"), "r", 1)


def test_types_widen_with_merging(spark, spec):
    """int to long is Spark's reader's; long to double, also within structs, is cast batch by batch."""
    kinds = ["int", "bigint", "double", "int", "double"]
    for k, kind in enumerate(kinds):
        df = spark.range(1).selectExpr(f"cast({k} + 1 AS {kind}) AS id", f"named_struct('x', cast({k} AS {kind})) AS s", f"array(cast({k} AS {kind})) AS l")
        sb.BronzeTable(spark, spec, merge_schema=True).append(df, "r", k)
        back = sb.read_bronze(spark, spec)
        assert sorted(r.id for r in back.collect()) == list(range(1, k + 2)) and sorted(r.s.x for r in back.collect()) == list(range(k + 1))
    assert dict(back.dtypes) == {"id": "double", "s": "struct<x:double>", "l": "array<double>"}
    assert sorted(r.l for r in back.collect()) == [[float(k)] for k in range(5)]


def test_other_widenings(spark, spec):
    table = sb.BronzeTable(spark, spec, merge_schema=True)
    first = "cast(1 AS tinyint) AS a, cast(1.5 AS float) AS b, DATE'2024-01-01' AS c, cast(1.25 AS decimal(5,2)) AS d, 7 AS e"
    second = "3000000000 AS a, 2.5D AS b, TIMESTAMP_NTZ'2024-01-02 03:00:00' AS c, cast(1.125 AS decimal(12,3)) AS d, cast(8.5 AS decimal(3,1)) AS e"
    table.append(spark.sql(f"SELECT {first}"), "r", 0)
    table.append(spark.sql(f"SELECT {second}"), "r", 1)
    back = sb.read_bronze(spark, spec)
    assert [t for _, t in back.dtypes] == ["bigint", "double", "timestamp_ntz", "decimal(12,3)", "decimal(11,1)"]
    assert [tuple(map(str, r)) for r in back.orderBy("a").collect()] == [
        ("1", "1.5", "2024-01-01 00:00:00", "1.250", "7.0"), ("3000000000", "2.5", "2024-01-02 03:00:00", "1.125", "8.5"),
    ]


def test_failed_widening_leaves_the_table(spark, spec):
    """A batch of wider type that was written but not committed does not show, and its replay does."""
    sb.BronzeTable(spark, spec).append(spark.range(2), "r", 0)
    wide = spark.range(2, 3).selectExpr("cast(id AS double) AS id")
    sb.BronzeTable(spark, spec, merge_schema=True).write(wide, "r", 1)
    back = sb.read_bronze(spark, spec)
    assert back.dtypes == [("id", "bigint")] and rows(back, "id") == [(0,), (1,)]
    sb.BronzeTable(spark, spec, merge_schema=True).append(wide, "r", 1)
    assert rows(sb.read_bronze(spark, spec), "id") == [(0.0,), (1.0,), (2.0,)]


def test_partition_column_keeps_its_type(spark, spec):
    sb.BronzeTable(spark, spec, partition_by="c").append(spark.range(1).selectExpr("id", "1 AS c"), "r", 0)
    with pytest.raises(SchemaMismatch, match="types differ"):
        sb.BronzeTable(spark, spec, merge_schema=True).append(spark.range(1).selectExpr("id", "1L AS c"), "r", 1)


def test_reserved_names(spark, spec):
    with pytest.raises(SchemaMismatch, match="reserved"):
        sb.BronzeTable(spark, spec).append(spark.range(1).withColumnRenamed("id", "_run"), "r", 0)


def test_nothing_committed(spark, spec):
    with pytest.raises(ValueError, match="nothing is committed"):
        sb.read_bronze(spark, spec)


def test_odd_dataset_name(spark, spec):
    odd = sb.DatasetSpec("crm", "web-events 2", spec.landing, spec.raw, spec.bronze, spec.database)
    sb.BronzeTable(spark, odd).append(spark.range(2), "r", 0)
    assert sb.read_bronze(spark, odd).count() == 2


def test_lost_checkpoint(spark, spec, drop_file, tmp_path):
    drop_file("a.json", '{"id":1}\n')
    sb.ingest_stream(spark, spec, "json", schema="id long")
    shutil.move(tmp_path / "bronze/crm/events_checkpoint_manifest", tmp_path / "lost")
    drop_file("b.json", '{"id":2}\n')
    sb.ingest_stream(spark, spec, "json", schema="id long")
    assert rows(sb.read_bronze(spark, spec), "id") == [(1,), (2,)]
