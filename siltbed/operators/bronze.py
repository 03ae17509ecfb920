"""Append-only bronze table with idempotent batches.

A batch is one static partition (``_run``, ``_batch_id``) of an external Parquet table and is
written with INSERT OVERWRITE of just that partition, so a replay replaces its own rows. A
one-row commit record written afterwards makes the batch count: readers prune to committed
batches, and a replay of a committed batch is skipped. The batches of a run commit in order,
so its last record stands for all before it and older ones are dropped. Each table has one
writer at a time.

With merging on, column types widen too. Files stay as they are: Spark's reader widens most types
itself, and batches whose types it does not are read under their own schema and cast.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..paths import qualify
from ..sources.schema_store import common_type, reads_natively, widen
from ..spec import DatasetSpec
from ..tables import one_row, read_or_empty
from .files import drop_dir

RUN, BATCH = "_run", "_batch_id"
COMMIT_SCHEMA = (
    "fields string, partition_by array<string>, committed_at timestamp, run string, batch bigint"
)
# Column types that batches were written with until a type became one that Spark's reader does
# not make of them: the schema, the last batch of each run, and when.
TYPES_SCHEMA = "fields string, upto map<string,bigint>, widened_at timestamp"

# Fixed value: the directory name Spark gives to a null partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class SchemaMismatch(ValueError):
    """The batch does not fit the table and merging is off or impossible."""


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def conform(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` with the inner struct fields it lacks filled with null."""
    if have == want:
        return value
    if isinstance(have, T.NullType):
        return value.cast(want)
    if isinstance(want, T.StructType):
        known = {f.name: f.dataType for f in have.fields}
        fields = [
            conform(value.getField(f.name), known[f.name], f.dataType).alias(f.name)
            if f.name in known
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        return F.transform_values(value, lambda _, x: conform(x, have.valueType, want.valueType))
    return value.cast(want)


def _nullable(t: T.DataType) -> T.DataType:
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_nullable(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(_nullable(t.keyType), _nullable(t.valueType), True)
    return t


def changed_fields(before: T.StructType, after: T.StructType) -> list[T.StructField]:
    """Fields of ``before`` that have another type in ``after``."""
    known = {f.name: f.dataType for f in after.fields}
    return [f for f in before.fields if known.get(f.name, f.dataType) != f.dataType]


def _text(value: str) -> str:
    """``value`` as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partition_spec(path: str) -> str:
    """``a=1/b=x%2Fy`` as the inside of a PARTITION clause."""
    pairs = [part.split("=", 1) for part in path.split("/")]
    return ", ".join(
        f"{_quote(unquote(k))} = " + ("null" if v == NO_VALUE else _text(unquote(v))) for k, v in pairs
    )


class BronzeTable:
    """The bronze table of one dataset."""

    def __init__(
        self,
        spark: SparkSession,
        spec: DatasetSpec,
        *,
        partition_by: str | Sequence[str] | None = None,
        merge_schema: bool | str = False,
    ) -> None:
        self.spark, self.spec = spark, spec
        self.merge_schema = str(merge_schema).lower() == "true"
        commits = read_or_empty(spark, spec.commits_dir, COMMIT_SCHEMA)
        # As many rows as there are runs, each with the two or three records kept of it.
        per_run = commits.groupBy("run").agg(
            F.max("batch").alias("batch"),
            F.sort_array(F.collect_set("batch")).alias("records"),
            F.max_by(F.struct("committed_at", "fields", "partition_by"), "batch").alias("last"),
        ).collect()
        self.committed: dict[str, int] = {r.run: r.batch for r in per_run}
        self._records: dict[str, list[int]] = {r.run: list(r.records) for r in per_run}
        self.schema: T.StructType | None = None
        asked = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
        self.partition_by = asked
        if per_run:
            last = max(per_run, key=lambda r: r.last.committed_at).last
            self.schema = T.StructType.fromJson(json.loads(last.fields))
            self.partition_by = list(last.partition_by)
            if asked and asked != self.partition_by:
                raise SchemaMismatch(f"table is partitioned by {self.partition_by}, not {asked}")

    def is_committed(self, run: str, batch_id: int) -> bool:
        return batch_id <= self.committed.get(run, -1)

    def append(self, df: DataFrame, run: str, batch_id: int) -> bool:
        """Write and commit a batch; False when it was committed before."""
        if self.is_committed(run, batch_id):
            return False
        self.write(df, run, batch_id)
        self.commit(run, batch_id)
        return True

    def write(self, df: DataFrame, run: str, batch_id: int) -> None:
        """Write a batch without committing it."""
        schema = self._merged(df.schema)
        self._keep_types(schema, run, batch_id)
        self._prepare(schema)
        self.schema = schema
        have = {f.name: _nullable(f.dataType) for f in df.schema.fields}
        columns = {
            f.name: conform(F.col(_quote(f.name)), have[f.name], f.dataType)
            if f.name in have
            else F.lit(None).cast(f.dataType)
            for f in schema.fields
        }
        order = [n for n in columns if n not in self.partition_by] + self.partition_by
        rows = df.select(*[columns[n].alias(n) for n in order])
        spark = df.sparkSession
        if self.partition_by and spark.conf.get("spark.sql.adaptive.enabled") == "true":
            # Rows of one partition value meet in few files; values that hold too many rows
            # for one task are split again at run time.
            rows = rows.hint("rebalance", *[F.col(_quote(c)) for c in self.partition_by])
        target = ", ".join(
            [f"{RUN} = '{run}'", f"{BATCH} = {batch_id}", *map(_quote, self.partition_by)]
        )
        spark.sql(
            f"INSERT OVERWRITE TABLE {self.spec.table} PARTITION ({target}) SELECT * FROM {{rows}}",
            rows=rows,
        )

    def commit(self, run: str, batch_id: int) -> None:
        """Make a written batch count.

        The record before the last is kept, for readers that are just looking at it.
        """
        record = one_row(
            self.spark,
            fields=self.schema.json(),
            partition_by=F.array(*map(F.lit, self.partition_by)).cast("array<string>"),
            committed_at=F.current_timestamp(),
        )
        path = f"{self.spec.commits_dir}/run={run}/batch={batch_id}"
        record.write.mode("overwrite").parquet(path)
        outdated = self._records.get(run, [])[:-1]
        self._records[run] = [*self._records.get(run, [])[-1:], batch_id]
        self.committed[run] = batch_id
        for old in outdated:
            drop_dir(f"{self.spec.commits_dir}/run={run}/batch={old}")

    def read(self) -> DataFrame:
        """Rows of committed batches, columns in the order they were first written."""
        if self.schema is None:
            raise ValueError(f"nothing is committed to {self.spec.table} yet")
        self.register()
        committed = self._is_committed(F.col(RUN), F.col(BATCH), self.committed)
        names = [F.col(_quote(n)) for n in self.schema.fieldNames()]
        past, parts = None, []
        for fields, upto in self._past_types():
            have = T.StructType([*fields.fields, T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())])
            until = self._is_committed(F.col(RUN), F.col(BATCH), upto)
            known = {f.name: f.dataType for f in fields.fields}
            own = [
                (conform(F.col(_quote(f.name)), known[f.name], f.dataType) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in self.schema.fields
            ]
            rows = self.spark.read.schema(have).parquet(self.spec.table_dir)
            parts.append(rows.where(until if past is None else until & ~past).where(committed).select(*own))
            past = until
        now = self.spark.table(self.spec.table).where(committed if past is None else committed & ~past).select(*names)
        return reduce(DataFrame.union, [*parts, now])

    def register(self) -> None:
        """Make the catalog of this session know the table as it is now."""
        self._prepare(self.schema)
        self.spark.catalog.refreshTable(self.spec.table)

    def read_batch(self, run: str, batch_id: int) -> DataFrame:
        """Rows of one batch, committed or not."""
        rows = self.spark.table(self.spec.table)
        return rows.where((F.col(RUN) == run) & (F.col(BATCH) == batch_id))

    def read_frames(self, columns: Sequence[str]) -> DataFrame:
        """These columns of all committed rows, with the run and batch of each."""
        self.register()
        committed = self._is_committed(F.col(RUN), F.col(BATCH), self.committed)
        return self.spark.table(self.spec.table).where(committed).select(*columns, RUN, BATCH)

    def _past_types(self) -> list[tuple[T.StructType, dict[str, int]]]:
        """Schemas before types that the reader does not widen, oldest first, and the last batches of each."""
        kept = read_or_empty(self.spark, self.spec.types_dir, TYPES_SCHEMA).orderBy("widened_at").collect()
        return [(T.StructType.fromJson(json.loads(r.fields)), r.upto) for r in kept]

    def _keep_types(self, schema: T.StructType, run: str, batch_id: int) -> None:
        """Keep the schema of the batches so far, if the reader cannot read them under ``schema``.

        Done again by a replay of the batch, with the same record. No batch is without its types: the
        record is there before any row of other types is.
        """
        if self.schema is None:
            return
        wider = {f.name: f.dataType for f in schema.fields}
        if all(reads_natively(f.dataType, wider[f.name]) for f in self.schema.fields):
            return
        upto = F.create_map(*[F.lit(v) for pair in self.committed.items() for v in pair]).cast("map<string,bigint>")
        row = one_row(self.spark, fields=self.schema.json(), upto=upto, widened_at=F.current_timestamp())
        row.write.mode("overwrite").parquet(f"{self.spec.types_dir}/run={run}/batch={batch_id}")

    def _merged(self, seen: T.StructType) -> T.StructType:
        seen = _nullable(seen)
        reserved = {RUN, BATCH} & {n.lower() for n in seen.fieldNames()}
        if reserved:
            raise SchemaMismatch(f"column names are reserved: {sorted(reserved)}")
        if self.schema is None:
            return seen
        wider, clash = widen(self.schema, seen, types=self.merge_schema)
        changed = [f.name for f in wider.fields if f not in self.schema.fields]
        if changed and not self.merge_schema:
            raise SchemaMismatch(f"columns {changed} are new or wider and merge_schema is off")
        by_name = {f.name: f.dataType for f in seen.fields}
        odd = [
            f.name for f in wider.fields
            if isinstance(f.dataType, T.AtomicType) and not self._takes(f.dataType, by_name.get(f.name, f.dataType))
        ]
        wider_keys = [f.name for f in changed_fields(self.schema, wider) if f.name in self.partition_by]
        if clash or odd or wider_keys:
            raise SchemaMismatch(f"column types differ from the table: {odd or wider_keys or 'inside nested columns'}")
        return wider

    def _takes(self, want: T.DataType, have: T.DataType) -> bool:
        """Whether a column of the table takes values of a type: its own or, with merging on, a narrower one."""
        return have in (want, T.NullType()) or self.merge_schema and common_type(want, have) == want

    def _prepare(self, schema: T.StructType) -> None:
        """Create the database and table, or bring the table's columns up to ``schema``."""
        spec, spark = self.spec, self.spark
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quote(spec.database)} LOCATION {_text(spec.bronze)}")
        if not spark.catalog.tableExists(spec.table):
            self._create(schema)
            return
        about = spark.sql(f"DESCRIBE TABLE EXTENDED {spec.table}")
        location = about.where("col_name = 'Location'").first()["data_type"]
        if qualify(location) != spec.table_dir:
            raise ValueError(f"{spec.table} is at {location}, not at {spec.table_dir}")
        have = {f.name: _nullable(f.dataType) for f in spark.table(spec.table).schema.fields}
        if any(f.name in have and have[f.name] != f.dataType for f in schema.fields):
            # Types and inner struct fields cannot be changed in place; the files of the table stay.
            spark.sql(f"DROP TABLE {spec.table}")
            self._create(schema)
            return
        new = T.StructType([f for f in schema.fields if f.name not in have])
        if new.fields:
            spark.sql(f"ALTER TABLE {spec.table} ADD COLUMNS ({new.toDDL()})")

    def _create(self, schema: T.StructType) -> None:
        spec, spark = self.spec, self.spark
        unknown = set(self.partition_by) - set(schema.fieldNames())
        if unknown:
            raise SchemaMismatch(f"partition columns are not in the data: {sorted(unknown)}")
        ddl = T.StructType(
            [*schema.fields, T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())]
        ).toDDL()
        keys = ", ".join([RUN, BATCH, *map(_quote, self.partition_by)])
        spark.sql(
            f"CREATE TABLE {spec.table} ({ddl}) USING parquet "
            f"PARTITIONED BY ({keys}) LOCATION {_text(spec.table_dir)}"
        )
        if self.committed:
            # A catalog that does not know this table yet: find the partitions once, without
            # those of batches that never got committed. Later batches register their own.
            spark.sql(f"MSCK REPAIR TABLE {spec.table}")
            self._forget_uncommitted()

    def _forget_uncommitted(self) -> None:
        """Take partitions of uncommitted batches out of the catalog; files stay."""
        found = self.spark.sql(f"SHOW PARTITIONS {self.spec.table}")
        path = F.col("partition")
        run = F.regexp_extract(path, f"^{RUN}=([^/]*)", 1)
        batch = F.regexp_extract(path, f"/{BATCH}=([^/]*)", 1).cast("long")
        left = [r.partition for r in found.where(~self._is_committed(run, batch, self.committed)).collect()]
        if left:
            drops = ", ".join(f"PARTITION ({_partition_spec(p)})" for p in left)
            self.spark.sql(f"ALTER TABLE {self.spec.table} DROP IF EXISTS {drops}")

    @staticmethod
    def _is_committed(run: Column, batch: Column, last_batches: dict[str, int]) -> Column:
        committed = F.lit(False)
        for name, last in last_batches.items():
            committed |= (run == name) & (batch <= last)
        return committed


def read_bronze(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """Committed rows of a dataset's bronze table."""
    return BronzeTable(spark, spec).read()
