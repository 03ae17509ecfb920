"""Streams into bronze."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.metadata import landing_file_name
from ..operators.archive import archive_files, distinct_source_files
from ..operators.bronze import BronzeTable
from ..paths import load_path
from ..sources.landing import resolve_schema
from ..sources.schema_store import SchemaStore
from ..spec import DatasetSpec
from .replay import has_frames, keep_spans, without_committed


class SchemaEvolved(RuntimeError):
    """A micro-batch holds columns its reader did not know; the wider schema is stored."""


def bronze_sink(
    spec: DatasetSpec,
    *,
    partition_by: str | Sequence[str] | None = None,
    merge_schema: bool | str = False,
    archive: bool = True,
    cache: bool = False,
    check: Callable[[DataFrame], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: write, commit, then archive the batch's source files.

    The file names come from the column just written, so the batch itself is evaluated once
    and needs no cache; ``cache`` is for callers whose ``check`` or plan evaluates it again.
    Files are archived only after the commit record exists, and a replayed batch that has
    one is not read again. Kafka sources pass ``archive=False``; frames that another query has
    committed, whose checkpoint was lost, are left out (:mod:`siltbed.streaming.replay`).
    """
    state: dict[str, BronzeTable] = {}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        # Taken out and put back at the end: after a failure the state is read anew.
        table = state.pop("table", None) or BronzeTable(
            spark, spec, partition_by=partition_by, merge_schema=merge_schema
        )
        from_files = "_ingested_filename" in batch.columns
        if not table.is_committed(run, batch_id):
            if cache:
                batch.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                frames = has_frames(batch)
                table.write(without_committed(batch, table, run) if frames else batch, run, batch_id)
                if check:
                    check(distinct_source_files(table.read_batch(run, batch_id)))
                if frames:
                    keep_spans(table, run, batch_id)
                table.commit(run, batch_id)
            finally:
                if cache:
                    batch.unpersist()
        if archive and from_files:
            table.register()
            raw = F.col("_ingested_filename")
            files = table.read_batch(run, batch_id).where(raw.isNotNull() & (raw != ""))
            files = files.groupBy(raw).agg(F.max("_ingested_at").alias("read_at"))
            files = files.select(landing_file_name(spec, raw).alias("file_path"), "read_at")
            archive_files(spec, files, run, batch_id, not_after=F.col("read_at"))
        state["table"] = table

    return write_batch


def column_check(
    spark: SparkSession, spec: DatasetSpec, fmt: str, reader_options: dict[str, str] | None = None
) -> Callable[[DataFrame], None]:
    """A ``check`` for the sink: no file of a batch has columns the stored schema lacks.

    Make it after the stream's reader. Where there are such columns it stores the wider
    schema and raises :class:`SchemaEvolved`, before the batch is committed; a query started
    with that schema on the same checkpoint reads the batch again.
    """
    store = SchemaStore(spark, spec.schema_dir)
    known = store.version()

    def check(files: DataFrame) -> None:
        landing = files.select(landing_file_name(spec, F.col("_ingested_filename")).alias("p"))
        # As many names as a micro-batch has files.
        paths = [load_path(r.p) for r in landing.collect()]
        if paths:
            resolve_schema(spark, spec, fmt, paths, reader_options)
        if store.version() != known:
            raise SchemaEvolved(f"new columns arrived in {spec.landing_dir}")

    return check


def start_bronze_query(
    df: DataFrame,
    spec: DatasetSpec,
    *,
    sink: Callable[[DataFrame, int], None] | None = None,
    trigger: dict | None = None,
    checkpoint: str | None = None,
    **options,
) -> StreamingQuery:
    """Start the stream ``df`` into bronze; ``options`` are those of :func:`bronze_sink`.

    The default trigger takes everything there is, in bounded micro-batches, and ends. ``checkpoint``
    is a folder for a query of its own, by default the dataset's.
    """
    return (
        df.writeStream.foreachBatch(sink or bronze_sink(spec, **options))
        .option("checkpointLocation", checkpoint or spec.checkpoint_dir)
        .queryName(spec.query_name)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
