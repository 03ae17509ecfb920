"""Incremental ingestion by manifest: no file is lost or read twice.

Discovery appends every new or changed landing file to the manifest, with a batch number.
A stream over the manifest, or a plain call, then reads the files of each batch. Both commit
under the same name, so one goes on where the other ended.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.metadata import LABEL_PATTERN
from ..operators.archive import archive_files
from ..operators.bronze import BronzeTable
from ..sources.landing import FORMATS, read_landing_files, read_named_files, readable_by_name, resolve_schema
from ..sources.listing import list_tree, listed_folders, listing_session
from ..sources.manifest import (
    FILE_KEY, MANIFEST_SCHEMA, add_to_manifest, forget_archived, keep_folders, keep_listing, new_files, read_manifest,
    still_listed,
)
from ..spec import DatasetSpec

# Run name of batches that come from the manifest.
RUN = "ingest"


class Ingestion:
    """One call of :func:`ingest` or :func:`ingest_stream`."""

    def __init__(
        self, spark: SparkSession, spec: DatasetSpec, fmt: str, *, schema, partition_by, merge_schema, archive,
        files_per_batch, bytes_per_batch, reader_options, label_pattern,
    ) -> None:
        if fmt not in FORMATS:
            raise ValueError(f"format {fmt!r} is not supported; choose one of {sorted(FORMATS)}")
        self.spark, self.spec, self.fmt = spark, spec, fmt
        self.schema, self.archive, self.options, self.label_pattern = schema, archive, reader_options, label_pattern
        self.limits = files_per_batch, bytes_per_batch
        self.table = BronzeTable(spark, spec, partition_by=partition_by, merge_schema=merge_schema)
        self.session = listing_session(spark)

    def discover(self) -> list[DataFrame]:
        """Files to read, with their batches: those left over from an interrupted call, and new ones."""
        done = self.table.committed.get(RUN, -1)
        known = read_manifest(self.session, self.spec)
        left_over = known.where(F.col("batch") > done)
        interrupted = not left_over.isEmpty()
        # Where files stay in landing, folders that are as they were have nothing new.
        same = not self.archive and not interrupted
        folders = listed_folders(self.session, self.spec.folders_dir) if same else None
        tree = list_tree(self.session, self.spec.landing_dir, FORMATS[self.fmt][1].get("pathGlobFilter"), folders)
        kept = keep_listing(self.spec, tree)
        listing = kept.where("file_path is not null").select(*FILE_KEY)
        if self.archive and done >= 0:
            # Committed files an interrupted call did not get to move.
            late = listing.join(known.where(F.col("batch") <= done), FILE_KEY, "left_semi")
            if not late.isEmpty():
                archive_files(self.spec, late, f"{RUN}-late", done, not_after=F.col("modified"))
        if interrupted:
            # A file changed or removed in the meantime is not read under its old entry.
            left_over = still_listed(self.spec, left_over, listing)
        fresh = add_to_manifest(self.spec, new_files(listing, known), done, *self.limits)
        if same:
            keep_folders(self.spec, kept)
        pending = [left_over, fresh]
        if self.schema is None and FORMATS[self.fmt][2] and not all(p.isEmpty() for p in pending):
            # Over all of landing, so that types do not depend on how files fall into batches.
            self.schema = resolve_schema(self.spark, self.spec, self.fmt, None, self.options)
        return pending

    def read(self, pending: DataFrame, arrived: DataFrame | None = None) -> int:
        """Append the batches that are not committed yet, or of these those ``arrived`` names; returns how many.

        The driver holds the file names of one batch at a time, of binary files none, and never data.
        """
        n = 0
        named = pending if arrived is None else arrived
        for batch in sorted(r.batch for r in named.select("batch").distinct().collect()):
            if self.table.is_committed(RUN, batch):
                continue
            files = pending.where(F.col("batch") == batch)
            self.table.append(self._rows(files), RUN, batch)
            if self.archive:
                archive_files(self.spec, files, RUN, batch, not_after=F.col("modified"))
            n += 1
        return n

    def _rows(self, files: DataFrame) -> DataFrame:
        if readable_by_name(self.spec, self.fmt, self.options):
            return read_named_files(files, self.spec, label_pattern=self.label_pattern)
        paths = [r.file_path for r in files.select("file_path").collect()]
        return read_landing_files(
            self.spark, self.spec, self.fmt, files=paths, schema=self.schema, options=self.options, label_pattern=self.label_pattern
        )

    def finish(self) -> None:
        if self.archive:
            forget_archived(self.spec)


def ingest(
    spark: SparkSession,
    spec: DatasetSpec,
    fmt: str,
    *,
    schema: T.StructType | str | None = None,
    partition_by: str | Sequence[str] | None = None,
    merge_schema: bool | str = False,
    archive: bool = True,
    files_per_batch: int = 10_000,
    bytes_per_batch: int = 1 << 40,
    reader_options: dict[str, str] | None = None,
    label_pattern: str = LABEL_PATTERN,
) -> int:
    """Append every new or overwritten landing file to bronze; returns the batches committed.

    Batches left over from an interrupted call are finished first, with the same files.
    Without ``schema`` it is inferred from all files in landing and merged into the stored one.
    """
    call = Ingestion(
        spark, spec, fmt, schema=schema, partition_by=partition_by, merge_schema=merge_schema, archive=archive,
        files_per_batch=files_per_batch, bytes_per_batch=bytes_per_batch, reader_options=reader_options, label_pattern=label_pattern,
    )
    n = sum(call.read(pending) for pending in call.discover())
    call.finish()
    return n


def ingest_stream(
    spark: SparkSession,
    spec: DatasetSpec,
    fmt: str,
    *,
    schema: T.StructType | str | None = None,
    max_files: int = 10_000,
    partition_by: str | Sequence[str] | None = None,
    merge_schema: bool | str = False,
    archive: bool = True,
    bytes_per_batch: int = 1 << 40,
    reader_options: dict[str, str] | None = None,
    label_pattern: str = LABEL_PATTERN,
) -> StreamingQuery | None:
    """:func:`ingest` as a stream over the manifest that ends when all is read; None if nothing is new.

    A file written again under its name, one of any age and one that another call has seen
    but not read are all read, and none is twice. ``max_files`` is about the most files of a
    batch. A micro-batch that is run again finds its batches committed.
    """
    call = Ingestion(
        spark, spec, fmt, schema=schema, partition_by=partition_by, merge_schema=merge_schema, archive=archive,
        files_per_batch=max_files, bytes_per_batch=bytes_per_batch, reader_options=reader_options, label_pattern=label_pattern,
    )
    left_over, fresh = call.discover()
    # Of an interrupted call, as far as the files are still what they were.
    call.read(left_over)
    query = None
    if not fresh.isEmpty():
        first = fresh.agg(F.min("batch")).first()[0]
        entries = spark.readStream.schema(MANIFEST_SCHEMA).option("maxFileAge", "36500d").parquet(spec.manifest_dir)
        query = (
            entries.writeStream.foreachBatch(lambda rows, _: call.read(fresh, rows.where(F.col("batch") >= first)))
            .option("checkpointLocation", f"{spec.checkpoint_dir}_manifest")
            .queryName(spec.query_name).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        # Entries that the checkpoint had already: of a call that ended before it read them.
        call.read(fresh)
    call.finish()
    return query
