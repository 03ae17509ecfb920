"""Landing files by their own column lists: header lines of CSV, footers of Parquet.

The head (or footer) of each file is read in a task, so a table of ``file_path, shape`` costs a few
KB a file whatever the files hold. Files of one shape are then read in one scan under the
columns that they have, and scans are put together by name.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.files import locate
from ..paths import load_path
from ..tables import spread_out
from .listing import list_files, list_tree

# Bytes of a file that are read for its header line; more only where that is longer.
HEAD_BYTES = 1 << 16
# Files of a scan over all of landing.
FILES_PER_SCAN = 10_000
# Fixed value: the key under which Spark keeps its own schema in a footer.
ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"


def option(options: dict[str, str], *names: str, default: str = "") -> str:
    """An option of a reader, whose names know no case; of several names for it the last one counts."""
    folded = {k.lower(): str(v) for k, v in options.items()}
    found = [folded[n.lower()] for n in names if n.lower() in folded]
    return found[-1] if found else default


def has_header(options: dict[str, str]) -> bool:
    return option(options, "header").lower() == "true"


def first_record(lines: Iterator[str], comment: str, quote: str, escape: str, multi_line: bool) -> str | None:
    """The first record of CSV lines that is neither blank nor a comment.

    With ``multi_line`` it goes on while a quote is open. None if there is none.
    """
    record = ""
    for line in lines:
        if not record and (not line.strip() or comment and line.startswith(comment)):
            continue
        record += line
        bare = record.replace(escape + quote, "") if escape and escape != quote else record
        if not multi_line or not quote or bare.count(quote) % 2 == 0:
            return record.rstrip("\r\n")
    return record.rstrip("\r\n") or None


def _head(uri: str, options: dict[str, str]) -> str | None:
    fs, path = locate(uri)
    # Streams are taken apart by the name's ending, as Spark's reader does.
    with fs.open_input_stream(path, compression="detect", buffer_size=HEAD_BYTES) as raw:
        text = io.TextIOWrapper(raw, encoding=option(options, "charset", "encoding", default="utf-8"), errors="replace", newline="")
        separator = option(options, "lineSep")

        def lines() -> Iterator[str]:
            first = True
            for line in text if not separator else iter(lambda: _until(text, separator), ""):
                yield line.removeprefix("\ufeff") if first else line
                first = False

        return first_record(
            lines(), option(options, "comment"), option(options, "quote", default='"'), option(options, "escape", default="\\"),
            option(options, "multiLine").lower() == "true",
        )


def _until(text: io.TextIOWrapper, separator: str) -> str:
    """Text up to a separator, which becomes a line end; empty at the end of the file."""
    found = ""
    while (c := text.read(1)) and not found.endswith(separator):
        found += c
        if found.endswith(separator):
            return found[: -len(separator)] + "\n"
    return found


def _footer(uri: str) -> str:
    fs, path = locate(uri)
    with fs.open_input_file(path) as source:
        found = pq.ParquetFile(source)
        own = (found.schema_arrow.metadata or {}).get(ROW_METADATA) or (found.metadata.metadata or {}).get(ROW_METADATA) or b""
        return f"{found.schema}\n{own.decode()}"


def shapes(files: DataFrame, fmt: str, options: dict[str, str] | None = None) -> DataFrame:
    """``file_path, shape`` of the files in column ``file_path``; null where a file has no record.

    The shape of a CSV file is its header record, that of a Parquet file its footer's schema.
    """
    own = dict(options or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("file_path")
            found = [_footer(p) if fmt == "parquet" else _head(p, own) for p in paths.to_pylist()]
            yield pa.RecordBatch.from_arrays([paths, pa.array(found, pa.string())], ["file_path", "shape"])

    return spread_out(files.select("file_path")).mapInArrow(run, "file_path string, shape string")


class Shape:
    """Files that have the same columns in the same order."""

    def __init__(self, columns: T.StructType, files: DataFrame):
        self.columns, self._files = columns, files

    @property
    def names(self) -> list[str]:
        return self.columns.fieldNames()

    def scans(self) -> Iterator[list[str]]:
        """Arguments for ``load``, some thousand files at a time; no more are on the driver."""
        paths: list[str] = []
        for row in self._files.toLocalIterator():
            paths.append(load_path(row.file_path))
            if len(paths) == FILES_PER_SCAN:
                yield paths
                paths = []
        if paths:
            yield paths


@contextmanager
def by_shape(spark: SparkSession, fmt: str, paths: str | Sequence[str], options: dict[str, str]) -> Iterator[list[Shape]]:
    """The files below ``paths`` by their shape, widest first, whatever the order of the files.

    The driver holds the different shapes and the names of one scan's files; all names with their shapes
    are kept on the executors until the end. CSV columns come as strings.
    """
    listing = list_tree if isinstance(paths, str) and not re.search(r"[*?\[\]{}\\]", paths) else list_files
    listed = listing(spark, paths, option(options, "pathGlobFilter") or None).where("length > 0")
    found = shapes(listed, fmt, options).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        one = {r["shape"]: r["file_path"] for r in found.where("shape is not null").groupBy("shape").agg(F.min("file_path").alias("file_path")).collect()}
        kinds = list(one)
        # Of a CSV file Spark reads the header alone, and says how columns without a name or with one twice are called.
        plain = {**options, "inferSchema": "false"} if fmt == "csv" else options
        columns = [spark.read.format(fmt).options(**plain).load([load_path(one[k])]).schema for k in kinds]
        merged: dict[str, tuple[T.StructType, list[str]]] = {}
        for kind, own in zip(kinds, columns):
            merged.setdefault(own.json(), (own, []))[1].append(kind)
        ordered = sorted(merged.values(), key=lambda x: (-len(x[0].fields), x[0].fieldNames(), x[0].json()))
        yield [Shape(own, found.where(F.col("shape").isin(same)).select("file_path")) for own, same in ordered]
    finally:
        found.unpersist()
