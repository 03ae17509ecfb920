"""Files below a directory as rows, without reading their contents.

:func:`list_tree` lists a tree of dated folders in tasks, so that the driver holds neither files
nor folders; :func:`list_files` is Spark's own listing, for single files and small folders.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.files import locate
from ..paths import encoded, qualify
from ..tables import no_rows, one_row, read_or_empty, spread_out

FILE_SCHEMA = "file_path string, modified timestamp, length bigint"
# With the folder that a file was listed by; a row without a file tells the folder's digest.
TREE_SCHEMA = f"{FILE_SCHEMA}, folder string, digest string"
FOLDER_SCHEMA = "folder string, digest string"
# Levels of folders above those that are listed in tasks of their own: year, month and day.
LEVELS = 3
# Calls to the file system that a task makes at a time.
CALLS = 16
# Rows of files that leave a listing task together.
ROWS = 10_000


def list_files(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = None
) -> DataFrame:
    """``file_path, modified, length`` of every file at any depth below ``paths``.

    ``file_path`` is spelled as ``_metadata.file_path``. Only file metadata is selected, so
    no content is read. A directory that does not exist has no files: object stores drop
    a directory with its last file.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        files = reader.load(paths)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, FILE_SCHEMA)
    return files.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("length"),
    )


def _hidden(name: str) -> bool:
    """Names that Spark's scans leave out."""
    return name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")


def _name_pattern(glob: str) -> str:
    """A file name pattern (``*``, ``?``, ``[a-z]``, ``{a,b}``) as a regular expression."""
    out, inside = "", 0
    for c in glob:
        if c == "{":
            out, inside = out + "(?:", inside + 1
        elif c == "}" and inside:
            out, inside = out + ")", inside - 1
        elif c == "," and inside:
            out += "|"
        elif c in "*?":
            out += "[^/]*" if c == "*" else "[^/]"
        else:
            out += c if c in "[]-^" else re.escape(c)
    return f"^{out}$"


def _entries(fs: pafs.FileSystem, path: str, recursive: bool) -> list[pafs.FileInfo]:
    found = fs.get_file_info(pafs.FileSelector(path, recursive=recursive, allow_not_found=True))
    if not recursive:
        return [i for i in found if not _hidden(i.base_name)]
    below = len(path.rstrip("/")) + 1
    return [i for i in found if not any(map(_hidden, i.path[below:].split("/")))]


def _is_file(info: pafs.FileInfo) -> bool:
    return info.type == pafs.FileType.File and bool(info.size)


def _millis(info: pafs.FileInfo) -> int:
    return (info.mtime_ns or 0) // 1_000_000


def list_tree(spark: SparkSession, root: str, glob: str | None = None, unchanged: DataFrame | None = None) -> DataFrame:
    """``file_path, modified, length, folder, digest`` of every file at any depth below ``root``.

    A task goes down the first three levels of folders (year, month, day), then each folder found there is
    listed by a task, with all below it. Besides its files such a folder has a row without a file
    that tells the digest of its listing. Folders that ``unchanged`` (``folder, digest``) names with
    that digest have this row alone. Files of no length, and names that begin with ``_`` or ``.``, are left
    out as in Spark's scans. A root that does not exist has no files.

    Tasks use Arrow's file systems as moves do; for schemes that these do not know it is
    :func:`list_files`, without folders.
    """
    root = qualify(root)
    try:
        locate(encoded(root))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        rows = list_files(spark, root, glob)
        return rows.select("*", F.lit(None).cast("string").alias("folder"), F.lit(None).cast("string").alias("digest"))
    # Files are spelled as in ``list_files``.
    base, pattern = encoded(root), _name_pattern(glob) if glob else None

    def spelled(top: str, path: str) -> str:
        return base + encoded(path[len(top):])

    def rows_of(found: list[tuple]) -> pa.RecordBatch:
        paths, modified, sizes, folders, digests = zip(*found) if found else ((),) * 5
        times = pa.array([None if t is None else t * 1000 for t in modified], pa.timestamp("us", "UTC"))
        return pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), times, pa.array(sizes, pa.int64()), pa.array(folders, pa.string()), pa.array(digests, pa.string())],
            ["file_path", "modified", "length", "folder", "digest"],
        )

    def go_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Files of the upper levels, and the folders below them as rows without a file or digest."""
        if not sum(batch.num_rows for batch in batches):
            return
        fs, top = locate(encoded(root))
        if _is_file(info := fs.get_file_info(top)):
            yield rows_of([(base, _millis(info), info.size, None, None)])
            return
        top, folders, found = top.rstrip("/"), [top], []
        with ThreadPoolExecutor(CALLS) as calls:
            for _ in range(LEVELS):
                entries = [i for own in calls.map(lambda f: _entries(fs, f, False), folders) for i in own]
                found += [(spelled(top, i.path), _millis(i), i.size, None, None) for i in entries if _is_file(i)]
                folders = [i.path for i in entries if i.type == pafs.FileType.Directory]
        found += [(None, None, None, spelled(top, f), None) for f in folders]
        for at in range(0, len(found), ROWS):
            yield rows_of(found[at:at + ROWS])

    def list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = locate(encoded(root))
        top = top.rstrip("/")
        for batch in batches:
            at_once = pc.is_null(batch.column("folder"))
            files = batch.filter(at_once).select(["file_path", "modified", "length", "folder"])
            if files.num_rows:
                yield files.append_column("digest", pa.nulls(files.num_rows, pa.string()))
            for row in batch.filter(pc.invert(at_once)).to_pylist():
                own = sorted((i for i in _entries(fs, locate(row["folder"])[1], True) if _is_file(i)), key=lambda i: i.path)
                seen = hashlib.sha256(repr(glob).encode())
                for i in own:
                    seen.update(f"{i.path}\0{_millis(i)}\0{i.size}\n".encode("utf-8", "surrogateescape"))
                yield rows_of([(None, None, None, row["folder"], seen.hexdigest())])
                if seen.hexdigest() == row["before"]:
                    continue
                for at in range(0, len(own), ROWS):
                    yield rows_of([(spelled(top, i.path), _millis(i), i.size, row["folder"], None) for i in own[at:at + ROWS]])

    upper = one_row(spark, here=1).mapInArrow(go_down, TREE_SCHEMA).drop("digest")
    if unchanged is None:
        both = upper.withColumn("before", F.lit(None).cast("string"))
    else:
        both = upper.join(unchanged.withColumnRenamed("digest", "before"), "folder", "left")
    rows = spread_out(both.select("file_path", "modified", "length", "folder", "before")).mapInArrow(list_folders, TREE_SCHEMA)
    if pattern:
        rows = rows.where(F.col("file_path").isNull() | F.regexp_extract("file_path", "[^/]*$", 0).rlike(pattern))
    return rows


def listed_folders(spark: SparkSession, path: str) -> DataFrame:
    """The folders and digests that an earlier call kept at ``path``."""
    return read_or_empty(spark, path, FOLDER_SCHEMA)


def listing_session(spark: SparkSession) -> SparkSession:
    """A session whose scans are packed for listing.

    A scan packs files into tasks by their length, which would make a task of every large
    file although only its name is read. A file that vanishes while the listing runs is
    simply not in it. Settings of the caller's session stay untouched.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.get(key, None) != value and session.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.files.maxPartitionBytes", str(64 << 30))
    session.conf.set("spark.sql.files.ignoreMissingFiles", "true")
    return session
