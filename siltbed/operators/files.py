"""File moves and copies inside executor tasks.

Within a file system a move is a rename. Between file systems it is a copy that is proven first, by
length and digest of what was read and of what the target then holds; the source goes in a second
step, once the log of the copies is written.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame

from ..paths import encoded
from ..tables import spread_out

# Hadoop connector schemes with the names Arrow knows them by.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}

MOVED_SCHEMA = "source string, not_after long, outcome string, target string"
# A log of copies also tells what was proven of each.
COPIED_SCHEMA = f"{MOVED_SCHEMA}, size long, digest string"

_open: dict[tuple[str, str], tuple[pafs.FileSystem, str]] = {}


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow file system and path of a ``_metadata.file_path`` style URI."""
    parts = urlsplit(uri)
    scheme = ARROW_SCHEMES.get(parts.scheme, parts.scheme)
    if scheme == "file":
        return pafs.LocalFileSystem(), unquote(parts.path)
    key = (scheme, parts.netloc)
    if key not in _open:
        fs, base = pafs.FileSystem.from_uri(f"{scheme}://{parts.netloc}/")
        _open[key] = fs, base.rstrip("/")
    fs, base = _open[key]
    return fs, base + unquote(parts.path)


def put(fs: pafs.FileSystem, target: str, chunks: Iterator[bytes]) -> None:
    """Write a file under a hidden name, then rename it, so readers never see half of it.

    The hidden name is unique per attempt: retried or speculative tasks do not meet.
    """
    folder, name = posixpath.split(target)
    fs.create_dir(folder, recursive=True)
    hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(hidden) as out:
        for chunk in chunks:
            out.write(chunk)
    fs.move(hidden, target)


def _chunks(fs: pafs.FileSystem, path: str) -> Iterator[bytes]:
    with fs.open_input_stream(path) as src:
        while chunk := src.read(8 << 20):
            yield chunk


def digest_of(fs: pafs.FileSystem, path: str) -> tuple[int, str]:
    """Length and SHA-256 of a file, read in pieces."""
    size, digest = 0, hashlib.sha256()
    for chunk in _chunks(fs, path):
        size += len(chunk)
        digest.update(chunk)
    return size, digest.hexdigest()


def copy_proven(src_fs: pafs.FileSystem, src: str, dst_fs: pafs.FileSystem, dst: str) -> tuple[int, str]:
    """Copy a file and prove the copy; its length and digest. Raises OSError where they do not agree.

    A target that already is that copy, of an attempt before, is not written again.
    """
    there, have = dst_fs.get_file_info(dst), src_fs.get_file_info(src)
    if there.type == pafs.FileType.File and there.size == have.size and (known := digest_of(dst_fs, dst)) == digest_of(src_fs, src):
        return known
    size, digest = 0, hashlib.sha256()

    def read() -> Iterator[bytes]:
        nonlocal size
        for chunk in _chunks(src_fs, src):
            size += len(chunk)
            digest.update(chunk)
            yield chunk

    put(dst_fs, dst, read())
    after = src_fs.get_file_info(src)
    if (after.size, after.mtime_ns) != (have.size, have.mtime_ns) or size != have.size:
        raise OSError(f"{src} changed while it was copied, or was cut short: {size} of {after.size} bytes")
    if (proof := digest_of(dst_fs, dst)) != (size, digest.hexdigest()):
        raise OSError(f"{dst} holds {proof[0]} bytes that are not the {size} of {src}")
    return size, digest.hexdigest()


def exists(fs: pafs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type == pafs.FileType.File


def drop_dir(uri: str) -> None:
    """Remove a directory this package made for its own bookkeeping, if it is there."""
    fs, path = locate(encoded(uri))
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        fs.delete_dir(path)


def same_system(source: str, target: str) -> bool:
    """Whether two URIs are of one file system, so that a move is a rename."""
    a, b = urlsplit(source), urlsplit(target)
    return (a.scheme, a.netloc) == (b.scheme, b.netloc)


def move_file(
    source: str, target: str, spare: str | None = None, not_after: int | None = None
) -> tuple[str, str]:
    """Move one file, or copy it to another file system; (outcome, final URI).

    Doing it again after success changes nothing. ``spare`` is the name to use when another file
    holds ``target`` already. A file changed later than ``not_after`` (epoch milliseconds) is left
    where it is. After ``copied`` the source is still there, see :func:`drop_copied`.
    """
    return _move(source, target, spare, not_after)[:2]


def _move(
    source: str, target: str, spare: str | None, not_after: int | None
) -> tuple[str, str, int | None, str | None]:
    """As :func:`move_file`, with length and digest of a copy."""
    src_fs, src = locate(source)
    info = src_fs.get_file_info(src)
    if info.type != pafs.FileType.File:
        for done in (spare, target):
            if done and exists(*locate(done)):
                return "moved", done, None, None
        return "missing", target, None, None
    if _changed(info, not_after):
        return "changed", source, None, None
    dst_fs, dst = locate(target)
    if dst_fs == src_fs:
        if spare and exists(dst_fs, dst):
            target = spare
            dst_fs, dst = locate(target)
        dst_fs.create_dir(posixpath.dirname(dst), recursive=True)
        src_fs.move(src, dst)
        return "moved", target, None, None
    if spare and exists(dst_fs, dst) and digest_of(dst_fs, dst) != digest_of(src_fs, src):
        target = spare
        dst_fs, dst = locate(target)
    return "copied", target, *copy_proven(src_fs, src, dst_fs, dst)


def _changed(info: pafs.FileInfo, not_after: int | None) -> bool:
    return not_after is not None and info.mtime_ns is not None and info.mtime_ns // 1_000_000 > not_after


def drop_copied(source: str, target: str, size: int, digest: str, not_after: int | None = None) -> str:
    """Delete a source whose copy is proven and logged; the outcome. To be done again at will.

    The source stays where it is no longer what was copied (``changed``), or where the target is not
    there in full (``copied``).
    """
    src_fs, src = locate(source)
    dst_fs, dst = locate(target)
    there, info = dst_fs.get_file_info(dst), src_fs.get_file_info(src)
    if there.type != pafs.FileType.File or there.size != size:
        return "copied"
    if info.type != pafs.FileType.File:
        return "moved"
    if _changed(info, not_after) or info.size != size or digest_of(src_fs, src) != (size, digest):
        return "changed"
    src_fs.delete_file(src)
    return "moved"


def _whole(value) -> int | None:
    return None if pd.isna(value) else int(value)


def _move_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        results = [_move(r.source, r.target, r.spare, _whole(r.not_after)) for r in rows.itertuples()]
        out = rows[["source", "not_after"]].copy()
        for k, name in enumerate(("outcome", "target", "size", "digest")):
            out[name] = pd.Series([r[k] for r in results], index=out.index, dtype="Int64" if name == "size" else object)
        yield out


def _drop_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        out = rows[["source", "not_after", "outcome", "target"]].copy()
        out["outcome"] = [
            drop_copied(source, target, int(size), digest, _whole(not_after)) if outcome == "copied" else outcome
            for source, not_after, outcome, target, size, digest in rows[["source", "not_after", "outcome", "target", "size", "digest"]].itertuples(index=False)
        ]
        yield out


def move_files(plan: DataFrame, copied_log: str | None = None) -> DataFrame:
    """Move the files named by ``source, target, spare, not_after`` rows, on the executors.

    Returns ``source, not_after, outcome, target``. The moves happen when the result is evaluated, so
    write it once rather than using it twice. With ``copied_log`` the files may be of different file
    systems: copies are made and logged there before the result drops their sources.
    """
    spread = spread_out(plan.select("source", "target", "spare", "not_after"))
    moved = spread.mapInPandas(_move_batches, COPIED_SCHEMA)
    if copied_log is None:
        return moved.select("source", "not_after", "outcome", "target")
    moved.write.mode("overwrite").parquet(copied_log)
    logged = plan.sparkSession.read.schema(COPIED_SCHEMA).parquet(copied_log)
    return spread_out(logged).mapInPandas(_drop_batches, MOVED_SCHEMA)


def _copy_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        sizes = []
        for r in rows.itertuples():
            src_fs, src = locate(r.source)
            dst_fs, dst = locate(r.target)
            put(dst_fs, dst, _chunks(src_fs, src))
            sizes.append(dst_fs.get_file_info(dst).size)
        yield pd.DataFrame({"source": rows["source"], "target": rows["target"], "size": sizes})


def copy_files(plan: DataFrame) -> DataFrame:
    """Copy the files named by ``source, target`` rows; returns ``source, target, size``."""
    spread = spread_out(plan.select("source", "target"))
    return spread.mapInPandas(_copy_batches, "source string, target string, size long")
