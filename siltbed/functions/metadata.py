"""Provenance columns for file sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..paths import encoded, prefixes
from ..spec import DatasetSpec
from .image import jpeg_size

# Fixed value: the directory whose child names the class of an image.
LABEL_PATTERN = "flower_photos/([^/]+)"

FILE_METADATA = ["_ingested_at", "_ingested_filename"]
IMAGE_METADATA = [*FILE_METADATA, "_label", "_size"]


def rebase(path: Column, old_root: str, new_root: str) -> Column:
    """``path`` moved from ``old_root`` to ``new_root``; paths outside stay as they are.

    Prefix comparison and concatenation only, so it stays in generated code.
    """
    out = path
    for prefix in prefixes(old_root):
        out = F.when(
            path.startswith(prefix),
            F.concat(F.lit(encoded(new_root) + "/"), F.substring(path, len(prefix) + 1, 2**31 - 1)),
        ).otherwise(out)
    return out


def raw_file_name(spec: DatasetSpec, path: Column | None = None) -> Column:
    """Where the row's source file will be archived."""
    return rebase(F.col("_metadata.file_path") if path is None else path, spec.landing, spec.raw)


def landing_file_name(spec: DatasetSpec, path: Column) -> Column:
    """Inverse of :func:`raw_file_name`."""
    return rebase(path, spec.raw, spec.landing)


def path_label(path: Column | str, pattern: str = LABEL_PATTERN) -> Column:
    """First group of ``pattern`` in ``path``; empty text where it does not match."""
    return F.regexp_extract(path, pattern, 1)


def add_file_metadata(
    df: DataFrame,
    spec: DatasetSpec,
    *,
    image: bool = False,
    label_pattern: str = LABEL_PATTERN,
    file_path: Column | None = None,
    size: Column | None = None,
) -> DataFrame:
    """Put ingest time and source file (and label and size of an image) before the data.

    ``file_path`` replaces ``_metadata.file_path`` for frames that no longer are a scan, ``size`` is
    the size of an image where that is known.
    """
    meta = {
        "_ingested_at": F.current_timestamp(),
        "_ingested_filename": raw_file_name(spec, file_path),
    }
    if image:
        meta["_label"] = path_label("path", label_pattern)
        meta["_size"] = jpeg_size(F.col("content")) if size is None else size
    clash = sorted(set(meta) & set(df.columns))
    if clash:
        raise ValueError(f"data columns use reserved names: {clash}")
    data = [F.col(f"`{c}`") for c in df.columns]
    return df.select(*[c.alias(n) for n, c in meta.items()], *data)
