"""Path text: absolute zone roots, and the two spellings Spark uses for one file."""

from __future__ import annotations

import re
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession

_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:")


def qualify(root: str) -> str:
    """Absolute URI of a zone root, spelled as Hadoop prints it (``file:/x``, ``hdfs://nn/x``).

    A root without a scheme belongs to the cluster's default file system.
    """
    if not _SCHEME.match(root):
        session = SparkSession.getActiveSession()
        default = (
            session.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
            if session
            else "file:///"
        )
        root = f"{default.rstrip('/')}/{root.lstrip('/')}"
    if root.startswith("file:"):
        root = "file:/" + root[len("file:"):].lstrip("/")
    return root.rstrip("/")


def encoded(path: str) -> str:
    """A plain path as it appears in ``_metadata.file_path`` (percent-encoded)."""
    return re.sub(r'[ "#%<>?\[\\\]^`{|}]', lambda m: quote(m[0], safe=""), path)


def prefixes(root: str) -> list[str]:
    """Every spelling under which files below ``root`` can show up in a scan."""
    base = encoded(root) + "/"
    if base.startswith("file:/"):
        return [base, "file:///" + base[len("file:/"):]]
    return [base]


def load_path(file_path: str) -> str:
    """A ``_metadata.file_path`` value as an argument for ``load``: decoded, globs escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(file_path))
