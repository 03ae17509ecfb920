"""Send this package to the executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make tasks of this application able to import the package; returns ``spark``.

    Not needed where the package is installed on the workers or given with ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId not in _sent:
        package = Path(__file__).parent
        base = Path(tempfile.mkdtemp(prefix="siltbed-")) / "siltbed"
        archive = shutil.make_archive(str(base), "zip", package.parent, package.name)
        context.addPyFile(archive)
        _sent.add(context.applicationId)
    return spark
