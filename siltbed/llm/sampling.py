"""Which rows a model may learn from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text, modulo 4, is 2. Null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def first_rows(rows: DataFrame, by: Column, n: int) -> DataFrame:
    """The ``n`` rows whose hash of ``by`` is least: a sample of bounded size that repeats."""
    return rows.orderBy(F.xxhash64(by), by).limit(n)
