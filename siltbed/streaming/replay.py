"""Frames that another query of the table has committed: a lost Kafka checkpoint adds no row twice.

Every query keeps, per topic and partition, the span of the offsets that it has committed. A new
query compares the span of a micro-batch with those of the others; only where they meet,
frames that are in the table are left out. Spans decide what is looked at, the table's own rows what
is left out, so offsets that a span passes over are still read. A frame is known by topic,
partition, offset and timestamp: a topic that was made anew starts again at 0 and loses nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bronze import RUN, BronzeTable
from ..operators.files import drop_dir
from ..spec import DatasetSpec
from ..tables import read_or_empty

PLACE = ["_topic", "_partition"]
FRAME = [*PLACE, "_offset", "_timestamp"]
SPAN_SCHEMA = "_topic string, _partition int, low bigint, high bigint, run string, batch bigint"


def has_frames(df: DataFrame) -> bool:
    return set(FRAME) <= set(df.columns)


def _spans(df: DataFrame) -> DataFrame:
    return df.groupBy(*PLACE).agg(F.min("_offset").alias("low"), F.max("_offset").alias("high"))


def kept_spans(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """Spans of each query as of its last record."""
    rows = read_or_empty(spark, spec.offsets_dir, SPAN_SCHEMA)
    last = rows.groupBy("run").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["run", "batch"], "left_semi")


def _known_dir(spec: DatasetSpec, run: str) -> str:
    return f"{spec.offsets_dir}_known/run={run}"


def without_committed(batch: DataFrame, table: BronzeTable, run: str) -> DataFrame:
    """The frames of a micro-batch that no other query has committed to the table.

    Without other queries, and where their spans do not meet the batch's, that is the batch as it is. Else
    the table's frames in the span are written down first, since a table cannot be read while it is
    written to: as many rows of four columns as the batch meets. The driver holds a row or two.
    """
    if not table.committed:
        return batch
    spark, spec = batch.sparkSession, table.spec
    others = kept_spans(spark, spec).where(F.col("run") != run)
    if others.isEmpty():
        return batch
    theirs = others.groupBy(*PLACE).agg(F.min("low").alias("their_low"), F.max("high").alias("their_high"))
    met = _spans(batch).join(theirs, PLACE).where("low <= their_high and their_low <= high")
    found = met.agg(F.min(F.greatest("low", "their_low")), F.max(F.least("high", "their_high")), F.collect_set("_topic")).first()
    if found[0] is None:
        return batch
    low, high, topics = found
    known = table.read_frames(FRAME).where((F.col(RUN) != run) & F.col("_offset").between(low, high) & F.col("_topic").isin(topics))
    known.select(*FRAME).write.mode("overwrite").parquet(_known_dir(spec, run))
    written = spark.read.schema(known.select(*FRAME).schema).parquet(_known_dir(spec, run))
    return batch.join(written, [batch[c].eqNullSafe(written[c]) for c in FRAME], "left_anti")


def keep_spans(table: BronzeTable, run: str, batch_id: int) -> None:
    """Add a written batch to the spans of its query; to be done before its commit.

    The record takes the place of the one before, which is kept for readers that look at it. Doing it
    again gives the same record.
    """
    spark, spec = table.spark, table.spec
    before = read_or_empty(spark, spec.offsets_dir, SPAN_SCHEMA).where((F.col("run") == run) & (F.col("batch") < batch_id))
    records = sorted(r.batch for r in before.select("batch").distinct().collect())
    last = before.where(F.col("batch") == records[-1]).select(*PLACE, "low", "high") if records else None
    own = _spans(table.read_batch(run, batch_id))
    both = own if last is None else own.unionByName(last).groupBy(*PLACE).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    both.coalesce(1).write.mode("overwrite").parquet(f"{spec.offsets_dir}/run={run}/batch={batch_id}")
    drop_dir(_known_dir(spec, run))
    for old in records[:-1]:
        drop_dir(f"{spec.offsets_dir}/run={run}/batch={old}")
