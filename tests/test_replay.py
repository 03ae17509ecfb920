"""Frames of a query whose checkpoint was lost."""

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException

import siltbed as sb
from siltbed.operators.bronze import BronzeTable
from siltbed.streaming import sink as module
from siltbed.streaming.replay import kept_spans

SCHEMA = "_key binary, _value binary, _topic string, _partition int, _offset long, _timestamp timestamp, _timestampType int"


def frames(spark, offsets, topic="t", partition=0, day="2024-01-01"):
    return spark.createDataFrame([(o,) for o in offsets], "o long").selectExpr(
        "cast(cast(o as string) as binary) _key", "cast(concat('v', o) as binary) _value", f"'{topic}' _topic", f"{partition} _partition",
        "o _offset", f"timestamp'{day} 00:00:00' _timestamp", "0 _timestampType",
    )


class Topic:
    """A stream over frames that are written from time to time, a micro-batch for each file."""

    def __init__(self, spark, spec, tmp_path):
        self.spark, self.spec, self.folder = spark, spec, tmp_path / "topic"

    def put(self, df):
        df.coalesce(1).write.mode("append").parquet(str(self.folder))

    def run(self, checkpoint, **options):
        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(self.folder))
        sb.start_bronze_query(stream, self.spec, archive=False, checkpoint=f"{self.folder}-{checkpoint}", **options).awaitTermination()

    def offsets(self):
        return rows(sb.read_bronze(self.spark, self.spec), "_topic", "_partition", "_offset")


@pytest.fixture
def topic(spark, spec, tmp_path):
    return Topic(spark, spec, tmp_path)


def expected(*parts):
    return sorted([(t, p, o) for t, p, offsets in parts for o in offsets], key=repr)


def test_new_checkpoint_adds_nothing_twice(spark, spec, topic):
    topic.put(frames(spark, range(10)))
    topic.put(frames(spark, range(5), partition=1))
    topic.run("a")
    topic.run("b")
    assert topic.offsets() == expected(("t", 0, range(10)), ("t", 1, range(5)))
    # The old query goes on, then the new one, then a third.
    topic.put(frames(spark, range(10, 14)))
    topic.run("a")
    topic.run("b")
    topic.put(frames(spark, range(2), topic="other"))
    topic.run("c")
    assert topic.offsets() == expected(("t", 0, range(14)), ("t", 1, range(5)), ("other", 0, range(2)))


def test_gaps_are_still_read(spark, spec, topic):
    """Frames between those that were committed, as after a run that began late, are no duplicates."""
    topic.put(frames(spark, [0, 1, 8, 9]))
    topic.run("a")
    topic.put(frames(spark, range(12)))
    topic.run("b")
    assert topic.offsets() == expected(("t", 0, range(12)))


def test_topic_made_anew(spark, spec, topic):
    topic.put(frames(spark, range(3)))
    topic.run("a")
    topic.put(frames(spark, range(3), day="2025-01-01"))
    topic.run("b")
    assert topic.offsets() == expected(("t", 0, [0, 1, 2, 0, 1, 2]))


def test_same_query_may_repeat_frames(spark, spec, topic):
    """Without a new checkpoint nothing is looked at: the source answers for its own batches."""
    topic.put(frames(spark, range(3)))
    topic.put(frames(spark, range(3)))
    topic.run("a")
    assert topic.offsets() == expected(("t", 0, [0, 0, 1, 1, 2, 2]))


def test_spans_are_folded(spark, spec, topic):
    for k in range(4):
        topic.put(frames(spark, range(10 * k, 10 * k + 10)))
        topic.run("a")
    assert [(r.low, r.high) for r in kept_spans(spark, spec).collect()] == [(0, 39)]
    assert len(list((topic.folder.parent / "bronze/crm/events_offsets").rglob("*.parquet"))) <= 2


def test_fault_between_spans_and_commit(spark, spec, topic, monkeypatch):
    """A span without its commit hides nothing, in the same query or in another."""
    topic.put(frames(spark, range(5)))
    with monkeypatch.context() as patch:
        patch.setattr(BronzeTable, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(StreamingQueryException):
            topic.run("a")
    topic.run("b")
    topic.run("a")
    assert topic.offsets() == expected(("t", 0, range(5)))


def test_batches_beyond_the_spans_are_not_joined(spark, spec, topic, monkeypatch):
    topic.put(frames(spark, range(5)))
    topic.run("a")
    plans = []
    plain = module.without_committed

    def seen(batch, table, run):
        found = plain(batch, table, run)
        plans.append(found is batch)
        return found

    monkeypatch.setattr(module, "without_committed", seen)
    topic.put(frames(spark, range(5, 9)))
    topic.run("b")
    assert sorted(plans) == [False, True] and topic.offsets() == expected(("t", 0, range(9)))
