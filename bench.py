"""Time the headline operations; prints one JSON line.

Set-up (landing the input, building frames) is outside the timed part. Every operation runs
once to warm up and then three times, each time in fresh zones; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import siltbed as sb  # noqa: E402
from siltbed.plans.fixtures import (  # noqa: E402
    frames, label_images, land_events_by_type, table, workspace, write_images,
)
from siltbed.plans.queries import EVENT_SCHEMA, PAYLOAD_SCHEMA  # noqa: E402
from siltbed.sources.listing import list_files, list_tree, listing_session  # noqa: E402
from siltbed.sources.manifest import new_files  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def land_json(spark):
    spec, events = workspace(spark, "crm", "events"), table(spark, SF_DIR, "events")
    return lambda: sb.land_dataframe(events, spec, "json")


def landed(spark, name, fmt):
    spec = workspace(spark, "erp", name)
    sb.land_dataframe(table(spark, SF_DIR, name), spec, fmt)
    return spec


def ingest_json(spark):
    spec = landed(spark, "events", "json")
    return lambda: sb.ingest_stream(spark, spec, "json", schema=EVENT_SCHEMA)


def ingest_csv_inferred(spark):
    spec = landed(spark, "lineitem", "csv")
    return lambda: sb.ingest_stream(spark, spec, "csv")


def ingest_csv_given_schema(spark):
    spec = landed(spark, "lineitem", "csv")
    types = [f.dataType.simpleString() for f in table(spark, SF_DIR, "lineitem").schema.fields]
    schema = ", ".join(f"_c{i} {t}" for i, t in enumerate(types))
    return lambda: sb.ingest_stream(spark, spec, "csv", schema=schema)


def ingest_parquet_partitioned(spark):
    spec = landed(spark, "orders", "parquet")
    return lambda: sb.ingest_stream(spark, spec, "parquet", partition_by="o_orderstatus")


def ingest_manifest(spark):
    spec = workspace(spark, "crm", "events")
    land_events_by_type(spec, table(spark, SF_DIR, "events"))
    return lambda: sb.ingest(spark, spec, "json", schema=EVENT_SCHEMA)


def stored(df: DataFrame, spec) -> DataFrame:
    df.write.parquet(f"{spec.landing}/frames")
    return df.sparkSession.read.parquet(f"{spec.landing}/frames")


def kafka_json(spark):
    payload = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    df = stored(frames(table(spark, SF_DIR, "events"), "events", "event_id", payload), workspace(spark, "bus", "e"))
    return lambda: drain(sb.add_kafka_metadata(df, schema_format="json", schema=PAYLOAD_SCHEMA))


def pictures(spark):
    spec = workspace(spark, "photos", "labels")
    write_images(label_images(table(spark, SF_DIR, "labels"), spec.landing_dir))
    return spec


def jpeg_header(spark):
    spec = pictures(spark)
    return lambda: drain(sb.read_landing_files(spark, spec, "jpg"))


def discovery(spark):
    spec = pictures(spark)
    session = listing_session(spark)
    known = f"{spec.bronze}/known"
    list_files(session, spec.landing_dir).where(~F.col("file_path").contains("/q0/")).write.parquet(known)
    files = list_tree(session, spec.landing_dir).where("file_path is not null").select("file_path", "modified", "length")
    return lambda: drain(new_files(files, session.read.parquet(known)))


def archive(spark):
    spec = pictures(spark)
    files = list_files(spark, spec.landing_dir)
    return lambda: sb.archive_files(spec, files, "bench", 0)


# Operation and the table whose rows it handles.
OPERATIONS = {
    "land_json": (land_json, "events"),
    "ingest_json": (ingest_json, "events"),
    "ingest_csv_inferred": (ingest_csv_inferred, "lineitem"),
    "ingest_csv_given_schema": (ingest_csv_given_schema, "lineitem"),
    "ingest_parquet_partitioned": (ingest_parquet_partitioned, "orders"),
    "ingest_manifest": (ingest_manifest, "events"),
    "kafka_json": (kafka_json, "events"),
    "jpeg_header": (jpeg_header, "labels"),
    "discovery": (discovery, "labels"),
    "archive": (archive, "labels"),
}


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sb.ship(spark)
    seconds, rates = {}, {}
    for name, (prepare, rows_of) in OPERATIONS.items():
        times = []
        for _ in range(RUNS + 1):
            run = prepare(spark)
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        rates[name] = round(table(spark, SF_DIR, rows_of).count() / seconds[name])
        print(name, seconds[name], rates[name], file=sys.stderr)
    print(json.dumps({
        "metric": "total of median seconds per operation",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": rates,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
