"""Landing-to-bronze ingestion on Spark DataFrames and Structured Streaming."""

from .functions.frames import add_kafka_metadata, decode_avro, decode_json, prefix_columns
from .functions.image import jpeg_size
from .functions.metadata import add_file_metadata, path_label, raw_file_name
from .operators.archive import archive_files, distinct_source_files
from .operators.bronze import BronzeTable, read_bronze
from .operators.land import land_dataframe, land_images
from .plans.ingest import ingest, ingest_stream
from .sources.kafka import read_kafka_stream
from .sources.landing import read_landing_files, read_landing_stream
from .sources.schema_store import SchemaStore
from .ship import ship
from .spec import DatasetSpec
from .streaming.sink import (
    SchemaEvolved, bronze_sink, column_check, start_bronze_query,
)

__all__ = [
    "BronzeTable", "DatasetSpec", "SchemaEvolved", "SchemaStore", "add_file_metadata", "add_kafka_metadata",
    "archive_files", "bronze_sink", "column_check", "decode_avro", "decode_json", "distinct_source_files",
    "ingest", "ingest_stream", "jpeg_size", "land_dataframe", "land_images", "path_label",
    "prefix_columns", "raw_file_name", "read_bronze", "read_kafka_stream",
    "read_landing_files", "read_landing_stream", "ship", "start_bronze_query",
]
