"""Readers of the landing zone."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.image import frame_size
from ..functions.metadata import LABEL_PATTERN, add_file_metadata
from ..operators.bronze import conform
from ..operators.files import locate
from ..paths import encoded, load_path
from ..spec import DatasetSpec
from ..tables import few_listing_tasks, spread_out
from .schema_store import CORRUPT, SchemaStore, reads_natively, widen
from .shapes import by_shape, has_header, option

BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"

# Files of a micro-batch.
FILES_AT_ONCE = 10_000

# Rows and bytes of binary files that leave a reading task together; a larger file leaves alone.
NAMED_ROWS = 1000
NAMED_BYTES = 1 << 24

# Spark source, reader options and whether the schema evolves, per format name.
FORMATS: dict[str, tuple[str, dict[str, str], bool]] = {
    "json": ("json", {"columnNameOfCorruptRecord": CORRUPT}, True),
    "csv": ("csv", {"delimiter": ";", "columnNameOfCorruptRecord": CORRUPT}, True),
    "avro": ("avro", {}, True),
    "parquet": ("parquet", {}, True),
    "jpg": ("binaryFile", {"pathGlobFilter": "*.jpg"}, False),
}


def _format(fmt: str) -> tuple[str, dict[str, str], bool]:
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not supported; choose one of {sorted(FORMATS)}")
    return FORMATS[fmt]


def infer_schema(
    spark: SparkSession,
    fmt: str,
    paths: str | Sequence[str],
    options: dict[str, str] | None = None,
) -> T.StructType:
    """Schema of all records below ``paths`` (arguments for ``load``).

    JSON and CSV are read whole (CSV twice, once with header lines), since a column may first
    appear in the last record. Parquet and Avro need only file headers.
    """
    source, fixed, evolves = _format(fmt)
    if not evolves:
        return T.StructType.fromDDL(BINARY_SCHEMA)
    if not paths:
        raise ValueError("there are no files to infer a schema from")
    with few_listing_tasks(spark):
        if fmt == "csv":
            return _infer_csv(spark, {**fixed, **(options or {})}, paths)
        if fmt == "parquet":
            return _infer_parquet(spark, options or {}, paths)
        reader = spark.read.format(source).options(**fixed).option("recursiveFileLookup", "true")
        return reader.options(**(options or {})).load(paths).schema


# What a text must look like to be read as a type, in the order in which they are tried.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^NaN$|^[+-]?Inf(inity)?$"
_CSV_TYPES = (
    ("int", r"^[+-]?\d+$"), ("bigint", r"^[+-]?\d+$"), ("double", _NUMBER), ("date", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("timestamp", r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d.*)?$"), ("boolean", r"(?i)^(true|false)$"),
)


_PATTERNS = dict(_CSV_TYPES)
_BITS = {kind: 1 << k for k, (kind, _) in enumerate(_CSV_TYPES)}
# Rows that are looked at for types that can be ruled out before all rows are.
FIRST_ROWS = 1000


def _csv_reader(spark: SparkSession, options: dict[str, str]):
    return spark.read.format("csv").options(**options).option("recursiveFileLookup", "true")


def _widest_record(spark: SparkSession, options: dict[str, str], paths: str | Sequence[str]) -> int:
    """Fields of the widest record, as Spark's CSV reader takes records apart.

    Where lines are records and none holds a quote, that is told by the separators. Else a record becomes
    an object of its fields, so quoted line ends, comments and escapes count as they are read, and the
    union of all objects' keys is one mergeable aggregate.
    """
    separator, quote = option(options, "delimiter", "sep"), option(options, "quote", default='"')
    other = any(option(options, name) for name in ("comment", "encoding", "charset", "lineSep"))
    if not other and option(options, "multiLine").lower() != "true" and "\\" not in separator:
        lines = spark.read.option("recursiveFileLookup", "true").text(paths).where(F.col("value").rlike(r"[^\x00-\x20]"))
        bare = F.replace("value", F.lit(separator), F.lit(""))
        separators = ((F.octet_length("value") - F.octet_length(bare)) / len(separator.encode())).cast("int")
        quoted = F.col("value").contains(quote) if quote else F.lit(False)
        width, quotes = lines.agg(F.max(separators), F.coalesce(F.bool_or(quoted), F.lit(False))).first()
        if not quotes:
            return 0 if width is None else width + 1
    plain = {k: v for k, v in options.items() if k.lower() not in ("header", "columnnameofcorruptrecord")}
    records = _csv_reader(spark, plain).option("singleVariantColumn", "record").load(paths)
    found = records.select(F.schema_of_variant_agg("record")).first()[0] or ""
    return max((int(k) + 1 for k in re.findall(r"[<, ]_c(\d+): ", found)), default=0)


def _infer_csv(spark: SparkSession, options: dict[str, str], paths: str | Sequence[str]) -> T.StructType:
    """Every column of any record, each of a type that all its values have.

    Without header lines these are as many as the widest record has fields. With them it is the union
    of all headers by name, those of the widest header first. Neither the order nor the
    number of files is a matter; passes are aggregates to one row.
    """
    if not has_header(options):
        width = _widest_record(spark, options, paths)
        names = [f"_c{k}" for k in range(width)]
        return _csv_types(options, names, [_fits(_strings(spark, options, names, paths), names, options)] if names else [])
    with by_shape(spark, "csv", paths, options) as shapes:
        union = T.StructType()
        for shape in shapes:
            union, _ = widen(union, shape.columns)
        found = [
            _fits(_strings(spark, options, shape.names, scan), shape.names, options)
            for shape in shapes for scan in shape.scans()
        ]
        return _csv_types(options, union.fieldNames(), found)


def _strings(spark: SparkSession, options: dict[str, str], names: list[str], paths) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return _csv_reader(spark, options).schema(schema).load(paths)


def _kinds(value: Column, kinds: set[str], formats: dict[str, str]) -> Column:
    """Of these types those that a value has, as the sum of their bits; null for null.

    A text that looks like a whole number is not looked at as anything else, and so on: but for formats that
    the caller names, of the patterns at most one matches.
    """
    own = [k for k in kinds if formats.get(k)]
    plain = kinds.difference(own)

    def bits(*names: str) -> Column:
        return F.lit(sum(_BITS[n] for n in names if n in plain))

    def has(kind: str) -> Column:
        return value.try_cast(kind).isNotNull()

    found = F.when(value.isNull(), F.lit(None).cast("int"))
    if plain & {"int", "bigint"}:
        size = F.when(has("int"), bits("int", "bigint", "double")) if "int" in plain else F.when(has("bigint"), bits("bigint", "double"))
        if "int" in plain and "bigint" in plain:
            size = size.when(has("bigint"), bits("bigint", "double"))
        found = found.when(value.rlike(_PATTERNS["int"]), size.otherwise(bits("double")))
    if "double" in plain:
        found = found.when(value.rlike(_PATTERNS["double"]), F.when(has("double"), bits("double")).otherwise(0))
    if plain & {"date", "timestamp"}:
        day = F.when(value.rlike(_PATTERNS["date"]) & has("date"), bits("date")).otherwise(0) if "date" in plain else F.lit(0)
        time = F.when(has("timestamp"), bits("timestamp")).otherwise(0) if "timestamp" in plain else F.lit(0)
        found = found.when(value.rlike(_PATTERNS["timestamp"]), day + time)
    if "boolean" in plain:
        found = found.when(value.rlike(_PATTERNS["boolean"]) & has("boolean"), bits("boolean"))
    found = found.otherwise(0)
    for kind in own:
        found += F.when(F.try_to_timestamp(value, F.lit(formats[kind])).isNotNull(), _BITS[kind]).otherwise(0)
    return found


def _fits(rows: DataFrame, names: list[str], options: dict[str, str]) -> dict[str, dict[str, bool]]:
    """For each column whether it has values (``values``), and by type whether all of them have it.

    One value that is not of a type rules it out for good, so the first rows leave few types to ask all
    others about, and none for a column of plain texts.
    """
    formats = {"date": option(options, "dateFormat"), "timestamp": option(options, "timestampFormat")}
    columns = {n: F.col("`" + n.replace("`", "``") + "`") for n in names}
    every = sum(_BITS.values())
    left = dict.fromkeys(names)
    first = rows.select(*[_kinds(columns[n], set(_BITS), formats) for n in names]).limit(FIRST_ROWS).collect()
    for row in first:
        for name, seen in zip(names, row):
            if seen is not None:
                left[name] = seen if left[name] is None else left[name] & seen
    asked = [n for n in names if left[n] != 0] if len(first) == FIRST_ROWS else []
    if asked:
        kinds = {n: {k for k, bit in _BITS.items() if (every if left[n] is None else left[n]) & bit} for n in asked}
        for name, seen in zip(asked, rows.agg(*[F.bit_and(_kinds(columns[n], kinds[n], formats)) for n in asked]).first()):
            left[name] = seen
    return {
        n: {"values": found is not None, **{k: found is None or bool(found & bit) for k, bit in _BITS.items()}} for n, found in left.items()
    }


def _csv_types(options: dict[str, str], names: list[str], found: list[dict[str, dict[str, bool]]]) -> T.StructType:
    """The first type that all scans agree on for each column; ``string`` where none or no value is."""
    fields = []
    for name in names:
        own = [f[name] for f in found if name in f]
        some = any(f["values"] for f in own)
        kind = next((kind for kind, _ in _CSV_TYPES if some and all(f[kind] for f in own)), "string")
        fields.append(T.StructField(name, T.StructType.fromDDL(f"c {kind}")[0].dataType, True))
    return T.StructType(fields)


def _infer_parquet(spark: SparkSession, options: dict[str, str], paths: str | Sequence[str]) -> T.StructType:
    """The columns of all footers; types that differ between files are widened."""
    with by_shape(spark, "parquet", paths, options) as shapes:
        union = T.StructType()
        for shape in shapes:
            wider, clash = widen(union, shape.columns, types=True)
            if clash:
                raise ValueError(f"column types differ and cannot be widened: {union.simpleString()} and {shape.columns.simpleString()}")
            union = wider
        return union


def resolve_schema(
    spark: SparkSession,
    spec: DatasetSpec,
    fmt: str,
    paths: str | Sequence[str] | None = None,
    options: dict[str, str] | None = None,
) -> T.StructType:
    """Infer over ``paths`` (all of landing by default) and merge into the stored schema."""
    seen = infer_schema(spark, fmt, spec.landing_dir if paths is None else paths, options)
    if not _format(fmt)[2]:
        return seen
    return SchemaStore(spark, spec.schema_dir).evolve(seen, quarantine=fmt in ("json", "csv"), types=fmt == "parquet")


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _load(reader, spark, spec, fmt, paths, schema, options, label_pattern, image=None) -> DataFrame:
    """The part that batch and stream readers share."""
    source, fixed, evolves = _format(fmt)
    reader = reader.option("recursiveFileLookup", "true")
    reader = reader.format(source).options(**fixed).options(**(options or {})).schema(schema)
    return reader.load(paths).transform(
        add_file_metadata, spec, image=not evolves if image is None else image, label_pattern=label_pattern
    )


def read_landing_files(
    spark: SparkSession,
    spec: DatasetSpec,
    fmt: str,
    *,
    files: Sequence[str] | None = None,
    schema: T.StructType | str | None = None,
    options: dict[str, str] | None = None,
    label_pattern: str = LABEL_PATTERN,
    image: bool | None = None,
) -> DataFrame:
    """Batch read of landing, or of just ``files`` (``_metadata.file_path`` values).

    Without ``schema`` it is inferred from those files and merged into the stored one.
    ``image`` adds label and size of pictures, by default for the format ``jpg``.
    """
    paths = spec.landing_dir if files is None else [load_path(f) for f in files]
    schema = _schema(schema or resolve_schema(spark, spec, fmt, paths, options))
    with few_listing_tasks(spark):
        if fmt == "parquet" or fmt == "csv" and has_header({**FORMATS[fmt][1], **(options or {})}):
            return _load_by_shape(spark, spec, fmt, paths, schema, options or {}, label_pattern, image)
        return _load(spark.read, spark, spec, fmt, paths, schema, options, label_pattern, image)


def _load_by_shape(spark, spec, fmt, paths, schema, options, label_pattern, image) -> DataFrame:
    """Files with the columns that they have, put together by name under ``schema``.

    CSV files with one header are a scan, whatever the order of their columns. Parquet files are one
    scan where Spark's reader widens what they hold, else a scan for each kind of footer.
    """
    wanted = {f.name: f.dataType for f in schema.fields}
    all_options = {**FORMATS[fmt][1], **options}
    parts = []
    with by_shape(spark, fmt, paths, all_options) as shapes:
        if fmt == "parquet" and all(reads_natively(f.dataType, wanted.get(f.name, f.dataType)) for s in shapes for f in s.columns.fields):
            return _load(spark.read, spark, spec, fmt, paths, schema, options, label_pattern, image)
        for shape in shapes:
            if fmt == "csv":
                own = T.StructType([T.StructField(f.name, wanted.get(f.name, f.dataType), True) for f in shape.columns.fields])
                if CORRUPT in wanted and CORRUPT not in own.fieldNames():
                    own = own.add(CORRUPT, T.StringType())
            else:
                own = shape.columns
            have = {f.name: f.dataType for f in own.fields}
            columns = [
                (conform(F.col("`" + n.replace("`", "``") + "`"), have[n], t) if n in have else F.lit(None).cast(t)).alias(n)
                for n, t in wanted.items()
            ]
            for scan in shape.scans():
                rows = _load(spark.read, spark, spec, fmt, scan, own, options, label_pattern, image)
                meta = [c for c in rows.columns if c not in have]
                parts.append(rows.select(*meta, *columns))
    if not parts:
        return _load(spark.read, spark, spec, fmt, paths, schema, options, label_pattern, image)
    return reduce(DataFrame.unionByName, parts)


def readable_by_name(spec: DatasetSpec, fmt: str, options: dict[str, str] | None) -> bool:
    """Whether :func:`read_named_files` reads the files of landing as Spark's reader with these options would."""
    if _format(fmt)[2] or options:
        return False
    try:
        locate(encoded(spec.landing_dir))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def read_named_files(files: DataFrame, spec: DatasetSpec, *, label_pattern: str = LABEL_PATTERN) -> DataFrame:
    """The binary files that the rows of ``files`` name by ``file_path``, as :func:`read_landing_files` gives them.

    Each file is opened by the task that has its name: the driver holds no names and looks nothing up,
    and small files are few tasks, since names are dealt and not lengths. A file that is gone is an error.
    """

    names = ["named", "size", "path", "modificationTime", "length", "content"]

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        uris, sizes, *data = zip(*found)
        width, height = (pa.array(side, pa.int32()) for side in zip(*sizes))
        arrays = [pa.array(c, t) for c, t in zip(data, (pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.binary()))]
        return pa.RecordBatch.from_arrays([pa.array(uris, pa.string()), pa.StructArray.from_arrays([width, height], ["width", "height"]), *arrays], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for uri in (u for batch in batches for u in batch.column("file_path").to_pylist()):
            fs, path = locate(uri)
            with fs.open_input_stream(path, compression=None) as source:
                content = source.read()
            changed = (fs.get_file_info(path).mtime_ns or 0) // 1_000_000 * 1000
            if found and (held + len(content) > NAMED_BYTES or len(found) == NAMED_ROWS):
                yield batch_of(found)
                found, held = [], 0
            found.append((uri, frame_size(content) or (None, None), unquote(uri), changed, len(content), content))
            held += len(content)
        if found:
            yield batch_of(found)

    rows = spread_out(files.select("file_path")).mapInArrow(read, f"named string, size struct<width:int,height:int>, {BINARY_SCHEMA}")
    made = add_file_metadata(rows, spec, image=True, label_pattern=label_pattern, file_path=F.col("named"), size=F.col("size"))
    return made.drop("named", "size")


def read_landing_stream(
    spark: SparkSession,
    spec: DatasetSpec,
    fmt: str,
    *,
    schema: T.StructType | str | None = None,
    max_files: int | None = FILES_AT_ONCE,
    options: dict[str, str] | None = None,
    label_pattern: str = LABEL_PATTERN,
) -> DataFrame:
    """Stream of the files that arrive in landing, ``max_files`` at most per micro-batch.

    This is Spark's file source: it knows a file by its path alone, so one that is written
    again under its name is not read again; :func:`siltbed.ingest_stream` does that. Files are
    read whatever their age. ``max_files=None`` leaves the limit to ``options``
    (``maxBytesPerTrigger``). Without ``schema`` it is inferred from all files there now and
    merged into the stored one; give the sink a :func:`siltbed.column_check` if files with
    other columns may arrive while the stream runs. One scan has one column list, so CSV files
    whose header line is not the schema's columns in order stop the stream;
    :func:`siltbed.ingest_stream` reads them by name.
    """
    if fmt == "csv" and has_header(options or {}):
        options = {"enforceSchema": "false", **options}
    schema = _schema(schema or resolve_schema(spark, spec, fmt, None, options))
    reader = spark.readStream.option("maxFileAge", "36500d")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _load(reader, spark, spec, fmt, spec.landing_dir, schema, options, label_pattern)
