"""Inferred schemas, kept and widened between runs."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..tables import one_row, read_or_empty

CORRUPT = "_corrupt_record"


def widen(stored: T.StructType, seen: T.StructType, *, types: bool = False) -> tuple[T.StructType, bool]:
    """``stored`` with the fields only ``seen`` has, last; and whether any type clashed.

    The stored type of a field stays, except that structs gain new inner fields and, with
    ``types``, that it becomes the type both widen to (:func:`common_type`).
    """
    by_name = {f.name: f for f in seen.fields}
    folded = {f.name.lower(): f.name for f in stored.fields}
    fields, clash = [], False
    for field in stored.fields:
        other = by_name.get(field.name)
        data_type = field.dataType
        if other is not None:
            data_type, clashed = _widen_type(data_type, other.dataType, types)
            clash |= clashed
        fields.append(T.StructField(field.name, data_type, True))
    for name, field in by_name.items():
        known = folded.get(name.lower())
        if known is None:
            fields.append(T.StructField(name, field.dataType, True))
        elif known != name:
            raise ValueError(f"field {name!r} differs from stored field {known!r} only in case")
    return T.StructType(fields), clash


def _widen_type(stored: T.DataType, seen: T.DataType, types: bool) -> tuple[T.DataType, bool]:
    if isinstance(stored, T.StructType) and isinstance(seen, T.StructType):
        return widen(stored, seen, types=types)
    if isinstance(stored, T.ArrayType) and isinstance(seen, T.ArrayType):
        inner, clash = _widen_type(stored.elementType, seen.elementType, types)
        return T.ArrayType(inner, True), clash
    if isinstance(stored, T.MapType) and isinstance(seen, T.MapType):
        inner, clash = _widen_type(stored.valueType, seen.valueType, types)
        return T.MapType(stored.keyType, inner, True), clash
    if types:
        both = common_type(stored, seen)
        return (stored, True) if both is None else (both, False)
    return stored, not _reads_as(seen, stored)


_INTEGERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
# Decimal digits that hold every value of an integer type.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type to which both widen, None where there is none.

    Integers widen to longer ones, to decimals that hold them all and to ``double``, ``float`` to
    ``double``, decimals to more digits on either side, ``date`` to ``timestamp_ntz``, no value (void) to
    all. A ``bigint`` beyond 2**53 is rounded as a ``double``; nothing else loses anything.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    whole = [type(t) in _INTEGERS for t in (a, b)]
    if all(whole):
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    if {type(a), type(b)} <= {*_INTEGERS, T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if all(isinstance(t, T.DecimalType) or w for t, w in zip((a, b), whole)):
        sides = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)]
        digits, scale = (max(side) for side in zip(*sides))
        return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else None
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return None


def reads_natively(have: T.DataType, want: T.DataType) -> bool:
    """Whether Spark's Parquet reader gives a column stored as ``have`` when asked for ``want``."""
    if have == want or isinstance(have, T.NullType):
        return True
    if type(have) is type(want) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        if isinstance(have, T.StructType):
            inner = {f.name: f.dataType for f in want.fields}
            return all(f.name in inner and reads_natively(f.dataType, inner[f.name]) for f in have.fields)
        parts = ("elementType",) if isinstance(have, T.ArrayType) else ("keyType", "valueType")
        return all(reads_natively(getattr(have, p), getattr(want, p)) for p in parts)
    if type(have) in _INTEGERS and type(want) in _INTEGERS:
        return _INTEGERS.index(type(have)) <= _INTEGERS.index(type(want))
    if type(have) in _INTEGERS[:3]:
        return isinstance(want, T.DoubleType)
    if isinstance(have, T.FloatType):
        return isinstance(want, T.DoubleType)
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        return have.scale <= want.scale and have.precision - have.scale <= want.precision - want.scale
    return isinstance(have, T.DateType) and isinstance(want, T.TimestampNTZType)


def _reads_as(seen: T.DataType, stored: T.DataType) -> bool:
    """Whether every text that infers as ``seen`` also parses as ``stored``."""
    if seen == stored or isinstance(seen, T.NullType) or isinstance(stored, T.StringType):
        return True
    order = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]
    if type(seen) in order and type(stored) in order:
        return order.index(type(seen)) <= order.index(type(stored))
    return isinstance(seen, T.DateType) and isinstance(stored, (T.TimestampType, T.TimestampNTZType))


class SchemaStore:
    """Versions of one dataset's reader schema below ``directory``."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark, self.directory = spark, directory

    def latest(self) -> tuple[int, T.StructType] | None:
        rows = (
            read_or_empty(self.spark, self.directory, "fields string, version int")
            .agg(F.max(F.struct("version", "fields")).alias("last"))
            .first()
        )
        if rows is None or rows["last"] is None:
            return None
        version, fields = rows["last"]
        return version, T.StructType.fromJson(json.loads(fields))

    def version(self) -> int:
        """Number of the latest version, 0 when there is none."""
        return (self.latest() or (0, None))[0]

    def put(self, version: int, schema: T.StructType) -> None:
        row = one_row(self.spark, fields=schema.json())
        row.write.mode("overwrite").parquet(f"{self.directory}/version={version}")

    def evolve(self, seen: T.StructType, *, quarantine: bool, types: bool = False) -> T.StructType:
        """Merge ``seen`` into the stored schema and keep the result.

        With ``quarantine``, a type clash adds the column for records that do not parse; with
        ``types``, stored types widen where :func:`common_type` knows how.
        """
        stored = self.latest()
        version, schema = stored or (0, T.StructType())
        wider, clash = widen(schema, seen, types=types)
        if clash and types:
            raise ValueError(f"column types of {self.directory} cannot be widened to {seen.simpleString()}")
        if clash and quarantine and CORRUPT not in wider.fieldNames():
            wider = wider.add(CORRUPT, T.StringType())
        if stored is None or wider != schema:
            self.put(version + 1, wider)
        return wider
