"""Width and height of JPEG bytes from their frame header."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIZE = T.StructType(
    [T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]
)

# Enough for the header of a picture without large embedded profiles or previews.
HEAD_BYTES = 16 * 1024

# Fixed values (ITU-T T.81): start-of-frame markers, and markers without a length field.
_FRAME = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
_BARE = frozenset(range(0xD0, 0xD8)) | {0x01}


def frame_size(data: bytes | None) -> tuple[int, int] | None:
    """(width, height) of the first frame header; None when there is none in ``data``."""
    if data is None or data[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            return None
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
        elif marker in _BARE:
            at += 2
        elif marker in _FRAME:
            if at + 9 > len(data):
                return None
            return int.from_bytes(data[at + 7:at + 9]), int.from_bytes(data[at + 5:at + 7])
        elif marker in (0xD9, 0xDA):
            return None
        else:
            at += 2 + int.from_bytes(data[at + 2:at + 4])
    return None


@F.arrow_udf(SIZE)
def _size(content: pa.Array) -> pa.Array:
    sizes = [frame_size(data) or (None, None) for data in content.to_pylist()]
    width, height = zip(*sizes) if sizes else ((), ())
    return pa.StructArray.from_arrays(
        [pa.array(width, pa.int32()), pa.array(height, pa.int32())], ["width", "height"]
    )


def jpeg_size(content: Column) -> Column:
    """struct<width,height>; null fields where the bytes are no JPEG.

    Python gets the first bytes of every picture, and the whole picture only where the
    header was not in them, so a batch of large pictures does not cross to Python whole.
    """
    head = _size(F.substring(content, 1, HEAD_BYTES))
    missed = head["width"].isNull() & (F.length(content) > HEAD_BYTES)
    return F.when(missed, _size(F.when(missed, content))).otherwise(head)
