"""Hierarchical packing of documents into training sequences of several lengths.

A document is cut into full long windows; what is left over is routed to the shortest tier
that holds it. Each tier opens a window for each of its pieces and fills the gap with whole
pieces of shorter tiers, longest first; the last gap takes the head of a piece. Every window
is thus full. The windows of a round are dealt to step groups of equal size, largest first
to the group with the fewest tokens, so that each group gets its share of every tier.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import TEXT_BYTES, batch_ids, text_encoder
from .shared import give_back, tidy
from .wordhash import slices

TIERS = (256, 512, 1024, 2048)
# Windows of a step group, counted in the longest tier.
STEP_WINDOWS = 64
# Pieces that wait for a window, per task, before a round of packing.
POOL_PIECES = 4096
# Bytes of text after which a task gives back the memory that taking them apart has left unused.
RELEASE_BYTES = 1 << 20
SEPARATOR = 1

# A piece: length, a number that makes it unique, document, start, ids as bytes of 4 each.
Piece = tuple[int, int, int, int, bytes]
_SCHEMA = "piece_start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


class Packer:
    """Packs the pieces of one task; ``sequences`` collects finished windows."""

    def __init__(self, tiers=TIERS):
        self.tiers = sorted(tiers)
        self.pools: dict[int, list[Piece]] = {t: [] for t in self.tiers}
        self.sequences: list[tuple[int, list[Piece]]] = []
        self._serial = 0

    @property
    def waiting(self) -> int:
        return sum(map(len, self.pools.values())) + len(self.sequences)

    def _put(self, document: int, start: int, ids: bytes) -> None:
        length = len(ids) // 4
        tier = next(t for t in self.tiers if t >= length)
        self._serial += 1
        insort(self.pools[tier], (length, self._serial, document, start, ids))

    def add(self, document: int, ids: bytes) -> None:
        """Cut off full long windows and route the rest."""
        longest, at = self.tiers[-1], 0
        while len(ids) - at >= 4 * longest:
            self.sequences.append((longest, [(longest, 0, document, at // 4, ids[at:at + 4 * longest])]))
            at += 4 * longest
        if at < len(ids):
            self._put(document, at // 4, ids[at:])

    def _fill(self, tier: int, window: list[Piece], gap: int) -> int:
        """Put whole pieces of the tiers up to ``tier`` into the gap; returns what stays open."""
        for t in reversed([t for t in self.tiers if t <= tier]):
            pool = self.pools[t]
            while gap and (k := bisect_right(pool, gap, key=lambda p: p[0])):
                window.append(pool.pop(k - 1))
                gap -= window[-1][0]
        return gap

    def _cut(self, window: list[Piece], gap: int, tier: int) -> int:
        """Fill the gap with the head of the shortest piece that is longer."""
        for t in (t for t in self.tiers if t <= tier):
            if pool := self.pools[t]:
                length, serial, document, start, ids = pool.pop(bisect_right(pool, gap, key=lambda p: p[0]))
                window.append((gap, serial, document, start, ids[:4 * gap]))
                self._put(document, start + gap, ids[4 * gap:])
                return 0
        return gap

    def pack(self) -> None:
        """Windows of every tier, longest first, as long as they can be filled."""
        for tier in reversed(self.tiers):
            pool = self.pools[tier]
            while pool:
                window = [pool.pop()]
                gap = self._fill(tier, window, tier - window[0][0])
                if gap:
                    gap = self._cut(window, gap, tier)
                if gap:
                    for piece in window:
                        insort(self.pools[next(t for t in self.tiers if t >= piece[0])], piece)
                    break
                self.sequences.append((tier, window))

    def finish(self) -> None:
        """Pack what is left into full windows and then into ever smaller powers of two."""
        self.pack()
        rest = [p for t in reversed(self.tiers) for p in reversed(self.pools[t])]
        self.pools = {t: [] for t in self.tiers}
        total = sum(p[0] for p in rest)
        size = self.tiers[-1]
        while total:
            if size > total:
                size //= 2
                continue
            window, gap = [], size
            while gap:
                length, serial, document, start, ids = rest.pop()
                take = min(length, gap)
                window.append((take, serial, document, start, ids[:4 * take]))
                if take < length:
                    rest.append((length - take, serial, document, start + take, ids[4 * take:]))
                gap -= take
            self.sequences.append((size, window))
            total -= size


def deal(sizes: list[int], step_tokens: int) -> list[int]:
    """Step group of each sequence: as many groups as needed, each with about as many tokens."""
    groups = max(1, -(-sum(sizes) // step_tokens))
    heap, found = [(0, g) for g in range(groups)], [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        tokens, group = heapq.heappop(heap)
        found[k] = group
        heapq.heappush(heap, (tokens + sizes[k], group))
    return found


def pack_documents(
    docs: DataFrame,
    path: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    tiers: tuple[int, ...] = TIERS,
    step_windows: int = STEP_WINDOWS,
    separator: int = SEPARATOR,
    ids: bool = False,
    text_bytes: int = TEXT_BYTES,
) -> DataFrame:
    """Pieces of documents with their place in packed sequences.

    A document is the token ids of its text (a null text has none) and then ``separator``.
    Returns per piece the id column, ``start`` (tokens of the document before it), ``length``,
    ``ids_crc32`` (of little-endian unsigned 32-bit ids), ``doc_tokens``, ``sequence_id``,
    ``offset`` in the sequence (gapless from 0), ``tier`` (tokens of the sequence) and
    ``step_group``; with ``ids`` also the token ids. Sequences are full: their lengths are the
    ``tiers`` (powers of two), but for a few smaller powers of two that end a task's share.
    ``text_bytes`` of text (at least a whole one) are taken apart together; it changes no result.

    Each task packs its own rows, so nothing is shuffled, a hot source is no matter and a lost
    task is done again alone. Sequence ids hold the task's number. Ids may be null or repeat;
    every row is packed. No rows give no pieces.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    step_tokens = step_windows * max(tiers)
    end = separator.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path, by_library=True)
        packer, documents = Packer(tiers), {}
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        serial = sequences = groups = handled = 0
        id_type = None

        def flushed() -> pa.RecordBatch:
            nonlocal sequences, groups
            found = deal([size for size, _ in packer.sequences], step_tokens)
            columns: list[list] = [[] for _ in range(10)]
            for (size, window), group in zip(packer.sequences, found):
                offset = 0
                for length, _, document, start, data in window:
                    owner, tokens = documents[document]
                    row = owner, start, length, zlib.crc32(data), tokens, first + sequences, offset, size, first + groups + group, data
                    for column, value in zip(columns, row):
                        column.append(value)
                    offset += length
                sequences += 1
            groups += max(found, default=-1) + 1
            packer.sequences.clear()
            waiting = {p[2] for pool in packer.pools.values() for p in pool}
            for document in [d for d in documents if d not in waiting]:
                del documents[document]
            kinds = [id_type, *[pa.int64()] * 6, pa.int32(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            names = ["id", *(c.split()[0] for c in _SCHEMA.split(", "))]
            if ids:
                flat = pa.Array.from_buffers(pa.int32(), sum(map(len, columns[9])) // 4, [None, pa.py_buffer(b"".join(columns[9]))])
                ends = [0]
                for data in columns[9]:
                    ends.append(ends[-1] + len(data) // 4)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in (part for whole in batches for part in slices(whole, "text", text_bytes)):
            id_type = batch.schema.field("id").type
            if (handled := handled + batch.nbytes) > RELEASE_BYTES:
                handled = 0
                give_back()
            flat, bounds = batch_ids(encoder, batch.column("text"))
            for owner, low, high in zip(batch.column("id").to_pylist(), bounds, bounds[1:]):
                data = flat[low:high].tobytes() + end
                serial += 1
                documents[serial] = owner, len(data) // 4
                packer.add(serial, data)
                if packer.waiting > 2 * POOL_PIECES:
                    packer.pack()
                    yield flushed()
        if id_type is not None:
            packer.finish()
            yield flushed()

    schema = f"id {kind}, {_SCHEMA}" + (", ids array<int>" if ids else "")
    made = rows.mapInArrow(tidy(run), schema)
    return made.withColumnsRenamed({"id": id_column, "piece_start": "start"})
