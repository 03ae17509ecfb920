"""Exact duplicates found by compressed radix tries over whole texts.

Texts are dealt to partitions by length and content hash. One trie for each partition takes the
full byte strings of all its texts, so equality is decided by the bytes, and texts that begin
alike share nodes; a terminal node holds the identifier that stays and the number of rows.

Tasks first merge the copies among their own rows in such a trie, which leaves a hot text one
row per task. When that trie grows too large, whole subtrees, the largest first, are sent on and
removed; the owners of the second step meet such texts again. These get their texts in order,
so that subtrees no later text can reach leave as soon as they are finished, and the
trie holds little more than the text at hand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import tidy

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes of text that the tries of a task hold before subtrees are sent on.
TRIE_BYTES = 32 << 20
# Bytes of text that leave a trie together.
BATCH_BYTES = 4 << 20


class Node:
    """An edge's bytes, what follows by first byte, and for a terminal its value."""

    __slots__ = ("edge", "children", "value")

    def __init__(self, edge: bytes, value=None):
        self.edge, self.children, self.value = edge, {}, value


class PatriciaTrie:
    """Byte strings with values; strings that share a head share its nodes."""

    def __init__(self):
        self.root = Node(b"")
        self.held = 0

    def insert(self, key: bytes, value, merge) -> None:
        """Store ``value``, or ``merge(old, value)`` where the key is there already."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], value)
                self.held += len(key) - at
                return
            edge = child.edge
            if key.startswith(edge, at):
                node, at = child, at + len(edge)
                continue
            n = 1
            while n < len(edge) and at + n < len(key) and edge[n] == key[at + n]:
                n += 1
            middle = Node(edge[:n])
            child.edge = edge[n:]
            middle.children[child.edge[0]] = child
            node.children[edge[0]] = middle
            node, at = middle, at + n
        node.value = value if node.value is None else merge(node.value, value)

    @staticmethod
    def _walk(node: Node, head: bytes) -> Iterator[tuple[bytes, object]]:
        stack = [(node, head)]
        while stack:
            node, head = stack.pop()
            key = head + node.edge
            if node.value is not None:
                yield key, node.value
            stack += [(child, key) for child in node.children.values()]

    def items(self) -> Iterator[tuple[bytes, object]]:
        return self._walk(self.root, b"")

    @staticmethod
    def _size(node: Node) -> int:
        """Bytes of all edges of a subtree."""
        total, stack = 0, [node]
        while stack:
            node = stack.pop()
            total += len(node.edge)
            stack += node.children.values()
        return total

    def spill(self, keep: int = 0) -> Iterator[tuple[bytes, object]]:
        """Remove whole subtrees, the largest first, until no more than ``keep`` bytes are held (0: all); what they held."""
        node, head = self.root, b""
        # All keys may begin alike: subtrees are those below where they part.
        while len(node.children) == 1 and node.value is None:
            head += node.edge
            node = next(iter(node.children.values()))
        head += node.edge
        for size, first in sorted(((self._size(c), f) for f, c in node.children.items()), reverse=True):
            if keep and self.held <= keep:
                return
            self.held -= size
            yield from self._walk(node.children.pop(first), head)
        if self.held > keep or not keep:
            if node.value is not None:
                yield head, node.value
            self.root, self.held = Node(b""), 0

    def finished(self, key: bytes) -> Iterator[tuple[bytes, object]]:
        """Remove the subtrees that no later key can reach when keys come in order."""
        node, at = self.root, 0
        while at < len(key):
            for first in [c for c in node.children if c < key[at]]:
                yield from self._walk(node.children.pop(first), key[:at])
            child = node.children.get(key[at])
            if child is None:
                return
            if not key.startswith(child.edge, at):
                rest = key[at:at + len(child.edge)]
                if child.edge < rest:
                    yield from self._walk(node.children.pop(key[at]), key[:at])
                return
            node, at = child, at + len(child.edge)


def folded(text: Column) -> Column:
    """The text that is compared: A to Z in lower case, nothing else changed; null is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def owners(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "largest",
    payload: bool = False,
    limit: int = TRIE_BYTES,
) -> DataFrame:
    """One row per different text: ``text_sha256``, ``keep_id``, ``group_size``.

    With ``payload`` the kept row itself is in the struct ``kept_row``. Of equal texts the row
    with the ``largest`` (or ``smallest``) id stays; a null id only where all are null; of rows
    that repeat an id any one. Empty tables give no rows.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    largest = keep == "largest"
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if payload else F.lit(None).cast("boolean")
    rows = docs.select(
        F.col(id_column).alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        folded(F.col(text_column)).alias("content"),
        whole.alias("kept_row"),
    )
    place = [F.octet_length("content").alias("length"), F.xxhash64("content").alias("hash")]
    kinds = {f.name: f.dataType for f in rows.schema}
    ddl = lambda *names: ", ".join(f"`{n}` {kinds[n].simpleString() if n in kinds else 'string'}" for n in names)

    def better(old, new):
        i, j = old[0], new[0]
        wins = j is not None and (i is None or (j > i if largest else j < i))
        return (new[0] if wins else i, old[1] + new[1], new[2] if wins else old[2])

    def batch_of(found: list, like: pa.RecordBatch, digest: bool) -> pa.RecordBatch:
        ids, counts, places = zip(*(v for _, v in found)) if found else ((), (), ())
        if digest:
            texts = pa.array([hashlib.sha256(k).hexdigest() for k, _ in found], pa.string())
        else:
            texts = pa.array([k for k, _ in found], pa.binary()).cast(pa.string(), safe=False)
        if payload:
            runs = [(held, [k for _, k in run]) for _, run in groupby(places, key=lambda p: id(p[0])) for run in [list(run)] for held in [run[0][0]]]
            kept = pa.concat_arrays([like.column("kept_row").slice(0, 0), *(held.take(pa.array(at)) for held, at in runs)])
        else:
            kept = pa.nulls(len(found), pa.bool_())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, like.schema.field("keep_id").type), pa.array(counts, pa.int64()), texts, kept],
            ["keep_id", "group_size", "text_sha256" if digest else "content", "kept_row"],
        )

    def entries(batch: pa.RecordBatch):
        held = batch.column("kept_row")
        values = zip(batch.column("keep_id").to_pylist(), batch.column("group_size").to_pylist())
        for k, (text, (i, n)) in enumerate(zip(batch.column("content"), values)):
            yield text.as_buffer().to_pybytes(), (i, n, (held, k) if payload else None)

    def batches_of(found: Iterator[tuple[bytes, tuple]], like: pa.RecordBatch, digest: bool) -> Iterator[pa.RecordBatch]:
        """What leaves a trie, some MB at a time."""
        some, size = [], 0
        for key, value in found:
            some.append((key, value))
            size += len(key)
            if size > BATCH_BYTES:
                yield batch_of(some, like, digest)
                some, size = [], 0
        if some:
            yield batch_of(some, like, digest)

    def merge_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, like = PatriciaTrie(), None
        for batch in batches:
            like = batch
            for text, value in entries(batch):
                trie.insert(text, value, better)
                if trie.held > limit:
                    yield from batches_of(trie.spill(limit // 2), like, False)
            if payload:
                # Kept rows point into the batch, which must not be held for long.
                yield from batches_of(trie.items(), like, False)
                trie = PatriciaTrie()
        if like is not None:
            yield from batches_of(trie.items(), like, False)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie()
        for batch in batches:
            def finished() -> Iterator[tuple[bytes, tuple]]:
                for text, value in entries(batch):
                    yield from trie.finished(text)
                    trie.insert(text, value, better)

            yield from batches_of(finished(), batch, True)
            like = batch
        if trie.root.children or trie.root.value is not None:
            yield from batches_of(trie.items(), like, True)

    merged = rows.mapInArrow(tidy(merge_copies), ddl("keep_id", "group_size", "content", "kept_row"))
    dealt = merged.select("*", *place).repartition("length", "hash").sortWithinPartitions("content").drop("length", "hash")
    names = ["text_sha256", "keep_id", "group_size"] + ["kept_row"] * payload
    return dealt.mapInArrow(tidy(own), ddl("keep_id", "group_size", "text_sha256", "kept_row")).select(*names)


def exact_duplicates(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest") -> DataFrame:
    """One row per row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``kept`` holds for every row with the id that stays, so rows that repeat it are all marked.
    Only the digest joins rows to the groups of several rows; a hot group is split by adaptive
    execution. See :func:`owners` for null ids, null texts and ties.
    """
    groups = owners(docs, id_column=id_column, text_column=text_column, keep=keep).where("group_size > 1")
    rows = docs.select(F.col(id_column).alias("id"), F.sha2(folded(F.col(text_column)), 256).alias("text_sha256"))
    found = rows.join(groups, "text_sha256", "left")
    keep_id = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("id").alias(id_column), keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"), "text_sha256",
    )


def kept_documents(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, one for each different text, with all their columns."""
    found = owners(docs, id_column=id_column, text_column=text_column, keep=keep, payload=True)
    return found.select(*[F.col("kept_row").getField(c).alias(c) for c in docs.columns])
