"""Near duplicates by ProbMinHash, banding and exact verification.

A text is the weighted set of its five-word shingles, the weight being how often one occurs.
Every shingle is a Poisson process whose rate is its weight; each arrival falls on a random
register, and a register keeps the shingle whose arrival was first. Two texts agree in a
register with the probability that is their probability Jaccard similarity. A shingle's
process is left as soon as its next arrival is later than all registers' first ones.

Texts with equal weighted sets become one node. Nodes that agree in a band meet in a bucket.
First each node is verified against one node, the first of the most of its buckets, which
settles most of a group of copies with a pair a member. In two rounds each node that is not
in the largest component of a bucket is then verified against the node of its buckets whose
sketch is most like its own, among those not yet connected with it. In buckets that still hold several components, all pairs between
components whose sketches are similar are at last verified in place, in blocks of a bucket,
each pair in the first bucket that it shares. The largest component of a bucket meets only
blocks of the others, so a bucket costs its members times those that are not connected with
most of them: what grows with the square is only a bucket of texts that share a band and
are not alike. Only links leave a block. No bucket is dropped or cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import rows_at_once, stored, tidy
from .wordhash import combined, mix, shingles, slices, word_hashes

WORDS = 5
SIMILARITY = 0.8
# 20 bands of 6 registers: a pair at 0.8 shares a bucket with probability 0.998.
BANDS, ROWS = 20, 6
# Sketches of pairs at 0.8 agree in a share of the registers below this once in 10,000.
SKETCH_SIMILARITY = 0.66
# Members of a block; two blocks of a bucket are compared in one place.
BLOCK = 512
# Rows that go to a Python worker together, and bytes of text that it hashes together.
BATCH_ROWS = 256
TEXT_BYTES = 1 << 20

_STEP = np.uint64(0xD1B54A32D192ED03)
# Beyond ASCII: what is neither letter, mark nor digit, and letters of scripts that set no blanks between words.
_BETWEEN = r"[^\x00-\x7F\p{L}\p{M}\p{N}]+"
_UNSPACED = "[" + "".join(rf"\p{{Is{s}}}" for s in ("Han", "Hiragana", "Katakana", "Bopomofo", "Yi", "Thai", "Lao", "Khmer", "Myanmar", "Tai_Le", "New_Tai_Lue", "Tai_Tham", "Tai_Viet", "Javanese", "Balinese")) + r"]\p{M}*"

# Whether a text has anything beyond ASCII and Latin letters; whether it has a script without blanks (or later ones).
_ODD = r"[^\x00-\x7F\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u02AF]"
_BEYOND = r"[\u0E00-\x{10FFFF}]"


def weighted_set(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles in order, and how often each occurs."""
    ordered = np.sort(hashes)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, np.int64)
    return ordered[first], np.diff(np.append(first, len(ordered))).astype(np.uint32)


def signature(elements: np.ndarray, weights: np.ndarray, registers: int = BANDS * ROWS) -> np.ndarray:
    """The element that arrives first at each register. ``elements`` may not be empty."""
    first = np.full(registers, np.inf)
    holder = np.zeros(registers, np.uint64)
    rate, at, step = weights.astype(np.float64), np.zeros(len(elements)), 0
    while len(elements):
        ahead = max(1, 4 * registers // len(elements))
        steps = np.arange(step + 1, step + ahead + 1, dtype=np.uint64)
        random = mix(elements[:, None] + steps * _STEP)
        gaps = -np.log(((random >> np.uint64(11)) + np.uint64(1)) * 2.0 ** -53) / rate[:, None]
        times = at[:, None] + np.cumsum(gaps, axis=1)
        places = (mix(random) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, places.ravel(), times.ravel())
        row, column = np.nonzero(times == first[places])
        holder[places[row, column]] = elements[row]
        at, step = times[:, -1], step + ahead
        going = at < first.max()
        elements, rate, at = elements[going], rate[going], at[going]
    return holder


def band_keys(holder: np.ndarray) -> np.ndarray:
    rows = holder.reshape(BANDS, ROWS)
    return combined([np.arange(BANDS, dtype=np.uint64), *rows.T]).view(np.int64)


def probability_jaccard(e1: np.ndarray, w1: np.ndarray, e2: np.ndarray, w2: np.ndarray) -> float:
    """Sum over common elements i of 1 / sum over j of max(p_j / p_i, q_j / q_i).

    Without repeated shingles this is the Jaccard similarity of the sets.
    """
    if not len(e1) or not len(e2):
        return 0.0
    _, at1, at2 = np.intersect1d(e1, e2, assume_unique=True, return_indices=True)
    if not len(at1):
        return 0.0
    p, q = w1 / w1.sum(), w2 / w2.sum()
    a, b = p[at1], q[at2]
    ratio = a / b
    order = np.argsort(ratio, kind="stable")
    ratio, a, b = ratio[order], a[order], b[order]
    # Elements of the first text alone have the largest ratio, those of the second the least.
    above = 1.0 - np.cumsum(a) - (p.sum() - 1.0)
    below = np.cumsum(b) + (q.sum() - b.sum())
    return float(np.sum(1.0 / (np.maximum(above, 0.0) / a + below / b)))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, "text", TEXT_BYTES)):
        hashes, bounds = shingles(*word_hashes(batch.column("text")), WORDS)
        nodes, keys, sketches = [], [], []
        for start, end in zip(bounds, bounds[1:]):
            if start == end:
                nodes.append(None), keys.append(None), sketches.append(None)
                continue
            elements, weights = weighted_set(hashes[start:end])
            holder = signature(elements, weights)
            nodes.append(hashlib.blake2b(elements.tobytes() + weights.tobytes(), digest_size=16).digest())
            keys.append(band_keys(holder))
            sketches.append((mix(holder) >> np.uint64(32)).astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("content"), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
            ["id", "content", "node", "bands", "sketch"],
        )


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, "text", TEXT_BYTES)):
        hashes, bounds = shingles(*word_hashes(batch.column("text")), WORDS)
        sets = [weighted_set(hashes[start:end]) for start, end in zip(bounds, bounds[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), *(pa.array([s[k].tobytes() for s in sets], pa.binary()) for k in (0, 1))],
            ["node", "elements", "weights"],
        )


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[x.as_buffer() for x in batch.column(c)] for c in ("elements_a", "weights_a", "elements_b", "weights_b")]
            keep = []
            for e1, w1, e2, w2 in zip(*columns):
                sets = [np.frombuffer(x, t) for x, t in ((e1, np.uint64), (w1, np.uint32), (e2, np.uint64), (w2, np.uint32))]
                keep.append(probability_jaccard(*sets) >= threshold - 1e-12)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _bytes(column: pa.Array, kind: str) -> np.ndarray:
    """A matrix of binary values of one length, a row for each."""
    return np.frombuffer(b"".join(x.as_buffer() for x in column), kind).reshape(len(column), -1)


class _Block:
    """Members of a bucket, or of two of its blocks, in one place."""

    def __init__(self, key: tuple, parts: list[pa.RecordBatch]):
        self.key, self.rows = key, pa.concat_batches(parts)
        self.sketches = _bytes(self.rows.column("sketch"), "<u4")
        bands = self.rows.column("bands")
        self.bands = bands.flatten().to_numpy().reshape(len(bands), -1)
        self.labels = self.rows.column("label").dictionary_encode().indices.to_numpy(zero_copy_only=False).copy()
        self.blocks = self.rows.column("block").to_numpy()

    def others(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Members with other labels and similar sketches that this block answers for, and how similar."""
        bucket, low, high = self.key
        apart = self.labels != self.labels[i]
        if low != high:
            apart &= self.blocks != self.blocks[i]
        others = np.flatnonzero(apart)
        alike = (self.sketches[others] == self.sketches[i]).mean(axis=1)
        near = alike >= SKETCH_SIMILARITY
        others, alike = others[near], alike[near]
        # Of the buckets that a pair shares the first one answers for it.
        own = np.argmax(self.bands[i] == bucket)
        first = np.argmax(self.bands[others] == self.bands[i], axis=1) == own if len(others) else np.zeros(0, bool)
        return others[first], alike[first]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    """Rows that come ordered by bucket and pair of blocks, a pair at a time."""
    key, parts, held = None, [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "low", "high")])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            own = tuple(int(k) for k in keys[:, start])
            if own != key:
                if held > 1:
                    yield _Block(key, parts)
                key, parts, held = own, [], 0
            parts.append(batch.slice(start, end - start))
            held += end - start
    if held > 1:
        yield _Block(key, parts)


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each member the one of another label whose sketch is most like its own."""
    for block in _blocks(batches):
        found = []
        for i in np.flatnonzero(block.rows.column("asks").to_numpy(zero_copy_only=False)):
            others, alike = block.others(i)
            if len(others):
                best = int(np.argmax(alike))
                found.append((int(i), int(others[best]), float(alike[best])))
        nodes = block.rows.column("node")
        yield pa.RecordBatch.from_arrays(
            [*(nodes.take(pa.array([f[k] for f in found], pa.int64())) for k in (0, 1)), pa.array([f[2] for f in found], pa.float64())], ["a", "b", "alike"]
        )


_BLOCK_ROW = "bucket long, low int, high int, node binary, label binary, block int, sketch binary, bands array<bigint>, asks boolean"


def _unsettled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members that some other of another label may be linked with."""
    for block in _blocks(batches):
        open_rows = [i for i in range(len(block.blocks)) if len(block.others(i)[0])]
        yield block.rows.select([c.split()[0] for c in _BLOCK_ROW.split(", ")]).take(pa.array(open_rows, pa.int64()))


def _settled(threshold: float):
    """Links between members of different labels, as many as connect what can be connected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            columns = (block.rows.column(c) for c in ("elements", "weights"))
            sets = [(np.frombuffer(e.as_buffer(), np.uint64), np.frombuffer(w.as_buffer(), np.uint32)) for e, w in zip(*columns)]
            plain = np.array([w.max(initial=1) == 1 for _, w in sets])
            sizes = np.array([len(e) for e, _ in sets])
            links = []
            for i in range(len(sets)):
                others = block.others(i)[0]
                others = others[others > i]
                while len(others):
                    # Sets without weights are counted together, some millions of elements at a time.
                    part = others[:max(1, int(np.searchsorted(np.cumsum(sizes[others]), 2_000_000)))]
                    others = others[len(part):]
                    simple = part[plain[part]] if plain[i] else part[:0]
                    linked = []
                    if len(simple):
                        at = np.searchsorted(sets[i][0], together := np.concatenate([sets[j][0] for j in simple]))
                        common = np.add.reduceat(sets[i][0][np.minimum(at, sizes[i] - 1)] == together, np.concatenate([[0], np.cumsum(sizes[simple])[:-1]]), dtype=np.int64)
                        linked += list(simple[common / (sizes[i] + sizes[simple] - common) >= threshold - 1e-12])
                    linked += [j for j in np.setdiff1d(part, simple) if probability_jaccard(*sets[i], *sets[j]) >= threshold - 1e-12]
                    for j in linked:
                        if block.labels[i] != block.labels[j]:
                            links.append((i, int(j)))
                            block.labels[block.labels == block.labels[j]] = block.labels[i]
                    if linked and len(others):
                        others = others[block.labels[others] != block.labels[i]]
            nodes = block.rows.column("node")
            yield pa.RecordBatch.from_arrays([nodes.take(pa.array([x[k] for x in links], pa.int64())) for k in (0, 1)], ["a", "b"])

    return run


def in_words(text: Column) -> Column:
    """Lower-case text in which what is no letter, mark or digit beyond ASCII is a blank, and unspaced letters are words.

    Texts of ASCII and Latin letters alone are that already.
    """
    lower = F.lower(text)
    apart = F.regexp_replace(lower, _BETWEEN, " ")
    unspaced = F.when(apart.rlike(_BEYOND), F.regexp_replace(apart, _UNSPACED, " $0 ")).otherwise(apart)
    plain = (F.octet_length(lower) == F.char_length(lower)) | ~lower.rlike(_ODD)
    return F.when(plain, lower).otherwise(unspaced)


def _content(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def _classes(docs: DataFrame, id_column: str, text_column: str, similarity: float) -> DataFrame:
    """The rows of :func:`_found_classes`, whose Python workers get small batches."""
    with rows_at_once(docs.sparkSession, BATCH_ROWS):
        return _found_classes(docs, id_column, text_column, similarity)


def _found_classes(docs: DataFrame, id_column: str, text_column: str, similarity: float) -> DataFrame:
    """``id, content, least, n, keeper`` of every row: a digest of its text, and of its class the least id, the
    number of rows and the row that stays; the last three are null where no other row is in the class."""
    plain = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), in_words(plain).alias("text"), _content(F.col(text_column)).alias("content"))
    kind = rows.schema["id"].dataType.simpleString()
    signed = stored(rows.mapInArrow(tidy(_sign), f"id {kind}, content binary, node binary, bands array<bigint>, sketch binary"), "signed")

    met = signed.where("node is not null").select("node", F.explode("bands").alias("bucket")).distinct()
    shared = met.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last")
    members = stored(met.join(shared.drop("last"), "bucket"), "members")
    # Only nodes that meet others go on, each once, and only a text of each is read again.
    candidates = stored(
        signed.join(members.select("node").distinct(), "node", "left_semi").groupBy("node")
        .agg(F.min("content").alias("content"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")),
        "candidates",
    )
    texts = docs.select(_content(F.col(text_column)).alias("content"), plain.alias("text")).join(candidates.select("content", "node"), "content")
    texts = texts.groupBy("node").agg(F.first("text").alias("text")).select("node", in_words(F.col("text")).alias("text"))
    sets = stored(texts.mapInArrow(tidy(_weigh), "node binary, elements binary, weights binary"), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "pairs")
        compared = pairs
        for side in "ab":
            own = sets.join(pairs.select(F.col(side).alias("node")).distinct(), "node", "left_semi")
            own = own.withColumnsRenamed({"node": side, "elements": f"elements_{side}", "weights": f"weights_{side}"})
            compared = compared.join(own, side)
        return stored(compared.mapInArrow(tidy(_verified(similarity)), "a binary, b binary"), "verified")

    def in_blocks(labels: DataFrame) -> DataFrame:
        """Members of buckets that hold several components, dealt to pairs of blocks of the bucket.

        The largest component has blocks of its own. Two of its members are never compared, so these
        blocks are paired with the others' only.
        """
        now = members.drop("first").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        parts = now.groupBy("bucket", "label").agg(F.count("*").alias("n")).groupBy("bucket").agg(
            F.count("*").alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("main")
        )
        blocks = parts.where("parts > 1").select(
            "bucket", F.col("main.label").alias("main"), F.ceil(F.col("main.n") / BLOCK).cast("int").alias("mains"),
            F.ceil((F.col("n") - F.col("main.n")) / BLOCK).cast("int").alias("others"),
        )
        inside = F.col("label") == F.col("main")
        number = F.xxhash64("node")
        block = F.when(inside, F.pmod(number, F.col("mains"))).otherwise(F.col("mains") + F.pmod(number, F.col("others")))
        last = F.col("mains") + F.col("others") - 1
        return (
            now.join(blocks, "bucket").join(candidates.select("node", "sketch", "bands"), "node")
            .withColumn("block", block.cast("int"))
            .withColumn("other", F.explode(F.sequence(F.when(inside, F.col("mains")).otherwise(0), last)))
            .select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "label", "block", "sketch", "bands", (~inside).alias("asks"))
        )

    def together(rows: DataFrame) -> DataFrame:
        return rows.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")

    # The first node of the most of a node's buckets.
    firsts = members.where("node <> first").groupBy("node", "first").agg(F.count("*").alias("n"))
    leads = firsts.groupBy("node").agg(F.max(F.struct("n", "first")).alias("best")).select("node", "best.first")
    links = verified(leads.select(F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b")).distinct())
    labels = components(links)
    for _ in range(2):
        near = together(in_blocks(labels)).mapInArrow(tidy(_nearest), "a binary, b binary, alike double")
        one_each = near.groupBy("a").agg(F.max(F.struct("alike", "b")).alias("best")).select("a", "best.b")
        found = verified(one_each.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        links = links.union(found)
        labels = components(links)
    open_rows = together(in_blocks(labels)).mapInArrow(tidy(_unsettled), _BLOCK_ROW)
    last = together(stored(open_rows, "unsettled").join(sets, "node")).mapInArrow(tidy(_settled(similarity)), "a binary, b binary")
    labels = components(links.union(last))

    classed = signed.select("id", "content", "node").join(labels, "node", "left").withColumn("class", F.coalesce("label", "node"))
    keeper = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "content")).alias("keeper")
    sizes = classed.where("class is not null").groupBy("class").agg(F.min("id").alias("least"), F.count("*").alias("n"), keeper)
    return classed.join(sizes.where("n > 1"), "class", "left").select("id", "content", "least", "n", "keeper")


def near_duplicates(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per row: id, ``class_id`` (smallest id of its class), ``class_size``, ``kept``.

    Classes are the connected components of pairs whose probability Jaccard similarity is at
    least ``similarity``; words are runs of letters, marks and digits in lower case, and single letters in
    scripts without blanks between words (Chinese, Japanese, Thai and others). A text of less
    than five words is one shingle; a null text or one without words is a class of its own.
    ``kept`` holds for rows with the class's id, so for all rows that repeat that id. In a
    class a null id is named only where all are null. Empty tables give no rows.
    """
    found = _classes(docs, id_column, text_column, similarity)
    class_id = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("least"))
    return found.select(
        F.col("id").alias(id_column), class_id.alias("class_id"), F.coalesce("n", F.lit(1).cast("long")).alias("class_size"),
        F.col("id").eqNullSafe(class_id).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each class, in the columns of ``docs``.

    It is the one of the smallest id, null being last, and of several texts under that id the one of the
    smallest digest; so an id that repeats with other texts loses none of their classes. Rows that repeat
    both id and text are one document and stay or go together. A null text or one without words stays.
    """
    own = _classes(docs, id_column, text_column, similarity)
    stays = F.col("id").eqNullSafe(F.col("keeper.id")) & (F.col("content") == F.col("keeper.content"))
    gone = own.where(F.col("n").isNotNull() & ~stays).select(F.col("id").alias("gone_id"), F.col("content").alias("gone_content")).distinct()
    same = docs[id_column].eqNullSafe(gone["gone_id"]) & (_content(docs[text_column]) == gone["gone_content"])
    return docs.join(gone, same, "left_anti")
