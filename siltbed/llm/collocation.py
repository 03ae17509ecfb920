"""Phrases whose words belong together, mined from a weighted de Bruijn graph.

Edges are phrases of ``longest`` words, nodes the phrases one word shorter that they overlap
in. Only the longest phrase that begins at each word is counted over the corpus: an edge or,
where a run of words ends, a shorter tail. The count of a node is the flow out of it (the
edges that begin with it) and the tails that are the node itself; the same step gives the
counts of ever shorter phrases down to words. Unary paths, on which all flow that enters a node
leaves it by one edge, are compacted first and enter the step whole.

No phrase is as frequent as asked unless all pairs of neighbours in it are, so runs end
between pairs that are not. Which ones are is kept in a filter of fixed size, by hash: a pair
too many only lengthens runs, and counts of frequent phrases are exact whatever its load.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import stored
from .wordhash import buffer_of, combined, slices

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
UNKNOWN = "und"
# Bits of the filter of frequent pairs, a power of two: 8 MB on every worker.
FILTER_BITS = 1 << 26
# Bytes of text that are looked at together; only a longer piece is taken whole.
STRETCH = 1 << 22
# Different pairs that a task gathers before it sends them on.
PAIRS = 1 << 20

# Kinds of bytes: 0 part of a word, 1 blank, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of a stretch of text in order, as numbers of its different words."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        """``bounds``: places in ``data`` where a text begins."""
        kind = _KIND[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = kind == 0
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        bounds = np.unique(bounds)
        cut = bounds[(bounds > 0) & (bounds < len(data))]
        cut = cut[inside[cut] & inside[cut + 1]]  # a word ends where its text ends
        if len(cut):
            edges = np.sort(np.concatenate([edges, cut, cut]))
        starts, ends = edges[::2], edges[1::2]
        piece = np.searchsorted(np.flatnonzero(kind == 2), starts) + np.searchsorted(bounds, starts, side="right")
        #: Whether a word and the next one lie in one piece.
        self.joined = piece[1:] == piece[:-1]
        sizes = ends - starts
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        body = _LOWER[data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]]
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body))
        found = words.dictionary_encode()
        self.codes = found.indices.to_numpy(zero_copy_only=False)
        self.different = found.dictionary

    def __len__(self) -> int:
        return len(self.codes)

    def pairs(self, key: np.uint64) -> np.ndarray:
        """A hash of each word with the next one; ``key`` sets languages apart."""
        hashes = pd.util.hash_array(self.different.to_numpy(zero_copy_only=False), categorize=False)
        own = hashes[self.codes]
        return combined([np.full(max(0, len(own) - 1), key, np.uint64), own[:-1], own[1:]])

    def grams(self, joined: np.ndarray, longest: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
        """Different phrases and their counts by length: at each word the longest that ``joined`` allows."""
        n = len(self)
        ends = np.flatnonzero(np.append(~joined, True)) + 1 if n else np.empty(0, np.int64)
        reach = np.minimum(ends[np.searchsorted(ends, np.arange(n), side="right")] - np.arange(n), longest) if n else ends
        for size in range(1, longest + 1):
            at = np.flatnonzero(reach == size)
            if not len(at):
                continue
            rank = self.codes[at].astype(np.int64)
            for j in range(1, size):
                # Numbers of the different phrases so far stay far below 2**31.
                rank = np.unique(rank * len(self.different) + self.codes[at + j], return_inverse=True)[1].astype(np.int64)
            _, first, counts = np.unique(rank, return_index=True, return_counts=True)
            places = (at[first][:, None] + np.arange(size)).ravel()
            words = self.different.take(pa.array(self.codes[places]))
            lists = pa.LargeListArray.from_arrays(pa.array(np.arange(len(first) + 1) * size, pa.int64()), words)
            yield size, pc.binary_join(lists, pa.scalar(" ", pa.large_string())), counts


def _stretches(texts: pa.Array) -> Iterator[Words]:
    """The words of texts, some MB at a time, cut between pieces."""
    data, bounds = buffer_of(texts)
    at, n = 0, len(data)
    while at < n:
        end = min(at + STRETCH, n)
        if end < n:
            breaks = np.flatnonzero(_KIND[data[at:end]] == 2)
            if len(breaks):
                end = at + int(breaks[-1]) + 1
            else:
                while end < n and _KIND[data[end - 1]] != 2:
                    more = np.flatnonzero(_KIND[data[end:end + STRETCH]] == 2)
                    end = end + int(more[0]) + 1 if len(more) else min(end + STRETCH, n)
        low, high = np.searchsorted(bounds, [at, end])
        yield Words(data[at:end], bounds[low:high] - at)
        at = end


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.uint64, Words]]:
    """The words of all rows, language by language within a run of rows."""
    for batch in (part for whole in batches for part in slices(whole, "text", STRETCH)):
        langs = batch.column("lang").dictionary_encode()
        numbers = langs.indices.to_numpy(zero_copy_only=False)
        names = langs.dictionary.to_pylist()
        keys = pd.util.hash_array(np.array(names, object), categorize=False)
        for k, name in enumerate(names):
            texts = batch.column("text").take(pa.array(np.flatnonzero(numbers == k)))
            for words in _stretches(texts):
                if len(words):
                    yield name, keys[k], words


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of neighbours in a piece and how often each occurs, added up before they leave the task."""
    hashes, counts, waiting, held = np.empty(0, np.uint64), np.empty(0, np.int64), [], 0

    def merge() -> None:
        nonlocal hashes, counts, held
        every = np.concatenate([hashes, *waiting])
        weights = np.concatenate([counts, np.ones(len(every) - len(hashes), np.int64)])
        order = np.argsort(every)
        every = every[order]
        first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.empty(0, np.int64)
        hashes, counts = every[first], np.add.reduceat(weights[order], first) if len(first) else weights
        waiting.clear()
        held = 0

    def made() -> Iterator[pa.RecordBatch]:
        for at in range(0, len(hashes), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(hashes[part].view(np.int64)), pa.array(counts[part])], ["pair", "n"])

    for _, key, words in _by_language(batches):
        waiting.append(words.pairs(key)[words.joined])
        held += len(waiting[-1])
        if held > PAIRS:
            merge()
            if len(hashes) > PAIRS:
                yield from made()
                hashes, counts = hashes[:0], counts[:0]
    merge()
    yield from made()


def _frequent_pairs(spark: SparkSession, rows: DataFrame, min_count: int, bits: int):
    """The filter of pairs that may occur ``min_count`` times, as a broadcast of ``bits / 8`` bytes."""
    counted = rows.mapInArrow(_count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    place = F.col("pair").bitwiseAND(F.lit(bits - 1))
    filled = counted.where(F.col("n") >= min_count).select(
        F.shiftright(place, 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(pair & 63 as int))").alias("mask")
    )
    found = filled.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    held = np.zeros(max(1, bits // 64), np.uint64)
    held[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(held)


def _passes(held: np.ndarray, pairs: np.ndarray, bits: int) -> np.ndarray:
    place = pairs & np.uint64(bits - 1)
    return (held[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def gram_counts(docs: DataFrame, *, text_column: str = "text", lang_column: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, words, phrase, n``: how often each phrase is the longest that begins at a word.

    Phrases have ``longest`` words or end where a run of pairs that may be frequent ends. Their
    counts sum to all words; those that begin with a phrase of ``min_count`` or more sum to its count.
    """
    rows = docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    frequent = _frequent_pairs(docs.sparkSession, rows, min_count, filter_bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = frequent.value
        for lang, key, words in _by_language(batches):
            for size, found, counts in words.grams(words.joined & _passes(held, words.pairs(key), filter_bits), longest):
                langs = pa.repeat(pa.scalar(lang, pa.string()), len(counts))
                sizes = pa.array(np.full(len(counts), size, np.int32))
                yield pa.RecordBatch.from_arrays([langs, sizes, found.cast(pa.string()), pa.array(counts, pa.int64())], ["lang", "words", "phrase", "n"])

    made = rows.mapInArrow(count, "lang string, words int, phrase string, n long")
    return stored(made.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")), "grams")


def _first(phrase: Column | str, words: int | Column) -> Column:
    return F.call_function("substring_index", F.col(phrase) if isinstance(phrase, str) else phrase, F.lit(" "), F.lit(words) if isinstance(words, int) else words)


def _flow(tails: DataFrame, longer: DataFrame, words: int) -> DataFrame:
    """Counts of phrases of ``words`` words: tails of that length and what begins with them."""
    into = longer.select("lang", _first("phrase", words).alias("phrase"), "n")
    tails = tails.where(F.col("words") == words).select("lang", "phrase", "n")
    return tails.union(into).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def unary_paths(edges: DataFrame, nodes: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``lang, phrase, words, n``: edges joined into paths at nodes that all flow passes by one edge.

    A node is passed so if the edge into it, the edge out of it and the node have one count. Every edge
    points to the one before it, pointers are doubled until they meet the first edge of the
    path, and the path is that edge and the last word of each one that follows. No path is
    longer than the longest piece of a text, and no such path closes to a ring, as some text enters it.
    """
    last = F.call_function("substring_index", F.col("phrase"), F.lit(" "), F.lit(-1))
    node = nodes.select("lang", F.col("phrase").alias("node"), F.col("n").alias("through"))
    into = edges.select("lang", F.call_function("substring_index", F.col("phrase"), F.lit(" "), F.lit(1 - longest)).alias("node"), F.col("phrase").alias("before"), F.col("n").alias("n_in"))
    out = edges.select("lang", _first("phrase", longest - 1).alias("node"), "phrase", "n")
    passed = out.join(node, ["lang", "node"]).join(into, ["lang", "node"]).where("n = through and n_in = through and before <> phrase")
    back = edges.join(passed.select("lang", "phrase", "before"), ["lang", "phrase"], "left")
    back = stored(back.select("lang", "phrase", "n", F.col("before").alias("head"), F.when(F.col("before").isNull(), 0).otherwise(1).alias("place")), "pointers")
    # A pointer has reached ``head``, ``place`` edges back; that of a first edge is null.
    while True:
        far = back.where("head is not null").select("lang", F.col("phrase").alias("head"), F.col("head").alias("further"), F.col("place").alias("more"))
        moved = back.join(far, ["lang", "head"], "left")
        place = (F.col("place") + F.coalesce("more", F.lit(0))).alias("place")
        back = stored(moved.select("lang", "phrase", "n", F.coalesce("further", "head").alias("head"), place, F.col("further").isNotNull().alias("moved")), "pointers")
        if back.where("moved").isEmpty():
            break
    parts = F.sort_array(F.collect_list(F.struct("place", F.when(F.col("place") == 0, F.col("phrase")).otherwise(last).alias("part"))))
    grouped = back.groupBy("lang", F.coalesce("head", "phrase").alias("head")).agg(F.max("n").alias("n"), parts.alias("parts"))
    return grouped.select("lang", F.array_join(F.col("parts.part"), " ").alias("phrase"), (F.size("parts") + longest - 1).alias("words"), "n")


def _inner(paths: DataFrame, words: int) -> DataFrame:
    """The nodes of ``words`` words that lie within paths, past their first and before their last."""
    each = F.split("phrase", " ")
    at = F.explode(F.sequence(F.lit(2), F.col("words") - words))
    return paths.where(F.col("words") > words + 1).select("lang", each.alias("each"), "n", at.alias("at")).select(
        "lang", F.array_join(F.slice("each", F.col("at"), words), " ").alias("phrase"), "n"
    )


def phrase_counts(grams: DataFrame, *, min_count: int = MIN_COUNT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Exact counts of all frequent phrases (``lang, phrase, words, n``), and the compacted paths."""
    edges = grams.where(F.col("words") == longest).select("lang", "phrase", "n")
    heavy = F.col("n") >= min_count
    frequent = edges.where(heavy).withColumn("words", F.lit(longest))
    nodes = stored(_flow(grams, edges, longest - 1), "nodes")
    paths = stored(unary_paths(edges.where(heavy), nodes.where(heavy), longest), "paths")
    # Nodes within paths go on as paths; the others as they are.
    inner = _inner(paths, longest - 1)
    rest = nodes.where(heavy).join(inner.select("lang", "phrase"), ["lang", "phrase"], "left_anti")
    counts = nodes.where(~heavy).union(rest.select("lang", "phrase", "n")).union(inner)
    frequent = frequent.union(nodes.where(heavy).withColumn("words", F.lit(longest - 1)))
    for words in range(longest - 2, 0, -1):
        counts = stored(_flow(grams, counts, words), f"phrases-{words}")
        frequent = frequent.union(counts.where(heavy).withColumn("words", F.lit(words)))
    return stored(frequent.select("lang", "phrase", "words", "n"), "frequent"), paths


def phrases(docs: DataFrame, *, text_column: str = "text", lang_column: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST, top: int | None = TOP, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: phrases by the score of their weakest cut.

    A to Z are taken in lower case; texts are split into pieces at ``.,;:!?`` and line ends, pieces
    into words at blanks and tabs. All is by language, null being ``und``; a null text is empty.
    Phrases have 2 to ``longest`` words and occur at least ``min_count`` times (a). Cut after k
    words, the parts occur l and r times, and the score is floor(1000 a n / (l r)), n being
    all words; the lowest counts, ties to the smallest k. A phrase is left out if a longer one
    holds it as often as it occurs. The first ``top`` of each language (None: all) by falling
    score, falling a and the bytes of the phrase. Rows count as often as they repeat; other columns
    may have any name; an empty table gives no rows.
    """
    if longest < 3:
        raise ValueError("phrases of at least three words are needed for a graph of pairs")
    grams = gram_counts(docs, text_column=text_column, lang_column=lang_column, min_count=min_count, longest=longest, filter_bits=filter_bits)
    frequent, _ = phrase_counts(grams, min_count=min_count, longest=longest)
    total = grams.groupBy("lang").agg(F.sum("n").alias("n"))

    # The longest count among phrases one word longer, on either side: none beyond them can be larger.
    part = F.when(F.col("side") == 0, _first("phrase", F.col("words") - 1)).otherwise(_first("phrase", 1 - F.col("words")))
    longer = frequent.where("words > 2").withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).select("lang", part.alias("phrase"), "n")
    held = longer.groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    kept = frequent.where("words > 1").join(held, ["lang", "phrase"], "left").where("most is null or most < n").select("lang", "phrase", "words", F.col("n").alias("a"))

    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    for side, cut in (("l", F.col("k")), ("r", F.col("k") - F.col("words"))):
        own = frequent.select("lang", F.col("phrase").alias(f"part_{side}"), F.col("n").alias(side))
        cuts = cuts.withColumn(f"part_{side}", _first("phrase", cut)).join(own, ["lang", f"part_{side}"])
    exact = [F.col(c).cast("decimal(17,0)").alias(f"{c}_") for c in "alrn"]
    scored = cuts.join(total, "lang").select("lang", "phrase", "a", "n", "k", "l", "r", *exact)
    scored = scored.withColumn("score", F.expr("(cast(1000 as decimal(4,0)) * a_ * n_) div (l_ * r_)"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
