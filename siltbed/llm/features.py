"""Sets of word and stem features of texts, and logistic models over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored, tidy
from .wordhash import buffer_of, chunks

# Bytes of the stems that count as features beside whole words.
STEMS = (4, 5, 6)
_TAG = 0x9FB21C651E98DF25
_BITS = 20
# Features of a sample's rows that a task counts together.
STRETCH = 1 << 19
# Targets are summed as whole numbers of this part, so that the order of the tasks is no matter.
UNIT = 1 << 32


def word_features(texts: pa.Array, stems: tuple[int, ...] = STEMS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For stretches of a batch: text number and feature hash of every word and of its stems."""
    data, bounds = buffer_of(texts)
    for at, chunk in chunks(data, bounds):
        text = np.searchsorted(bounds, chunk.starts + at, side="right") - 1
        yield text, chunk.words()
        for n in stems:
            long = np.flatnonzero(chunk.ends - chunk.starts >= n)
            starts = chunk.starts[long]
            yield text[long], chunk.hashes(starts, starts + n) + np.uint64(_TAG * n % (1 << 64))


def feature_sets(texts: pa.Array) -> list[np.ndarray]:
    """The different features of each text, in order."""
    parts = list(word_features(texts)) or [(np.empty(0, np.int64), np.empty(0, np.uint64))]
    text, found = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(text, kind="stable")
    cuts = np.searchsorted(text[order], np.arange(len(texts) + 1))
    found = found[order]
    return [np.unique(found[a:b]) for a, b in zip(cuts, cuts[1:])]


class FeatureTable:
    """Weights by feature hash; other features weigh nothing."""

    def __init__(self, features: np.ndarray, weights: np.ndarray):
        order = np.argsort(features)
        self.features, self.weights = features[order], weights[order]
        self._maybe = np.zeros(1 << _BITS, bool)
        self._maybe[self._short(self.features)] = True

    @staticmethod
    def _short(features: np.ndarray) -> np.ndarray:
        return (features >> np.uint64(64 - _BITS)).astype(np.int64)

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Text number and place in the table of every different feature that a text has."""
        pairs = [np.empty(0, np.int64)]
        n = max(1, len(self.features))
        for text, found in word_features(texts):
            likely = np.flatnonzero(self._maybe[self._short(found)])
            place = np.searchsorted(self.features, found[likely])
            place = np.minimum(place, n - 1)
            real = self.features[place] == found[likely] if len(self.features) else np.zeros(len(likely), bool)
            pairs.append(np.unique(text[likely][real] * n + place[real]))
        both = np.unique(np.concatenate(pairs))
        return both // n, both % n

    def sums(self, texts: pa.Array) -> np.ndarray:
        text, place = self.hits(texts)
        return np.bincount(text, weights=self.weights[place], minlength=len(texts))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Rows:
    """Sparse 0/1 rows: the columns that are set."""

    def __init__(self, sets: list[np.ndarray]):
        self.counts = np.array([len(s) for s in sets], np.int64)
        self.columns = np.concatenate(sets) if sets else np.empty(0, np.int64)
        self.rows = np.repeat(np.arange(len(sets)), self.counts)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights=weights[self.columns], minlength=len(self.counts))

    def back(self, values: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.columns, weights=values[self.rows], minlength=width)


def gains(support: np.ndarray, a: np.ndarray, p: float, n: float) -> np.ndarray:
    """What features tell about a target (0 to 1 per row), by the likelihood ratio.

    ``support``: rows that have the feature; ``a``: the sum of their targets; ``p`` and ``n``: those of all rows and of their rest to 1.
    """
    b = support - a

    def entropy(x: np.ndarray, of: np.ndarray | float, rate: np.ndarray | float) -> np.ndarray:
        return x * np.log(np.maximum(x, 1e-12) / np.maximum(of * rate, 1e-12))

    present, share = a + b, p / max(p + n, 1e-12)
    gain = entropy(a, present, share) + entropy(b, present, 1 - share)
    return gain + entropy(p - a, p + n - present, share) + entropy(n - b, p + n - present, 1 - share)


def known(sets: list[np.ndarray], features: np.ndarray) -> list[np.ndarray]:
    """Each row's features as places in the sorted ``features``."""
    found = []
    for s in sets:
        at = np.minimum(np.searchsorted(features, s), max(0, len(features) - 1))
        found.append(at[features[at] == s] if len(features) else np.empty(0, np.int64))
    return found


class Sample:
    """Rows with their sets of features, kept as a table that tasks count.

    The driver holds the other columns of the rows, in the order of their features' hash, and
    gets the places of features that it names; the sets never come to it.
    """

    def __init__(self, rows: DataFrame, name: str):
        """``rows``: ``features``, the bytes of hashes, and small columns."""
        self.table = stored(rows.select(F.monotonically_increasing_id().alias("row"), F.xxhash64("features").alias("hash"), "*"), name)
        small = self.table.drop("features").toArrow()
        own = {c: small.column(c).to_numpy() for c in small.column_names}
        order = np.lexsort((own["row"], own["hash"]))
        self.columns = {c: v[order] for c, v in own.items()}
        self.by_row = np.argsort(self.columns["row"])
        self.rows = self.columns["row"][self.by_row]

    def __len__(self) -> int:
        return len(self.rows)

    def counts(self, present: np.ndarray, share: np.ndarray) -> DataFrame:
        """Of every feature: sums of whole numbers ``present`` and ``share`` over the rows that have it."""
        rows, present, share = self.rows, present[self.by_row], share[self.by_row]

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for own, sets in _stretches(batches):
                names, columns = np.unique(np.concatenate(sets), return_inverse=True)
                at = np.repeat(np.searchsorted(rows, own), [len(s) for s in sets])
                sums = [np.bincount(columns, weights=x[at], minlength=len(names)).astype(np.int64) for x in (present, share)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (names.view(np.int64), *sums)], ["feature", "present", "share"])

        found = self.table.select("row", "features").mapInArrow(tidy(count), "feature long, present long, share long")
        return found.groupBy("feature").agg(F.sum("present").alias("present"), F.sum("share").alias("share"))

    def screened(self, target: np.ndarray, most: int, least_rows: int = 3) -> np.ndarray:
        """The features that tell most about ``target`` (0 to 1 per row), see ``gains``."""
        whole = np.rint(target * UNIT).astype(np.int64)
        p = whole.sum() / UNIT
        n = len(target) - p

        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                gain = gains(batch.column("present").to_numpy(), batch.column("share").to_numpy() / UNIT, p, n)
                yield pa.RecordBatch.from_arrays([batch.column("feature"), pa.array(gain)], ["feature", "gain"])

        found = self.counts(np.ones(len(self), np.int64), whole).where(F.col("present") >= least_rows)
        found = found.mapInArrow(weigh, "feature long, gain double").where("gain > 3")
        # Hashes have no sign: of features that tell as much the least are taken.
        return names_of(found.orderBy(F.desc("gain"), F.col("feature").bitwiseXOR(F.lit(-1 << 63))).limit(most))

    def sets(self, features: np.ndarray) -> list[np.ndarray]:
        """Each row's features among the sorted ``features``."""

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for own, sets in _stretches(batches):
                places = [x.astype(np.int32).tobytes() for x in known(sets, features)]
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(places, pa.binary())], ["row", "places"])

        found = self.table.select("row", "features").mapInArrow(tidy(place), "row long, places binary").toArrow()
        places = found.column("places")
        order = np.argsort(found.column("row").to_numpy())[np.argsort(self.by_row)]
        return [features[np.frombuffer(places[int(k)].as_buffer(), np.int32)] for k in order]


def names_of(counted: DataFrame) -> np.ndarray:
    """The features of rows, sorted."""
    return np.sort(counted.select("feature").toArrow().column("feature").to_numpy().view(np.uint64))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Rows and their sets, about ``STRETCH`` features at once."""
    for batch in batches:
        own, sets, first, size = batch.column("row").to_numpy(), [], 0, 0
        for at, features in enumerate(batch.column("features"), 1):
            sets.append(np.frombuffer(features.as_buffer(), np.uint64))
            size += len(sets[-1])
            if size >= STRETCH or at == batch.num_rows:
                yield own[first:at], sets
                sets, first, size = [], at, 0
