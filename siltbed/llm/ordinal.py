"""Graded quality by ordinal cumulative-link regression.

One set of weights over hashed words, stems and classes of the text's form gives a text its
place on a line; ordered thresholds cut the line into grades: P(grade <= k) is the logistic
of threshold k less the place. The expected grade and the probability of at least a given
grade are for choosing texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import FeatureTable, Rows, Sample, feature_sets, known, sigmoid
from .sampling import first_rows, held_out
from .shared import tidy
from .wordhash import buffer_of, mix, slices, word_hashes

# Rows of a grade that the model is fitted on, at most.
ROWS_PER_GRADE = 2000
FEATURES = 4096
BINS = 12
# A text is kept if it has at least this probability of the grade asked for.
KEEP = 0.5


def form_features(texts: pa.Array) -> list[np.ndarray]:
    """Hashes of classes of each text's form: length, repetition, capitals, digits, marks."""
    data, bounds = buffer_of(texts)
    words, starts = word_hashes(texts)
    kinds = np.zeros(256, np.int64)
    for kind, signs in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?", b"!", b"|", b"#$%&*@<>{}[]=_/\\~^", b"\n"), 1):
        kinds[list(signs)] = kind
    out = []
    for k in range(len(texts)):
        counts = np.bincount(kinds[data[bounds[k]:bounds[k + 1]]], minlength=8)[:8]
        own = words[starts[k]:starts[k + 1]]
        size, n = max(1, counts.sum()), max(1, len(own))
        repeated = 1 - len(np.unique(own)) / n
        doubled = (own[1:] == own[:-1]).mean() if len(own) > 1 else 0.0
        shares = [*(counts[1:] / size), repeated, doubled]
        classes = [int(np.log2(size)), int(np.log2(n)), min(BINS, int(size / n)), *(min(BINS, int(np.ceil(np.sqrt(s) * BINS))) for s in shares)]
        out.append(mix((np.arange(len(classes), dtype=np.uint64) << np.uint64(32)) + np.array(classes, np.uint64) + np.uint64(1 << 50)))
    return out


@dataclass
class OrdinalModel:
    table: FeatureTable
    thresholds: np.ndarray  # ordered; one less than grades

    def places(self, lowered: pa.Array, texts: pa.Array) -> np.ndarray:
        places = self.table.sums(lowered)
        for k, found in enumerate(form_features(texts)):
            at = known([found], self.table.features)[0]
            places[k] += self.table.weights[at].sum()
        return places

    def at_least(self, places: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 and up, as columns."""
        return sigmoid(places[:, None] - self.thresholds[None, :])


def fit(sets: list[np.ndarray], grade: np.ndarray, weight: np.ndarray, grades: int, features: np.ndarray, rounds: int = 400) -> OrdinalModel:
    """Most likely weights and thresholds with a light ridge (Adagrad on the whole sample)."""
    rows, w = Rows(known(sets, features)), np.zeros(len(features))
    total = weight.sum()
    above = np.array([(weight * (grade >= k)).sum() / total for k in range(1, grades)]).clip(1e-6, 1 - 1e-6)
    first = -np.log(above / (1 - above))
    # The first threshold, then logarithms of the steps up, which keep them in order.
    free = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
    seen_w, seen_t = np.full(len(w), 1e-4), np.full(len(free), 1e-4)
    one = np.arange(len(grade))
    for _ in range(rounds):
        steps = np.concatenate([free[:1], np.exp(free[1:])])
        edges = np.concatenate([[-np.inf], np.cumsum(steps), [np.inf]])
        place = rows.times(w)
        below_high, below_low = sigmoid(edges[grade + 1] - place), sigmoid(edges[grade] - place)
        below_high[grade == grades - 1], below_low[grade == 0] = 1.0, 0.0
        inside = np.maximum(below_high - below_low, 1e-9)
        d_high, d_low = below_high * (1 - below_high) / inside, below_low * (1 - below_low) / inside
        slope = rows.back(weight * (d_high - d_low) / total, len(w)) + 1e-4 * w
        by_edge = np.zeros((len(grade), grades + 1))
        by_edge[one, grade + 1] -= weight * d_high / total
        by_edge[one, grade] += weight * d_low / total
        edge_slope = by_edge.sum(axis=0)[1:grades]
        free_slope = np.cumsum(edge_slope[::-1])[::-1] * np.concatenate([[1.0], steps[1:]])
        seen_w += slope ** 2
        seen_t += free_slope ** 2
        w -= 0.3 * slope / np.sqrt(seen_w)
        free -= 0.1 * free_slope / np.sqrt(seen_t)
    return OrdinalModel(FeatureTable(features, w), np.cumsum(np.concatenate([free[:1], np.exp(free[1:])])))


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def train(docs: DataFrame, ratings: DataFrame, grades: int) -> OrdinalModel:
    """Fit on at most ROWS_PER_GRADE rows of each grade that are not held out.

    ``docs``: ``doc_id, text``; ``ratings``: ``doc_id, grade`` from 0 to ``grades - 1``. Null ids,
    texts and grades teach nothing; of ratings that repeat the largest counts. Without ratings
    every grade is as likely.
    """
    rated = ratings.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, grades - 1) & ~held_out(F.col("doc_id")))
    rated = rated.groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade"))
    sample = None
    for grade in range(grades):
        own = first_rows(rated.where(F.col("grade") == grade), F.col("doc_id"), ROWS_PER_GRADE)
        sample = own if sample is None else sample.union(own)
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = rows.select("grade", _text("text").alias("text"), F.lower(_text("text")).alias("lowered"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            pairs = zip(feature_sets(batch.column("lowered")), form_features(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array([np.union1d(a, b).tobytes() for a, b in pairs], pa.binary())], ["grade", "features"])

    found = rows.mapInArrow(tidy(gather), "grade int, features binary").groupBy("features").agg(F.max("grade").alias("grade"))
    found = Sample(found, "quality-sample")
    if not len(found):
        even = np.arange(grades - 1, 0, -1) / grades
        return OrdinalModel(FeatureTable(np.empty(0, np.uint64), np.empty(0)), -np.log(even / (1 - even)))
    grade = found.columns["grade"].astype(np.int64)
    counts = {r.grade: r.n for r in rated.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    weight = np.zeros(len(grade))
    for g in np.unique(grade):
        weight[grade == g] = counts[g] / (grade == g).sum()
    features = np.unique(np.concatenate([found.screened((grade >= k).astype(np.float64), FEATURES) for k in range(1, grades)]))
    return fit(found.sets(features), grade, weight, grades, features)


def grade_documents(docs: DataFrame, model: OrdinalModel, *, at_least: int | None = None, keep: float = KEEP, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: id, ``held_out``, ``expected_grade``, ``tail_probability``, ``kept``.

    ``tail_probability`` is that of a grade of ``at_least`` (the highest by default); a text is
    kept from ``keep`` on. Null texts count as empty, which have a form but no words.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    tail = (len(model.thresholds) if at_least is None else at_least) - 1
    rows = docs.select(F.col(id_column).alias("id"), _text(text_column).alias("text"), F.lower(_text(text_column)).alias("lowered"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            chances = model.at_least(model.places(batch.column("lowered"), batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(chances.sum(axis=1)), pa.array(chances[:, tail])], ["id", "expected_grade", "tail_probability"])

    found = rows.mapInArrow(run, f"id {kind}, expected_grade double, tail_probability double")
    return found.select(
        F.col("id").alias(id_column), held_out(F.col("id")).alias("held_out"), "expected_grade", "tail_probability",
        (F.col("tail_probability") >= keep).alias("kept"),
    )
