"""Toxicity by weak supervision.

Voters are lexicon entries (words and stems that occur in toxic texts, chosen one after
another so that each explains texts no earlier one does) and patterns over them and over the
text's form. A generative label model holds, for every voter, how often it fires for either
class, and for pairs of voters how they go together within a class; voters that say the same
share their say. It is fitted on the votes over all texts that are not held out, rated or
not; given ratings are one more voter there. What the voters say of a sample of texts trains
a linear classifier over words and stems, which alone scores texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import FeatureTable, Rows, Sample, feature_sets, known, names_of, sigmoid
from .sampling import first_rows, held_out
from .shared import tidy
from .wordhash import slices

# Rows that the linear model is fitted on, at most: rated toxic, rated clean, not rated.
TOXIC_ROWS, CLEAN_ROWS, UNRATED_ROWS = 2000, 3000, 500
ENTRIES = 96
FEATURES = 4096
THRESHOLD = 0.3
# Rows that must have a lexicon entry or feature.
HITS = 2
# Toxic rows that a lexicon entry must have more of, for each clean one.
CLEAN_HITS = 4
# How often a given rating is taken to be right.
RATING_ACCURACY = 0.97
# Correlation within a class above which two voters share their say.
CORRELATED = 0.2
# Voters beside the lexicon entries.
PATTERNS = 6
# Combinations of votes that are summed together.
BLOCK = 1 << 14


def mine_entries(sets: list[np.ndarray], toxic: np.ndarray, most: int = ENTRIES) -> np.ndarray:
    """Lexicon entries: features of toxic texts, each of which explains texts not yet explained."""
    names, columns = np.unique(np.concatenate(sets) if sets else np.empty(0, np.uint64), return_inverse=True)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(columns, kind="stable")
    cuts = np.searchsorted(columns[order], np.arange(len(names) + 1))
    clean = np.bincount(columns, weights=(toxic == 0)[rows], minlength=len(names))
    open_rows = toxic == 1
    chosen: list[int] = []
    hits = np.bincount(columns, weights=open_rows[rows], minlength=len(names))
    while len(chosen) < most:
        score = np.where(hits >= HITS, hits - CLEAN_HITS * clean, -np.inf)
        best = int(np.argmax(score)) if len(score) else -1
        if best < 0 or not score[best] > 0:
            break
        chosen.append(best)
        own = rows[order[cuts[best]:cuts[best + 1]]]
        explained = own[open_rows[own]]
        open_rows[explained] = False
        for row in explained:
            hits[columns[np.searchsorted(rows, row):np.searchsorted(rows, row, side="right")]] -= 1
    return np.sort(names[chosen])


@dataclass
class LabelModel:
    """How often each voter fires for clean and toxic texts, and its share of a say."""

    fires: np.ndarray  # 2 x voters
    share: np.ndarray
    prior: float

    @classmethod
    def fit(cls, votes: np.ndarray, rating: np.ndarray, weight: np.ndarray, rounds: int = 25) -> LabelModel:
        """``votes``: 0/1 per text and voter. ``rating``: 1, 0 or -1 for none. EM from the ratings."""
        rated = rating >= 0
        share_of = weight * rated
        prior = float(np.clip((share_of * (rating == 1)).sum() / max(share_of.sum(), 1e-9), 0.01, 0.5))
        belief = np.where(rating == 1, RATING_ACCURACY, np.where(rating == 0, 1 - RATING_ACCURACY, prior))
        model = cls(np.full((2, votes.shape[1]), 0.5), np.ones(votes.shape[1]), prior)
        for _ in range(rounds):
            total, fired, both = cls._moments(votes, belief, weight)
            model.fires = (fired + 0.02) / (total[:, None] + 1.0)
            model.share = model._shares(total, fired, both)
            belief = model.posterior(votes, rating)
        return model

    @staticmethod
    def _moments(votes: np.ndarray, belief: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of either class: its weight, that of each voter's votes and that of votes of two together."""
        k = votes.shape[1]
        total, fired, both = np.zeros(2), np.zeros((2, k)), np.zeros((2, k, k))
        for at in range(0, len(votes), BLOCK):
            own, part = votes[at:at + BLOCK].astype(np.float64), slice(at, at + BLOCK)
            for y, of in ((0, weight[part] * (1 - belief[part])), (1, weight[part] * belief[part])):
                total[y] += of.sum()
                fired[y] += of @ own
                both[y] += (own * of[:, None]).T @ own
        return total, fired, both

    def _shares(self, total: np.ndarray, fired: np.ndarray, both: np.ndarray) -> np.ndarray:
        """One over the number of voters that say the same within a class."""
        alike = np.zeros(both.shape[1:])
        for y in (0, 1):
            crossed = np.outer(self.fires[y], fired[y])
            rest = both[y] - crossed - crossed.T + total[y] * np.outer(self.fires[y], self.fires[y])
            spread = np.sqrt(np.maximum(np.diag(rest), 1e-9))
            alike += (total[y] / max(total.sum(), 1e-9)) * rest / np.outer(spread, spread)
        alike = np.where(alike > CORRELATED, alike, 0)
        np.fill_diagonal(alike, 1)
        return 1 / alike.sum(axis=1)

    def posterior(self, votes: np.ndarray, rating: np.ndarray) -> np.ndarray:
        fired = np.log(self.fires[1] / self.fires[0]) * self.share
        silent = np.log((1 - self.fires[1]) / (1 - self.fires[0])) * self.share
        odds = np.full(len(votes), np.log(self.prior / (1 - self.prior)) + silent.sum())
        for at in range(0, len(votes), BLOCK):
            odds[at:at + BLOCK] += votes[at:at + BLOCK].astype(np.float64) @ (fired - silent)
        say = np.log(RATING_ACCURACY / (1 - RATING_ACCURACY))
        odds += np.where(rating == 1, say, np.where(rating == 0, -say, 0))
        return sigmoid(odds)


def with_patterns(votes: np.ndarray, form: np.ndarray) -> np.ndarray:
    """Entry by entry, then patterns: no entry, several entries, and the text's form."""
    many = votes.sum(axis=1)
    patterns = [many == 0, many >= 2, many >= 4, form[:, 0] > 0.3, form[:, 1] > 0.02, form[:, 2] > 0.1]
    return np.hstack([votes, np.stack(patterns, axis=1).astype(votes.dtype)])


def cast_votes(sets: list[np.ndarray], form: np.ndarray, entries: np.ndarray) -> np.ndarray:
    votes = np.zeros((len(sets), len(entries)), np.uint8)
    for row, places in enumerate(known(sets, entries)):
        votes[row, places] = 1
    return with_patterns(votes, form)


def count_votes(docs: DataFrame, rated: DataFrame, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Votes over all rows of ``docs``: the different combinations with a rating (-1 for none) and how many rows have each.

    Rows leave Python as an id and bits, so ratings are joined to these and not to texts.
    """
    table = FeatureTable(entries, np.ones(len(entries)))
    width = len(entries) + PATTERNS
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            votes = np.zeros((batch.num_rows, len(entries)), np.uint8)
            votes[table.hits(batch.column("text"))] = 1
            form = np.stack([batch.column(c).to_numpy() for c in _FORM], axis=1)
            bits = np.packbits(with_patterns(votes, form), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([b.tobytes() for b in bits], pa.binary())], ["doc_id", "votes"])

    texts = docs.select("doc_id", F.lower(_text("text")).alias("text"), *_form(_text("text")))
    cast_rows = texts.mapInArrow(cast, f"doc_id {kind}, votes binary").join(rated, "doc_id", "left")
    found = cast_rows.groupBy("votes", F.coalesce("rating", F.lit(-1)).alias("rating")).agg(F.count("*").alias("n")).orderBy("votes", "rating").toArrow()
    bits = np.frombuffer(b"".join(found.column("votes").to_pylist()), np.uint8).reshape(found.num_rows, -1)
    return np.unpackbits(bits, axis=1, count=width), found.column("rating").to_numpy(), found.column("n").to_numpy().astype(np.float64)


def fit_linear(sets: list[np.ndarray], target: np.ndarray, weight: np.ndarray, features: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels with a pull of every weight to nought (proximal Adagrad)."""
    rows = Rows(known(sets, features))
    w, bias, seen = np.zeros(len(features)), 0.0, np.full(len(features), 1e-3)
    seen_bias, total = 1e-3, max(weight.sum(), 1e-9)
    pull = 0.5 / len(sets) if sets else 0.0
    for _ in range(rounds):
        error = weight * (sigmoid(rows.times(w) + bias) - target) / total
        slope = rows.back(error, len(features)) + 1e-4 * w
        seen += slope ** 2
        seen_bias += error.sum() ** 2
        rate = 0.5 / np.sqrt(seen)
        w = w - rate * slope
        w = np.sign(w) * np.maximum(np.abs(w) - rate * pull * 0.1, 0)
        bias -= 0.5 * error.sum() / np.sqrt(seen_bias)
    return w, bias


@dataclass
class ToxicityModel:
    table: FeatureTable
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        return sigmoid(self.table.sums(texts) + self.bias)


_FORM = ("upper", "shout", "marks")


def _text(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _form(text) -> list:
    """Shares of capital letters, exclamation marks and other marks."""
    size = F.greatest(F.length(text), F.lit(1))
    count = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    return [(1 - count(p) / size).alias(n) for n, p in zip(_FORM, ("[A-Z]", "!", "[#$%&*|]"))]


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic") -> ToxicityModel:
    """Fit the label model on all rows that are not held out, the others on a sample of them.

    Entries are mined from at most TOXIC_ROWS + CLEAN_ROWS rated rows; the linear model also
    has UNRATED_ROWS others. The rows' sets of features stay in a table that tasks count (``Sample``);
    the driver holds those that may be entries, those of the linear model, and a row for each
    different combination of votes.
    ``docs`` has ``doc_id, text``; ``labels`` has ``doc_id`` and the 0/1 ``label``. Null ids,
    labels and texts teach nothing; of labels that repeat the largest counts. Without rated
    rows of both classes every score is the share of toxic ones (0 without any).
    """
    rated = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    rated = rated.groupBy("doc_id").agg(F.max(label).cast("int").alias("rating"))
    own = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    other = own.where(~held_out(F.col("doc_id"))).select("doc_id").join(rated.select("doc_id"), "doc_id", "left_anti")
    sample = first_rows(rated.where("rating = 1"), F.col("doc_id"), TOXIC_ROWS)
    sample = sample.union(first_rows(rated.where("rating = 0"), F.col("doc_id"), CLEAN_ROWS))
    sample = sample.union(first_rows(other.distinct(), F.col("doc_id"), UNRATED_ROWS).select("doc_id", F.lit(-1).alias("rating")))
    text = F.lower(_text("text"))
    rows = own.join(F.broadcast(sample), "doc_id").select("rating", text.alias("text"), *_form(_text("text")))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            sets = [s.tobytes() for s in feature_sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("rating"), pa.array(sets, pa.binary()), *(batch.column(c) for c in _FORM)], ["rating", "features", *_FORM])

    found = rows.mapInArrow(tidy(gather), f"rating int, features binary, {', '.join(f'{c} double' for c in _FORM)}")
    found = Sample(found.groupBy("features").agg(F.max("rating").alias("rating"), *[F.first(c).alias(c) for c in _FORM]), "toxicity-sample")
    rating = found.columns["rating"].astype(np.int64)
    counts = {r.rating: r.n for r in rated.groupBy("rating").agg(F.count("*").alias("n")).collect()}
    if not (rating == 1).any() or not (rating == 0).any():
        share = counts.get(1, 0) / max(1, sum(counts.values()))
        return ToxicityModel(FeatureTable(np.empty(0, np.uint64), np.empty(0)), float(np.log(max(share, 1e-15) / max(1 - share, 1e-15))))
    form = np.stack([found.columns[c] for c in _FORM], axis=1)
    # Each class stands for as many rated rows as there are.
    weight = np.where(rating == 1, counts[1] / (rating == 1).sum(), counts[0] / (rating == 0).sum())
    rated_rows = np.flatnonzero(rating >= 0)
    told = found.counts((rating >= 0).astype(np.int64), (rating == 1).astype(np.int64))
    sets = found.sets(names_of(told.where((F.col("share") >= HITS) & (F.col("share") > CLEAN_HITS * (F.col("present") - F.col("share"))))))
    entries = mine_entries([sets[k] for k in rated_rows], rating[rated_rows])
    votes = cast_votes(sets, form, entries)
    model = LabelModel.fit(*count_votes(own.where(~held_out(F.col("doc_id"))), rated, entries))
    # Targets are what the voters say; the ratings had their say in the fit.
    belief = model.posterior(votes, np.full(len(votes), -1))
    features = np.union1d(found.screened(belief, FEATURES, HITS), entries)
    return ToxicityModel(*_fitted(found.sets(features), belief, weight, features))


def _fitted(sets, belief, weight, features) -> tuple[FeatureTable, float]:
    w, bias = fit_linear(sets, belief, weight, features)
    used = np.abs(w) > 1e-6
    return FeatureTable(features[used], w[used]), float(bias)


def toxicity(model: ToxicityModel, text: Column) -> Column:
    """The score of a text; null and empty ones have that of a text without known words."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts), pa.float64())

    return score(F.lower(F.coalesce(text.cast("string"), F.lit(""))))


def score_documents(docs: DataFrame, model: ToxicityModel, *, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row: id, ``held_out``, ``score`` and ``predicted`` (1 from ``threshold`` on)."""
    rows = docs.select(F.col(id_column).alias("id"), toxicity(model, F.col(text_column)).alias("score"))
    return rows.select(
        F.col("id").alias(id_column), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
