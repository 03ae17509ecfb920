"""Language proportions of every text by expectation-maximisation over n-gram likelihoods.

A language is a distribution over hashed byte trigrams of lower-case words with their
borders. The words of a text are drawn from a mixture of languages; for nested sets of the
text's likeliest languages EM gives the proportions, and the set with the best likelihood
less a penalty for every further language is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import held_out
from .shared import tidy
from .wordhash import _IN_WORD, buffer_of, chunks

BUCKETS = 1 << 16
# Documents that a language is learned from, about, at most.
ROWS_PER_LANGUAGE = 3000
SMOOTHING = 0.05
ROUNDS = 8
# Rounds with all languages, which only put them in order.
ORDER_ROUNDS = 3
# Penalty of a further language, in units of half the logarithm of the number of words.
PENALTY = 2.0
# Words whose likelihoods are held together; a longer text is taken by itself.
WORDS_AT_ONCE = 1 << 15
UNKNOWN = "und"


def trigram_buckets(data: np.ndarray) -> np.ndarray:
    """A bucket for every byte with its neighbours; bytes outside words count as one space."""
    padded = np.full(len(data) + 2, 32, np.uint32)
    padded[1:-1] = np.where(_IN_WORD[data], data, 32)
    three = (padded[:-2] << np.uint32(16)) | (padded[1:-1] << np.uint32(8)) | padded[2:]
    return ((three * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


def count_trigrams(texts: pa.Array) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.int64)
    data, bounds = buffer_of(texts)
    for at, chunk in chunks(data, bounds):
        own = data[at:at + len(chunk._sums) - 1]
        counts += np.bincount(trigram_buckets(own)[_IN_WORD[own]], minlength=BUCKETS)
    return counts


def _fit(chance: np.ndarray, words: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions by EM and the logarithm of each word's chance under them, summed by text.

    ``chance``: of each word under each language (largest 1), ordered by text; ``words``: how
    many each text has (at least one); ``allowed``: 1 for the languages that a text may have.
    """
    starts = np.concatenate([[0], np.cumsum(words)[:-1]])
    share = (allowed / allowed.sum(axis=1, keepdims=True)).astype(np.float32)
    for _ in range(rounds):
        part = chance * np.repeat(share, words, axis=0)
        part /= np.maximum(part @ np.ones(part.shape[1], np.float32), 1e-30)[:, None]
        share = np.add.reduceat(part, starts, axis=0) / words[:, None].astype(np.float32)
    total = np.einsum("ij,ij->i", chance, np.repeat(share, words, axis=0))
    return share, np.add.reduceat(np.log(np.maximum(total, 1e-30)).astype(np.float64), starts)


def best_mixture(likelihood: np.ndarray, words: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (text by language) and number of languages of each text.

    ``likelihood``: log of every word under every language, ordered by text; ``words``: how
    many each text has, at least one. A text is tried with a further language as long as
    that is worth the penalty.
    """
    n, languages = len(words), likelihood.shape[1]
    starts = np.concatenate([[0], np.cumsum(words)[:-1]])
    top = likelihood.max(axis=1)
    base = np.add.reduceat(top.astype(np.float64), starts)
    alone = np.add.reduceat(likelihood, starts, axis=0, dtype=np.float64)
    first = alone.argmax(axis=1)
    share = np.zeros((n, languages))
    share[np.arange(n), first] = 1.0
    best = alone[np.arange(n), first] - penalty / 2 * np.log(words + 1)
    size = np.ones(n, np.int64)
    # A mixture that gave every word its best language for nothing is an upper bound.
    going = np.flatnonzero(base - penalty * np.log(words + 1) > best)
    if languages == 1 or not len(going):
        return share, size
    order = None
    for k in range(2, languages + 1):
        inside = np.zeros(n, bool)
        inside[going] = True
        own = np.flatnonzero(np.repeat(inside, words))
        chance, counts = np.exp(likelihood[own] - top[own, None]), words[going]
        if order is None:
            rough, _ = _fit(chance, counts, np.ones((len(going), languages)), ORDER_ROUNDS)
            order = np.zeros((n, languages), np.int64)
            order[going] = np.argsort(-rough, axis=1, kind="stable")
        allowed = np.zeros((len(going), languages))
        np.put_along_axis(allowed, order[going, :k], 1.0, axis=1)
        found, value = _fit(chance, counts, allowed, ROUNDS)
        value += base[going] - k * penalty / 2 * np.log(counts + 1)
        better = value > best[going]
        going, found, value = going[better], found[better], value[better]
        share[going], best[going], size[going] = found, value, k
        if not len(going):
            break
    return share, size


@dataclass
class LanguageModel:
    languages: list[str]
    logs: np.ndarray  # bucket x language
    expected: np.ndarray  # mean logarithm of a trigram of each language's training texts
    least: np.ndarray  # logarithm of a trigram that these lack

    def mixtures(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Proportions of each text (all nought without words), its number of languages and its fit.

        The fit is the mean logarithm of a trigram's chance under the likeliest language, on a scale from
        0 for trigrams that its training texts lack to 1 for their own mean.
        """
        n = len(texts)
        share, size = np.zeros((n, len(self.languages))), np.zeros(n, np.int64)
        totals, trigrams = np.zeros((n, len(self.languages))), np.zeros(n, np.int64)
        if not self.languages:
            return share, size, np.zeros(n)
        data, bounds = buffer_of(texts)
        held, held_words = [], 0

        def settle(parts: list) -> None:
            likelihood, text = (np.concatenate(x) for x in zip(*parts))
            numbers, words = np.unique(text, return_counts=True)
            share[numbers], size[numbers] = best_mixture(likelihood, words)

        for at, chunk in chunks(data, bounds):
            if not len(chunk.starts):
                continue
            own = data[at:at + len(chunk._sums) - 1]
            inside = _IN_WORD[own]
            logs = self.logs[trigram_buckets(own)[inside]]
            # Within the bytes of words, each word begins after those before it.
            lengths = chunk.ends - chunk.starts
            likelihood = np.add.reduceat(logs, np.concatenate([[0], np.cumsum(lengths)[:-1]]), axis=0)
            text = np.searchsorted(bounds, chunk.starts + at, side="right") - 1
            begin = np.flatnonzero(np.diff(text, prepend=-1))
            totals[text[begin]] += np.add.reduceat(likelihood, begin, axis=0, dtype=np.float64)
            trigrams[text[begin]] += np.add.reduceat(lengths, begin)
            held.append((likelihood, text))
            held_words += len(text)
            while held_words > WORDS_AT_ONCE:
                # All texts but the last are whole.
                likelihood, text = (np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(text, text[-1]))
                held, held_words = [(likelihood[cut:], text[cut:])], len(text) - cut
                if not cut:
                    break
                settle([(likelihood[:cut], text[:cut])])
        if held:
            settle(held)
        likeliest = totals.argmax(axis=1)
        mean, least = totals[np.arange(n), likeliest] / np.maximum(trigrams, 1), self.least[likeliest]
        return share, size, (mean - least) / np.maximum(self.expected[likeliest] - least, 1e-9)

    def described(self, texts: pa.Array, letters: pa.Array) -> list[pa.Array]:
        """Language, its share, all shares and fit of each text."""
        share, size, fit = self.mixtures(texts)
        names, scores, maps = [], [], []
        for own, k, some in zip(share, size, letters.to_pylist()):
            best = int(own.argmax()) if k and some else -1
            names.append(self.languages[best] if best >= 0 else UNKNOWN)
            scores.append(min(1.0, float(own[best])) if best >= 0 else 0.0)
            maps.append([(self.languages[j], float(own[j])) for j in np.flatnonzero(own > 0)] if best >= 0 else [])
        known = size > 0
        return [
            pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(maps, pa.map_(pa.string(), pa.float64())),
            pa.array(fit, mask=~known),
        ]


def train(docs: DataFrame, *, rows_per_language: int = ROWS_PER_LANGUAGE) -> LanguageModel:
    """Trigram distributions from ``doc_id, text, lang`` of rows that are not held out.

    About ``rows_per_language`` rows of a language at most, those with the least hashes.
    Null texts and languages teach nothing.
    """
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # The share of a language's rows that is about as many as wanted, by a hash of the row.
    shares = rows.groupBy("lang").agg((F.lit(float(rows_per_language)) / F.count("*")).alias("share"))
    place = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) * 2.0 ** -53
    taken = rows.join(F.broadcast(shares), "lang").where(place < F.col("share")).select("lang", F.lower("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), object)
            for name in dict.fromkeys(names):
                own = batch.column("text").filter(pa.array(names == name))
                found[name] = found.get(name, 0) + count_trigrams(own)
        for name, counts in found.items():
            places = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(places), pa.string()), pa.array(places.astype(np.int32)), pa.array(counts[places])], ["lang", "bucket", "n"])

    counted = taken.mapInArrow(tidy(count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(counted.column("lang").to_pylist()))
    counts = np.full((BUCKETS, len(names)), SMOOTHING)
    place = {name: k for k, name in enumerate(names)}
    columns = np.array([place[x] for x in counted.column("lang").to_pylist()], np.int64)
    counts[counted.column("bucket").to_numpy(), columns] += counted.column("n").to_numpy()
    logs = np.log(counts / counts.sum(axis=0))
    seen = counts - SMOOTHING
    expected = (seen * logs).sum(axis=0) / np.maximum(seen.sum(axis=0), 1)
    return LanguageModel(names, logs.astype(np.float32), expected, logs.min(axis=0))


def mixture(model: LanguageModel, text: Column) -> Column:
    """A struct of ``lang_pred``, ``score``, ``proportions`` and ``fit``; see :func:`identify`."""
    text = F.coalesce(text.cast("string"), F.lit(""))

    @F.arrow_udf("struct<lang_pred string, score double, proportions map<string,double>, fit double>")
    def found(texts: pa.Array, letters: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(model.described(texts, letters), ["lang_pred", "score", "proportions", "fit"])

    return found(F.lower(text), text.rlike(r"\p{L}"))


def identify(docs: DataFrame, model: LanguageModel, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: id, ``held_out``, ``lang_pred``, ``score``, ``proportions``, ``fit``.

    ``proportions`` maps the languages of the chosen set to their shares of the words;
    ``lang_pred`` is the one with the largest (ties to the first name) and ``score`` its share.
    A null text or one without a letter is ``und`` with score 0, as all are without a model.
    ``fit`` is 1 for texts whose trigrams are on average as likely as those of the training texts, 0 where
    these have none of them; null where nothing could be learned or a text has no words.
    """
    rows = docs.select(F.col(id_column).alias("id"), mixture(model, F.col(text_column)).alias("found"))
    return rows.select(F.col("id").alias(id_column), held_out(F.col("id")).alias("held_out"), "found.*")
