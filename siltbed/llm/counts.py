"""Token counts of whole texts by batch encoding.

Texts arrive in Arrow batches, are dealt to batches of about equal bytes and cut at safe
boundaries, which are the places where the splitter of a byte-level vocabulary ends a piece
whatever stands around it: between a character that is no white space and one that is. The
stretches between them that are not remembered go to the library in one call, and only
lengths come back. The count of a text is the sum over its stretches.
"""

from __future__ import annotations

import collections
import json
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .wordhash import slices

LIMIT = 512
# Bytes of text that are encoded together.
BATCH_BYTES = 1 << 22
# Characters of a text that are cut up together.
WINDOW_CHARS = 1 << 18
# Stretches that a worker remembers, and their longest.
CACHE_ENTRIES = 300_000
CACHED_CHARS = 32

# White space as the splitter of byte-level vocabularies knows it.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_STRETCH = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_ASCII_STRETCH = re.compile("[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
_BOUNDARY = re.compile(f"(?<=[^{_SPACE}])(?=[{_SPACE}])")


def windows(text: str, size: int = WINDOW_CHARS) -> Iterator[str]:
    """The text in parts of about ``size`` characters that end at safe boundaries."""
    at = 0
    while at < len(text):
        cut = _BOUNDARY.search(text, at + size) if len(text) - at > size else None
        end = cut.start() if cut else len(text)
        yield text[at:end] if at or cut else text
        at = end


def stretches(text: str) -> list[str]:
    """The text between all its safe boundaries."""
    return (_ASCII_STRETCH if text.isascii() else _STRETCH).findall(text)


def _safe(model: dict) -> bool:
    """Whether a vocabulary file splits texts so that the boundaries above are safe."""
    split = model["pre_tokenizer"] or {}
    return (
        model["normalizer"] is None
        and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"]
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or _BOUNDARY.search(f"x{t['content']}x") for t in model["added_tokens"])
    )


def _library(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """Token counts of a list of texts by the library of a vocabulary file, and whether texts may be cut."""
    if path.endswith(".model"):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: list(map(len, processor.encode(texts, num_threads=1))), False
    # Spark has a worker for every core.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as f:
        safe = _safe(json.load(f))
    return lambda texts: list(map(len, tokenizer.encode_batch_fast(texts, add_special_tokens=False))), safe


class Counter:
    """Token counts of texts; remembers, up to a bound, those of short stretches that come up again."""

    def __init__(self, path: str):
        self._count, self._safe = _library(path)
        self._known: dict[str, int] = {}

    def _totals(self, parts: list[str], ends: list[int]) -> list[int]:
        """Tokens of each run of stretches, the runs being given by their ends."""
        found = list(map(self._known.get, parts))
        new = [part for part, n in zip(parts, found) if n is None]
        again = [part for part, times in collections.Counter(new).items() if times > 1 and len(part) <= CACHED_CHARS]
        if again:
            if len(self._known) + len(again) > CACHE_ENTRIES:
                self._known.clear()
            self._known.update(zip(again, self._count(again)))
            found = list(map(self._known.get, parts))
        # Stretches without their neighbours still end where stretches end, so that those of a
        # run that came up once are counted together.
        rest, totals, at = [], [], 0
        for end in ends:
            own = found[at:end]
            if None in own:
                rest.append("".join(part for part, n in zip(parts[at:end], own) if n is None))
                totals.append(sum(filter(None, own)))
            else:
                rest.append("")
                totals.append(sum(own))
            at = end
        return list(map(int.__add__, totals, self._count(rest)))

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text. The stretches of short texts go to the library together."""
        if not self._safe:
            return self._count(texts)
        totals, parts, ends, owners, size = [0] * len(texts), [], [], [], 0

        def add() -> None:
            for k, n in zip(owners, self._totals(parts, ends)):
                totals[k] += n
            parts.clear(), ends.clear(), owners.clear()

        for k, text in enumerate(texts):
            for window in windows(text):
                parts += stretches(window)
                ends.append(len(parts))
                owners.append(k)
                size += len(window)
                if size >= BATCH_BYTES:
                    add()
                    size = 0
        add()
        return totals


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter of this Python worker, made once for a vocabulary."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, path: str, *, id_column: str = "doc_id", text_column: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per row: id, ``n_bytes long`` (UTF-8), ``n_tokens long``, ``over_limit boolean``.

    ``path`` is a vocabulary file that every worker can read, ``.json`` for the ``tokenizers``
    and ``.model`` for the ``sentencepiece`` library; begin, end and other special tokens are
    not added, special strings inside texts count as the library counts them by default. Null
    and empty texts have no bytes and no tokens. Ids may be null or repeat, other columns may
    have any name; an empty table gives no rows. Long texts are cut only where the vocabulary
    file makes that safe; with other vocabularies (normalisers, other splitters, sentence
    pieces) a text goes to the library whole. Nothing is shuffled.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
            texts = batch.column("text")
            counts = own.counts(texts.to_pylist())
            sizes = pc.cast(pc.binary_length(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), sizes, pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    made = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return made.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
