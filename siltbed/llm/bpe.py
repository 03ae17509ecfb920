"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word the last token of its BPE encoding is unique. A token that ends
at a prefix is that last token exactly when it can stand next to the last token of the
prefix before it, so one pass over the matches of an automaton over all tokens fills the
table, and following it back gives the ids. The automaton is one over the dictionary of all
tokens (Aho and Corasick), whose states are the suffixes that tokens can begin with; a suffix
automaton of each word would find the same matches. The vocabulary comes from a file of the
public ``tokenizers`` library, whose own normaliser and word splitter are used as they are.

Texts are taken apart and put together by batch in Arrow; the table is filled once for each
different piece that is not remembered.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import struct
from collections.abc import Iterator
from functools import cached_property
from itertools import accumulate, chain, islice, pairwise
from string import punctuation

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .wordhash import slices

# Entries of a generation of the word cache; two generations are held at most.
CACHE_ENTRIES = 100_000
# Longer pieces between white space are encoded without being remembered.
CACHED_CHARS = 64
# Bytes of text whose different pieces are looked up together.
TEXT_BYTES = 1 << 24
# Different pieces that are looked up, and places of pieces that are put together, at a time: what is held
# beside the ids is bounded by it, however many there are in a batch.
PIECES_AT_ONCE = 1 << 14

END = "</w>"
# The library's notion of white space, without the separators that str.split() adds.
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_EXTRA = re.compile("[\x1c-\x1f]")
# Pieces of ASCII and composed Latin letters are their own normal form but for case, and the
# letter class below is all of their letters; others go through the library's normaliser.
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_SIMPLE = re.compile(f"[!-~{_LATIN}]+")
_SIMPLE_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z{_LATIN}]+|[0-9]|[^A-Za-z0-9{_LATIN}]+")
# What the vocabulary file must ask for so that simple pieces can take the shortcut.
_NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PATTERN = json.dumps(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for bytes: printable ones for themselves."""
    plain = [b for b in range(256) if chr(b).isprintable() and chr(b) != " "]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


_BYTES = _byte_letters()


def words_of(text: str) -> list[str]:
    """The pieces between white space; no token crosses them."""
    if _EXTRA.search(text):
        return [w for w in _SPACE.split(text) if w]
    return text.split()


class PrefixEncoder:
    """Token ids of one word, by the table of last tokens."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str):
        made = {}
        self.ranks: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(merges):
            pair = vocab[left], vocab[right]
            self.ranks.setdefault(pair, rank)
            made.setdefault(vocab[left + right], (*pair, rank))
        # Symbols are single characters: a letter of the vocabulary, or the same letter at a
        # word's end, moved to a private plane.
        spelled: dict[int, str] = {}
        for token, i in vocab.items():
            if i not in made:
                body = token.removesuffix(end) if end and token != end else token
                spelled[i] = body if body == token else self._last(body)
        for i, (left, right, _) in sorted(made.items(), key=lambda x: x[1][2]):
            spelled[i] = spelled[left] + spelled[right]
        # Each token's parts along its edges, with the rank of the merge that uses them up.
        self._right = {i: self._edge(made, i, 1) for i in spelled}
        self._left = {i: self._edge(made, i, 0) for i in spelled}
        self._fits: dict[int, bool] = {}
        self.has_end = bool(end)
        automaton = ahocorasick.Automaton()
        for i, symbols in spelled.items():
            if self._derivable(made, i):
                automaton.add_word(symbols, i << 32 | len(symbols))
        automaton.make_automaton()
        self._matches = automaton.iter
        self.known = {s for s in spelled.values() if len(s) == 1}

    @staticmethod
    def _last(symbol: str) -> str:
        return chr(ord(symbol[-1]) + 0xF0000) if len(symbol) == 1 else symbol

    @staticmethod
    def _edge(made: dict, token: int, side: int) -> list[tuple[int, float]]:
        edge, used_up = [(token, math.inf)], math.inf
        while token in made:
            *parts, used_up = made[token]
            token = parts[side]
            edge.append((token, used_up))
        return edge

    def _first_merge(self, left: int, right: int) -> tuple[float, int, int] | None:
        """The first merge over the border between two tokens while both are being built."""
        found = None
        ranks = self.ranks
        for x, x_gone in self._right[left]:
            for y, y_gone in self._left[right]:
                rank = ranks.get((x, y))
                # Of equal merges the leftmost is done first: that within the left token
                # comes before, that within the right one after the merge over the border.
                if rank is not None and rank < x_gone and rank <= y_gone:
                    if found is None or rank < found[0]:
                        found = rank, x, y
        return found

    def _derivable(self, made: dict, token: int) -> bool:
        """Whether a token's own text is encoded as that token."""
        stack = [token]
        while stack:
            t = stack.pop()
            if t in made:
                left, right, _ = made[t]
                if (first := self._first_merge(left, right)) is None or first[1:] != (left, right):
                    return False
                stack += [left, right]
        return True

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens can be neighbours: no merge crosses the border between them."""
        key = left << 32 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > 1_000_000:
                self._fits.clear()
            known = self._fits[key] = self._first_merge(left, right) is None
        return known

    def _symbols(self, word: str) -> str:
        """The word in symbols of the vocabulary; letters that it lacks are left out."""
        symbols = word[:-1] + self._last(word[-1]) if self.has_end else word
        return symbols if self.known.issuperset(symbols) else "".join(s for s in symbols if s in self.known)

    def encode(self, word: str) -> list[int]:
        """Ids of one word of the splitter."""
        symbols = self._symbols(word)
        last = [-1] * (len(symbols) + 1)
        before = [0] * (len(symbols) + 1)
        known = self._fits
        for at, match in self._matches(symbols):
            at += 1
            if last[at] >= 0:
                continue
            token, start = match >> 32, at - (match & 0xFFFFFFFF)
            if start:
                left = last[start]
                if left < 0:
                    continue
                fit = known.get(left << 32 | token)
                if not (self.fits(left, token) if fit is None else fit):
                    continue
            last[at] = token
            before[at] = start
        ids, at = [], len(symbols)
        while at:
            ids.append(last[at])
            at = before[at]
        ids.reverse()
        return ids

    def _all_fit(self, pairs: np.ndarray) -> np.ndarray:
        different, which = np.unique(pairs, return_inverse=True)
        known = self._fits
        found = list(map(known.get, different.tolist()))
        if None in found:
            found = [self.fits(pair >> 32, pair & 0xFFFFFFFF) if fit is None else fit for pair, fit in zip(different.tolist(), found)]
        return np.array(found, bool)[which]

    def encode_many(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian bytes of four each.

        One table for all words, filled for the prefixes of one length after the other: of
        the tokens that end at a prefix exactly one can follow the last token of the prefix before it.
        """
        symbols = list(map(self._symbols, words))
        # No token holds the letter that parts the words, so no match crosses it.
        matched = np.fromiter(chain.from_iterable(self._matches("\0".join(symbols))), np.int64)
        ends, tokens = matched[::2] + 1, matched[1::2] >> 32
        starts = ends - (matched[1::2] & 0xFFFFFFFF)
        sizes = np.fromiter(map(len, symbols), np.int64, len(symbols))
        first = np.cumsum(sizes + 1) - sizes - 1
        length = ends - first[np.searchsorted(first, starts, side="right") - 1] if len(ends) else ends
        last = np.full(int(first[-1] + sizes[-1]) + 1 if len(first) else 0, -1, np.int64)
        before = np.zeros(len(last), np.int64)
        order = np.argsort(length, kind="stable")
        bounds = np.flatnonzero(np.diff(length[order], prepend=0, append=np.iinfo(np.int64).max))
        for low, high in zip(bounds, bounds[1:]):
            own = order[low:high]
            left = last[starts[own]]
            whole = starts[own] == ends[own] - length[own]
            fits = whole.copy()
            behind = np.flatnonzero(~whole & (left >= 0))
            fits[behind] = self._all_fit(left[behind] << 32 | tokens[own[behind]])
            own = own[fits]
            last[ends[own]], before[ends[own]] = tokens[own], starts[own]
        # Back from the ends of all words at once.
        number, at = np.arange(len(words)), first + sizes
        steps = []
        while len(number := number[at > first[number]] if len(number) else number):
            at = at[at > first[steps[-1][0]]] if steps else at[at > first]
            steps.append((number, last[at]))
            at = before[at]
        if not steps:
            return [b""] * len(words)
        owner, ids = (np.concatenate([s[k] for s in steps[::-1]]) for k in (0, 1))
        order = np.argsort(owner, kind="stable")
        data = ids[order].astype("<u4").tobytes()
        cuts = (4 * np.searchsorted(owner[order], np.arange(len(words) + 1))).tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]


class TextEncoder:
    """Ids of whole texts, as the library gives them without special tokens at the ends.

    Texts are cut at white space; the ids of a piece, as little-endian bytes of four each, are
    remembered in two generations of bounded dictionaries.
    """

    def __init__(self, path: str, by_library: bool = False):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        bpe = model["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in bpe["merges"]]
        if by_library:
            tokenize = self.library.model.tokenize
            self._encode_many = lambda words: many_id_bytes([[t.id for t in tokenize(word)] for word in words])
        else:
            self._encode_many = PrefixEncoder(bpe["vocab"], merges, bpe["end_of_word_suffix"] or "").encode_many
        self.names = {i: t for t, i in bpe["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        # The shortcut for simple pieces holds for this normaliser and this word pattern only.
        self._simple = model["normalizer"] == _NORMAL and _PATTERN in json.dumps(model["pre_tokenizer"])
        self._special_ids = {w: id_bytes([i]) for w, i in self.special.items()}
        self._words_known: dict[str, bytes] = {}
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _words(self, piece: str) -> list[str]:
        if self._simple and _SIMPLE.fullmatch(piece):
            words = _SIMPLE_WORDS.findall(piece.lower())
            return words if piece.isascii() else [w.encode().decode("latin-1").translate(_BYTES) for w in words]
        normal = self.library.normalizer
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal.normalize_str(piece) if normal else piece)]

    def _parts(self, piece: str) -> list[str]:
        """The words of a piece without white space, special strings by themselves."""
        if self._special is None or "<" not in piece or not self._special.search(piece):
            return self._words(piece)
        return [w for p in self._special.split(piece) if p for w in ([p] if p in self.special else self._words(p))]

    def _new(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, each different word in them being encoded once."""
        parts, simple, parts_of = [], self._simple, self._parts
        for piece in pieces:
            if simple and piece.isascii() and "<" not in piece:
                # Most pieces are letters, and marks after them.
                word = piece.rstrip(punctuation)
                if word.isalpha():
                    parts.append((word.lower(),) if len(word) == len(piece) else (word.lower(), piece[len(word):]))
                    continue
            parts.append(parts_of(piece))
        known = self._words_known
        words = list(set(chain.from_iterable(parts)).difference(known, self.special))
        known.update(zip(words, self._encode_many(words)))
        known.update(self._special_ids)
        ids_of = known.__getitem__
        found = [ids_of(own[0]) if len(own) == 1 else b"".join(map(ids_of, own)) for own in parts]
        for word in chain(self._special_ids, [w for w in words if len(w) > CACHED_CHARS]):
            del known[word]
        return found

    def lookup(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece."""
        young = self._young
        found = list(map(young.get, pieces))
        if None in found:
            fresh = dict.fromkeys(p for p, value in zip(pieces, found) if value is None)
            old = {p: value for p in fresh if (value := self._old.get(p)) is not None}
            unknown = [p for p in fresh if p not in old]
            fresh = old | dict(zip(unknown, self._new(unknown)))
            found = [fresh[p] if value is None else value for p, value in zip(pieces, found)]
            young.update(fresh)
            for piece in [p for p in fresh if len(p) > CACHED_CHARS]:
                del young[piece]
        return found

    def forget(self) -> None:
        """Let go of what has not been met for long."""
        if len(self._young) > CACHE_ENTRIES:
            self._old, self._young = self._young, {}
        if len(known := self._words_known) > CACHE_ENTRIES:
            self._words_known = dict(islice(known.items(), len(known) - CACHE_ENTRIES // 2, None))

    def pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Pieces of a batch of texts: their numbers in order, where each text's begin (and the last end),
        and the ids of each different piece. Only different pieces become Python strings."""
        texts = texts.cast(pa.large_string())
        if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():
            lists = pa.array([words_of(t) for t in texts.to_pylist()], pa.large_list(pa.large_string()))
        else:
            lists = pc.utf8_split_whitespace(texts)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        found = lists.flatten().dictionary_encode()
        made = []
        for low in range(0, len(found.dictionary), PIECES_AT_ONCE):
            made += self.lookup(found.dictionary.slice(low, PIECES_AT_ONCE).to_pylist())
        self.forget()
        return found.indices.to_numpy(zero_copy_only=False), bounds - bounds[0], made

    def encode(self, text: str) -> list[int]:
        ids = np.frombuffer(b"".join(self.lookup(words_of(text))), "<u4").tolist()
        self.forget()
        return ids

    def decode(self, ids: list[int]) -> str:
        """As the library decodes where the file names no decoder: tokens with spaces between."""
        return " ".join(self.names[i] for i in ids)


    @cached_property
    def texts_of_ids(self) -> tuple[pa.Array, pa.Array]:
        """By id its decimal digits and its name."""
        ids = range(max(self.names) + 1)
        return pa.array(map(str, ids), pa.large_string()), pa.array(map(self.names.get, ids), pa.large_string())


_encoders: dict[tuple, TextEncoder] = {}


def id_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian bytes of four each."""
    return struct.pack(f"<{len(ids)}I", *ids)


def many_id_bytes(words: list[list[int]]) -> list[bytes]:
    """:func:`id_bytes` of each word, packed together."""
    data = np.fromiter(chain.from_iterable(words), "<u4").tobytes()
    cuts = [0, *accumulate(4 * len(ids) for ids in words)]
    return [data[a:b] for a, b in pairwise(cuts)]


def text_encoder(path: str, by_library: bool = False) -> TextEncoder:
    """The encoder of this Python worker, made once for a vocabulary."""
    if (path, by_library) not in _encoders:
        _encoders[path, by_library] = TextEncoder(path, by_library)
    return _encoders[path, by_library]


def batch_ids(encoder: TextEncoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of a batch of texts, one after the other, and where each text's begin (and the last end)."""
    numbers, bounds, made = encoder.pieces(texts)
    flat = np.frombuffer(b"".join(made), "<u4")
    sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
    first = np.cumsum(sizes) - sizes
    ends = np.zeros(len(numbers) + 1, np.int64)
    np.cumsum(sizes[numbers], out=ends[1:])
    ids = np.empty(ends[-1], "<u4")
    for low in range(0, len(numbers), PIECES_AT_ONCE):
        own, at = numbers[low:low + PIECES_AT_ONCE], ends[low:low + PIECES_AT_ONCE + 1]
        ids[at[0]:at[-1]] = flat[np.repeat(first[own] - at[:-1], sizes[own]) + np.arange(at[0], at[-1])]
    return ids, ends[bounds]


def _joined(names: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The names of each text's ids, joined by blanks."""
    lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), names.take(pa.array(ids)))
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))


def encode_documents(
    docs: DataFrame, path: str, *, id_column: str = "doc_id", text_column: str = "text", digests: bool = False
) -> DataFrame:
    """Token ids of every text and the text that they decode to.

    Returns the id column, ``n_tokens long`` and ``ids array<int>``, ``decoded string``; with
    ``digests`` instead their SHA-256 in hex (``ids_sha256`` of decimal ids joined by a space).
    Null and empty texts have no tokens. Ids may be null or repeat; each row gives a row.
    ``path`` is a vocabulary file without a decoder that every worker can read.
    """
    kind = docs.schema[id_column].dataType
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path)
        for batch in (part for whole in batches for part in slices(whole, "text", TEXT_BYTES)):
            ids, texts = batch.column("id"), batch.column("text")
            flat, bounds = batch_ids(encoder, texts)
            counts = np.diff(bounds)
            digits, names = encoder.texts_of_ids
            second = _joined(names, flat, bounds)
            if digests:
                first, second = (pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in own], pa.string()) for own in (_joined(digits, flat, bounds), second))
            else:
                first = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.astype(np.int32)))
                second = second.cast(pa.string())
            yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), first, second], ["id", "n_tokens", "first", "second"])

    made = rows.mapInArrow(run, f"id {kind.simpleString()}, n_tokens long, first {'string' if digests else 'array<int>'}, second string")
    names = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")
    return made.select(F.col("id").alias(id_column), "n_tokens", F.col("first").alias(names[0]), F.col("second").alias(names[1]))
