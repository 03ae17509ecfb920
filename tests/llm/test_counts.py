import random

import pyarrow.parquet as pq
import pytest
from public_tokenizers import path
from siltbed.llm import counts, queries
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
FILE = path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def expected(library, rows, limit=512):
    out = []
    for i, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        out.append((i, len((text or "").encode()), n, n > limit))
    return sorted(out, key=repr)


def result(docs, file=FILE, **options):
    return sorted(map(tuple, counts.token_counts(docs, file, **options).collect()), key=repr)


def test_cuts_are_safe(library, monkeypatch):
    """Any mixture of white space, letters, marks and special strings, cut everywhere, counts the same."""
    monkeypatch.setattr(counts, "CACHE_ENTRIES", 300)
    rnd = random.Random(3)
    letters = list("ab'stre12!  \n\t\x0b\x1c\x1f\x85") + [chr(c) for c in (0xA0, 0x1680, 0x180E, 0x2003, 0x200B, 0x2028, 0x202F, 0x3000, 0xFEFF, 0xE9, 0x301, 0x6F22, 0xE17, 0x1F600)]
    letters += ["<|endoftext|>", "'ll", "  ", " \n", "<|", "|>", " word", "aaaaaaaa"]
    own = counts.Counter(FILE)
    for size in (1, 5, 1 << 18):
        monkeypatch.setattr(counts.windows, "__defaults__", (size,))
        texts = ["".join(rnd.choices(letters, k=rnd.randint(0, 60))) for _ in range(3000)]
        assert own.counts(texts) == [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
        assert all("".join(counts.windows(t)) == t and "".join(counts.stretches(t)) == t for t in texts)


def test_edges(library, edge_docs, no_docs):
    docs = edge_docs.selectExpr("*", "1 as n_tokens", "2 as id", "3 as n_bytes")
    assert result(docs) == expected(library, [(r.doc_id, r.text) for r in docs.collect()])
    assert result(no_docs) == []


def test_very_long_texts(spark, library):
    rnd = random.Random(4)
    texts = ["x" * 300_000, " " * 300_000, "word " * 400_000, "".join(rnd.choices("abc \n", k=1_500_000))]
    rows = list(enumerate(texts))
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == expected(library, rows)


def test_other_vocabularies(spark, edge_docs):
    """Files that do not make cuts safe are given whole texts."""
    import sentencepiece

    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    words = Tokenizer.from_file(path("word_bpe_49k.json"))
    assert result(edge_docs, path("word_bpe_49k.json"), limit=3) == expected(words, rows, 3)
    pieces = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    want = sorted(((i, len((t or "").encode()), n, n > 512) for i, t in rows for n in [len(pieces.encode(t or ""))]), key=repr)
    assert result(edge_docs, path("piece_bpe_32k.model")) == want


def test_query(spark, library):
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    got = sorted(map(tuple, queries.op13_token_counts(spark, SF).collect()), key=repr)
    assert got == expected(library, list(zip(table["doc_id"], table["text"])))
