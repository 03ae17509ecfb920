import random
import zlib
from collections import defaultdict

import numpy as np
from siltbed.llm import packing
from siltbed.llm.queries import WORD_BPE
from tokenizers import Tokenizer


def test_windows_are_full_and_hold_everything():
    rnd = random.Random(1)
    packer = packing.Packer((8, 16, 32))
    for document in range(400):
        packer.add(document, np.arange(rnd.choice([1, 3, 7, 9, 20, 31, 32, 90]), dtype="<u4").tobytes())
        if document % 97 == 0:
            packer.pack()
    packer.finish()
    seen = defaultdict(list)
    for size, window in packer.sequences:
        assert size & (size - 1) == 0 and sum(p[0] for p in window) == size
        for length, _, document, start, ids in window:
            assert np.frombuffer(ids, "<u4").tolist() == list(range(start, start + length))
            seen[document] += range(start, start + length)
    assert all(sorted(v) == list(range(len(v))) for v in seen.values()) and len(seen) == 400
    assert sum(size < 8 for size, _ in packer.sequences) <= 3


def test_step_groups_are_even():
    sizes = [32] * 10 + [8] * 40 + [16] * 21
    groups = packing.deal(sizes, 64)
    sums = np.bincount(groups, weights=sizes)
    assert len(sums) == -(-sum(sizes) // 64) and sums.max() - sums.min() <= 8


def check(docs, rows, tiers=packing.TIERS):
    library = Tokenizer.from_file(WORD_BPE)
    want = defaultdict(int)
    for row in docs.collect():
        want[row.doc_id, len(library.encode(row.text or "", add_special_tokens=False).ids) + 1] += 1
    have, sequences = defaultdict(int), defaultdict(list)
    for row in rows:
        assert zlib.crc32(np.array(row.ids, "<u4").tobytes()) == row.ids_crc32 and len(row.ids) == row.length
        have[row.doc_id, row.doc_tokens] += row.length
        sequences[row.sequence_id].append((row.offset, row.length, row.tier))
    assert {k: n * k[1] for k, n in want.items()} == dict(have)
    for pieces in sequences.values():
        pieces.sort()
        ends = np.cumsum([p[1] for p in pieces])
        assert [p[0] for p in pieces] == [0, *ends[:-1]]
        assert ends[-1] == pieces[0][2] <= max(tiers) and ends[-1] & (ends[-1] - 1) == 0


def test_documents(edge_docs, no_docs, monkeypatch):
    check(edge_docs, packing.pack_documents(edge_docs, WORD_BPE, ids=True).collect())
    tiers = (16, 64)
    check(edge_docs, packing.pack_documents(edge_docs, WORD_BPE, tiers=tiers, step_windows=4, ids=True).collect(), tiers)
    assert packing.pack_documents(no_docs, WORD_BPE).count() == 0


def test_ids_go_round(edge_docs):
    library = Tokenizer.from_file(WORD_BPE)
    docs = edge_docs.where("doc_id in (7, 9)")
    pieces = defaultdict(list)
    for row in packing.pack_documents(docs, WORD_BPE, tiers=(32, 128), ids=True).collect():
        pieces[row.doc_id].append((row.start, row.ids))
    for row in docs.collect():
        ids = [i for _, part in sorted(pieces[row.doc_id]) for i in part]
        assert ids == [*library.encode(row.text, add_special_tokens=False).ids, packing.SEPARATOR]


def test_text_is_taken_apart_in_parts(edge_docs):
    """The same pieces, whatever goes into the table together."""
    rows = [sorted(map(tuple, packing.pack_documents(edge_docs, WORD_BPE, text_bytes=n).collect()), key=repr) for n in (packing.TEXT_BYTES, 64)]
    assert rows[0] == rows[1]
