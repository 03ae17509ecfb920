import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from siltbed.llm import minhash, wordhash
from siltbed.llm.components import components

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def weights(text, size=5):
    w = words(text)
    return Counter(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()


def similarity(x, y):
    every = list(set(x) | set(y))
    p, q = (np.array([s[e] / max(1, sum(s.values())) for e in every]) for s in (x, y))
    return sum(1 / np.maximum(p / p[k], q / q[k]).sum() for k in range(len(every)) if p[k] and q[k])


def classes(rows, threshold=0.8):
    """Smallest id of each row's class, all pairs compared."""
    sets = [weights(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    where = defaultdict(list)
    for k, s in enumerate(sets):
        for j, n in Counter(j for e in s for j in where[e]).items():
            if n / max(len(s), len(sets[j])) > 0.3 and find(j) != find(k) and similarity(s, sets[j]) >= threshold - 1e-12:
                parent[find(k)] = find(j)
        for e in s:
            where[e].append(k)
    members = defaultdict(list)
    for k in range(len(rows)):
        members[find(k)].append(rows[k][0])
    return sorted(((rows[k][0], min((i for i in members[find(k)] if i is not None), default=None), len(members[find(k)])) for k in range(len(rows))), key=repr)


def test_words_of_a_batch(monkeypatch):
    texts = ["ab cd", "", "cd,ab ab", "é", "x" * 300, "ab"]
    for size in (1 << 19, 64, 5):
        monkeypatch.setattr(wordhash, "CHUNK", size)
        hashes, bounds = wordhash.word_hashes(pa.array(texts))
        assert np.diff(bounds).tolist() == [2, 0, 3, 1, 1, 1]
        ab, cd, cd2, ab2, ab3, *_ = hashes
        assert ab == ab2 == ab3 == hashes[-1] and cd == cd2 and len(set(hashes.tolist())) == 4
        parts = [p.num_rows for p in wordhash.slices(pa.record_batch([pa.array(texts)], ["t"]), "t", 8)]
        assert sum(parts) == len(texts)


def test_registers_agree_as_often_as_sets_are_alike():
    rnd = np.random.default_rng(2)
    for shared in (50, 150, 400):
        names = rnd.integers(1, 1 << 62, 600).astype(np.uint64)
        first, second = np.sort(names[:300]), np.sort(names[300 - min(shared, 299):])
        w1, w2 = rnd.integers(1, 5, len(first)).astype(np.uint32), rnd.integers(1, 5, len(second)).astype(np.uint32)
        exact = minhash.probability_jaccard(first, w1, second, w2)
        a, b = minhash.signature(first, w1, 4000), minhash.signature(second, w2, 4000)
        assert abs((a == b).mean() - exact) < 0.035
        want = similarity(Counter(dict(zip(first.tolist(), w1.tolist()))), Counter(dict(zip(second.tolist(), w2.tolist()))))
        assert exact == pytest.approx(want)


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 101), (103, 101), (7, 7)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    labels = {r.node: r.label for r in got}
    assert len(got) == 34 and len({labels[i] for i in range(31)}) == 1 and labels[100] == labels[101] == labels[103] != labels[0]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def result(docs):
    return sorted(map(tuple, minhash.near_duplicates(docs).select("doc_id", "class_id", "class_size").collect()), key=repr)


def test_edges(edge_docs, no_docs):
    assert result(edge_docs) == classes([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert minhash.near_duplicates(no_docs).count() == 0
    kept = minhash.without_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r.doc_id for r in kept.collect()} == {None, 1, 4, 5, 6, 7, 9, 10, 12}


def test_repeated_ids_lose_no_text(spark):
    """An id that repeats with another text: each class keeps one document, by row and not by id."""
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    rows = [(3, a, 1), (5, b, 2), (5, a, 3), (7, b + " more", 4), (None, a + " end", 5), (None, "alone but for itself here", 6), (9, None, 7), (9, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone_id int").repartition(3)
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.gone_id for r in kept.collect()) == [1, 2, 6, 7, 8]


def test_hot_bucket_is_settled_in_linear_passes(spark, monkeypatch):
    """Of a large group of near copies with a few strangers only the strangers meet block by block."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rnd = np.random.default_rng(9)
    source = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(300):
        text = list(source)
        text[int(rnd.integers(0, 300))] = f"edit{k}"
        rows.append((k, " ".join(text)))
    asked = []
    plain = minhash.stored
    monkeypatch.setattr(minhash, "stored", lambda rows, name: asked.append((name, made := plain(rows, name))) or made)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert set(result(docs)) == {(k, 0, 300) for k in range(300)}
    assert [made.count() for name, made in asked if name == "unsettled"] == [0]


def test_equals_brute_force(spark, monkeypatch):
    """With small blocks, and a group of near copies that only their source connects."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    rows = list(zip(table["doc_id"], table["text"]))
    rnd = np.random.default_rng(4)
    source = [f"w{k}" for k in range(150)]
    for copy in range(40):
        text = list(source)
        for at in rnd.integers(0, 150, 3):
            text[at] = f"edit{copy}"
        rows.append((10_000 + copy, " ".join(text)))
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == classes(rows)


def unicode_words(text):
    """Runs of letters, marks and digits; Han, kana and Thai letters (with their marks) by themselves."""
    found, run = [], ""
    for c in text.lower():
        inside, apart = unicodedata.category(c)[0] in "LMN", re.match("[\u3041-\u30fa\u4e00-\u9fff\u0e01-\u0e4f]", c) and unicodedata.category(c)[0] == "L"
        if run and (apart or not inside or (len(run) and re.match("[\u3041-\u30fa\u4e00-\u9fff\u0e01-\u0e4f]", run[0]) and unicodedata.category(c)[0] != "M")):
            found.append(run)
            run = ""
        if inside:
            run += c
    return found + [run] * bool(run)


def test_words_by_unicode_classes(spark, monkeypatch):
    """Typographic marks and blanks part words, and scripts without blanks have words."""
    rnd = np.random.default_rng(7)
    plain = " ".join(f"w{k}" for k in range(60))
    marked = plain.replace("w10 ", "\u201cw10\u201d\u00a0").replace("w30 ", "w30\u2014").replace("w45 ", "w45\u3000").replace("w20 ", "w20\u2026 ")
    pages = ["".join(chr(c) for c in rnd.integers(low, low + size, 200)) for low, size in ((0x4E00, 2000), (0x3042, 60), (0x0E01, 46))]
    rows = [(1, plain), (2, marked)]
    for k, page in enumerate(pages):
        rows += [(10 + 10 * k, page), (11 + 10 * k, page[:100] + "\u3002" + page[100:150] + page[151:]), (12 + 10 * k, page[::-1])]
    monkeypatch.setitem(globals(), "words", lambda text: unicode_words(text or ""))
    found = result(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found == classes(rows)
    assert {i: c for i, c, _ in found} == {1: 1, 2: 1, **{10 * k + j: 10 * k + (j if j == 2 else 0) for k in (1, 2, 3) for j in (0, 1, 2)}}
