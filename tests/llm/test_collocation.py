import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from siltbed.llm import collocation, queries

SF = "/root/testdata/sf0.001"


def brute(rows, min_count, top, longest=5):
    """Every phrase counted and every cut tried, with exact integers."""
    counts, totals, out = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    for lang, own in counts.items():
        candidates = [p for p, a in own.items() if a >= min_count and len(p) > 1]
        held = {q[i:i + k] for q in candidates for k in range(2, len(q)) for i in range(len(q) - k + 1) if own[q] >= own[q[i:i + k]]}
        found = []
        for p in candidates:
            if p not in held:
                cuts = ((1000 * own[p] * totals[lang] // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
                score, _, left, right = min(cuts)
                found.append((-score, -own[p], " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def result(docs, **options):
    return sorted(map(tuple, collocation.phrases(docs, **options).collect()))


def test_edges(edge_docs, no_docs):
    """Nulls, empty and long texts, repeated rows and clashing columns."""
    docs = edge_docs.withColumnsRenamed({"score": "phrase"}).selectExpr("*", "1 as n", "2 as words", "3 as pair")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert result(docs, min_count=2) == brute(rows, 2, 2000)
    assert result(docs) == brute(rows, 100, 2000)
    assert result(no_docs) == [] and collocation.phrases(no_docs).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert result(edge_docs.where("text is null or text = ''"), min_count=1) == []


@pytest.mark.parametrize("options", [{}, {"filter_bits": 64}, {"longest": 3}])
def test_equals_brute_force(spark, monkeypatch, options):
    """Repeated passages, word rings, every separator, and stretches of a few bytes."""
    rnd = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = []
    for k in range(300):
        words = [rnd.choice(["a", "b", "B", "c", "é", "d,", "e.", "x\ty", "z\n", " ", "  "]) for _ in range(rnd.randint(0, 60))]
        words.insert(rnd.randint(0, len(words)), rnd.choice([passage, "ring ring ring ring ring ring ring", "one two one two one two one two", ""]))
        rows.append((rnd.choice(["en", "de", None, ""]), " ".join(words)))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    monkeypatch.setattr(collocation, "STRETCH", 100)
    monkeypatch.setattr(collocation, "PAIRS", 50)
    for least, top in ((2, 30), (20, 500)):
        assert result(docs, min_count=least, top=top, **options) == brute(rows, least, top, options.get("longest", 5))


def test_paths_are_compacted(spark):
    """A passage of all copies is one path; it parts where another text goes on otherwise."""
    words = [f"w{k}" for k in range(30)]
    rows = [("en", " ".join(words))] * 4 + [("en", "v " + " ".join(words[10:20]) + " v")] * 3
    grams = collocation.gram_counts(spark.createDataFrame(rows, "lang string, text string"), min_count=2)
    frequent, paths = collocation.phrase_counts(grams, min_count=2)
    found = {(r.phrase, r.words, r.n) for r in paths.collect()}
    assert found == {
        (" ".join(words[:14]), 14, 4), (" ".join(words[10:20]), 10, 7), (" ".join(words[16:]), 14, 4),
        (" ".join(["v", *words[10:14]]), 5, 3), (" ".join([*words[16:20], "v"]), 5, 3),
    }
    counts = {r.phrase: r.n for r in frequent.collect()}
    assert counts["w12"] == counts["w12 w13"] == 7 and counts["w2 w3 w4 w5"] == 4 and counts["v"] == 6


def test_products_beyond_64_bits(spark):
    """The arithmetic of scores is exact: 1000 a n passes 2**63 here."""
    made = spark.createDataFrame([(2**40 + 1, 2**41 + 3, 2**42 + 5, 2**50 + 7)], "a long, l long, r long, n long")
    names = [f"cast({c} as decimal(17,0)) as {c}_" for c in "alrn"]
    score = made.selectExpr(*names).selectExpr("(cast(1000 as decimal(4,0)) * a_ * n_) div (l_ * r_) as s").first().s
    assert score == 1000 * (2**40 + 1) * (2**50 + 7) // ((2**41 + 3) * (2**42 + 5))


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries.op11_collocations(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(queries.ORACLES["op11_collocations"]).fetchall())
