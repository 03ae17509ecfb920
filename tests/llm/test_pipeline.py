import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
import pytest  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from siltbed.llm import queries, trie  # noqa: E402

from .test_minhash import classes  # noqa: E402
from .test_packing import check  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_each_stage_decides_on_what_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    junk = spark.createDataFrame([(9001, "12 34", "en", "s", 5), (9002, None, None, None, None), (9003, "...", "en", "s", 3)], docs.schema)
    start = docs.union(junk)
    stage = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "exact_dedup", "near_dedup", "packing"]
    ids = lambda frame: {r.doc_id for r in frame.select("doc_id").collect()}
    spoken = stage["language_id"](spark, start, SF)
    assert ids(spoken) == ids(docs) and spoken.columns == docs.columns
    kind = stage["toxicity"](spark, docs, SF)
    gone = ids(docs) - ids(kind)
    assert gone and sum(labels.get(i, 1) for i in gone) >= 0.8 * len(gone)
    exact = stage["exact_dedup"](spark, docs, SF)
    rows = exact.collect()
    assert len({r.text.lower() for r in rows}) <= len(rows) < docs.count()
    assert ids(exact) == {r.keep_id for r in trie.owners(docs).collect()}
    near = stage["near_dedup"](spark, exact, SF)
    assert ids(near) == {c for _, c, _ in classes([(r.doc_id, r.text) for r in rows])}
    check(docs, corpus_pipeline.packing.pack_documents(docs, corpus_pipeline.WORD_BPE, ids=True).collect())


def test_language_decides(spark):
    """Text of no learned language goes; without any language named, texts with letters stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9001, "q#### 0000 %%%% 1111"), (9002, "xqzj kvw pqxz zzkq jjxw"), (9003, "aGVsbG8gd29ybGQgdGhpcyBpcyBiYXNlNjQ")]
    more = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in odd], docs.schema)
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    assert {r.doc_id for r in stage(spark, docs.union(more), SF).collect()} == {r.doc_id for r in docs.collect()}
    unnamed = docs.union(more).withColumn("lang", F.lit(None).cast("string"))
    junk = spark.createDataFrame([(9004, "12 34", None, "s", 5), (9005, None, None, None, None)], docs.schema)
    assert stage(spark, unnamed.union(junk), SF).count() == docs.count() + 3


# Names that the operators use for columns of their own.
CLASHING = ("share", "n", "rating", "votes", "id", "content", "label", "bucket", "hash", "length", "start", "node", "bands", "found", "place", "words", "phrase", "fit", "gone_id", "kept")


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_columns_of_any_name(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    wide = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)])
    stage = dict(corpus_pipeline.STAGES)[name]
    want, got = stage(spark, docs, SF), stage(spark, wide, SF)
    if name != "packing":
        assert got.columns == wide.columns
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


@pytest.mark.parametrize("name", ["op2_packing", "op4_langid", "op5_trie", "op6_toxicity", "op8_ordinal", "op9_bpe", "op10_probminhash", "op11_collocations", "op13_token_counts"])
def test_queries_take_columns_of_any_name(spark, tmp_path, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for folder, extra in (("plain", ()), ("wide", CLASHING)):
        docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(extra)]).write.parquet(f"{tmp_path}/{folder}/documents.parquet")
        labels.select("*", *[F.lit(k).alias(c) for k, c in enumerate(extra)]).write.parquet(f"{tmp_path}/{folder}/labels.parquet")
    want, got = (queries.QUERIES[name](spark, f"{tmp_path}/{folder}") for folder in ("plain", "wide"))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_run_and_empty_tables(spark):
    pieces = corpus_pipeline.run(spark, SF)
    kept = pieces.select("doc_id").distinct().count()
    assert 0 < kept < 200
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
