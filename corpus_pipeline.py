"""From documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm import langid, minhash, packing, toxicity, trie
from siltbed.llm.queries import WORD_BPE, table
from siltbed.llm.shared import stored
from siltbed.ship import ship


# Rows that go to a Python worker together. Workers serve all stages and keep what memory they
# once took, so small batches bound them.
BATCH_ROWS = 1000
# Bytes of text that packing takes apart together.
PACKED_BYTES = 1 << 20

# Texts below this fit (see ``langid.identify``) go. Random letters, codes and scripts that no
# language was learned for are at 0 to 0.21, texts of a few words full of numbers and
# secrets at 0.45 and more, prose at 0.9 to 1.1.
LEAST_FIT = 0.33


def ready(spark: SparkSession) -> None:
    """Make tasks able to import the package, and bound the batches that they hold."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages, or in several.

    Null texts, those without a letter and those whose trigrams are far from all of them (``LEAST_FIT``)
    go. Where no document names its language nothing can be learned, and texts with letters stay.
    Each row is decided by its text alone: null or repeated ids, ties and repeated rows are no matter.
    """
    ready(spark)
    model = langid.train(docs)
    if not model.languages:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = langid.mixture(model, F.col("text"))
    return docs.where((found["lang_pred"] != langid.UNKNOWN) & (found["fit"] >= LEAST_FIT))


def low_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic; a null text counts as empty, each row by its text alone."""
    ready(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxicity(model, F.col("text")) < toxicity.THRESHOLD)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id; null ids come before all, a null text is empty."""
    ready(spark)
    return trie.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest id; see ``without_near_duplicates``."""
    ready(spark)
    return minhash.without_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their place in the sequences; every row is packed."""
    ready(spark)
    return packing.pack_documents(docs, WORD_BPE, text_bytes=PACKED_BYTES)


STAGES = [
    ("language_id", language_id),
    ("toxicity", low_toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", pack),
]

# Learned stages, hashed banding and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
