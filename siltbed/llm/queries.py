"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocation, counts, langid, minhash, ordinal, packing, toxicity, transcript, trie, vafile, warc, whiten
from .shared import stored

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page, taken as a WARC response."""
    made = warc.derive(warc.response_records(table(spark, sf_dir, "pages")), id_column="page_id")
    return made.withColumn("record_sha256", F.sha2("record", 256)).drop("record")


# How a transcript may mark its speakers, in the order system, user, assistant.
MARKS = (
    ("System:", "User:", "Assistant:"),
    ("### System:", "### Instruction:", "### Response:"),
    ("**Instructions:**", "**Human:**", "**AI:**"),
    ("[SYSTEM]:", "[CUSTOMER]:", "[AGENT]:"),
)


def transcripts(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, text`` with a marker before three of four messages, in a style of the conversation."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(MARKS)))
    marks = F.array(*[F.array(*map(F.lit, marks)) for marks in MARKS])
    which = F.when(F.col("role") == "system", 0).when(F.col("role") == "user", 1).when(F.col("role") == "assistant", 2)
    marker = F.when(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)) > 0, F.concat(marks[style.cast("int")][which], F.lit(" ")))
    return conversations.select("conv_id", "turn", F.concat(F.coalesce(marker, F.lit("")), F.coalesce("text", F.lit(""))).alias("text"), "role")


def op3_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns recovered from the lines of all conversations, a quarter of whose messages have no marker.

    A half of the conversations is parsed by what is learned from the other half.
    """
    messages = transcripts(table(spark, sf_dir, "conversations"))
    half = F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 2, F.lit(0))
    first, second = messages.where(half == 0), messages.where(half == 1)
    found = [transcript.parse(own.drop("role"), transcript.train(other), stored=stored) for own, other in ((first, second), (second, first))]
    return found[0].union(found[1])


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into full sequences of 2048 tokens or a smaller power of two."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_BPE)


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of every text and their proportions."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op5_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts, A to Z in lower case; the row with the largest id stays."""
    return trie.exact_duplicates(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text by weak supervision."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest inner products of every fiftieth vector."""
    vectors = vafile.scaled(table(spark, sf_dir, "embeddings"))
    return vafile.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op8_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of every text: 0 of low quality, 1 toxic but else good, 2 good; at least 1 is kept."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality").isNotNull() & F.col("toxic").isNotNull(), 2)
    model = ordinal.train(docs, labels.select("doc_id", grade.alias("grade")), 3)
    return ordinal.grade_documents(docs, model, at_least=1)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text and what they decode to, as digests."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), WORD_BPE, digests=True)


def op10_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near duplicates at a probability Jaccard similarity of 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of two to five words of each language by their weakest cut."""
    return collocation.phrases(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight leading components of all, whitened."""
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text."""
    return counts.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE)


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc, op2_packing, op3_transcripts, op4_langid, op5_trie, op6_toxicity, op7_vafile, op8_ordinal, op9_bpe, op10_probminhash,
        op11_collocations, op12_whitening, op13_token_counts,
    )
}

ORACLES: dict[str, str] = {
    "op11_collocations": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                unnest(regexp_split_to_array(translate(coalesce(text, ''), '{trie.UPPER}', '{trie.LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        ), lists AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces
        ), spread AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
            FROM lists, (VALUES (1), (2), (3), (4), (5)) AS sizes(k)
        ), counted AS (
            SELECT lang, k, phrase, count(*) AS a FROM spread GROUP BY ALL
        ), totals AS (
            SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang
        ), candidates AS (
            SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1 AND a >= 100
        ), parts AS (
            SELECT lang, a, size, unnest(list_transform(range(1, k - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
            FROM candidates, (VALUES (2), (3), (4)) AS sizes(size) WHERE size < k
        ), held AS (
            SELECT lang, phrase, max(a) AS most FROM parts GROUP BY ALL
        ), kept AS (
            SELECT c.* FROM candidates c LEFT JOIN held h USING (lang, phrase) WHERE h.most IS NULL OR 100 * h.most < 100 * c.a
        ), cuts AS (
            SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS cut FROM kept
        ), scored AS (
            SELECT c.lang, c.phrase, c.a, t.n, c.cut, x.a AS l, y.a AS r,
                CAST(1000::HUGEINT * c.a * t.n // (x.a::HUGEINT * y.a) AS BIGINT) AS score
            FROM cuts c JOIN totals t USING (lang)
            JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
            JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')
        ), weakest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM weakest QUALIFY rank <= 2000
    """,
    "op5_trie": f"""
        WITH folded AS (
            SELECT doc_id, translate(coalesce(text, ''), '{trie.UPPER}', '{trie.LOWER}') AS content FROM documents
        ), grouped AS (
            SELECT doc_id, content, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size
            FROM folded WINDOW same AS (PARTITION BY content)
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM grouped
    """,
    "op7_vafile": """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vector, c.vector) AS BIGINT) AS score
            FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
}
