"""A training corpus from the documents: stages that each apply one operator.

Toxic documents go, then copies, then near copies; what is left is mixed to the sources'
target weights, which repeats documents, and encoded, which is checked by decoding. Every
stage reads what the one before it has written.

Columns beside those of documents, whatever their names, are kept by all stages but the
last. Null and empty texts are clean, copies of each other, and near copies of each other,
so one of them goes on; they have no tokens. Of repeated rows one stays. Null ids and
sources are values like any other. Texts are taken whole, however long. Empty documents
give an empty result; without labels the fixed voters decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabtally.llm.bpe import encode_and_decode, tokenizer_path
from cabtally.llm.common import rows_at_once, stored, table
from cabtally.llm.exact_dedup import exact_dedup
from cabtally.llm.mixing import mix
from cabtally.llm.simhash import near_dedup
from cabtally.llm.toxicity import clean_documents

#: Documents that Python gets at once.
ROWS = 1000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. The classifier learns from ``labels`` and docs. The
    result is written here, while Python is given few documents at once: with all their
    columns they go through it."""
    with rows_at_once(spark, ROWS):
        return stored(clean_documents(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")), "pipeline-toxicity")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one document stays."""
    return near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, in shuffled shards."""
    return mix(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang, n_tokens, token_ids, decoded_sha256`` of each row of the mix;
    the last is the digest of the text that the ids are decoded to."""
    encoded = encode_and_decode(docs.select("doc_id", "source", "lang", "text"), tokenizer_path())
    n_tokens = F.size("token_ids").cast("long").alias("n_tokens")
    return encoded.select("doc_id", "source", "lang", n_tokens, "token_ids", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode_texts),
]

#: The stages have no equivalent in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) and stage is not drop_toxic:  # which has written its own
            docs = stored(docs, f"pipeline-{name}")
    return docs
