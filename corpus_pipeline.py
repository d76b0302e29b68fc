"""From raw documents to token ids in stages, each a call of one corpus operator, written as Parquet in between.

Every stage takes the documents its predecessor kept and returns the columns of documents (the last one token ids). A
null text counts as empty; columns that documents do not have are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripecast.llm import bpe, jaccard_join, mixing, pii, quality_rules
from ripecast.llm.common import read, store

TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the training policy go."""
    return quality_rules.filter_documents(docs, quality_rules.STRICT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest doc_id stays."""
    return jaccard_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the words that give it away are blanked; n_chars follows the new text."""
    clean = pii.sanitise(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, not at all where it takes none."""
    mixed = mixing.mix(docs)
    return mixing.take(mixed, docs.columns, mixing.mixed_names(docs.columns)["epochs"])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and the hash of what the ids decode to."""
    decoded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), TOKENIZER, public_tokenizers.PATTERN)
    count = (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens")
    return decoded.select("doc_id", "lang", "source", count, "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", rules),
    ("jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("mixing", mix),
    ("bpe", tokens),
]

# The last stage, the encoder, has no SQL twin; tests hold the whole pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = store(docs, f"stage-{name}")
    return docs
