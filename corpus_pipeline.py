"""A training corpus from raw documents: five stages, each a table that the next one reads.

Toxic documents go, one of each group of near duplicates stays, documents that hold benchmark
passages go, secrets are replaced, and what is left is encoded. A stage decides by its own input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleforge import session
from candleforge.llm import decontaminate, merge_replay, secret_scan, simhash, toxicity
from candleforge.llm.common import fold, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold; learned without the held-out labels."""
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 3) != 1)
    lexicon = toxicity.learn(docs, labels)
    scored = toxicity.scored(docs, lexicon, "__toxicity")
    return scored.filter(F.col("__toxicity") < toxicity.THRESHOLD).drop("__toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of benchmark passages."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by a mark."""
    return secret_scan.redact(docs, secret_scan.cuts(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the digest of the ids and that of the decoded bytes."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = merge_replay.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("byte-level BPE encoding and decoding", encode),
]

# SQL cannot express the learned, iterative and tokenizing stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again."""
    docs = table(session.prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return docs
