"""From raw documents to token ids: quality, near-duplicates, personal data, mixture, encoding.

Each stage takes the session, the documents its predecessor kept, and the folder of the other tables, and returns
the documents it keeps (the last: their ids). `run` writes every stage's result to the shared folder and reads it
back, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import bpe, bytecnn, dart, pii, pivotal
from riskspark.llm.queries import QUALITY_CUT, quality_net
from riskspark.llm.text import table
from riskspark.session import materialise

#: SQL has no convolutional network, sketches or byte-pair merges; tests compare with plain versions instead.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below QUALITY_CUT go. The network learns from the labelled ones not held out."""
    return docs.filter(bytecnn.score(F.col("text"), quality_net(spark, docs, sf_dir)) >= QUALITY_CUT)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of texts one document stays, that with the least id; see `dart.distinct_documents`."""
    return dart.distinct_documents(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal spans become their kind in brackets."""
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it."""
    return pivotal.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and ids of every document."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode_documents(docs, path).withColumn("n_tokens", F.size("ids").cast("long"))
    return encoded.select("doc_id", "source", "n_tokens", "ids")


STAGES = [
    ("quality classifier", keep_quality),
    ("near-duplicates", drop_near_copies),
    ("personal data", mask_personal_data),
    ("mixture", mix_sources),
    ("encoding", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
