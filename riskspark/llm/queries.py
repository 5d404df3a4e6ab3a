"""The registered queries of the operators, with their SQL where SQL can state them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import ads, blockmax, bpe, bytecnn, centroid, dart, pfor, pii, piecebpe, pivotal, variants, whiten
from riskspark.llm import edits as edits_op
from riskspark.llm.text import held_out, table
from riskspark.session import shared_folder

QUALITY_CUT = 0.3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def quality_net(spark: SparkSession, docs: DataFrame, sf_dir: str) -> bytecnn.Net:
    """Trained on the labelled ones of these documents, without the held-out ids."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return bytecnn.train(docs, labels.filter(~held_out("id")))


@query("op1_adaptive_dimension_scan")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query("op3_block_max_top_k", """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) "rank", vec_id, score
from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5
""")
def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockmax.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query("op5_byte_level_bpe")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    digest = bpe.round_trip_digest(F.col("text"), path)
    return table(spark, sf_dir, "documents").select("doc_id", digest.alias("d")).select("doc_id", "d.*")


@query("op6_token_file")
def token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    pfor.write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return pfor.read_documents(spark, folder)


@query("op2_pivotal_mixture")
def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = pivotal.mix_plan(table(spark, sf_dir, "documents"))
    each = plan.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    return each.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op8_dart_min_hash")
def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart.near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_byte_network_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = docs.select("doc_id", held_out().alias("held_out"), bytecnn.score(F.col("text"), quality_net(spark, docs, sf_dir)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_CUT).cast("int"))


@query("op7_weak_supervision_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [pii.count_of("base", k).alias(f"n_{k}") for k in pii.KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


@query("op4_nearest_centroid_language")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = centroid.predict(F.col("text"), centroid.train(docs.filter(~held_out())))
    scored = docs.select("doc_id", held_out().alias("held_out"), found.alias("f"))
    return scored.select("doc_id", "held_out", F.col("f.lang").alias("lang_pred"), "f.score", "f.rejected")


@query("op9_edit_aware_counts")
def edited_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is counted, then edited: a line before it, ten characters in its middle, words after it."""
    length = F.coalesce(F.length("text"), F.lit(0))
    middle = F.floor(length / 2).cast("int")
    edit = lambda at, end, new: F.struct(at.alias("at"), end.alias("end"), F.lit(new).alias("text"))
    edits = F.array(edit(middle, middle + 10, "12 more'll"), edit(F.lit(0), F.lit(0), "Edited\n"), edit(length + 17, length + 17, " the end."))
    counts = edits_op.counts(F.col("text"), edits, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return table(spark, sf_dir, "documents").select("doc_id", counts.alias("c")).select("doc_id", "c.*")


@query("op11_polarisation_whitening")
def whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whitened(table(spark, sf_dir, "embeddings"))


@query("op12_sentencepiece_prefix_table")
def sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = piecebpe.round_trip_digest(F.col("text"), public_tokenizers.path("piece_bpe_32k.model"))
    return table(spark, sf_dir, "documents").select("doc_id", digest.alias("d")).select("doc_id", "d.*")


@query("op13_variable_gram_variants")
def spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))
