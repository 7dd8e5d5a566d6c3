"""The operators' queries, with production parameters over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import (
    context_trees,
    hilbert_shards,
    importance_sample,
    itq_dedup,
    letter_profiles,
    pareto_mix,
    simhash_trie,
    subvector_clusters,
    tier_packing,
    token_transducer,
    toxicity_models,
    weighted_minhash,
    wrapper_induction,
)
from llm.common import Scratch, in_fold, numbered, table
from llm.oracles import IMPORTANCE, subvector_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op10_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = numbered(table(spark, sf_dir, "documents").select("doc_id", "text"), "row")
    found = simhash_trie.near_duplicates(docs)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op8_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = numbered(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "row")
    found = pareto_mix.sampled(docs, Scratch(spark, "mix"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return found.select("doc_id", "size", "source_size", "target", taken)


@query
def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hilbert_shards.sharded(table(spark, sf_dir, "documents"))
    return found.select(
        *["doc_id", "size", "text_crc32"],
        F.lit("rows").alias("law"),
        *["shard", "slot"],
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tier_packing.packed(table(spark, sf_dir, "documents"))


@query
def op5_token_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_transducer.counted(table(spark, sf_dir, "documents"))
    over = F.col("n_tokens") > 512
    return found.select("doc_id", "n_bytes", "n_tokens", over.alias("over_limit"))


@query
def op9_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_minhash.fingerprinted(table(spark, sf_dir, "documents"))


@query
def op2_letter_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold("doc_id", 4, 2)
    learned = letter_profiles.prototypes(docs.where(~held_out))
    docs = docs.select("doc_id", "text", held_out.alias("held_out"))
    return letter_profiles.with_language(docs, learned, ("lang_pred", "score")).drop("text")


@query
def op6_context_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "text", in_fold("doc_id", 5, 1).alias("held_out"))
    return context_trees.scored(docs, "held_out")


@query
def op7_toxicity_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fit = toxicity_models.fitted(docs, table(spark, sf_dir, "labels"))
    docs = docs.select("doc_id", "text", in_fold("doc_id", 4, 2).alias("held_out"))
    scored = toxicity_models.with_score(docs, fit, "score").drop("text")
    predicted = (F.col("score") >= toxicity_models.THRESHOLD).cast("int")
    return scored.withColumn("predicted", predicted)


@query
def op1_itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op11_subvector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subvector_clusters.clustered(table(spark, sf_dir, "embeddings"))


@query
def op12_importance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = numbered(table(spark, sf_dir, "documents").select("doc_id", "text"), "row")
    return importance_sample.ranked(docs, table(spark, sf_dir, "benchmark")).drop("row")


@query
def op13_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrapper_induction.extracted(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


ORACLES["op11_subvector_clusters"] = subvector_sql(k=40, rounds=5)
ORACLES["op12_importance_sample"] = IMPORTANCE
