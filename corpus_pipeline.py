"""A training corpus from `documents`: language, toxicity, near-duplicates, mix, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept,
and returns a table that is written and read again as the next one's documents.
All but the last return the columns of `documents`. A stage given an empty table
returns an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import letter_profiles, pareto_mix, simhash_trie, tier_packing, toxicity_models
from llm.common import Scratch, fresh, in_fold, table

# A text of many trigrams whose cosine with every language is lower is in none of them. Of n
# trigrams a text of a known language has about sqrt(n / (n + HALF_WAY)) of a long one's cosine,
# and chance adds or takes about ALLOWANCE twice.
LEAST_COSINE = 0.165
HALF_WAY = 150
ALLOWANCE = 0.015


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages.

    Texts that are NULL or have no letters go, and those that resemble no
    language as much as texts of so many trigrams do. Of a few letters that
    asks for next to nothing.
    """
    learned = letter_profiles.prototypes(docs.where(~in_fold("doc_id", 4, 2)))
    names = [fresh(docs, n) for n in ("lang_pred", "score", "trigrams")]
    found = letter_profiles.with_language(docs, learned, names)
    n = F.col(names[2])
    least = LEAST_COSINE * F.sqrt(n / (n + HALF_WAY)) - ALLOWANCE
    known = F.col(names[0]) != letter_profiles.UNKNOWN
    return found.where(known & (F.col(names[1]) >= least)).select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic, after learning from the labels of those given."""
    fit = toxicity_models.fitted(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "toxic_score")
    found = toxicity_models.with_score(docs, fit, score)
    return found.where(F.col(score) < toxicity_models.THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of least doc_id, of each group that fingerprints link.

    The groups are those of op10: three-word shingles, three bits. This misses
    most near copies below a similarity of 0.95; the README has the figures.
    """
    return simhash_trie.one_per_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return pareto_mix.mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in training sequences; a repeated document is packed each time."""
    return tier_packing.packed(docs)


STAGES = [
    ("language", language),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("packing", packing),
]

# Python decides in every stage; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = stage(spark, docs, sf_dir)
        docs = done if name == STAGES[-1][0] else scratch.save(done)
    return docs
