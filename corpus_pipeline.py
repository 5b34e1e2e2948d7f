"""From raw documents to mixed training tokens.

Stages, each over all that the one before kept: quality rules drop documents;
of near duplicates one stays; personal data is replaced; sources are put into
the order of a weighted mix, each document with its position in it; the texts are
encoded, and every row of tokens keeps its source and position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import jaccard, mixing, pieces, pii, rules
from starloom.llm.queries import table, tokenizer_path
from starloom.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and the cutoffs proven on all labels, by language."""
    return rules.filter_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts linked by five-word similarity of 0.8 or more."""
    return jaccard.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their position in the mix and in its order, sources weighted by the root of their number of documents."""
    return mixing.in_mixed_order(docs, mixing.natural_weights(docs, "source"))


def sentencepiece_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with its source and its position in the mix."""
    return pieces.training_tokens(docs, tokenizer_path(spark), kept=("source", "mix_position"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("sentencepiece_tokens", sentencepiece_tokens),
]

# Learned cutoffs, n-gram sets, a trained tagger and piece merging cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage before it is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
