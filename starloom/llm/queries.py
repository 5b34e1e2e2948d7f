"""One query per operator, over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import conversations, fingerprints, jaccard, licenses, mixing, pieces, pii, rules, runs, scoring, toxicity, warc, wrappers
from starloom.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(spark: SparkSession) -> str:
    """The SentencePiece model: the setting starloom.sentencepiece.model, or the public 32k model."""
    return spark.conf.get("starloom.sentencepiece.model", None) or public_tokenizers.path("piece_bpe_32k.model")


def _query(function):
    QUERIES[function.__name__] = function
    return function


@_query
def op1_document_fingerprints(spark, folder):
    """Fingerprints of every document and of its edited text, with their likeness."""
    return fingerprints.fingerprint_edits(table(spark, folder, "documents"))


@_query
def op2_personal_data(spark, folder):
    """Personal data in every document: counts and digest of the patterns' spans, and all spans."""
    found = pii.find_personal_data(table(spark, folder, "documents"), ["doc_id"])
    counts = [F.regexp_count("_base", F.lit(rf"\b{kind}:")).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2("_base", 256).alias("base_sha256"), F.col("_spans").alias("spans"))


@_query
def op3_lm_scoring(spark, folder):
    """Every document under the unigram counts and the log-bilinear model of the documents not held out."""
    return scoring.score(table(spark, folder, "documents"))


@_query
def op4_license_scans(spark, folder):
    """Every license notice in every document, with its differences from the template."""
    found = licenses.find_licenses(table(spark, folder, "documents"))
    words = [F.array_join(name, " ").alias(name) for name in ("missing", "added")]
    return found.select("doc_id", "license", "start", "end", "reduction", "agreement", *words, "wording")


@_query
def op5_quality_rules(spark, folder):
    """Counts and verdict of every document; cutoffs from all labels, by language."""
    measured = stage(rules.measure(table(spark, folder, "documents"), ["doc_id", "lang"]), "measures")
    chosen = rules.cutoffs(measured, table(spark, folder, "labels"), "doc_id", "lang")
    shown = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rules.judge(measured, chosen, "lang").select(*shown, F.array_join("rejected_by", ",").alias("rejected_by"))


@_query
def op6_ngram_jaccard_join(spark, folder):
    """Class and number of links of every document: five words, similarity 0.8."""
    return jaccard.similar(table(spark, folder, "documents"))


@_query
def op7_toxicity(spark, folder):
    """Grade and expected severity of every document."""
    return toxicity.grade(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_query
def op8_mixing(spark, folder):
    """Every document's place in a mix of all sources, weighted by the root of their number of documents."""
    docs = table(spark, folder, "documents")
    return mixing.mix(docs, mixing.natural_weights(docs, "source"))


@_query
def op9_warc(spark, folder):
    """Every page written to seekable bundles and read back."""
    return warc.archive(table(spark, folder, "pages")).drop("url", "payload")


@_query
def op10_sentencepiece(spark, folder):
    """Pieces of every document and the text decoded from them, as digests."""
    return pieces.encoding_digests(table(spark, folder, "documents"), tokenizer_path(spark))


@_query
def op11_periodic_runs(spark, folder):
    """Runs of words that repeat at least four times, in every document, a tenth of them with a periodic tail."""
    return runs.run_digests(table(spark, folder, "documents"), rewrite=runs.repeat_tail)


@_query
def op12_html_extraction(spark, folder):
    """The main text of every page, by the templates of all pages of its host."""
    return wrappers.extract(table(spark, folder, "pages"))


@_query
def op13_conversation_repair(spark, folder):
    """Faults of every damaged conversation, the cheapest edits that repair it, and a digest of the repaired one."""
    return conversations.audit(conversations.damage(table(spark, folder, "conversations")))


ORACLES["op9_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first_id FROM p)
SELECT page_id, CASE WHEN n >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id > first_id THEN first_id END AS refers_to, d AS payload_digest, CAST(n AS BIGINT) AS payload_bytes
FROM f
"""
