"""A training-data pipeline over ``documents``: five stages, each on all that the one before kept.

Language ID, near-dedup, benchmark decontamination, redaction of secrets, SentencePiece encoding.
Stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import decontaminate, language_id, secret_scan, simhash_dedup
from winnow.llm.common import fold, forget, store, table, unused, written
from winnow.llm.queries import spelled

# A language is rejected only where the calibrated model has no preference to speak of.
MIN_LANGUAGE_SCORE = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter or without a likely language; fills in missing languages."""
    model = language_id.fit(docs, fold("doc_id", 4) != 2)
    if not model.languages:  # nothing to learn from: only texts without a letter go
        return docs.filter(F.regexp_like("text", F.lit(r"\p{L}")))
    out = unused("_lang", docs.columns), unused("_score", docs.columns)
    found = language_id.identify(docs, model, keep=docs.columns, out=out)
    lang, score = map(F.col, out)
    kept = found.filter((lang != language_id.UNDETERMINED) & (score >= MIN_LANGUAGE_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", lang)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of every group of near copies."""
    return simhash_dedup.drop_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    out = unused("_leaks", docs.columns)
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), out=out)
    return found.filter(F.size(out) == 0).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts and recounts the characters of those texts."""
    redacted = secret_scan.redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return redacted
    kind = docs.schema["n_chars"].dataType
    changed = F.contains("text", F.lit("[secret]"))
    return redacted.withColumn(
        "n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document that is left, with a digest of the text decoded from them."""
    return spelled(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("secret_scan", redact_secrets),
    ("sentencepiece", encode_pieces),
]

# Hashes, a fitted model and merges by rank have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each but the last is stored and read again.

    What a stage stored on its way, and what it read, goes once its result is stored.
    """
    docs, read = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with written() as made:
            docs = store(stage(spark, docs, sf_dir), name)
        forget(spark, *read, *(path for path in made if path != docs.stored_at))
        read = [docs.stored_at]
    return STAGES[-1][1](spark, docs, sf_dir)
