"""A training corpus from ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``. ``run`` writes every stage as Parquet
into the session's shared folder and reads it again for the next one, so no
stage recomputes an earlier one and a lost executor costs its own tasks only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cabgrid.llm import op1_mix, op5_near_dedup, op6_bpe, op9_lines, op10_language
from cabgrid.llm.common import table
from cabgrid.session import shared_path

#: Near-duplicate stages on word shingles take five words (similarity 0.8).
SHINGLE_WORDS = 5

#: Languages the corpus accepts (None: each that a row of ``docs`` is labelled
#: with), and the least score of a document (0.5: a tie of the two best).
LANGUAGES: list[str] | None = None
LEAST_SCORE = op10_language.LEAST_SCORE


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: fitted on the labelled rows of ``docs``. Documents it
    rejects go: those without a letter, in a language that is not one of
    LANGUAGES, or with a score below LEAST_SCORE; a null lang is filled."""
    return op10_language.keep_identified(docs, op10_language.fit(docs), LANGUAGES, LEAST_SCORE)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: lines of ten characters and more stay in one document."""
    return op9_lines.without_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: the smallest doc_id of each group of near-duplicates stays."""
    return op5_near_dedup.keep_one(docs, SHINGLE_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: each document as often as the target weights take it."""
    return op1_mix.emit_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: doc_id, n_tokens, ids, ids_sha256, decoded_sha256 of each copy."""
    return op6_bpe.encoded_corpus(docs)


STAGES = [
    ("language", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mix", mix_sources),
    ("encode", encode),
]

#: Language scores and BPE merges have no SQL form; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    base = shared_path(spark, f"corpus-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
