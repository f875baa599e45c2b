"""A corpus pipeline of five stages over ``documents``: language, lines, near-duplicates, mix, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import byte_bpe, language_id, line_dedup, mixing, simhash
from millrace.llm.queries import RANKS
from millrace.llm.scratch import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with enough margin; columns as they came.

    Texts that are null or have no letter go, and texts that two languages shorten alike (a tie, or a lead under 1 %).
    Repeated rows stay or go together; nulls in other columns change nothing; an empty table gives an empty one.
    """
    return language_id.known(docs, language_id.learn(docs))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the lines that many share taken out of all but one; n_chars follows the text.

    Every row stays: a null text stays null, a text of which all lines go is empty. Rows without an id lose lines that a
    row with one holds. Repeated rows get equal texts; an empty table gives an empty one.
    """
    kept = line_dedup.drop_repeated_lines(docs)
    text = F.col(kept.columns[-3])
    new = {"text": F.when(F.col("text").isNotNull(), text), "n_chars": F.length(F.col("text"))}
    out = kept.withColumn("text", new["text"])
    return (out.withColumn("n_chars", new["n_chars"].cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingle sets of similarity 0.8 or more), that of the smallest doc_id.

    Texts without words (null ones too) are one group. Rows without an id stay; of rows that repeat id and text one
    stays. An empty table gives an empty one.
    """
    return simhash.keep_one(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Texts without words take part in no mix and go; a null source is a source; rows that repeat id and text are taken
    alike. An empty table gives an empty one.
    """
    return mixing.mixed_rows(docs).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document: ids, and the text decoded from them.

    Null texts count as empty; repeated rows get equal rows; an empty table gives an empty one.
    """
    return byte_bpe.digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN).drop("decoded_chars")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: The stages fit dictionaries and compress texts, which SQL cannot express; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each reading what the one before has written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
