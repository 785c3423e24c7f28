"""The corpus pipeline: language ID, line dedup, near-duplicate removal, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.llm.language import fit, keep_identified
from evidentia.llm.lines import dedup_lines
from evidentia.llm.minhash import keep_first
from evidentia.llm.packing import pack
from evidentia.llm.queries import tokenizer_path
from evidentia.session import stored

#: Characters that a worker packs at once; fewer than by default, as the workers have come from the other stages.
PACKED_TOGETHER = 500_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose predicted language holds less than half of their letters, as do null texts and those without a letter.

    The model is fitted on `docs` itself; extra columns, repeated rows and null keys pass through unchanged, an
    empty table gives an empty one.
    """
    return keep_identified(docs, fit(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text loses the lines that another place keeps; n_chars, where there is one, follows the text.

    Every row stays, with an empty text at worst; null texts stay null, and of repeated rows the first keeps its lines.
    """
    kept = dedup_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest doc_id; empty and null texts are one group.

    Rows with a null doc_id stay; rows that repeat the smallest doc_id stay with it.
    """
    return keep_first(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of token sequences; an empty text is its end id alone."""
    return pack(docs, tokenizer_path(), together=PACKED_TOGETHER)


STAGES = [
    ("language", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack_documents),
]

#: SimHash, signatures and the tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents`; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
