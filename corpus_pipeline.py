"""Corpus pipeline over `documents`; each stage calls one operator of millrace.llm.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the last
return the columns of `documents`, the last returns the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, lines, packing, quality, simhash
from millrace.llm.queries import TOKENIZER, learned_rules, table
from millrace.session import store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    judged = quality.apply_rules(docs.withColumn("_row", F.struct("*")), learned_rules(spark, docs, sf_dir))
    return judged.where("kept").select("_row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go; every document stays."""
    found = lines.remove_spread_lines(docs)
    row = F.col("doc").withField("text", F.col("text")).withField("n_chars", F.char_length("text").cast("long"))
    return found.select(row.alias("doc")).select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", pack_windows),
]
#: Learned rules, similarity and retrieval are beyond SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
