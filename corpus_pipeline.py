"""Cleaning pipeline over ``documents``: five stages, each written as Parquet and read again.

All stages take an empty table and columns beside those of ``documents``; all but the last return the columns they are given."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import mixing, simhash, substrings, toxicity, winnowing
from wakeline.sources.scratch import mark, materialise, release

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more for toxicity go. Null and empty texts stay; without usable labels the fixed lexicon judges;
    repeated rows are judged alike."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.score(F.col("text"), model) < 0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest id, rows without id last. Null and wordless texts are one group;
    repeated ids with different texts are different documents."""
    return simhash.one_of_each(docs, "doc_id", "text", size=4, budget=4)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated 35-word windows go. Null texts stay null, all rows stay, repeated rows lose what they share."""
    return substrings.remove_repeats(docs, "text", 35)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover a twentieth or more go. Null and wordless texts stay; with an empty benchmark all do;
    items without text have no windows."""
    return winnowing.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=13)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document that is left is taken: sources weigh 1, 2, 3, repeating. Null sources are the last source, null texts
    have size 0, repeated rows and null ids are documents of their own."""
    return mixing.mix(docs, weights=(1, 2, 3), most=3)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

#: The stages hash, learn and draw in ways that SQL cannot repeat; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    since = mark()
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
        # What the stage stored on its way, and the table that it read, is not needed any more.
        release(spark, since, keep_last=True)
    return STAGES[-1][1](spark, docs, sf_dir)
