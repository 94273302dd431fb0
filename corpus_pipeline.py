"""The corpus pipeline: quality rules, toxicity, near duplicates, decontamination, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; all but the last return the columns of
documents. ``run`` writes each stage's rows as Parquet in the shared folder and gives them to the next; what a stage kept
there for itself is freed once its rows are written.

Texts are shuffled only where they have to meet others (candidates of the n-gram join); rows to drop are known by ids or digests, which
are broadcast below a counted bound. Defined results: null and empty texts, and those of fewer than 20 words, fail the quality
rules and go; null ids, languages and sources are values like others; rows that repeat an id or a text are judged each, and one row of each
group of copies stays; extra columns pass all stages but the last; empty tables give empty results; without labels nothing is dropped
as toxic, without items nothing as contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veilframe.llm import decontaminate, ngram_join, packing, quality_rules, toxicity
from veilframe.llm.common import Cut, free, marked, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go."""
    return quality_rules.keep_good(docs)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays."""
    return ngram_join.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in which bin."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("toxicity", harmless), ("near_duplicates", unique), ("decontamination", clean), ("packing", packed)]

#: A trained model and an order-dependent packing are among the stages; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        mark = marked()
        kept = Cut(stage(spark, docs, sf_dir))
        free(mark, keep=(kept,))
        if before is not None:
            before.drop()
        docs, before = kept.df, kept
    return STAGES[-1][1](spark, docs, sf_dir)
