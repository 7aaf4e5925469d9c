"""A training corpus from raw documents: five stages, each written and reread.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from urbanlens.llm import factorisation, line_dedup, mixing, partenum, suffix_automaton
from urbanlens.llm.common import cut, prepare, table
from urbanlens.llm.queries import quality_machine


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score below its threshold) go."""
    prepare(spark)
    return factorisation.keep_good(docs, quality_machine(spark, docs, sf_dir))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, except where they stand first; every document stays."""
    prepare(spark)
    return line_dedup.dedup_lines_in_place(docs)


def similar_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar five-word shingle sets (0.8 or more) the one with the smallest id stays."""
    prepare(spark)
    return partenum.keep_first(docs, size=5, part=80, of=100)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; all others stay as they are."""
    prepare(spark)
    return suffix_automaton.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn by the temperature mix: doc_id, source, n_tokens, epoch, block_rank, draw."""
    prepare(spark)
    return mixing.mix(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("jaccard", similar_stage),
    ("decontamination", benchmark_stage),
    ("mixing", mixing_stage),
]

#: The classifier is not expressible in SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
