"""Corpus pipeline: documents through five text operators, stage by stage.

Each stage gets all rows that the one before left, and its decisions take
effect: rejected documents and near copies go, repeated passages are cut out
of the texts, and what is left is packed into sequences. All stages but the
last return the columns of documents, extra ones included. Null texts count
as empty, and so are rejected by the first stage; what each operator does with
nulls, ties and repeated rows stands in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from proclivity.llm import (
    chosen_path,
    fertility,
    packing,
    substring_dedup,
    toxicity,
)
from proclivity.llm.common import scratch, table
from proclivity.llm.queries import PACKED_BY, VOCABULARIES


def quality_rules(
    spark: SparkSession, docs: DataFrame, sf_dir: str
) -> DataFrame:
    """Documents that the fertility rules keep."""
    return fertility.accepted(docs, *VOCABULARIES)


def toxicity_filter(
    spark: SparkSession, docs: DataFrame, sf_dir: str
) -> DataFrame:
    """Documents that aren't predicted toxic; learned from the labels."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(
    spark: SparkSession, docs: DataFrame, sf_dir: str
) -> DataFrame:
    """One document of each class of copies and near copies."""
    return chosen_path.deduplicated(docs)


def repeated_passages(
    spark: SparkSession, docs: DataFrame, sf_dir: str
) -> DataFrame:
    """All documents, without the passages that occur elsewhere."""
    return substring_dedup.without_repeats(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into sequences."""
    return packing.pack(packing.pieces_of(docs, PACKED_BY))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", sequences),
]

#: Tokenisers, learned scores and sampled trees have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order, each on the written result of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
