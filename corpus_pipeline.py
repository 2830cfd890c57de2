"""From raw documents to packed training sequences, stage by stage.

Every stage works on all rows that the one before it kept, written as Parquet
and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matchwright.llm.batches import table
from matchwright.llm.near_join import near_components
from matchwright.llm.packing import pack_documents
from matchwright.llm.quality_classifier import keep_good
from matchwright.llm.quality_rules import keep_by_rules, labelled_good
from matchwright.llm.substrings import without_repeats
from matchwright.sources.staging import stage_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_by_rules(docs, labelled_good(table(spark, sf_dir, "labels")))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays.

    Near copies share 80 in 100 of their five-word shingles. Documents without
    an id, words or text are no one's copies and stay; copies of an id go or
    stay together; an empty table stays empty, extra columns stay.
    """
    found = near_components(docs, words=5, percent=80)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the passages that a document with a smaller id holds."""
    return without_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, ids included."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("packing", packing),
]

#: Hashed scores, weak labels and the curve are not to be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
