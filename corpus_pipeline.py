"""From raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns what the next one gets as docs; the result of a
stage is written as a Parquet table and read again. All but the last return the columns of docs.
Stages have no rows for empty tables, and treat nulls, ties and repeated rows as their operators do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from helixframe.llm.common import checkpoint_folder, read
from helixframe.llm.exact_dedup import drop_copies
from helixframe.llm.mixing import mixed_documents
from helixframe.llm.ngram_join import drop_near_copies
from helixframe.llm.packing import pack_documents
from helixframe.llm.quality import good_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, judged against the labels of the folder."""
    return good_documents(docs, read(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar texts, the document with the smallest id."""
    return drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, each as often as it is taken."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", near_dedup),
    ("source_mix", source_mix),
    ("best_fit_packing", packing),
]

#: Neither the quality score nor tokens can be had in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
