"""Corpus pipeline: five stages over ``documents``, each one of the dealt operators.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that
its predecessor kept and is written as Parquet and read again for the next one.
All but the last return the columns of ``documents``:

1. quality classifier (9): documents with a score below 0.5 go;
2. n-gram Jaccard join (5): one document of each group of near duplicates stays;
3. substring dedup (4): passages of 35 words or more that occur again are cut out;
4. benchmark decontamination (10): documents that contain a test item go;
5. mixing sources to target weights (6): adds size, source_size, target and taken
   (words the mix takes of a document, repeats counted).

Nulls, empty tables, repeated rows and further columns are treated as each
operator's module says.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from responsekit.llm.common import read  # noqa: E402
from responsekit.llm.decontaminate import drop_leaks  # noqa: E402
from responsekit.llm.ngram_jaccard import keep_one_of_each  # noqa: E402
from responsekit.llm.quality_qda import keep_good  # noqa: E402
from responsekit.llm.source_mix import mix  # noqa: E402
from responsekit.llm.substring_dedup import cut_repeats  # noqa: E402
from responsekit.session import materialize  # noqa: E402


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cut_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    new = ["size", "source_size", "target", "taken"]  # these take the place of columns of the same names
    return mix(docs).select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in new], *new)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: The classifier's scores are not expressible in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each one keeps is written to the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
