"""A training corpus from raw documents: one operator after another, each on what the one before it kept."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from relaylog.llm import ngram_join, quality_classifier, queries, secret_scan  # noqa: E402
from relaylog.llm import quality_rules as rules  # noqa: E402
from relaylog.llm.common import documents, prepared  # noqa: E402
from relaylog.session import shared_dir  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are depleted go; lines above the limits go from the others."""
    prepared(spark)
    return rules.clean(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below the threshold go. Trained on the labelled documents that are left."""
    prepared(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality_classifier.accepted(docs, quality_classifier.train(docs, labels), queries.ACCEPTED)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    prepared(spark)
    return ngram_join.keep_first(docs)


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark that tells live-looking ones from widely copied examples."""
    prepared(spark)
    return secret_scan.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return queries.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier_stage),
    ("n-gram Jaccard join", ngram_join_stage),
    ("secret scans", secret_scan_stage),
    ("best-fit packing", best_fit_packing),
]

#: Token ids and trained classifiers are not SQL; the tests hold run() against a plain version of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's rows written and read again before the next."""
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = shared_dir(spark, "stage")
            result.write.parquet(path)
            result = spark.read.parquet(path)
        docs = result
    return docs
