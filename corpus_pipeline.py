"""The corpus pipeline: stages over `documents`, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from laserfold.llm import (
    jaccard_join,
    mixing,
    packing,
    quality_gam,
    quality_rules,
    tokens,
)
from laserfold.llm.common import read_back
from laserfold.llm.queries import MIXTURE_WEIGHTS, mixture_levels

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model takes for good."""
    return quality_gam.keep(docs, quality_gam.train(docs, _labels(spark, sf_dir)))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    trusted = _labels(spark, sf_dir).where("quality = 1").select("doc_id")
    return quality_rules.keep(docs, trusted)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.deduplicate(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, and those of scarce sources up to twice, by the target weights."""
    chosen = mixing.select(
        docs,
        mixture_levels(),
        path=tokens.default_path(),
        share=None,
        weights=MIXTURE_WEIGHTS,
        max_epochs=2,
    )
    return chosen.drop("epoch")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    return packing.pack(docs, tokens.default_path(), with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("jaccard_dedup", deduplicate),
    ("mixing", mix),
    ("packing", pack),
]

# The stages learn, iterate or encode, which SQL cannot express; tests hold the rows
# against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what a stage keeps is written and is the next stage's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = read_back(docs, name)
    return docs
