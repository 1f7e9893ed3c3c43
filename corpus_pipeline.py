"""From raw documents to packed training sequences.

Quality rules drop documents, the Jaccard join (five-word shingles, similarity 0.8) keeps the one with the least doc_id of
each group of near duplicates, substring dedup cuts passages that repeat, mixing puts what is left in the order of the
sources' target weights, and best-fit packing tokenises and places it. Each stage's rows are written as Parquet and read
again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import jaccard_join, mixing, packing, quality_rules, substring_dedup
from tidemill.llm.shared import documents, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules.stage),
    ("ngram_jaccard_join", jaccard_join.stage),
    ("substring_dedup", substring_dedup.stage),
    ("mix_sources", mixing.stage),
    ("best_fit_packing", packing.stage),
]
#: Fitted cutoffs, a tokenizer and best fit are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of sf_dir."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
