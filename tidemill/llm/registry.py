"""Every corpus operator's query and, where SQL can express it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import alignment, co_training, jaccard_join, mixing, packing, quality_rules, runs, substring_dedup, tiff, token_blocks, token_counts, toxicity, warc

MODULES = (warc, co_training, substring_dedup, quality_rules, tiff, toxicity, token_counts, mixing, packing, jaccard_join, runs, token_blocks, alignment)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def sql() -> dict[str, str]:
    return {name: q for m in MODULES for name, q in getattr(m, "SQL", {}).items()}
