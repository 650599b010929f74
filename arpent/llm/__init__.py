"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

from __future__ import annotations

from importlib import import_module

#: Each module has QUERIES and ORACLES.
MODULES = ["sharding", "secrets", "bpe", "packing", "jaccard", "permutation_index", "exact_topk", "warc", "substring_dedup", "toxicity", "hard_negatives", "alignment", "quality"]


def queries() -> dict:
    return {k: v for m in MODULES for k, v in import_module(f"arpent.llm.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in import_module(f"arpent.llm.{m}").ORACLES.items()}
