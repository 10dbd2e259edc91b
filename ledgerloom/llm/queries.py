"""Imports every operator module, which registers its query."""

from importlib import import_module

from ledgerloom.llm.common import ORACLE, QUERIES

MODULES = ["toxicity", "suffix_dedup", "sharding", "topk", "token_files", "mixing", "packing", "simhash", "hnsw", "secrets", "bpe", "lexical", "collocations"]

for name in MODULES:
    import_module(f"ledgerloom.llm.{name}")

__all__ = ["ORACLE", "QUERIES"]
