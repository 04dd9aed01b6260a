"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib

#: Modules that hold QUERIES and ORACLE_SQL.
MODULES = ["packing", "neardup", "secrets", "toxicity", "ann", "counts", "media", "bpe", "suffixes", "sharding", "lexical", "lines", "turns"]


def _merged(name: str) -> dict:
    out: dict = {}
    for module in MODULES:
        out |= getattr(importlib.import_module(f"fwloom.llm.{module}"), name)
    return out


QUERIES = _merged("QUERIES")
ORACLE_SQL = _merged("ORACLE_SQL")
