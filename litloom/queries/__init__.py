"""Registered queries and the SQL they are held against."""

from __future__ import annotations

import importlib

from litloom.queries.registry import QUERIES, SQL

MODULES = (
    "texts", "searching", "relations", "reports", "vectors", "mining", "ingest", "enriching", "affiliations", "abbreviations", "hyponyms", "taxonomies", "languages", "evaluation", "phrases", "sources", "models",
)

for _name in MODULES:
    importlib.import_module(f"litloom.queries.{_name}")

__all__ = ["QUERIES", "SQL"]
