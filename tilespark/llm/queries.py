"""The queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

import importlib

MODULES = ("toxicity", "bpe", "quality", "byte_dedup", "media", "word_dedup", "secret_scan", "jaccard", "fingerprints", "mixing")

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in MODULES:
    _module = importlib.import_module(f"{__package__}.{_name}")
    QUERIES.update(_module.QUERIES)
    SQL.update(_module.SQL)
