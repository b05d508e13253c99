"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib

MODULES = ("toxicity", "sharding", "tokens", "packing", "pii", "minhash", "mixing", "html_text", "itq", "hilbert")

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in MODULES:
    _m = importlib.import_module(f"{__package__}.{_name}")
    QUERIES |= _m.QUERIES
    SQL |= _m.SQL
