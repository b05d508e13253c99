"""All registered queries of the table engine and their SQL."""

from __future__ import annotations

import importlib

FAMILIES = ("page_queries", "table_queries", "review_queries", "doi_queries", "layout_queries", "assembly_queries", "whole_queries", "export_queries")

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in FAMILIES:
    _m = importlib.import_module(f"{__package__}.{_name}")
    QUERIES |= _m.QUERIES
    SQL |= _m.SQL
