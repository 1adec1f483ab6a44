"""Queries over the driver's tables, by name, with the SQL each must agree with."""

from __future__ import annotations

from . import catalogue, claims, folders, inventory, ledgers, text, validation  # noqa: F401

FLAGSHIP = "timeline_latest"

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _part in (catalogue, inventory, text, claims, validation):
    QUERIES |= _part.QUERIES
    ORACLE_SQL |= _part.ORACLE_SQL
