"""All queries of this subpackage, with their SQL."""

from __future__ import annotations

from rosterlake.llm import entities
from rosterlake.llm import queries as plain

MODULES = (plain, entities)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in MODULES for k, v in m.ORACLE.items()}
