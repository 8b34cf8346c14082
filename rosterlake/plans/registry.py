"""All queries outside the subpackage for language-model data, with their SQL."""

from __future__ import annotations

from rosterlake.plans import directory, q_functions, q_relational, q_sources, q_state

MODULES = (directory, q_functions, q_relational, q_state, q_sources)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in MODULES for k, v in m.ORACLE.items()}
