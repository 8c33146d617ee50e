"""All registered queries (importing the modules registers them)."""

from __future__ import annotations

from duebook.workload import cleaning, delivery, histories, invariants, layouts, loans, quality  # noqa: F401
from duebook.workload.registry import QUERIES, runnable


def queries() -> dict:
    return {name: runnable(name) for name in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {name: entry.oracle for name, entry in QUERIES.items() if entry.oracle}
