"""All registered queries."""

from __future__ import annotations

from . import derived_checks, file_checks, table_checks  # noqa: F401  (importing registers the queries)


def queries() -> dict[str, table_checks.Query]:
    return dict(table_checks.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(table_checks.ORACLE)
