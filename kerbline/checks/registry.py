"""All registered queries with the SQL that checks them."""

from __future__ import annotations

from kerbline.checks import cleaning_checks, history_checks, model_checks, report_checks

FAMILIES = [cleaning_checks, history_checks, report_checks, model_checks]


def queries() -> dict:
    return {name: query for family in FAMILIES for name, query in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for family in FAMILIES for name, text in family.SQL.items()}
