"""Operators for preparing training data at scale, and their registered queries."""

from textmill.llm.registry import QUERIES, SQL


def queries():
    import textmill.llm.entries  # noqa: F401  registers on import

    return dict(QUERIES)


def oracle_sql():
    import textmill.llm.entries  # noqa: F401

    return dict(SQL)
