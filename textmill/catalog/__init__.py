"""Registered queries over the given tables, each with its SQL twin where one exists."""

from textmill.catalog import cleaning, corpora, live, mixing, rendering, runs, tokens, training
from textmill.catalog.base import QUERIES, SQL


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
