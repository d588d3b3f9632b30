"""Registered queries of the cohort operators, and their SQL."""

from .queries import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
