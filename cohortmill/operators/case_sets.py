"""Stored selections of cases: written as a table with its facts, read back with a check of version and invariants, applied to rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .selection import restrict, selection_balance, selection_checks, shared_selection

VERSION = 1
ORDERING = "project_id, submitter_id, case_id"


def write_case_set(selections: dict[str, DataFrame], n: int, path: str, *, name: str, filters: dict[str, dict] | None = None) -> DataFrame:
    """Selects the first ``n`` shared cases per project and writes cases, balance and facts below ``path``; returns the checks.

    ``filters`` are the resolved filters by selection. A selection that breaks an invariant is not written.
    """
    if n <= 0 or not selections:
        raise ValueError("a case set needs selections and a positive number of cases per project")
    cases, balance = shared_selection(selections, n), selection_balance(selections, n)
    filters = filters or {k: {} for k in selections}
    checks = selection_checks(cases, balance, n, names=list(selections), filters=list(filters), ordering=ORDERING)
    _require(checks)
    spark = cases.sparkSession
    facts = spark.range(1).select(
        F.lit(VERSION).alias("version"), F.lit(name).alias("name"), F.lit(n).alias("requested"), F.lit(ORDERING).alias("ordering"), F.current_timestamp().alias("created_at"),
        F.array(*map(F.lit, selections)).alias("selections"), F.lit(json.dumps(filters, sort_keys=True)).alias("filters"),
    )
    for table, df in (("cases", cases), ("balance", balance), ("facts", facts)):
        df.write.mode("errorifexists").parquet(f"{path}/{table}")
    return checks


def load_case_set(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cases, balance, facts) of a stored set; another version or a broken invariant raises ``ValueError``."""
    cases, balance, facts = (spark.read.parquet(f"{path}/{t}") for t in ("cases", "balance", "facts"))
    known = facts.first()
    if known is None or known["version"] != VERSION:
        raise ValueError(f"case set {path} has version {known and known['version']!r}, expected {VERSION}")
    _require(selection_checks(cases, balance, known["requested"], names=list(known["selections"]), filters=list(json.loads(known["filters"])), ordering=known["ordering"]))
    return cases.orderBy("project_id", "submitter_id", "case_id"), balance, facts


def apply_case_set(rows: DataFrame, cases: DataFrame, key: str = "case_id") -> DataFrame:
    """The rows of the stored cases."""
    return restrict(rows, cases, key)


def _require(checks: DataFrame) -> None:
    broken = [k for k, held in checks.first().asDict().items() if not held]
    if broken:
        raise ValueError(f"case set breaks: {broken}")
