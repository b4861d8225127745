"""Query registry: name → Spark callable, name → DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame over the whole driver
tables; ``ORACLES[name]`` is the same result written as plain SQL over the same
tables (DuckDB dialect).  Both sides alias every computed column identically.
Doubles that come out of an aggregate are rounded the same way on both sides
(sums to 2 places, averages to 6) so the comparison does not depend on
summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def r6(col):
    """Rounding applied to averages on the Spark side (DuckDB: round(x, 6))."""
    return F.round(col, 6)


def r2(col):
    """Rounding applied to sums of 2-decimal amounts (DuckDB: round(x, 2)).

    Large sums differ in the last bits with the summation order; the exact
    sum of 2-decimal values has 2 decimals, so rounding there is lossless.
    """
    return F.round(col, 2)


def xsum(expr: str) -> str:
    """SQL twin of ``functions.exact_sum``: an order-independent sum."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(38,10))) AS DOUBLE)"


def load_all() -> tuple[dict, dict]:
    """Import every query module (each registers itself) and return the maps."""
    from tidemark.plans import catalog, q_audit, q_lineage, q_prepare, q_quality, q_runs, q_sources  # noqa: F401

    return QUERIES, ORACLES
