"""Scalar helpers that keep the model's NULL semantics on Spark.

All helpers return built-in Column expressions (JVM side, code-generated).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def extract_or_null(c: Column, pattern: str, group: int, holds: str | None = None) -> Column:
    """``regexp_extract`` that gives NULL when there is no match.

    Spark gives '' on no match; the model needs NULL so that COALESCE
    fallbacks fire and blank ids never join each other. Every captured group
    used by the model is non-empty on a match. The first of all matches is NULL
    without one, in one search (a ``nullif`` of the extract searches twice).
    ``holds`` is a text that every match has: texts without it, most of a bill's,
    are not searched at all.
    """
    found = F.get(F.regexp_extract_all(c, F.lit(pattern), F.lit(group)), F.lit(0))
    return found if holds is None else F.when(c.contains(holds), found)


def least_one(x: Column) -> Column:
    """LEAST(1, x) with NULL in, NULL out (Spark's ``least`` skips NULLs)."""
    return F.when(x < 1, x).when(x >= 1, F.lit(1))


def first_match(rules: list[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """Searched CASE: the first true condition wins."""
    expr = None
    for cond, value in rules:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr if otherwise is None else expr.otherwise(otherwise)


def lookup(c: Column, table: dict[str, str], otherwise: Column | None = None) -> Column:
    """Simple CASE on equality against a fixed table, in the table's order."""
    return first_match([(c == k, F.lit(v)) for k, v in table.items()], otherwise)
