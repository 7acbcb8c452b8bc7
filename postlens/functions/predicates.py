"""Filters and predicates P1-P10 (plain Column expressions; Catalyst pushes them into the Parquet scan)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.scalars import col_of, haystack, midpoint, regex_quote

__all__ = [
    "with_salary", "between", "exclude", "any_of", "is_true", "is_not_true", "search", "contains_any",
    "since", "having_min", "has_text", "drop_null",
]


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All listed columns non-NULL."""
    return df.dropna(subset=list(cols))


def with_salary(df: DataFrame, lo: str = "salary_min", hi: str = "salary_max") -> DataFrame:
    """P1 for the salary pair."""
    return df.where(F.col(lo).isNotNull() & F.col(hi).isNotNull())


def between(c: str | Column, lo: float, hi: float) -> Column:
    """Inclusive range."""
    return col_of(c).between(lo, hi)


def exclude(c: str | Column, value: str) -> Column:
    """Not-equal (NULL never passes; the reference column is NOT NULL)."""
    return col_of(c) != F.lit(value)


def any_of(c: str | Column, values: Iterable) -> Column:
    """Membership."""
    return col_of(c).isin(list(values))


def is_true(c: str | Column) -> Column:
    """P5: tri-state == True (NULL is not true)."""
    return col_of(c).eqNullSafe(F.lit(True))


def is_not_true(c: str | Column) -> Column:
    """P5: tri-state != True (NULL and False)."""
    return ~col_of(c).eqNullSafe(F.lit(True))


def search(df: DataFrame, needle: str | None, cols: Sequence[str] = ("title", "company", "location")) -> DataFrame:
    """Literal, case-insensitive substring over the haystack; blank needle keeps every row."""
    n = (needle or "").strip().lower()
    if not n:
        return df
    return df.where(haystack(*cols).contains(F.lit(n)))


def contains_any(c: str | Column, needles: Sequence[str]) -> Column:
    """Case-insensitive any-of contains; NULL -> no match."""
    alt = "|".join(regex_quote(x) for x in needles)
    return F.coalesce(col_of(c).rlike(f"(?iu)(?:{alt})"), F.lit(False))


def since(ts: str | Column, as_of: str, hours: int) -> Column:
    """Ts >= as_of - hours; ``as_of`` is an explicit parameter (deterministic re-runs)."""
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.make_interval(hours=F.lit(hours))
    return col_of(ts) >= cutoff


def having_min(df: DataFrame, count_col: str, n: int) -> DataFrame:
    """Post-aggregate minimum count."""
    return df.where(F.col(count_col) >= n)


def has_text(c: str | Column) -> Column:
    """P10: neither NULL nor ''."""
    return F.coalesce(F.length(col_of(c)), F.lit(0)) > 0


def salary_mid(lo: str = "salary_min", hi: str = "salary_max") -> Column:
    return midpoint(lo, hi)
