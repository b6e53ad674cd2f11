"""Forgiving text-to-value casts as SQL expressions: bad text becomes NULL.

Expressions are SQL text rather than Column objects: the plan is the same, and
the driver parses one string instead of building a tree call by call.
"""

from __future__ import annotations

# What a calendar date looks like at the start of a text.
_DATE_PREFIX = r"^\\s*\\d{4}-\\d{1,2}-\\d{1,2}"
_DATE_ONLY = _DATE_PREFIX + r"\\s*$"


def instant(text: str) -> str:
    """Text with an optional offset to a UTC instant.

    Spark also reads a bare year or a bare time of day as a timestamp; the
    sources never mean that, so the text has to start with a calendar date.
    """
    return f"CASE WHEN {text} RLIKE '{_DATE_PREFIX}' THEN TRY_CAST({text} AS TIMESTAMP) END"


def calendar_date(text: str) -> str:
    """Date text, or the date part of a valid timestamp text."""
    return (
        f"CASE WHEN {text} RLIKE '{_DATE_ONLY}' THEN TRY_CAST({text} AS DATE) "
        f"WHEN {text} RLIKE '{_DATE_PREFIX}' THEN CAST(TRY_CAST({text} AS TIMESTAMP_NTZ) AS DATE) END"
    )


def money(text: str, precision: int = 14, scale: int = 2) -> str:
    """Fixed-point money; rounds half up, out of range is NULL."""
    return f"TRY_CAST({text} AS DECIMAL({precision},{scale}))"


def whole_number(text: str, kind: str = "BIGINT") -> str:
    """Integer text; fractions and exponents round half up instead of failing.

    Plain digits take the cheap cast; only what it refuses is read as a decimal.
    """
    rounded = f"TRY_CAST(ROUND(TRY_CAST({text} AS DECIMAL(38,18)), 0) AS {kind})"
    return f"COALESCE(TRY_CAST({text} AS {kind}), {rounded})"


def utc_date(ts: str) -> str:
    """Calendar date of an instant in UTC (the session zone is UTC)."""
    return f"TO_DATE({ts})"


def reporting_date(ts: str, zone: str) -> str:
    """Calendar date of an instant in the reporting zone."""
    return f"TO_DATE(FROM_UTC_TIMESTAMP({ts}, '{zone}'))"
