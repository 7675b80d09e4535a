"""Severity handling and report text as columns, without UDFs.

``format_number`` with a pattern rounds half to even on the exact value, which is what report
text needs; ``format_string`` would round half up.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ABSENT = "—"


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _pattern(value: Column, pattern: str) -> Column:
    return F.call_function("format_number", value, F.lit(pattern))


def _or(text: Column, value: Column, fallback: str = ABSENT) -> Column:
    return F.when(value.isNull(), F.lit(fallback)).otherwise(text)


def _fixed(decimals: int) -> str:
    return "0." + "0" * decimals if decimals else "0"


def normalize_severity(severity: str | Column) -> Column:
    """Trimmed upper-case severity; a missing one counts as INFO."""
    return F.upper(F.trim(F.coalesce(_col(severity), F.lit("INFO"))))


def severity_rank(severity: str | Column) -> Column:
    """INFO 0, WARNING 1, CRITICAL 2; null for any other word."""
    word = normalize_severity(severity)
    return F.when(word == "CRITICAL", 2).when(word == "WARNING", 1).when(word == "INFO", 0)


def percentage(value: str | Column, decimals: int = 1) -> Column:
    v = _col(value)
    return _or(F.concat(_pattern(v * 100, _fixed(decimals)), F.lit("%")), v)


def fixed(value: str | Column, decimals: int = 2) -> Column:
    v = _col(value)
    return _or(_pattern(v, _fixed(decimals)), v)


def integer(value: str | Column) -> Column:
    v = _col(value)
    return _or(F.format_number(v, 0), v)


def currency(value: str | Column, symbol: str = "$") -> Column:
    v = _col(value)
    return _or(F.concat(F.lit(symbol), F.format_number(v, 2)), v)


def hours(value: str | Column) -> Column:
    v = _col(value)
    return _or(F.concat(_pattern(v, "0.0"), F.lit(" hrs")), v)


def temperature(value: str | Column) -> Column:
    v = _col(value)
    return _or(F.concat(_pattern(v, "0.0"), F.lit("°C")), v)


def fatigue(value: str | Column) -> Column:
    return fixed(value, 2)


def short_time(value: str | Column) -> Column:
    v = _col(value)
    return _or(F.date_format(v, "dd MMM HH:mm"), v, "NEVER")


def activity_time(value: str | Column) -> Column:
    v = _col(value)
    return _or(F.date_format(v, "yyyy-MM-dd HH:mm"), v, "NEVER REPORTED")
