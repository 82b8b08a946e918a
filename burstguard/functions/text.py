"""Tolerant text parsing."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def first_not_blank(available: list[str], *names: str) -> Column:
    """First non-blank trimmed value among ``names``; column names match without case.

    The lookup happens once, while the plan is built, so the scan reads only what is found.
    """
    by_lower: dict[str, str] = {}
    for column in available:
        by_lower.setdefault(column.lower(), column)
    found = [by_lower[n.lower()] for n in names if n.lower() in by_lower]
    if not found:
        return F.lit(None).cast("string")
    return F.coalesce(*[_blank_to_null(F.col(f"`{c}`").cast("string")) for c in found])


def non_empty_or_default(primary: Column, secondary: Column, fallback: str) -> Column:
    return F.coalesce(_blank_to_null(primary), _blank_to_null(secondary), F.lit(fallback.lower()))


def integer_or_null(text: Column) -> Column:
    """A whole decimal number that fits 64 bits, else null."""
    value = F.trim(text)
    return F.when(value.rlike(r"^[+-]?[0-9]+$"), value.try_cast("bigint"))


def safe_long(text: Column) -> Column:
    return F.coalesce(integer_or_null(text), F.lit(-1).cast("bigint"))


def safe_double(text: Column) -> Column:
    return F.trim(text).try_cast("double")
