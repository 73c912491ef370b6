"""Strict calendar dates and timestamps without a time zone."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column as SparkColumn
from pyspark.sql import functions as F

from ..contract import Column, Contract, canonical_type

# The exact text forms of a DATE and of a TIMESTAMP without a time zone.
DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
TIMESTAMP_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?\z"

INVALID = "A DATE or TIMESTAMP text is not exact"


def _native(type_name: str) -> str:
    return "timestamp_ntz" if canonical_type(type_name) == "TIMESTAMP" else "date"


def is_exact_text(column: SparkColumn, type_name: str) -> SparkColumn:
    """True where the text has the exact form, a year 0001-9999 and names a real instant."""
    form = DATE_TEXT if canonical_type(type_name) == "DATE" else TIMESTAMP_TEXT
    # try_cast alone would accept short forms, drop offsets and truncate nanoseconds.
    return column.rlike(form) & (F.substring(column, 1, 4) != "0000") & column.try_cast(_native(type_name)).isNotNull()


def parse(column: SparkColumn, type_name: str) -> SparkColumn:
    """Typed value of text already known to be exact; NULL otherwise."""
    return F.when(is_exact_text(column, type_name), column.try_cast(_native(type_name)))


def parse_or_fail(column: SparkColumn, type_name: str) -> SparkColumn:
    """Typed value; fails the running query on text that is not exact. NULL stays NULL."""
    native = _native(type_name)
    bad = column.isNotNull() & ~is_exact_text(column, type_name)
    return F.when(bad, F.raise_error(F.lit(INVALID)).cast(native)).otherwise(column.try_cast(native))


def year_in_range(column: SparkColumn) -> SparkColumn:
    return F.year(column).between(1, 9999)


def invalid_value(column: Column, fmt: str) -> SparkColumn:
    """True where a source value of a temporal column must be refused."""
    source = F.col(f"`{column.name}`")
    valid = year_in_range(source) if fmt == "parquet" else is_exact_text(source, column.type)
    return source.isNotNull() & ~valid


def any_invalid(contract: Contract, fmt: str) -> SparkColumn:
    """True where a row has at least one temporal value that must be refused."""
    condition = F.lit(False)
    for column in contract.columns:
        if column.temporal:
            condition = condition | invalid_value(column, fmt)
    return condition


def literal(type_name: str, value) -> SparkColumn | None:
    """Exact temporal literal of a rule, or None when the text can never match a row."""
    if not isinstance(value, str) or not value.isascii():
        return None
    day = canonical_type(type_name) == "DATE"
    form = DATE_TEXT if day else TIMESTAMP_TEXT
    if not re.fullmatch(form.removeprefix("^").removesuffix(r"\z"), value):
        return None
    try:
        parsed = dt.date.fromisoformat(value) if day else dt.datetime.fromisoformat(value)
    except ValueError:
        return None
    if not day and not value[11:13] <= "23":
        return None
    text = parsed.isoformat() if day else value.replace("T", " ")
    return F.lit(text).cast(_native(type_name))
