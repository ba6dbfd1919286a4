"""Small column expressions, all evaluated inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_true(predicate: Column) -> Column:
    """SQL's WHERE rule: UNKNOWN counts as false."""
    return F.coalesce(predicate, F.lit(False))


def build_label(*parts: Column | str) -> Column:
    """Join pieces like SQL's ``||``: one NULL piece makes the label NULL."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def json_scalar(value: Column) -> Column:
    """A text value as a quoted and escaped JSON string; NULL stays NULL."""
    return F.when(value.isNotNull(), F.to_json(value.cast("variant")))


def json_localised(value: Column, language: str) -> Column:
    """A text value as a one-entry JSON object keyed by language."""
    return F.when(value.isNotNull(), F.to_json(F.create_map(F.lit(language), value)))


def counter_name(prefix: str, number: Column, width: int = 3, truncate: bool = False) -> Column:
    """Name of the object behind a counter, its number padded with zeros.

    ``truncate=True`` pads like ``lpad``, which cuts longer numbers so that
    distinct ids share a name; the default keeps every digit.
    """
    if truncate:
        return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))
    return F.concat(F.lit(prefix), F.format_string(f"%0{width}d", number.cast("long")))


def any_like(column: Column, patterns: Sequence[str]) -> Column:
    """``column LIKE p1 OR column LIKE p2 …``; `_` and `%` are wildcards."""
    matched = F.lit(False)
    for pattern in patterns:
        matched = matched | column.like(pattern)
    return matched


def all_matches(column: Column, pattern: str, group: int = 1) -> Column:
    """Every match of one capture group, in text order."""
    return F.regexp_extract_all(column, F.lit(pattern), F.lit(group))


def shorten(column: Column, length: int) -> Column:
    return F.left(column, F.lit(length))


def path_without_root(path: Column) -> Column:
    """The path without one leading slash; NULL for empty paths and glob patterns."""
    usable = (path != "") & ~path.contains("*")
    return F.when(usable, F.regexp_replace(path, "^/", ""))


def numeric_text(column: Column) -> Column:
    """True for text that consists of decimal digits only."""
    return column.rlike("^[0-9]+$")
