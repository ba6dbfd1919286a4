"""Set-based updates, deletes and schema changes.

Parquet tables are immutable, so each operator is a projection or a filter that
yields the next snapshot.  UNKNOWN predicates behave as in SQL's UPDATE and
DELETE: the row is left alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.functions import any_like, is_true
from tablelift.scale import as_list, lookup_join


def _value(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def set_constant(df: DataFrame, column: str, value: Any) -> DataFrame:
    """The same value in every row."""
    return df.withColumn(column, F.lit(value).cast(df.schema[column].dataType))


def backup_column(df: DataFrame, column: str, backup: str) -> DataFrame:
    """Copy the current values aside; an earlier backup is replaced."""
    return df.withColumn(backup, F.col(column))


def update_where(df: DataFrame, predicate: Column, assignments: Mapping[str, Any]) -> DataFrame:
    """Conditional update; all right-hand sides see the old row, and every column keeps its type."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def assigned(column: str, value: Any) -> Column:
        if column not in types:
            return F.when(predicate, _value(value))
        return F.when(predicate, _value(value).cast(types[column])).otherwise(F.col(column))

    return df.withColumns({c: assigned(c, v) for c, v in assignments.items()})


def update_by_keys(
    df: DataFrame, key: str | Sequence[str], keys: DataFrame, assignments: Mapping[str, Any]
) -> DataFrame:
    """Update the rows whose key occurs in another table."""
    names = as_list(key)
    wanted = keys.select(*names).distinct().withColumn("__hit", F.lit(True))
    marked = lookup_join(df, wanted, names, "left")
    return update_where(marked, F.col("__hit"), assignments).select(*df.columns)


def placeholder_rename(df: DataFrame, column: str, placeholder: str, prefix: str, row_id: str) -> DataFrame:
    """Give every placeholder value a name of its own, made from the row id."""
    fresh = F.concat(F.lit(prefix), F.col(row_id).cast("string"))
    return update_where(df, F.col(column) == placeholder, {column: fresh})


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Drop the rows for which the predicate is TRUE; UNKNOWN rows stay."""
    return df.where(~is_true(predicate))


def delete_like(
    df: DataFrame, column: str, patterns: Sequence[str], extra: Column | None = None
) -> DataFrame:
    """Drop the rows matching any LIKE pattern, or the extra predicate."""
    doomed = any_like(F.col(column), patterns)
    return delete_where(df, doomed if extra is None else doomed | extra)


def add_column(df: DataFrame, name: str, data_type: str, if_absent: bool = False) -> DataFrame:
    """A new column of NULLs; the strict form refuses an existing name."""
    if name in df.columns:
        if if_absent:
            return df
        raise ValueError(f"column {name} exists already")
    return df.withColumn(name, F.lit(None).cast(data_type))


def rename_column(df: DataFrame, old: str, new: str, if_present: bool = False) -> DataFrame:
    """Rename; the strict form refuses a missing name, both refuse a taken one."""
    if old not in df.columns:
        if if_present:
            return df
        raise ValueError(f"no column {old}")
    if new in df.columns:
        raise ValueError(f"column {new} exists already")
    return df.withColumnRenamed(old, new)


def nullify(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Replace one value by NULL."""
    return df.withColumn(column, F.nullif(F.col(column), F.lit(value)))


def bump_counters(df: DataFrame, name: str, pattern: str, counter: str, step: int = 1) -> DataFrame:
    """Advance every counter whose name matches, ignoring case."""
    return update_where(
        df,
        F.col(name).ilike(pattern),
        {counter: (F.col(counter) + step).cast(df.schema[counter].dataType)},
    )
