"""Existence checks in front of a step."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

Tables = Mapping[str, DataFrame]


def has_table(where: Tables | SparkSession, name: str) -> bool:
    """Is the table in this table set, or in the session catalog?"""
    if isinstance(where, SparkSession):
        return where.catalog.tableExists(name)
    return name in where


def has_column(df: DataFrame | None, column: str) -> bool:
    return df is not None and column in df.columns


def run_if(present: bool, step: Callable[[DataFrame], DataFrame], df: DataFrame) -> DataFrame:
    """Apply the step when its table or column is there; else hand the input on."""
    return step(df) if present else df
