"""Ordered reads: sorting, previews, deterministic picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelift.scale import once


def sort_by(df: DataFrame, *keys: Column | str) -> DataFrame:
    """A total sort; Spark range-partitions it."""
    return df.orderBy(*keys)


def preview(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows in order, each with the number of rows not shown.

    Every task keeps its own first n only, so nothing is sorted as a whole.
    What is no stored table is written first, as it is read twice.
    """
    df = once(df, "preview")
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.orderBy(*order).limit(n).withColumn("n_more", F.greatest(total - n, F.lit(0)))


def pick_one(df: DataFrame, predicate: Column, *order: Column | str) -> DataFrame:
    """The first matching row in the given order (a total order makes it repeatable)."""
    return df.where(predicate).orderBy(*order).limit(1)


def sample_per_row(df: DataFrame, column: str, n: int, out: str) -> DataFrame:
    """The first n entries of an array column."""
    return df.withColumn(out, F.slice(column, 1, n))


def first_per_group(df: DataFrame, part: Sequence[str], order: Sequence[Column | str], n: int, out: str) -> DataFrame:
    """The first n rows of each group; tasks pass on at most n rows per group."""
    window = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window).cast("long")).where(F.col(out) <= n)
