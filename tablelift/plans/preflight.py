"""What will not survive the move, and why: the questions asked before a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.operators.checks import census
from tablelift.operators.dedup import duplicate_keys
from tablelift.operators.documents import extract_exprs
from tablelift.operators.joins import classify, missing_in_target


def missing_by_class(
    source: DataFrame, target: DataFrame, key: str, catalog: DataFrame, where: Column | None = None
) -> DataFrame:
    """Rows without a counterpart in the target, each with its class and label."""
    return classify(missing_in_target(source, target, key, where), catalog, key)


def class_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def view_census(
    views: DataFrame,
    row_id: str,
    key: str,
    parent: str,
    document: str,
    active: Column,
    custom: Column,
) -> DataFrame:
    """One row: all, custom and module views, duplicate keys, custom views with expressions."""
    with_exprs = extract_exprs(views, document, "exprs", where=active & F.col(parent).isNotNull())
    duplicates = duplicate_keys(views, key, row_id, active).agg(F.count(F.lit(1)).alias("n"))
    totals = census(views, {"custom": custom, "module": ~custom})
    return totals.withColumns(
        {
            "duplicate_keys": duplicates.scalar(),
            "custom_with_exprs": with_exprs.agg(F.count_if(custom).alias("n")).scalar(),
        }
    )
