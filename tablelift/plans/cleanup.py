"""Clean-up after the last version: duplicate keys and entries nothing stands behind."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame

from tablelift.operators.dedup import Deleted, dedup_summary, delete_losers, losers_of, redirect_children
from tablelift.scale import materialise


class Deduplicated(NamedTuple):
    rows: DataFrame
    log: DataFrame
    failures: DataFrame
    summary: DataFrame


def dedup_hierarchy(
    df: DataFrame, key: str, row_id: str, parent: str, prefer: Column, active: Column | None = None
) -> Deduplicated:
    """Keep one row per key, hang the children of the others below it, delete the others.

    All rows are looked at, active or not; the summary counts the duplicates
    that remain among the active ones.
    """
    losers = materialise(losers_of(df, key, row_id, prefer), "losers")  # four steps read them
    moved = redirect_children(df, parent, losers, row_id, same_table=True)
    deleted: Deleted = delete_losers(moved.children, row_id, moved.losers, moved.children, parent, row_id)
    summary = dedup_summary(df, deleted, moved.log, key, row_id, active)
    return Deduplicated(deleted.rows, moved.log, deleted.failures, summary)
