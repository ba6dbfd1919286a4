"""Duplicate keys: find them, keep one row, re-point what hangs below the others."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.operators.hierarchy import lineage_check
from tablelift.operators.sequence import collect_in_pieces
from tablelift.scale import as_list, lookup_join, materialise, materialise_counted, once


def _keyed(df: DataFrame, keys: list[str], where: Column | None) -> DataFrame:
    """Rows with a usable key: neither NULL nor empty."""
    usable = F.lit(True) if where is None else where
    for k in keys:
        usable = usable & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
    return df.where(usable)


def duplicate_keys(
    df: DataFrame, key: str | Sequence[str], row_id: str, where: Column | None = None
) -> DataFrame:
    """Keys held by more than one row, with their count and first and last id."""
    keys = as_list(key)
    grouped = _keyed(df, keys, where).groupBy(*keys)
    counted = grouped.agg(
        F.count(F.lit(1)).alias("n"), F.min(row_id).alias("first_id"), F.max(row_id).alias("last_id")
    )
    return counted.where("n > 1")


def duplicate_members(
    df: DataFrame, key: str | Sequence[str], row_id: str, where: Column | None = None
) -> DataFrame:
    """Every row of a duplicated key as (key, id, n)."""
    keys = as_list(key)
    doubled = duplicate_keys(df, keys, row_id, where).select(*keys, "n")
    return lookup_join(_keyed(df, keys, where).select(*keys, row_id), doubled, keys, "inner")


def duplicate_lists(
    df: DataFrame, key: str | Sequence[str], row_id: str, where: Column | None = None, entries: int = 1000
) -> DataFrame:
    """The sorted ids of each duplicated key, in pieces of at most `entries`."""
    return collect_in_pieces(duplicate_members(df, key, row_id, where), key, row_id, "ids", entries=entries)


def pick_survivor(
    df: DataFrame, key: str | Sequence[str], row_id: str, prefer: Column, where: Column | None = None
) -> DataFrame:
    """One survivor per duplicated key: a preferred row first, then the lowest id.

    Two minima over the id, combined before the shuffle; no group is sorted.
    """
    keys = as_list(key)
    chosen = (
        _keyed(df, keys, where)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.when(prefer, F.col(row_id))).alias("__preferred"),
            F.min(row_id).alias("__lowest"),
        )
        .where("n > 1")
    )
    return chosen.select(*keys, "n", F.coalesce("__preferred", "__lowest").alias("survivor_id"))


def losers_of(
    df: DataFrame, key: str | Sequence[str], row_id: str, prefer: Column, where: Column | None = None
) -> DataFrame:
    """(loser_id, survivor_id) for every row that gives way to its survivor."""
    keys = as_list(key)
    survivors = pick_survivor(df, keys, row_id, prefer, where).select(*keys, "survivor_id")
    members = lookup_join(_keyed(df, keys, where).select(*keys, row_id), survivors, keys, "inner")
    lost = members.where(F.col(row_id) != F.col("survivor_id"))
    return lost.select(F.col(row_id).alias("loser_id"), "survivor_id")


class Redirected(NamedTuple):
    children: DataFrame  # the child table with its new parents
    log: DataFrame  # child_id, from_id, to_id, done
    losers: DataFrame  # losers free of a failed redirect


def _redirect(children: DataFrame, parent: str, losers: DataFrame) -> DataFrame:
    moves = losers.select(F.col("loser_id").alias(parent), F.col("survivor_id").alias("__to"))
    moved = lookup_join(children, moves, parent, "left")
    return moved.withColumn(parent, F.coalesce("__to", parent)).select(*children.columns)


def _without_loops(children: DataFrame, parent: str, losers: DataFrame, child_id: str) -> tuple[DataFrame, DataFrame]:
    """(losers whose redirects close no loop, the others), all redirects considered together.

    A loop that a redirect closes runs from a moved child through its survivor
    back to the child, however deep the survivor lies below its loser and
    however many redirects take part.  All losers whose children stand on such
    a loop fail; since their children then stay, the rest is looked at again
    until no loop is left.  A loop that was there before concerns nobody.
    """
    good, failed = losers, losers.limit(0)
    edges = children.select(F.col(child_id).alias("id"), F.col(parent).alias("parent"))
    while True:
        above = lookup_join(good.select(F.col("survivor_id").alias("id")).distinct(), edges, "id", "inner")
        if above.where("parent IS NOT NULL").isEmpty():
            return good, failed  # every survivor is a root, so nothing can hang below itself
        fate = lineage_check(_redirect(edges, "parent", good), "id", "parent")
        looped = fate.where("status = 'cycle'").select("id")
        moved = lookup_join(edges, looped, "id", "left_semi").select(F.col("parent").alias("loser_id"))
        bad, seen = materialise_counted(
            lookup_join(good, moved.distinct(), "loser_id", "left_semi").select(*losers.columns), "looped", {"rows": F.lit(True)}
        )
        if not seen["rows"]:
            return good, failed
        failed = failed.unionByName(bad)
        good = materialise(lookup_join(good, bad.select("loser_id"), "loser_id", "left_anti").select(*losers.columns), "good")


def redirect_children(
    children: DataFrame, parent: str, losers: DataFrame, child_id: str, same_table: bool = False
) -> Redirected:
    """Hang the children of each loser below its survivor; inactive children too.

    In a hierarchy (``same_table``) a survivor may lie somewhere below its
    loser, or below another loser whose survivor lies below this one.  A
    redirect that would close a loop fails as a whole and the loser is kept.
    """
    good, failed = losers, None
    if same_table:
        good, failed = _without_loops(children, parent, once(losers, "losers"), child_id)
    redirected = _redirect(children, parent, good)

    planned = losers.select(F.col("loser_id").alias("from_id"), F.col("survivor_id").alias("to_id"))
    touched = children.select(F.col(child_id).alias("child_id"), F.col(parent).alias("from_id"))
    log = lookup_join(touched, planned, "from_id", "inner")
    if failed is None:
        log = log.withColumn("done", F.lit(True))
    else:
        marks = failed.select(F.col("loser_id").alias("from_id"), F.lit(False).alias("done")).distinct()
        log = lookup_join(log, marks, "from_id", "left").withColumn("done", F.coalesce("done", F.lit(True)))
    return Redirected(redirected, log.select("child_id", "from_id", "to_id", "done"), good)


class Deleted(NamedTuple):
    rows: DataFrame  # the table without the deleted losers
    failures: DataFrame  # id, reason


def _blocked_above(blocked: DataFrame, waiting: DataFrame) -> DataFrame:
    """`blocked` (loser_id) and all losers above that wait for one of them, directly or through others.

    After a round everything within 2, 4, 8, … levels is marked, and the
    pointers lead as many levels up.  Where they lead from no marked loser, none
    has that many levels above it, and all are marked.  Ids that several rows
    share have several pointers.
    """
    marked, jump, some = blocked, waiting, {"rows": F.lit(True)}
    while True:
        struck = lookup_join(jump, marked.select(F.col("loser_id").alias("child_id")).distinct(), "child_id", "left_semi")
        struck, seen = materialise_counted(struck.select("loser_id").distinct(), "blocked", some)
        if not seen["rows"]:
            return marked.distinct()
        marked = marked.unionByName(struck)
        onward = jump.select(F.col("child_id").alias("loser_id"), F.col("loser_id").alias("__next"))
        further = lookup_join(jump, onward, "loser_id", "inner").select("child_id", F.col("__next").alias("loser_id"))
        jump, seen = materialise_counted(further.distinct(), "jumps", some)
        if not seen["rows"]:
            return marked.distinct()


def delete_losers(
    df: DataFrame, row_id: str, losers: DataFrame, children: DataFrame, parent: str, child_id: str | None = None
) -> Deleted:
    """Delete the losers, highest id first, except those that still have children.

    With `child_id` the children live in the same table: a child that is itself
    a deletable loser with a higher id is gone by the time its parent's turn
    comes.  What is blocked blocks all losers above it that wait for it; their
    pointers are doubled, so the rounds grow with the logarithm of the longest
    line of losers below losers.
    """
    doomed = losers.select(F.col("loser_id")).distinct()
    columns = [F.col(parent).alias("loser_id")] + ([F.col(child_id).alias("child_id")] if child_id else [])
    hanging = lookup_join(children.select(*columns), doomed, "loser_id", "left_semi")

    if child_id is None:
        remaining = hanging
        blocked = hanging.select("loser_id").distinct()
    else:
        flags = doomed.select(F.col("loser_id").alias("child_id"), F.lit(True).alias("child_doomed"))
        goes_first = F.coalesce(F.col("child_doomed"), F.lit(False)) & (F.col("child_id") > F.col("loser_id"))
        edges = lookup_join(hanging, flags, "child_id", "left")
        edges, seen = materialise_counted(edges, "edges", {"waiting": goes_first})
        blocked = edges.where(~goes_first).select("loser_id").distinct()
        waiting = edges.where(goes_first)
        if seen["waiting"]:
            blocked = _blocked_above(materialise(blocked, "blocked"), waiting.select("child_id", "loser_id"))
        stays = blocked.select(F.col("loser_id").alias("child_id"), F.lit(True).alias("child_stays"))
        judged = lookup_join(edges, stays, "child_id", "left")
        remaining = judged.where(~goes_first | F.coalesce(F.col("child_stays"), F.lit(False)))

    gone = doomed.join(blocked, "loser_id", "left_anti")
    kept = lookup_join(df, gone.select(F.col("loser_id").alias(row_id)), row_id, "left_anti")
    failures = (
        remaining.groupBy(F.col("loser_id").alias("id"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("id", F.concat(F.lit("Still has "), F.col("n").cast("string"), F.lit(" children")).alias("reason"))
    )
    return Deleted(kept.select(*df.columns), failures)


def dedup_summary(
    before: DataFrame, after: Deleted, log: DataFrame, key: str | Sequence[str], row_id: str, where: Column | None = None
) -> DataFrame:
    """One row: deleted, failed, redirected (failures included), remaining duplicate keys."""
    spark = before.sparkSession
    count = F.count(F.lit(1)).alias("n")
    remaining = duplicate_keys(after.rows, key, row_id, where).agg(count)
    return spark.range(1).select(
        (before.agg(count).scalar() - after.rows.agg(count).scalar()).alias("deleted"),
        after.failures.agg(count).scalar().alias("failed"),
        log.agg(count).scalar().alias("redirected"),
        remaining.scalar().alias("remaining"),
    )
