"""Checks on parent pointers and implied memberships.

Both follow edges in rounds of joins.  Each round's result is written below
``spark.checkpoint.dir`` before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelift.functions import is_true
from tablelift.scale import lookup_join, materialise_counted, once

SHORTCUTS = 4  # longer steps kept per source and length
DEEP = 4  # rounds that go by edges alone


def lineage_check(df: DataFrame, row_id: str, parent: str, broken: Column | None = None) -> DataFrame:
    """Can every row be traced to a sound root?

    One row per id: id, parent, `status` and `depth`.  Of rows that share an id
    the one of smallest parent counts (a root before all others), and it is
    broken if any of them is; `doubled_ids` lists such ids.

    * ``ok``: all ancestors exist and none is broken; depth counts them.
    * ``broken``: the row itself is marked broken.
    * ``missing_parent``: its own parent does not exist.
    * ``cycle``: it is its own ancestor.
    * ``broken_ancestor``: some ancestor has one of the above.

    Every round follows each pointer three times as far (parent, 3 levels, 9, …),
    so the rounds grow with the logarithm of the depth, and a row leaves the
    working set as soon as its fate is known.
    """
    bad = F.lit(False) if broken is None else is_true(broken)
    rows = df.select(F.col(row_id).alias("id"), F.col(parent).alias("parent"), bad.alias("__bad"))
    single = rows.groupBy("id").agg(
        F.min("parent").alias("__least"), F.bool_or(F.col("parent").isNull()).alias("__root"), F.bool_or("__bad").alias("__bad")
    )
    rows = single.select("id", F.when(~F.col("__root"), F.col("__least")).alias("parent"), "__bad")
    known = rows.select(F.col("id").alias("parent"), F.lit(True).alias("__found"))
    status = (
        F.when(F.col("__bad"), "broken")
        .when(F.col("parent").isNull(), "ok")
        .when(F.col("__found").isNull(), "missing_parent")
        .when(F.col("parent") == F.col("id"), "cycle")
    )
    state = lookup_join(rows, known, "parent", "left").select(
        "id", "parent", status.alias("status"), F.lit(0).cast("long").alias("depth")
    )
    state, seen = materialise_counted(state, "lineage", {"open": F.col("status").isNull()})

    fates, left = state.where(F.col("status").isNotNull()), seen["open"]
    settled = [fates]
    # an open row knows its ancestor `hop` levels up, and that all nearer ones are open too
    open_rows = state.where(F.col("status").isNull()).select(
        "id", "parent", F.col("parent").alias("ancestor"), F.lit(1).cast("long").alias("hop")
    )
    images, no_id, no_text, no_number = None, *[F.lit(None).cast(t) for t in (fates.schema["id"].dataType, "string", "long")]
    while left:
        ahead = fates.select("id", F.struct("status", "depth", no_id.alias("ancestor"), no_number.alias("hop")).alias("ahead"))
        ahead = ahead.unionByName(open_rows.select("id", F.struct(no_text.alias("status"), no_number.alias("depth"), "ancestor", "hop").alias("ahead")))
        joined = _one_ahead(_one_ahead(open_rows.withColumns({"status": no_text, "depth": no_number}), ahead), ahead)
        joined, seen = materialise_counted(joined, "lineage", {"open": F.col("status").isNull()})
        done = joined.where(F.col("status").isNotNull()).select("id", "parent", "status", "depth")
        open_rows = joined.where(F.col("status").isNull()).select("id", "parent", "ancestor", "hop")
        settled.append(done)
        fates = fates.unionByName(done)
        before, left = left, seen["open"]
        if left == before:
            # nobody was settled: all that is left lies on a cycle or below one.  Doubling on
            # moves every pointer onto a cycle; the pointers' targets are then the cycles.
            targets = open_rows.select(F.col("ancestor").alias("id")).distinct()
            reached = targets.count()
            if reached == images:
                on_cycle = targets.withColumn("__cycle", F.lit(True))
                last = lookup_join(open_rows, on_cycle, "id", "left").select(
                    "id",
                    "parent",
                    F.when(F.col("__cycle"), "cycle").otherwise("broken_ancestor").alias("status"),
                    F.lit(0).cast("long").alias("depth"),
                )
                settled.append(last)
                break
            images = reached
    result, *others = settled
    for part in others:
        result = result.unionByName(part)
    return result


def _one_ahead(rows: DataFrame, ahead: DataFrame) -> DataFrame:
    """Open rows with their ancestor's fate, or else its ancestor; settled ones as they are."""
    columns = rows.columns
    open_here = F.col("status").isNull()
    found = lookup_join(rows.withColumn("__at", F.when(open_here, F.col("ancestor"))), ahead.withColumnRenamed("id", "__at"), "__at", "left")
    sound, told = F.col("ahead.status") == "ok", open_here & F.col("ahead.status").isNotNull()
    moves = {
        "status": F.when(told, F.when(sound, "ok").otherwise("broken_ancestor")).otherwise(F.col("status")),
        "depth": F.when(told, F.when(sound, F.col("hop") + F.col("ahead.depth")).otherwise(0)).otherwise(F.col("depth")),
        "ancestor": F.when(open_here, F.col("ahead.ancestor")).otherwise(F.col("ancestor")),
        "hop": F.when(open_here, F.col("hop") + F.col("ahead.hop")).otherwise(F.col("hop")),
    }
    return found.withColumns(moves).select(*columns)


def doubled_ids(df: DataFrame, row_id: str) -> DataFrame:
    """(id, n) of ids that several rows share."""
    return df.groupBy(F.col(row_id).alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _few_per_source(pairs: DataFrame) -> DataFrame:
    """At most SHORTCUTS targets of each source, always the same ones."""
    nth = F.row_number().over(Window.partitionBy("source").orderBy(F.xxhash64("source", "target"), "target"))
    return pairs.withColumn("__nth", nth).where(F.col("__nth") <= SHORTCUTS).drop("__nth")


def _then(left: DataFrame, right: DataFrame) -> DataFrame:
    """(source, target): from the sources of `left` over its targets to those of `right`, itself excepted."""
    onward = right.select(F.col("source").alias("target"), F.col("target").alias("__next"))
    reached = lookup_join(left, onward, "target", "inner").select("source", F.col("__next").alias("target"))
    return reached.where("source <> target").distinct()


def implication_closure(implications: DataFrame, source: str, target: str, starts: DataFrame | None = None) -> DataFrame:
    """What each source implies, directly or through others, as distinct pairs (source, target).

    With `starts` (one column) only these sources are followed, so the pairs
    are those asked for.  Pairs found in one round are extended in the next by
    every edge, so nothing is missed, and from the DEEP-th round on by
    shortcuts over 2, 4, 8, … edges.  Each round makes the next shortcuts from
    the last; a source keeps SHORTCUTS of them, so there are never many more
    than edges.  A chain or a cycle of n groups so takes about log2(n) rounds.
    Only pairs not seen before go on to the next round.
    """
    edges = implications.select(F.col(source).alias("source"), F.col(target).alias("target")).dropna()
    edges = once(edges.where("source <> target").distinct(), "implications")
    first = edges
    if starts is not None:
        wanted = starts.toDF("source").dropna().distinct()
        first = lookup_join(edges, wanted, "source", "left_semi")
    found = {"pairs": F.lit(True)}
    frontier, seen = materialise_counted(first, "closure", found)
    known, steps, shortcuts, rounds = frontier, edges, _few_per_source(edges), 0
    while seen["pairs"]:
        rounds += 1
        fresh = _then(frontier, steps).join(known, ["source", "target"], "left_anti")
        frontier, seen = materialise_counted(fresh, "closure", found)
        known = known.unionByName(frontier)
        if seen["pairs"] and rounds >= DEEP and shortcuts is not None:
            shortcuts, longer = materialise_counted(_few_per_source(_then(shortcuts, shortcuts)), "shortcuts", found)
            steps = steps.unionByName(shortcuts)
            shortcuts = shortcuts if longer["pairs"] else None
    return known


def implied_closure(
    grants: DataFrame, member: str, group: str, implications: DataFrame, source: str, target: str
) -> DataFrame:
    """Memberships that follow from the implications but are not granted yet.

    The closure is taken over the groups alone, and only from those that are
    granted; the members, of whom there are many more, are joined once.  Adding
    the result and asking again yields nothing.
    """
    held = once(grants.select(member, group).dropna().distinct(), "grants")
    closure = implication_closure(implications, source, target, held.select(group))
    follow = closure.select(F.col("source").alias(group), F.col("target").alias("__implied"))
    implied = lookup_join(held, follow, group, "inner").select(member, F.col("__implied").alias(group)).distinct()
    return implied.join(held, [member, group], "left_anti")
