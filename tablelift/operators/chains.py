"""Ordered pair tables (ord, old, new) of any length, resolved without the driver.

Pairs take effect one after another, and what one of them does depends on those before.  Followed
from a name, though, a list of pairs is a chain of pointers, so its end can be found by doubling: every
round follows each pointer twice as far, and is written before the next one reads it.  Rounds grow
with the logarithm of the longest chain; only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelift.operators.sequence import number_rows, surrogate_keys
from tablelift.scale import Limits, lookup_join, materialise, materialise_counted


def numbered_pairs(pairs: DataFrame) -> DataFrame:
    """(id, old, new): pairs that can have an effect, numbered in the order they apply (equal `ord`: by old, then new)."""
    useful = pairs.select("ord", "old", "new").where("old IS NOT NULL AND new IS NOT NULL AND old <> new").distinct()
    numbered = surrogate_keys(materialise(useful, "pairs"), ["ord", "old", "new"], "id")
    return materialise(numbered.select("id", "old", "new"), "pairs")


def with_next(pairs: DataFrame) -> DataFrame:
    """`pairs` with `jump`: the first later pair whose old name is this one's new name.

    Names are cut into stretches of `groupRows` consecutive ids, so a name that a third of all pairs
    share is not one group; what a stretch does not find is the first of a later stretch.
    """
    stretch = F.floor((F.col("id") - 1) / Limits.of(pairs.sparkSession).group_rows).alias("stretch")
    asked = pairs.select(F.col("new").alias("name"), "id", F.lit(None).cast("long").alias("given"), stretch)
    given = pairs.select(F.col("old").alias("name"), "id", F.col("id").alias("given"), stretch)
    both = asked.unionByName(given)
    later = Window.partitionBy("name", "stretch").orderBy(F.col("id").desc()).rowsBetween(Window.unboundedPreceding, -1)
    inside = both.withColumn("here", F.min("given").over(later)).where("given IS NULL")
    firsts = both.groupBy("name", "stretch").agg(F.min("given").alias("first"))
    beyond = Window.partitionBy("name").orderBy(F.col("stretch").desc()).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.withColumn("beyond", F.min("first").over(beyond)).select("name", "stretch", "beyond")
    found = inside.join(firsts, ["name", "stretch"]).select("id", F.coalesce("here", "beyond").alias("jump"))
    return pairs.join(found, "id")


def renames_from(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """(old, new): what becomes of every name that some pair renames, one row per old name.

    A pair counts while its old name exists: `names` (old) do at first, and new names as pairs make
    them.  What carries a name goes to the first pair from it and on from pair to pair, whatever else
    happens, so pairs point to pairs; those that a first pair of an existing name leads to count.
    """
    pairs = numbered_pairs(pairs)
    first = pairs.groupBy("old").agg(F.min("id").alias("id"))
    seeds = lookup_join(first, names.distinct(), "old", "left_semi").select("id", F.lit(True).alias("hit"))
    state = with_next(pairs).join(seeds, "id", "left")
    state = state.select("id", "old", "jump", F.col("new").alias("last"), F.coalesce("hit", F.lit(False)).alias("hit"))
    state, seen = materialise_counted(state, "renames", {"open": F.col("jump").isNotNull()})
    while seen["open"]:
        ahead = state.select(F.col("id").alias("jump"), F.col("jump").alias("__jump"), F.col("last").alias("__last"))
        struck = state.where(F.col("hit") & F.col("jump").isNotNull()).select(F.col("jump").alias("id"), F.lit(True).alias("__hit")).distinct()
        moved = lookup_join(state.where("jump IS NOT NULL"), ahead, "jump", "inner")
        moved = moved.select("id", "old", F.col("__jump").alias("jump"), F.col("__last").alias("last"), "hit")
        state = moved.unionByName(state.where("jump IS NULL")).join(struck, "id", "left")
        state = state.select("id", "old", "jump", "last", (F.col("hit") | F.coalesce("__hit", F.lit(False))).alias("hit"))
        state, seen = materialise_counted(state, "renames", {"open": F.col("jump").isNotNull()})
    ends = state.where("hit").groupBy("old").agg(F.min_by("last", "id").alias("new"))
    return materialise(ends, "renamed")


def merges_from(pairs: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(member, target, rank) of everything that is merged or merged into, and the names (old) that are gone.

    A pair counts while its old name is one of `names` (old) and not gone.  So each name is merged at
    most once, by its first pair, into what then has the new name: that name's own rows and all that
    came before, unless it is gone by then; later arrivals under a gone name start anew.  This is a
    forest, and the order of arrival is its preorder, children by the time they come: a tour of the
    forest is one list, and ranks are its suffix sums by doubling.  Lower ranks came first.
    """
    pairs = numbered_pairs(pairs)
    first = pairs.groupBy("old").agg(F.min("id").alias("at"), F.min_by("new", "id").alias("into"))
    merged = materialise(lookup_join(first, names.distinct(), "old", "left_semi"), "merges")
    ends = merged.select(F.col("old").alias("into"), F.col("at").alias("gone_at"))
    again = F.col("gone_at").isNotNull() & (F.col("at") > F.col("gone_at"))
    children = lookup_join(merged, ends, "into", "left").select("old", "at", "into", again.alias("again"))
    children = materialise(children, "children")

    # every name is a node, and once more (`again`) if something arrives after it is gone
    nodes = children.select(F.col("old").alias("name"), F.lit(False).alias("again"))
    nodes = nodes.unionByName(children.select(F.col("into").alias("name"), "again")).distinct()
    nodes = materialise(surrogate_keys(materialise(nodes, "nodes"), ["name", "again"], "node"), "nodes")
    of_child = nodes.where("NOT again").select(F.col("name").alias("old"), F.col("node").alias("child"))
    of_parent = nodes.select(F.col("name").alias("into"), "again", F.col("node").alias("parent"))
    tree = lookup_join(children.join(of_child, "old"), of_parent, ["into", "again"], "inner").select("child", "parent", "at")
    tree = materialise(number_rows(materialise(tree, "tree"), "parent", ["at"], "nth", previous="before", row_id="child"), "tree")

    # the tour enters and leaves every node: place 2 * node, and 2 * node + 1
    enter, leave = (lambda c: F.col(c) * 2), (lambda c: F.col(c) * 2 + 1)
    parents = tree.select(F.col("parent").alias("node")).distinct()
    lasts = tree.join(tree.select(F.col("before").alias("child")), "child", "left_anti")
    steps = tree.where("nth = 1").select(enter("parent").alias("place"), enter("child").alias("jump"))
    steps = steps.unionByName(tree.where("nth > 1").select(leave("before").alias("place"), enter("child").alias("jump")))
    steps = steps.unionByName(lasts.select(leave("child").alias("place"), leave("parent").alias("jump")))
    steps = steps.unionByName(nodes.join(parents, "node", "left_anti").select(enter("node").alias("place"), leave("node").alias("jump")))
    roots = nodes.join(tree.select(F.col("child").alias("node")), "node", "left_anti")
    steps = steps.unionByName(roots.select(leave("node").alias("place"), F.lit(None).cast("long").alias("jump")))
    state = steps.select("place", "jump", F.col("place").alias("last"), (1 - F.col("place") % 2).alias("entered"))
    state, seen = materialise_counted(state, "tour", {"open": F.col("jump").isNotNull()})
    while seen["open"]:
        ahead = state.select(F.col("place").alias("jump"), F.col("jump").alias("__jump"), F.col("last").alias("__last"), F.col("entered").alias("__entered"))
        moved = state.where("jump IS NOT NULL").join(ahead, "jump")  # no two places lead to the same one
        moved = moved.select("place", F.col("__jump").alias("jump"), F.col("__last").alias("last"), (F.col("entered") + F.col("__entered")).alias("entered"))
        state, seen = materialise_counted(moved.unionByName(state.where("jump IS NULL")), "tour", {"open": F.col("jump").isNotNull()})

    entries = state.where("place % 2 = 0").select((F.col("place") / 2).cast("long").alias("node"), ((F.col("last") - 1) / 2).cast("long").alias("root"), "entered")
    members = nodes.where("NOT again").select("node", F.col("name").alias("member")).join(entries, "node")
    targets = nodes.select(F.col("node").alias("root"), F.col("name").alias("target"))
    ranks = lookup_join(members, targets, "root", "inner").select("member", "target", (-F.col("entered")).alias("rank"))
    return materialise(ranks, "ranks"), merged.select("old")
