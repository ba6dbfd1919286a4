"""Reconciling one table with another.

Every join is an equi-join.  The right side is reduced to one row per key
first, so a row is never multiplied by an update, and hot keys on the left are
spread by `lookup_join`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.functions import is_true
from tablelift.operators.sequence import collect_in_pieces
from tablelift.scale import as_list, lookup_join, orderable


def one_per_key(
    df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str], keep: Sequence[str] | None = None
) -> DataFrame:
    """The first row of each key in the given order; combined before the shuffle."""
    keys = as_list(key)
    rest = [c for c in df.columns if c not in keys] if keep is None else list(keep)
    if not rest:
        return df.select(*keys).distinct()
    first = F.min_by(F.struct(*rest), F.struct(*order))
    columns = [c for c in df.columns if c in keys or c in rest]
    return df.groupBy(*keys).agg(first.alias("__row")).select(*keys, "__row.*").select(*columns)


def with_membership(df: DataFrame, column: str, others: DataFrame, key: str, out: str) -> DataFrame:
    """Add ``column IN (SELECT key FROM others)`` as a three-valued boolean.

    Whether `others` is empty or holds a NULL is asked once, as two scalars;
    the rows themselves meet in a plain equi-join that shuffles at any size,
    where ``NOT IN`` would broadcast the whole right side.
    """
    members = others.select(F.col(key).alias(column)).where(F.col(column).isNotNull()).distinct()
    marked = lookup_join(df, members.withColumn("__hit", F.lit(True)), column, "left")
    facts = others.agg(
        (F.count(F.lit(1)) == 0).alias("empty"), (F.count_if(F.col(key).isNull()) > 0).alias("nulls")
    )
    unknown = F.col(column).isNull() | facts.select("nulls").scalar()
    value = (
        F.when(F.col("__hit"), True)
        .when(facts.select("empty").scalar(), False)
        .when(unknown, F.lit(None).cast("boolean"))
        .otherwise(False)
    )
    return marked.select(*df.columns, value.alias(out))


def missing_in_target(
    src: DataFrame, dst: DataFrame, key: str | Sequence[str], where: Column | None = None
) -> DataFrame:
    """Source rows whose key has no counterpart in the target (NULL keys have none)."""
    keys = as_list(key)
    rows = src if where is None else src.where(where)
    return lookup_join(rows, dst.select(*keys).distinct(), keys, "left_anti").select(*src.columns)


def classify(missing: DataFrame, catalog: DataFrame, name: str) -> DataFrame:
    """Say why a name is missing: obsolete before merged before renamed before missing.

    Adds `class` and `label`; the label of a renamed entry reads "old -> new".
    A rename is one hop, never followed further.
    """
    known = catalog.groupBy(F.col("old").alias(name)).agg(
        F.bool_or(F.col("kind") == "obsolete").alias("__obsolete"),
        F.bool_or(F.col("kind") == "merged").alias("__merged"),
        F.max(F.when(F.col("kind") == "renamed", F.col("new"))).alias("__new"),
    )
    found = lookup_join(missing, known, name, "left")
    kind = (
        F.when(F.col("__obsolete"), "obsolete")
        .when(F.col("__merged"), "merged")
        .when(F.col("__new").isNotNull(), "renamed")
        .otherwise("missing")
    )
    label = F.when(F.col("class") == "renamed", F.concat(F.col(name), F.lit(" -> "), F.col("__new")))
    labelled = found.withColumn("class", kind).withColumn("label", F.coalesce(label, F.col(name)))
    return labelled.select(*missing.columns, "class", "label")


def delete_orphans(
    df: DataFrame,
    row_id: str,
    scope: tuple[str, DataFrame, str],
    tracked: tuple[DataFrame, str],
    where: Column,
) -> DataFrame:
    """Drop rows that satisfy `where`, lie in the scope, and are not tracked.

    ``scope`` is (column, table, key) and means ``column IN (SELECT key …)``;
    ``tracked`` is (table, key) and means ``row_id NOT IN (SELECT key …)`` with
    SQL's rule that one NULL among the keys protects every row.
    """
    column, scope_table, scope_key = scope
    tracked_table, tracked_key = tracked
    candidates = df.where(where)
    flagged = with_membership(candidates, column, scope_table, scope_key, "__in_scope")
    flagged = with_membership(flagged, row_id, tracked_table, tracked_key, "__tracked")
    survivors = flagged.where(~is_true(F.col("__in_scope") & ~F.col("__tracked")))
    return df.where(~is_true(where)).unionByName(survivors.select(*df.columns))


def update_from(
    df: DataFrame,
    other: DataFrame,
    on: Mapping[str, str],
    columns: Mapping[str, str | Column],
    where: Column | None = None,
    tie: Sequence[Column | str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Copy columns from the matching row of another table, NULLs included.

    A column `df` has already keeps its type.

    ``on`` maps columns of `df` to columns of `other`, ``columns`` targets to
    their sources.  With several matches the one that sorts first by `tie` is
    used; ``unique=True`` promises there is at most one.
    """
    keys = list(on)
    ties = [F.col(t) if isinstance(t, str) else t for t in tie or []]
    picked = other.select(
        *[F.col(source).alias(key) for key, source in on.items()],
        *[(F.col(s) if isinstance(s, str) else s).alias(f"__new_{t}") for t, s in columns.items()],
        *[t.alias(f"__tie_{i}") for i, t in enumerate(ties)],
    ).dropna(subset=keys)
    if not unique:
        values = [f"__new_{t}" for t in columns]
        # the values themselves settle what the tie leaves open, so a rerun picks the same row
        order = [f"__tie_{i}" for i in range(len(ties))] + [v for v in values if v in orderable(picked)]
        picked = one_per_key(picked, keys, order, values)
    picked = picked.drop(*[f"__tie_{i}" for i in range(len(ties))]).withColumn("__hit", F.lit(True))
    joined = lookup_join(df, picked, keys, "left")
    apply = F.col("__hit") if where is None else F.col("__hit") & where
    joined = joined.withColumns(
        {
            t: F.when(apply, F.col(f"__new_{t}").cast(df.schema[t].dataType)).otherwise(F.col(t))
            if t in df.columns
            else F.when(apply, F.col(f"__new_{t}"))
            for t in columns
        }
    )
    return joined.select(*df.columns, *[t for t in columns if t not in df.columns])


def remap_self_reference(df: DataFrame, old_ref: str, old_id: str, new_id: str, out: str) -> DataFrame:
    """Turn a pointer to an old id into the new id of the row that replaced it."""
    replaced = df.groupBy(old_id).agg(F.min(new_id).alias(new_id))
    return update_from(df, replaced, {old_ref: old_id}, {out: new_id}, unique=True)


class Link(NamedTuple):
    """One step of a lookup chain: join `table`, known as `name`, where left = name.right."""

    name: str
    table: DataFrame
    left: str
    right: str


def update_from_chain(
    df: DataFrame,
    links: Sequence[Link],
    columns: Mapping[str, str],
    tie: str,
    only_null: bool = False,
) -> DataFrame:
    """Fill columns through a chain of tables; a missing link leaves the row unchanged.

    The chain is joined from its far end to one lookup with a row per key, so
    `df` itself is shuffled at most once.  Sources and `tie` are written as
    "link.column".  ``only_null`` protects values that are already there.
    """
    first, *others = links
    wanted = {*columns.values(), tie, f"{first.name}.{first.right}", *[link.left for link in others]}

    def held(source: str) -> str:
        """The column that carries "link.column" along the chain."""
        return "__".join(["", *source.split(".", 1)])

    def reduced(link: Link) -> DataFrame:
        """The columns the chain uses, each distinct combination once."""
        names = {w.split(".", 1)[1] for w in wanted if w.split(".", 1)[0] == link.name} | {link.right}
        return link.table.select(*[F.col(n).alias(held(f"{link.name}.{n}")) for n in sorted(names)]).distinct()

    resolved = reduced(first)
    for link in others:
        # rows of one key that agree in all that is used are one row, and a hot key is spread
        right = reduced(link).withColumn("__meet", F.col(held(f"{link.name}.{link.right}")))
        left = resolved.withColumn("__meet", F.col(held(link.left))).where("__meet IS NOT NULL")
        resolved = lookup_join(left, right, "__meet", "inner").drop("__meet")
    lookup = resolved.select(
        F.col(held(f"{first.name}.{first.right}")).alias("__key"),
        *[F.col(held(source)).alias(f"__from_{target}") for target, source in columns.items()],
        F.col(held(tie)).alias("__tie"),
    )
    guard = None
    if only_null:
        guard = F.lit(True)
        for target in columns:
            guard = guard & F.col(target).isNull()
    sources = {target: f"__from_{target}" for target in columns}
    return update_from(df, lookup, {first.left: "__key"}, sources, guard, tie=["__tie"])


def precheck_count(
    fact: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    fact_where: Column | None = None,
    dim_where: Column | None = None,
    out: str = "n",
) -> DataFrame:
    """How many joined rows satisfy both predicates.

    Both sides are counted per key before they meet, so the join moves one row
    per key however often a key occurs.
    """
    left = fact if fact_where is None else fact.where(fact_where)
    right = dim if dim_where is None else dim.where(dim_where)
    left = left.groupBy(F.col(on[0]).alias("__key")).agg(F.count(F.lit(1)).alias("__left"))
    right = right.groupBy(F.col(on[1]).alias("__key")).agg(F.count(F.lit(1)).alias("__right"))
    pairs = left.join(right, "__key")
    return pairs.agg(F.coalesce(F.sum(F.col("__left") * F.col("__right")), F.lit(0)).alias(out))


def expand_relation(
    rows: DataFrame,
    relation: DataFrame,
    on: tuple[str, str],
    when: Column,
    pair: Mapping[str, str],
) -> DataFrame:
    """One bridge row per child of each qualifying row.

    ``pair`` maps the two output columns to a column of `rows` and one of
    `relation`.
    """
    (left_out, left), (right_out, right) = pair.items()
    chosen = rows.where(when).select(F.col(on[0]).alias("__on"), F.col(left).alias(left_out))
    children = relation.select(F.col(on[1]).alias("__on"), F.col(right).alias(right_out))
    return lookup_join(children, chosen, "__on", "inner").select(left_out, right_out).distinct()


def remap_bridge(
    bridge: DataFrame, column: str, mapping: DataFrame, old: str, new: str, out: str | None = None
) -> DataFrame:
    """Replace one foreign key of a bridge by its new id; rows without one vanish."""
    out = out or column
    ids = mapping.select(F.col(old).alias(column), F.col(new).alias("__new")).dropna().distinct()
    joined = lookup_join(bridge, ids, column, "inner")
    return joined.select(
        *[F.col("__new").alias(out) if c == column else F.col(c) for c in bridge.columns]
    ).distinct()


def children_of(df: DataFrame, row_id: str, parent: str, keep: Sequence[str] = ()) -> DataFrame:
    """Every (parent_id, child_id) edge whose parent exists, with columns of the parent."""
    children = df.select(F.col(parent).alias("parent_id"), F.col(row_id).alias("child_id"))
    parents = df.select(F.col(row_id).alias("parent_id"), *keep)
    return lookup_join(children.dropna(), parents, "parent_id", "inner")


def child_lists(df: DataFrame, row_id: str, parent: str, entries: int = 1000) -> DataFrame:
    """The sorted children of each parent, in pieces of at most `entries`."""
    return collect_in_pieces(children_of(df, row_id, parent), "parent_id", "child_id", "children", entries=entries)


def dependents(
    items: DataFrame, name: str, dependencies: DataFrame, owner: str, needs: str, where: Column | None = None
) -> DataFrame:
    """For each item the owners that need it; items nobody needs are kept with NULL.

    `dependencies` holds one row per (owner, needed item); `where` selects the
    owners that count.
    """
    edges = dependencies if where is None else dependencies.where(where)
    edges = edges.select(F.col(needs).alias(name), F.col(owner).alias("dependent")).distinct()
    wanted = items.select(name).distinct()
    found = lookup_join(edges, wanted, name, "left_semi")
    idle = wanted.join(found.select(name).distinct(), name, "left_anti")
    return found.unionByName(idle.withColumn("dependent", F.lit(None).cast(found.schema["dependent"].dataType)))


def absent_from_manifest(
    df: DataFrame, name: str, manifest: DataFrame, path: str, state: str, installed: str = "installed"
) -> DataFrame:
    """Rows without an entry in the manifest, marked caution (in use) or safe (deletable)."""
    present = manifest.select(F.col(path).alias(name))
    verdict = F.when(F.col(state) == installed, "caution").otherwise("safe")
    return missing_in_target(df, present, name).withColumn("verdict", verdict)


def drop_safe(df: DataFrame, row_id: str, absent: DataFrame) -> DataFrame:
    """Delete the rows marked safe; the cautious ones stay for a person to decide."""
    safe = absent.where(F.col("verdict") == "safe").select(row_id).distinct()
    return lookup_join(df, safe, row_id, "left_anti").select(*df.columns)


def expected_missing(df: DataFrame, name: Column, actual: DataFrame, column: str, out: str = "expected") -> DataFrame:
    """Rows whose derived object name does not exist."""
    named = df.withColumn(out, name)
    found = actual.select(F.col(column).alias(out)).distinct()
    return lookup_join(named, found, out, "left_anti").select(*named.columns)


def expected_present(df: DataFrame, name: Column, actual: DataFrame, column: str, out: str = "expected") -> DataFrame:
    """Rows whose derived object name exists."""
    named = df.withColumn(out, name)
    found = actual.select(F.col(column).alias(out)).distinct()
    return lookup_join(named, found, out, "left_semi").select(*named.columns)
