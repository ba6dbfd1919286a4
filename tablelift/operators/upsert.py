"""Inserts, replacements, renames and merges that are safe to run again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.functions import is_true
from tablelift.operators.chains import merges_from, renames_from
from tablelift.operators.edit import delete_where
from tablelift.operators.joins import one_per_key, update_from
from tablelift.operators.sequence import surrogate_keys
from tablelift.scale import as_list, listed_frame, lookup_join


def _literal(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _cast_like(df: DataFrame, values: Mapping[str, Any]) -> list[Column]:
    """The values in the column order and types of `df`, NULL where none is given."""
    return [_literal(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]


def append_mapped(
    target: DataFrame,
    source: DataFrame,
    mapping: Mapping[str, Any],
    row_id: str,
    source_id: str,
    old_id: str,
) -> DataFrame:
    """Append source rows under new ids, keeping their old id in `old_id`.

    ``mapping`` gives target columns as columns or constants of the source.
    Rows whose old id is already in the target are left out, so a second run
    adds nothing.
    """
    if old_id in target.columns:
        migrated = target.select(F.col(old_id).cast(source.schema[source_id].dataType).alias(source_id))
        fresh = lookup_join(source, migrated.dropna().distinct(), source_id, "left_anti")
    else:
        fresh = source
    chosen = fresh.select(
        *[_literal(value).alias(column) for column, value in mapping.items()],
        F.col(source_id).alias(old_id),
    )
    numbered = surrogate_keys(chosen, [old_id], row_id, after=target)
    types = {f.name: f.dataType for f in target.schema.fields}
    numbered = numbered.select(
        *[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in numbered.columns]
    )
    return target.unionByName(numbered, allowMissingColumns=True)


def insert_ignore(
    target: DataFrame, rows: DataFrame, key: str | Sequence[str], order: Sequence[Column | str] | None = None
) -> DataFrame:
    """Insert rows whose key is not taken, one per key (the first by `order`).

    As in SQL a key with a NULL conflicts with nothing.
    """
    keys = as_list(key)
    open_key = F.lit(False)
    for k in keys:
        open_key = open_key | F.col(k).isNull()
    closed = rows.where(~open_key)
    if set(keys) == set(rows.columns):
        single = closed.distinct()
    else:
        single = one_per_key(closed, keys, order or [c for c in rows.columns if c not in keys])
    fresh = lookup_join(single, target.select(*keys).distinct(), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns)).unionByName(
        rows.where(open_key).select(*target.columns)
    )


def replace_by_key(target: DataFrame, rows: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Delete the rows with these keys, then insert the new ones."""
    keys = as_list(key)
    kept = lookup_join(target, rows.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*target.columns).unionByName(rows.select(*target.columns))


def replace_slice(
    target: DataFrame, column: str, slice_keys: DataFrame, rows: DataFrame, key: str | Sequence[str]
) -> DataFrame:
    """Empty the slice of the given parents, then insert their new rows once each.

    `slice_keys` is a one-column table of parents.
    """
    doomed = slice_keys.toDF(column).dropna().distinct()
    kept = lookup_join(target, doomed, column, "left_anti").select(*target.columns)
    return insert_ignore(kept, rows, key)


def ensure_row(df: DataFrame, predicate: Column, default: Mapping[str, Any], row_id: str) -> DataFrame:
    """Insert the default row, under the next free id, only if no row matches."""
    spark = df.sparkSession
    facts = df.agg(
        F.coalesce(F.bool_or(predicate), F.lit(False)).alias("present"),
        (F.coalesce(F.max(row_id), F.lit(0)) + 1).alias("next"),
    )
    values = {**default, row_id: facts.select("next").scalar()}
    row = spark.range(1).where(~facts.select("present").scalar()).select(*_cast_like(df, values))
    return df.unionByName(row)


def matching_id(df: DataFrame, predicate: Column, row_id: str) -> Column:
    """The lowest id among matching rows as a scalar column, NULL if none matches."""
    return df.where(predicate).agg(F.min(row_id).alias("id")).scalar()


def _next_id(df: DataFrame, row_id: str) -> Column:
    """The next free id as a scalar column."""
    return df.agg((F.coalesce(F.max(row_id), F.lit(0)) + 1).alias("next")).scalar()


def set_setting(
    settings: DataFrame,
    key: str,
    name: str,
    value: Column,
    column: str,
    defaults: Mapping[str, Any] | None = None,
    row_id: str | None = None,
) -> DataFrame:
    """Replace one key of a key/value table; the value may be a scalar subquery.

    `defaults` fill the other columns of the new row (dates, say), and with
    `row_id` it gets the next free id.
    """
    spark = settings.sparkSession
    values = {**(defaults or {}), key: name, column: value}
    if row_id:
        values[row_id] = _next_id(settings, row_id)
    row = spark.range(1).select(*_cast_like(settings, values))
    return delete_where(settings, F.col(key) == name).unionByName(row)


def retire_placeholder(
    df: DataFrame,
    placeholder: Column,
    real: Column,
    row_id: str,
    settings: DataFrame,
    key: str,
    name: str,
    column: str,
    defaults: Mapping[str, Any] | None = None,
    setting_id: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Delete the placeholder and point the setting at the real row instead.

    Without a placeholder nothing changes.  Without a real row the setting
    becomes NULL.  The new setting is a whole row, as in `set_setting`.
    Returns the table and the settings.
    """
    spark = df.sparkSession
    found = df.agg(F.coalesce(F.bool_or(placeholder), F.lit(False)).alias("found")).scalar()
    kept = delete_where(df, placeholder)
    value = matching_id(kept, real, row_id)
    values = {**(defaults or {}), key: name, column: value}
    if setting_id:
        values[setting_id] = _next_id(settings, setting_id)
    row = spark.range(1).where(found).select(*_cast_like(settings, values))
    others = settings.where(~is_true((F.col(key) == name) & found))
    return kept, others.unionByName(row)


class Renamed(NamedTuple):
    tables: dict[str, DataFrame]
    collisions: DataFrame


Pairs = Sequence[tuple[str, str]] | DataFrame


def _present(master: DataFrame, column: str, pairs: Sequence[tuple[str, str]]) -> set[str]:
    """Which old names of a driver-held list occur in the master table: no more than the list has."""
    old = listed_frame(master.sparkSession, [(n,) for n in sorted({old for old, _ in pairs if old is not None})], "old string")
    names = master.select(F.col(column).alias("old"))
    return {row.old for row in lookup_join(names, old, "old", "left_semi").distinct().collect()}


def resolve_renames(pairs: Sequence[tuple[str, str]], present: set[str]) -> dict[str, str]:
    """Apply ordered pairs to a set of names; a pair counts only while its old name exists."""
    names, final = set(present), {}
    carriers: dict[str, list[str]] = {}  # first names by the name they have now
    for old, new in pairs:
        if old not in names or old == new or new is None:
            continue
        moved = carriers.pop(old, [])
        if old not in final:
            moved.append(old)
        final.update(dict.fromkeys(moved, new))
        carriers.setdefault(new, []).extend(moved)
        names.discard(old)
        names.add(new)
    return final


def _renames(master: DataFrame, column: str, pairs: Pairs) -> DataFrame | None:
    """(old, new) of every renamed name; None if a list of pairs renames nothing."""
    if isinstance(pairs, DataFrame):
        return renames_from(pairs, master.select(F.col(column).alias("old")))
    final = resolve_renames(pairs, _present(master, column, pairs))
    return listed_frame(master.sparkSession, sorted(final.items()), "old string, new string") if final else None


def _map_values(df: DataFrame, column: str, final: DataFrame) -> DataFrame:
    lookup = final.select(F.col("old").alias("__old"), F.col("new").alias("__final"))
    joined = lookup_join(df.withColumn("__old", F.col(column)), lookup, "__old")
    return joined.withColumn(column, F.coalesce("__final", column)).select(*df.columns)


def rename_cascade(
    tables: Mapping[str, DataFrame],
    columns: Mapping[str, str],
    master: str,
    pairs: Pairs,
) -> Renamed:
    """Apply ordered renames in a master table and in its dependants.

    ``columns`` names the column that holds the name in each table.  The pairs
    are resolved first, so each table is read once however many there are: a
    list in the driver, a table (ord, old, new) of any length by Spark.  Names
    that two master rows would share afterwards come back as `collisions`.
    """
    names, spark = columns[master], tables[master].sparkSession
    final = _renames(tables[master], names, pairs)
    if final is None:
        return Renamed(dict(tables), spark.createDataFrame([], "name string, n long"))
    renamed = {name: _map_values(df, columns[name], final) if name in columns else df for name, df in tables.items()}
    targets = final.select(F.col("new").alias("name")).distinct()
    after = renamed[master].select(F.col(names).alias("name"))
    collisions = lookup_join(after, targets, "name", "left_semi").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return Renamed(renamed, collisions.where("n > 1"))


class Merged(NamedTuple):
    tables: dict[str, DataFrame]
    dropped: DataFrame
    duplicate_links: DataFrame


def resolve_merges(pairs: Sequence[tuple[str, str]], present: set[str]) -> tuple[dict[str, list[str]], set[str]]:
    """Final namespaces with their members in order of precedence, and the names that are gone.

    A pair counts only while its old name exists in the master table.
    """
    names, order, gone = set(present), {}, set()
    for old, new in pairs:
        if old not in names or old == new or new is None:
            continue
        arriving = order.pop(old, [] if old in gone else [old])
        order.setdefault(new, [] if new in gone else [new]).extend(arriving)
        names.discard(old)
        gone.add(old)
    return order, gone


def _merges(master: DataFrame, column: str, pairs: Pairs) -> tuple[DataFrame, DataFrame] | None:
    """(member, target, rank) and the names (old) that are gone; None if a list of pairs merges nothing."""
    if isinstance(pairs, DataFrame):
        return merges_from(pairs, master.select(F.col(column).alias("old")))
    order, gone = resolve_merges(pairs, _present(master, column, pairs))
    if not gone:
        return None
    spark = master.sparkSession
    ranks = [(member, target, rank) for target, members in order.items() for rank, member in enumerate(members)]
    return listed_frame(spark, ranks, "member string, target string, rank long"), listed_frame(spark, [(g,) for g in sorted(gone)], "old string")


def merge_namespace(
    tables: Mapping[str, DataFrame],
    master: tuple[str, str],
    owned: tuple[str, str, str],
    links: tuple[str, str, Sequence[str]],
    pairs: Pairs,
) -> Merged:
    """Move everything of an old namespace into a new one, for ordered (old, new) pairs (list or table).

    ``master`` is (table, name column); its row of the old name disappears.
    ``owned`` is (table, namespace column, name column): a row whose name the
    new namespace already has is dropped, the rest is re-labelled.  ``links``
    is (table, name column, key columns); re-pointed links may end up double,
    which is reported and not repaired.

    All pairs are applied in one pass: each namespace gets a target and a rank,
    the target's own rows the lowest and later arrivals higher ranks, and of
    the rows sharing a name the lowest rank stays.
    """
    master_table, master_name = master
    owned_table, namespace, name = owned
    links_table, link_name, link_keys = links
    rows, linked = tables[owned_table], tables[links_table]
    found = _merges(tables[master_table], master_name, pairs)
    if found is None:
        double = linked.limit(0).groupBy(*link_keys).agg(F.count(F.lit(1)).alias("n"))
        return Merged(dict(tables), rows.limit(0), double)
    ranks, gone = found
    lookup = ranks.select(F.col("member").alias("__ns"), F.col("target").alias("__target"), F.col("rank").alias("__rank"))
    placed = lookup_join(rows.withColumn("__ns", F.col(namespace)), lookup, "__ns")
    affected = placed.where(F.col("__target").isNotNull())
    winners = affected.where(F.col(name).isNotNull()).groupBy("__target", name).agg(F.min("__rank").alias("__first"))
    judged = lookup_join(affected, winners, ["__target", name], "left")
    loses = F.col("__rank") > F.coalesce("__first", "__rank")
    kept = judged.where(~loses).withColumn(namespace, F.col("__target")).select(*rows.columns)
    dropped = judged.where(loses).select(*rows.columns)
    moved = placed.where(F.col("__target").isNull()).select(*rows.columns).unionByName(kept)

    final = ranks.where("member <> target").select(F.col("member").alias("old"), F.col("target").alias("new"))
    relinked = _map_values(linked, link_name, final)
    targets = final.select(F.col("new").alias(link_name)).distinct()
    double = lookup_join(relinked, targets, link_name, "left_semi").groupBy(*link_keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    removed = gone.select(F.col("old").alias(master_name))
    slim = lookup_join(tables[master_table], removed, master_name, "left_anti").select(*tables[master_table].columns)
    result = {**tables, master_table: slim, owned_table: moved, links_table: relinked}
    return Merged(result, dropped, double)


def ensure_dimension(
    fact: DataFrame,
    fact_id: str,
    foreign_key: str,
    dim: DataFrame,
    dim_id: str,
    make_row: Mapping[str, Any],
    context: DataFrame | None = None,
    order: Sequence[Column | str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Create a dimension row for every fact row without one and write its id back.

    Without one means NULL or 0.  ``make_row`` builds the dimension columns
    from the fact row and from `context`, a table joined on `fact_id`.  With
    several context rows each gets a dimension row and the fact points at the
    first.  Returns the fact table and the dimension table.
    """
    lacking = fact.where(F.col(foreign_key).isNull() | (F.col(foreign_key) == 0))
    if context is not None:
        lacking = lookup_join(lacking, context, fact_id, "inner")
    made = lacking.select(
        F.col(fact_id).alias("__fact"),
        *[_literal(v).alias(c) for c, v in make_row.items()],
        *[(F.col(o) if isinstance(o, str) else o).alias(f"__order_{i}") for i, o in enumerate(order or [])],
    )
    by = ["__fact", *[f"__order_{i}" for i in range(len(order or []))]]
    numbered = surrogate_keys(made, by, dim_id, after=dim)
    fresh = numbered.select(
        *[
            (F.col(f.name) if f.name in numbered.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in dim.schema.fields
        ]
    )
    first = numbered.groupBy(F.col("__fact").alias(fact_id)).agg(F.min(dim_id).alias("__made"))
    linked = update_from(fact, first, {fact_id: fact_id}, {"__made": "__made"}, unique=True)
    key = F.coalesce(F.col("__made").cast(fact.schema[foreign_key].dataType), F.col(foreign_key))
    return linked.withColumn(foreign_key, key).select(*fact.columns), dim.unionByName(fresh)
