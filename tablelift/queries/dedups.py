"""Duplicate keys in parts (children: order lines) and in documents (a hierarchy)."""

from pyspark.sql import functions as F

from tablelift.operators import dedup
from tablelift.plans.cleanup import dedup_hierarchy
from tablelift.queries.registry import query, table


def preferred():
    return F.col("p_brand") == "Brand#1"


def part_losers(spark, sf):
    return dedup.losers_of(table(spark, sf, "part"), "p_name", "p_partkey", preferred())


LOSERS = """ranked AS (
        SELECT p_partkey, p_name, first_value(p_partkey) OVER (
                   PARTITION BY p_name ORDER BY CASE WHEN p_brand = 'Brand#1' THEN 0 ELSE 1 END, p_partkey) AS survivor_id
        FROM part WHERE p_name <> ''),
    losers AS (SELECT p_partkey AS loser_id, survivor_id FROM ranked WHERE p_partkey <> survivor_id)"""


@query(
    "duplicate_keys",
    """SELECT p_name, count(*) AS n, min(p_partkey) AS first_id, max(p_partkey) AS last_id
       FROM part WHERE p_name <> '' AND p_size > 10 GROUP BY p_name HAVING count(*) > 1""",
)
def duplicate_keys(spark, sf):
    return dedup.duplicate_keys(table(spark, sf, "part"), "p_name", "p_partkey", F.col("p_size") > 10)


@query(
    "duplicate_line_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n, min(l_partkey) AS first_id, max(l_partkey) AS last_id
       FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_line_keys(spark, sf):
    return dedup.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_partkey")


@query(
    "duplicate_members",
    """SELECT p_name, p_partkey, n FROM (SELECT p_name, p_partkey, count(*) OVER (PARTITION BY p_name) AS n
                                         FROM part WHERE p_name <> '') WHERE n > 1""",
)
def duplicate_members(spark, sf):
    return dedup.duplicate_members(table(spark, sf, "part"), "p_name", "p_partkey")


@query(
    "duplicate_lists",
    """WITH keys AS (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1),
       numbered AS (SELECT p_name, p_partkey,
                           (row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) - 1) // 5 AS piece
                    FROM part WHERE p_name IN (SELECT p_name FROM keys))
       SELECT p_name, piece, count(*) AS n, string_agg(p_partkey, ',' ORDER BY p_partkey) AS ids
       FROM numbered GROUP BY p_name, piece""",
)
def duplicate_lists(spark, sf):
    lists = dedup.duplicate_lists(table(spark, sf, "part"), "p_name", "p_partkey", entries=5)
    return lists.withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))


@query(
    "pick_survivor",
    f"WITH {LOSERS} SELECT p_name, count(*) AS n, any_value(survivor_id) AS survivor_id FROM ranked GROUP BY p_name HAVING count(*) > 1",
)
def pick_survivor(spark, sf):
    return dedup.pick_survivor(table(spark, sf, "part"), "p_name", "p_partkey", preferred())


@query(
    "redirect_children",
    f"""WITH {LOSERS} SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(survivor_id, l_partkey) AS l_partkey
        FROM lineitem LEFT JOIN losers ON loser_id = l_partkey""",
)
def redirect_children(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return dedup.redirect_children(lines, "l_partkey", part_losers(spark, sf), "l_orderkey").children


@query(
    "redirect_log",
    f"""WITH {LOSERS} SELECT l_orderkey AS child_id, l_partkey AS from_id, survivor_id AS to_id, true AS done
        FROM lineitem JOIN losers ON loser_id = l_partkey""",
)
def redirect_log(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return dedup.redirect_children(lines, "l_partkey", part_losers(spark, sf), "l_orderkey").log


HELD = "l_returnflag = 'N' AND l_quantity > 48"


def _one_run(spark, sf):
    """Redirect, then delete: lines that are held keep hanging below their losers, which therefore stay."""
    lines = table(spark, sf, "lineitem")
    losers = part_losers(spark, sf)
    free = lines.where(f"NOT ({HELD})").select("l_orderkey", "l_partkey")
    moved = dedup.redirect_children(free, "l_partkey", losers, "l_orderkey")
    held = lines.where(HELD).select("l_orderkey", "l_partkey")
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    below = moved.children.unionByName(held)
    return part, moved, dedup.delete_losers(part, "p_partkey", moved.losers, below, "l_partkey")


@query(
    "delete_losers",
    f"""WITH {LOSERS} SELECT p_partkey, p_name FROM part
        WHERE p_partkey NOT IN (SELECT loser_id FROM losers)
           OR p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'N' AND l_quantity > 48)""",
)
def delete_losers(spark, sf):
    return _one_run(spark, sf)[2].rows


@query(
    "delete_failures",
    f"""WITH {LOSERS} SELECT loser_id AS id, 'Still has ' || count(*) || ' children' AS reason
        FROM losers JOIN lineitem ON l_partkey = loser_id WHERE l_returnflag = 'N' AND l_quantity > 48 GROUP BY loser_id""",
)
def delete_failures(spark, sf):
    return _one_run(spark, sf)[2].failures


@query(
    "dedup_summary",
    f"""WITH {LOSERS}, held AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'N' AND l_quantity > 48),
        rest AS (SELECT * FROM part WHERE p_partkey NOT IN (SELECT loser_id FROM losers) OR p_partkey IN (SELECT * FROM held))
        SELECT (SELECT count(*) FROM part) - (SELECT count(*) FROM rest) AS deleted,
               (SELECT count(*) FROM losers WHERE loser_id IN (SELECT * FROM held)) AS failed,
               (SELECT count(*) FROM lineitem JOIN losers ON loser_id = l_partkey
                WHERE NOT (l_returnflag = 'N' AND l_quantity > 48)) AS redirected,
               (SELECT count(*) FROM (SELECT p_name FROM rest GROUP BY p_name HAVING count(*) > 1)) AS remaining""",
)
def dedup_summary(spark, sf):
    part, moved, deleted = _one_run(spark, sf)
    return dedup.dedup_summary(part, deleted, moved.log, "p_name", "p_partkey")


def document_tree(spark, sf):
    """Documents keyed by their text, hanging below the document of half their number."""
    return table(spark, sf, "documents").select(
        "doc_id",
        F.md5("text").alias("key"),
        F.nullif(F.floor(F.col("doc_id") / 2), F.col("doc_id")).alias("parent_id"),
        F.col("lang"),
    )


ROUNDS = 6  # more than these tables need


def _round(n: int) -> str:
    """One round in SQL: redirects whose moved child can reach itself through the new pointers fail."""
    failed = " UNION ".join(["SELECT -1", *[f"SELECT loser FROM looped{k}" for k in range(n)]])
    return f"""good{n} AS (SELECT * FROM lost WHERE loser NOT IN ({failed})),
    moved{n} AS (SELECT id, key, parent_id AS was, coalesce(survivor, parent_id) AS parent_id FROM base LEFT JOIN good{n} ON loser = parent_id),
    walk{n}(start, node) AS (SELECT id, parent_id FROM moved{n} WHERE was IS DISTINCT FROM parent_id
                             UNION SELECT w.start, m.parent_id FROM walk{n} w JOIN moved{n} m ON m.id = w.node WHERE m.parent_id IS NOT NULL),
    looped{n} AS (SELECT DISTINCT was AS loser FROM moved{n} WHERE id IN (SELECT start FROM walk{n} WHERE start = node))"""


def _tree(base: str) -> str:
    """SQL for a hierarchy (id, key, parent_id, preferred): its redirects in rounds, until none closes a loop."""
    rounds = ",\n    ".join(_round(n) for n in range(ROUNDS))
    return f"""base AS ({base}),
    ranked AS (SELECT *, first_value(id) OVER (PARTITION BY key ORDER BY CASE WHEN preferred THEN 0 ELSE 1 END, id) AS survivor FROM base),
    lost AS (SELECT id AS loser, survivor FROM ranked WHERE id <> survivor),
    {rounds},
    good AS (SELECT * FROM good{ROUNDS - 1} WHERE loser NOT IN (SELECT loser FROM looped{ROUNDS - 1})),
    moved AS (SELECT id, key, coalesce(survivor, parent_id) AS parent_id FROM base LEFT JOIN good ON loser = parent_id)"""


TREE = _tree("SELECT doc_id AS id, md5(text) AS key, nullif(doc_id // 2, doc_id) AS parent_id, lang = 'en' AS preferred FROM documents")


@query(
    "dedup_hierarchy",
    f"WITH RECURSIVE {TREE} SELECT id AS doc_id, key, parent_id FROM moved WHERE id NOT IN (SELECT loser FROM good)",
)
def dedup_hierarchy_query(spark, sf):
    done = dedup_hierarchy(document_tree(spark, sf), "key", "doc_id", "parent_id", F.col("lang") == "en")
    return done.rows.select("doc_id", "key", "parent_id")


DEEP = _tree(
    """SELECT c_custkey AS id, c_nationkey || '|' || (c_custkey % 13) AS key, nullif(c_custkey // 2, 0) AS parent_id,
              c_acctbal > 7000 AS preferred FROM customer"""
)


@query(
    "dedup_hierarchy_deep",
    f"WITH RECURSIVE {DEEP} SELECT id, key, parent_id FROM moved WHERE id NOT IN (SELECT loser FROM good)",
)
def dedup_hierarchy_deep(spark, sf):
    """Customers below the customer of half their number: many survivors lie somewhere below a loser."""
    tree = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat_ws("|", F.col("c_nationkey").cast("string"), (F.col("c_custkey") % 13).cast("string")).alias("key"),
        F.nullif(F.floor(F.col("c_custkey") / 2), F.lit(0)).alias("parent_id"),
        (F.col("c_acctbal") > 7000).alias("preferred"),
    )
    return dedup_hierarchy(tree, "key", "id", "parent_id", F.col("preferred")).rows.select("id", "key", "parent_id")
