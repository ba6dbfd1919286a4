"""Reconciliation, updates from other tables, bridges and hierarchies."""

from pyspark.sql import functions as F

from tablelift.functions import counter_name
from tablelift.operators import joins
from tablelift.plans.preflight import class_counts, missing_by_class
from tablelift.queries.registry import query, table
from tablelift.sources import apply_mirror, change_catalog, invalid_changes, mirror_plan


def label_changes(spark, sf):
    """Change lists made from the labelled documents: label = version, length = kind."""
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    version = (
        F.when((F.col("quality") == 0) & (F.col("toxic") == 1), 15)
        .when(F.col("quality") == 0, 16)
        .when(F.col("toxic") == 1, 17)
        .otherwise(18)
    )
    kind = F.when(F.col("n_chars") < 700, "obsolete").when(F.col("n_chars") < 900, "merged").otherwise("renamed")
    return documents.join(labels, "doc_id").select(
        version.alias("version"),
        kind.alias("kind"),
        F.col("doc_id").alias("ord"),
        F.concat("source", F.lit("-"), "lang").alias("old"),
        F.when(kind == "renamed", F.concat("source", F.lit("-new-"), F.col("doc_id"))).alias("new"),
    )


def missing_documents(spark, sf):
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    author = F.nullif(F.col("source"), F.lit("src1"))
    return joins.missing_in_target(
        documents.select("doc_id", "source", "lang", F.concat("source", F.lit("-"), "lang").alias("name")),
        labels,
        "doc_id",
        ~author.isin("src0"),
    )


MISSING = """
    SELECT doc_id, source, lang, source || '-' || lang AS name FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
      AND nullif(source, 'src1') NOT IN ('src0')"""

LABEL_CHANGES = """
    SELECT CASE WHEN quality = 0 AND toxic = 1 THEN 15 WHEN quality = 0 THEN 16
                WHEN toxic = 1 THEN 17 ELSE 18 END AS version,
           CASE WHEN n_chars < 700 THEN 'obsolete' WHEN n_chars < 900 THEN 'merged' ELSE 'renamed' END AS kind,
           d.doc_id AS ord, source || '-' || lang AS old,
           CASE WHEN n_chars >= 900 THEN source || '-new-' || d.doc_id END AS new
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id"""

CLASSIFIED = f"""
    WITH missing AS ({MISSING}), changes AS ({LABEL_CHANGES}),
    known AS (SELECT old, bool_or(kind = 'obsolete') AS obsolete, bool_or(kind = 'merged') AS merged,
                     arg_max(new, CAST(version AS BIGINT) * 1000000000 + ord) FILTER (kind = 'renamed') AS new
              FROM changes WHERE version > 14 AND version <= 17 GROUP BY old)
    SELECT doc_id, name,
           CASE WHEN obsolete THEN 'obsolete' WHEN merged THEN 'merged'
                WHEN new IS NOT NULL THEN 'renamed' ELSE 'missing' END AS class,
           CASE WHEN coalesce(obsolete, false) OR coalesce(merged, false) OR new IS NULL THEN name
                ELSE name || ' -> ' || new END AS label
    FROM missing LEFT JOIN known ON known.old = missing.name"""


def order_changes(spark, sf):
    """A change list as large as `orders`: status = kind, year = version."""
    orders = table(spark, sf, "orders")
    kind = (
        F.when(F.col("o_orderstatus") == "F", "obsolete")
        .when(F.col("o_orderstatus") == "P", "merged")
        .otherwise("renamed")
    )
    old = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "null").otherwise(
        F.concat(F.lit("cust-"), F.col("o_custkey"))
    )
    new = F.when(
        (kind == "renamed") & (F.col("o_orderpriority") != "5-LOW"), F.concat(F.lit("acct-"), F.col("o_orderkey"))
    )
    return orders.select(
        F.year("o_orderdate").alias("version"),
        kind.alias("kind"),
        F.col("o_orderkey").alias("ord"),
        old.alias("old"),
        new.alias("new"),
    )


ORDER_CHANGES = """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS version, o_orderkey AS ord,
           CASE o_orderstatus WHEN 'F' THEN 'obsolete' WHEN 'P' THEN 'merged' ELSE 'renamed' END AS kind,
           CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'null' ELSE 'cust-' || o_custkey END AS old,
           CASE WHEN o_orderstatus = 'O' AND o_orderpriority <> '5-LOW' THEN 'acct-' || o_orderkey END AS new
    FROM orders"""


@query(
    "change_catalog",
    f"""SELECT kind, old, arg_max(new, CAST(version AS BIGINT) * 1000000000 + ord) AS new FROM ({ORDER_CHANGES})
        WHERE version > 1995 AND version <= 2000 AND old NOT IN ('', 'null')
          AND (kind <> 'renamed' OR new IS NOT NULL)
        GROUP BY kind, old""",
)
def change_catalog_query(spark, sf):
    return change_catalog(order_changes(spark, sf), 1995, 2000)


@query(
    "invalid_changes",
    f"""SELECT version, kind, ord, old, new FROM ({ORDER_CHANGES})
        WHERE version > 1995 AND version <= 2000 AND kind = 'renamed' AND old NOT IN ('', 'null') AND new IS NULL""",
)
def invalid_changes_query(spark, sf):
    return invalid_changes(order_changes(spark, sf), 1995, 2000)


@query("missing_in_target", MISSING)
def missing_in_target(spark, sf):
    return missing_documents(spark, sf)


@query("classify_missing", CLASSIFIED)
def classify_missing(spark, sf):
    catalog = change_catalog(label_changes(spark, sf), 14, 17)
    return joins.classify(missing_documents(spark, sf).select("doc_id", "name"), catalog, "name")


@query("missing_class_counts", f"SELECT class, count(*) AS n FROM ({CLASSIFIED}) GROUP BY class")
def missing_class_counts(spark, sf):
    """The pre-flight question: what will not survive the move, and why?"""
    documents = table(spark, sf, "documents").select(
        "doc_id", "source", F.concat("source", F.lit("-"), "lang").alias("name")
    )
    author = F.nullif(F.col("source"), F.lit("src1"))
    missing = joins.missing_in_target(documents, table(spark, sf, "labels"), "doc_id", ~author.isin("src0"))
    return class_counts(joins.classify(missing, change_catalog(label_changes(spark, sf), 14, 17), "name"))


def preflight(spark, sf):
    """Customers against the change list made of their own orders."""
    customers = table(spark, sf, "customer").select(F.concat(F.lit("cust-"), F.col("c_custkey")).alias("name"))
    catalog = change_catalog(order_changes(spark, sf), 1995, 2000)
    target = table(spark, sf, "orders").where("o_orderstatus = 'P'")
    target = target.select(F.concat(F.lit("cust-"), F.col("o_custkey")).alias("name"))
    return class_counts(missing_by_class(customers, target, "name", catalog))


def mirror_tables(spark, sf):
    """Documents, and a copy that covers the labelled ones, is stale for some and has extras."""
    documents = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("print"))
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    stale = F.when(F.col("quality") == 0, F.concat("print", F.lit("*"))).otherwise(F.col("print"))
    copied = documents.join(labels, "doc_id").select("doc_id", stale.alias("print"))
    extras = table(spark, sf, "benchmark").select((-F.col("item_id") - 1).alias("doc_id"), F.md5("text").alias("print"))
    return documents, copied.unionByName(extras)


@query(
    "mirror_plan",
    """WITH src AS (SELECT doc_id, md5(text) AS p FROM documents),
       dst AS (SELECT s.doc_id, CASE WHEN quality = 0 THEN p || '*' ELSE p END AS p
               FROM src s JOIN labels l ON l.doc_id = s.doc_id
               UNION ALL SELECT -item_id - 1, md5(text) FROM benchmark)
       SELECT coalesce(src.doc_id, dst.doc_id) AS doc_id,
              CASE WHEN dst.doc_id IS NULL THEN 'copy' WHEN src.doc_id IS NULL THEN 'delete'
                   WHEN src.p = dst.p THEN 'keep' ELSE 'update' END AS action
       FROM src FULL JOIN dst ON src.doc_id = dst.doc_id""",
)
def mirror_plan_query(spark, sf):
    src, dst = mirror_tables(spark, sf)
    return mirror_plan(src, dst, "doc_id", "print")


@query("mirror_apply", """SELECT doc_id, md5(text) AS print FROM documents""")
def mirror_apply(spark, sf):
    src, dst = mirror_tables(spark, sf)
    return apply_mirror(src, dst, mirror_plan(src, dst, "doc_id", "print"), "doc_id")


@query(
    "delete_orphans",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE NOT coalesce(
           o_orderstatus = 'F' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
           AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'), false)""",
)
def delete_orphans(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    building = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    returned = table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    return joins.delete_orphans(
        orders,
        "o_orderkey",
        ("o_custkey", building, "c_custkey"),
        (returned, "l_orderkey"),
        F.col("o_orderstatus") == "F",
    )


@query(
    "not_in_with_null",
    """SELECT o_orderkey, o_custkey IN (SELECT nullif(c_nationkey, 7) FROM customer) AS listed FROM orders""",
)
def not_in_with_null(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    keys = table(spark, sf, "customer").select(F.nullif(F.col("c_nationkey"), F.lit(7)).cast("long").alias("key"))
    return joins.with_membership(orders, "o_custkey", keys, "key", "listed").drop("o_custkey")


@query(
    "update_from",
    """WITH first AS (SELECT l_orderkey, l_returnflag, l_partkey, row_number() OVER (
                          PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS rn
                      FROM lineitem)
       SELECT o_orderkey,
              CASE WHEN l_orderkey IS NOT NULL AND o_orderstatus <> 'P' THEN nullif(l_returnflag, 'A')
                   ELSE o_orderpriority END AS o_orderpriority,
              CASE WHEN l_orderkey IS NOT NULL AND o_orderstatus <> 'P' THEN l_partkey END AS partkey
       FROM orders LEFT JOIN first ON l_orderkey = o_orderkey AND rn = 1""",
)
def update_from(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return joins.update_from(
        orders,
        table(spark, sf, "lineitem"),
        {"o_orderkey": "l_orderkey"},
        {"o_orderpriority": F.nullif(F.col("l_returnflag"), F.lit("A")), "partkey": "l_partkey"},
        where=F.col("o_orderstatus") != "P",
        tie=["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"],
    ).drop("o_orderstatus")


CHAIN_LINKS = """FROM orders LEFT JOIN (customer JOIN nation ON n_nationkey = c_nationkey
                 JOIN region ON r_regionkey = n_regionkey AND r_name <> 'ASIA') ON c_custkey = o_custkey"""


def chain_links(spark, sf):
    region = table(spark, sf, "region").where("r_name <> 'ASIA'")
    return [
        joins.Link("c", table(spark, sf, "customer"), "o_custkey", "c_custkey"),
        joins.Link("n", table(spark, sf, "nation"), "c.c_nationkey", "n_nationkey"),
        joins.Link("r", region, "n.n_regionkey", "r_regionkey"),
    ]


@query(
    "update_chain",
    f"""SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), r_name) AS o_orderpriority {CHAIN_LINKS}""",
)
def update_chain(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    orders = orders.withColumn("o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    filled = joins.update_from_chain(
        orders, chain_links(spark, sf), {"o_orderpriority": "r.r_name"}, tie="c.c_custkey", only_null=True
    )
    return filled.drop("o_custkey")


@query(
    "update_chain_overwrite",
    f"""SELECT o_orderkey, coalesce(r_name, o_orderpriority) AS o_orderpriority,
               CASE WHEN r_name IS NOT NULL THEN c_mktsegment ELSE o_orderstatus END AS o_orderstatus {CHAIN_LINKS}""",
)
def update_chain_overwrite(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    columns = {"o_orderpriority": "r.r_name", "o_orderstatus": "c.c_mktsegment"}
    return joins.update_from_chain(orders, chain_links(spark, sf), columns, tie="c.c_custkey").drop("o_custkey")


@query(
    "remap_self_ref",
    """SELECT a.c_custkey, CASE WHEN b.c_custkey IS NULL THEN a.c_custkey ELSE b.c_custkey + 1000000 END AS new_ref
       FROM customer a LEFT JOIN (SELECT c_custkey FROM customer) b ON b.c_custkey = nullif(a.c_nationkey, 3)""",
)
def remap_self_ref(spark, sf):
    customer = table(spark, sf, "customer").select(
        "c_custkey",
        F.nullif(F.col("c_nationkey"), F.lit(3)).cast("long").alias("old_ref"),
        (F.col("c_custkey") + 1000000).alias("new_id"),
        F.col("c_custkey").alias("new_ref"),
        F.col("c_custkey").alias("old_id"),
    )
    return joins.remap_self_reference(customer, "old_ref", "old_id", "new_id", "new_ref").select("c_custkey", "new_ref")


@query(
    "precheck_count",
    """SELECT count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey
       WHERE l_returnflag IN ('R', 'A') AND o_orderstatus IN ('F', 'O')""",
)
def precheck_count(spark, sf):
    return joins.precheck_count(
        table(spark, sf, "lineitem"),
        table(spark, sf, "orders"),
        ("l_orderkey", "o_orderkey"),
        F.col("l_returnflag").isin("R", "A"),
        F.col("o_orderstatus").isin("F", "O"),
    )


@query(
    "expand_relation",
    """SELECT DISTINCT s_suppkey + 100000 AS line_id, l_partkey AS part_id
       FROM supplier JOIN lineitem ON l_suppkey = s_suppkey WHERE s_acctbal > 0""",
)
def expand_relation(spark, sf):
    suppliers = table(spark, sf, "supplier").withColumn("new_id", F.col("s_suppkey") + 100000)
    return joins.expand_relation(
        suppliers,
        table(spark, sf, "lineitem"),
        ("s_suppkey", "l_suppkey"),
        F.col("s_acctbal") > 0,
        {"line_id": "new_id", "part_id": "l_partkey"},
    )


@query(
    "remap_bridge",
    """SELECT DISTINCT s_suppkey + 100000 AS line_id, l_partkey
       FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal > 0""",
)
def remap_bridge(spark, sf):
    bridge = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey")
    migrated = table(spark, sf, "supplier").where("s_acctbal > 0")
    mapping = migrated.select("s_suppkey", (F.col("s_suppkey") + 100000).alias("new_id"))
    return joins.remap_bridge(bridge, "l_suppkey", mapping, "s_suppkey", "new_id", "line_id")


@query(
    "children_of",
    """SELECT p.event_id AS parent_id, c.event_id AS child_id, p.event_type
       FROM events c JOIN events p ON p.event_id = c.user_id""",
)
def children_of(spark, sf):
    events = table(spark, sf, "events")
    return joins.children_of(events, "event_id", "user_id", ["event_type"])


@query(
    "child_lists",
    """WITH numbered AS (SELECT user_id AS parent_id, event_id,
                                (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 10 AS piece
                         FROM events WHERE user_id IN (SELECT event_id FROM events))
       SELECT parent_id, piece, count(*) AS n, string_agg(event_id, ',' ORDER BY event_id) AS children
       FROM numbered GROUP BY parent_id, piece""",
)
def child_lists(spark, sf):
    lists = joins.child_lists(table(spark, sf, "events"), "event_id", "user_id", entries=10)
    return lists.withColumn("children", F.array_join(F.col("children").cast("array<string>"), ","))


@query(
    "dependents",
    """SELECT p_partkey, l_suppkey AS dependent
       FROM (SELECT p_partkey FROM part WHERE p_size <= 10) LEFT JOIN
            (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag = 'A') d
            ON l_partkey = p_partkey""",
)
def dependents(spark, sf):
    return joins.dependents(
        table(spark, sf, "part").where("p_size <= 10"),
        "p_partkey",
        table(spark, sf, "lineitem"),
        "l_suppkey",
        "l_partkey",
        (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "A"),
    )


@query(
    "absent_from_manifest",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN 'caution' ELSE 'safe' END AS verdict
       FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def absent_from_manifest(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, sf, "lineitem")
    return joins.absent_from_manifest(orders, "o_orderkey", lines, "l_orderkey", "o_orderstatus", "O")


@query(
    "drop_safe",
    """SELECT o_orderkey, o_orderstatus FROM orders
       WHERE o_orderstatus = 'O' OR EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def drop_safe(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return joins.drop_safe(orders, "o_orderkey", absent_from_manifest(spark, sf))


def named_objects(spark, sf):
    """The objects that exist: one per part that was ever returned in bulk."""
    lines = table(spark, sf, "lineitem").where("l_returnflag = 'R' AND l_quantity > 40")
    return lines.select(F.concat(F.lit("part_"), F.format_string("%03d", "l_partkey")).alias("relname"))


EXPECTED = """SELECT p_partkey, 'part_' || printf('%03d', p_partkey) AS expected FROM part WHERE {} IN
              (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40)"""


@query("expected_missing", EXPECTED.format("p_partkey NOT"))
def expected_missing(spark, sf):
    part = table(spark, sf, "part").select("p_partkey")
    return joins.expected_missing(part, counter_name("part_", F.col("p_partkey")), named_objects(spark, sf), "relname")


@query("expected_present", EXPECTED.format("p_partkey"))
def expected_present(spark, sf):
    part = table(spark, sf, "part").select("p_partkey")
    return joins.expected_present(part, counter_name("part_", F.col("p_partkey")), named_objects(spark, sf), "relname")


@query(
    "expected_truncated",
    """SELECT p_partkey, 'part_' || lpad(CAST(p_partkey AS VARCHAR), 3, '0') AS expected FROM part
       WHERE 'part_' || lpad(CAST(p_partkey AS VARCHAR), 3, '0') NOT IN
             (SELECT 'part_' || printf('%03d', l_partkey) FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40)""",
)
def expected_truncated(spark, sf):
    """The same with names cut to three digits, where distinct ids collide."""
    part = table(spark, sf, "part").select("p_partkey")
    name = counter_name("part_", F.col("p_partkey"), truncate=True)
    return joins.expected_missing(part, name, named_objects(spark, sf), "relname")


@query(
    "preflight_customers",
    f"""WITH known AS (SELECT old, bool_or(kind = 'obsolete') AS obsolete, bool_or(kind = 'merged') AS merged,
                              max(new) FILTER (kind = 'renamed' AND new IS NOT NULL) AS new
                       FROM ({ORDER_CHANGES})
                       WHERE version > 1995 AND version <= 2000 AND old <> 'null'
                         AND (kind <> 'renamed' OR new IS NOT NULL) GROUP BY old)
        SELECT CASE WHEN obsolete THEN 'obsolete' WHEN merged THEN 'merged'
                    WHEN new IS NOT NULL THEN 'renamed' ELSE 'missing' END AS class, count(*) AS n
        FROM customer LEFT JOIN known ON old = 'cust-' || c_custkey
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1""",
)
def preflight_customers(spark, sf):
    return preflight(spark, sf)
