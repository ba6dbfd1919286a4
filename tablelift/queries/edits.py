"""Reading, updates, deletes and schema changes."""

from pyspark.sql import functions as F

from tablelift.functions import build_label, json_localised, json_scalar, shorten
from tablelift.operators import edit
from tablelift.queries.registry import query, table
from tablelift.sources import has_column, read_declared, run_if


@query(
    "scan_declared",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'""",
)
def scan_declared(spark, sf):
    declared = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
    rows = read_declared(spark, f"{sf}/orders.parquet", declared)
    return rows.where(F.col("o_orderstatus") != "P").select("o_orderkey", "o_custkey", "o_orderstatus")


@query(
    "run_if_present",
    """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, 'present' AS branch FROM orders
       UNION ALL SELECT o_orderkey, o_orderpriority, 'absent' AS branch FROM orders""",
)
def run_if_present(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")

    def step(df):
        return edit.nullify(df, "o_orderpriority", "5-LOW")

    present = run_if(has_column(orders, "o_orderpriority"), step, orders)
    absent = run_if(has_column(orders, "legacy_priority"), step, orders)
    return present.withColumn("branch", F.lit("present")).unionByName(absent.withColumn("branch", F.lit("absent")))


@query("set_constant", """SELECT c_custkey, c_name, 'INACTIVE' AS c_mktsegment FROM customer""")
def set_constant(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return edit.set_constant(customer, "c_mktsegment", "INACTIVE")


@query(
    "backup_column",
    """SELECT c_custkey, 'INACTIVE' AS c_mktsegment, c_mktsegment AS segment_bkp FROM customer""",
)
def backup_column(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    kept = edit.backup_column(customer, "c_mktsegment", "segment_bkp")
    return edit.set_constant(kept, "c_mktsegment", "INACTIVE")


@query(
    "update_where",
    """SELECT o_orderkey,
              CASE WHEN nullif(o_orderstatus, 'F') = 'O' THEN 'installed' ELSE o_orderstatus END AS o_orderstatus,
              CASE WHEN nullif(o_orderstatus, 'F') = 'O' THEN o_orderstatus ELSE o_orderpriority END AS o_orderpriority
       FROM orders""",
)
def update_where(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    pending = F.nullif(F.col("o_orderstatus"), F.lit("F")) == "O"
    return edit.update_where(
        orders, pending, {"o_orderstatus": "installed", "o_orderpriority": F.col("o_orderstatus")}
    )


@query(
    "update_by_keys",
    """SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
                               THEN '0-RETURNED' ELSE o_orderpriority END AS o_orderpriority
       FROM orders""",
)
def update_by_keys(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    returned = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return edit.update_by_keys(orders, "o_orderkey", returned, {"o_orderpriority": "0-RETURNED"})


@query(
    "placeholder_rename",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'MIGRATED-' || event_id ELSE event_type END AS event_type
       FROM events""",
)
def placeholder_rename(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    return edit.placeholder_rename(events, "event_type", "error", "MIGRATED-", "event_id")


@query(
    "delete_where",
    """SELECT event_id, event_type FROM events
       WHERE NOT coalesce(nullif(event_type, 'click') = 'view', false)""",
)
def delete_where(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    return edit.delete_where(events, F.nullif(F.col("event_type"), F.lit("click")) == "view")


@query(
    "delete_like",
    """SELECT page_id, url FROM pages
       WHERE NOT coalesce(url LIKE '%.example.%/fr/%' OR url LIKE '%/e_/%?page=%'
                          OR (starts_with(url, 'https://m.') AND length(html) > 4000), false)""",
)
def delete_like(spark, sf):
    pages = table(spark, sf, "pages")
    extra = F.col("url").startswith("https://m.") & (F.length("html") > 4000)
    kept = edit.delete_like(pages, "url", ["%.example.%/fr/%", "%/e_/%?page=%"], extra)
    return kept.select("page_id", "url")


@query(
    "add_column",
    """SELECT p_partkey, p_brand, CAST(NULL AS VARCHAR) AS analytic_policy FROM part""",
)
def add_column(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    added = edit.add_column(part, "analytic_policy", "string")
    return edit.add_column(added, "p_brand", "string", if_absent=True)


@query("rename_column", """SELECT s_suppkey, s_name AS legacy_name FROM supplier""")
def rename_column(spark, sf):
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    renamed = edit.rename_column(supplier, "s_name", "legacy_name", if_present=True)
    return edit.rename_column(renamed, "barcode", "legacy_barcode", if_present=True)


@query("nullify", """SELECT p_partkey, nullif(p_type, 'ECONOMY') AS p_type FROM part""")
def nullify(spark, sf):
    return edit.nullify(table(spark, sf, "part").select("p_partkey", "p_type"), "p_type", "ECONOMY")


@query(
    "build_label",
    """SELECT p_partkey, p_brand || '/' || coalesce(nullif(p_type, 'ECONOMY'), 'POS') || '/' AS prefix,
              nullif(p_type, 'PROMO') || ' Picking' AS label FROM part""",
)
def build_label_query(spark, sf):
    part = table(spark, sf, "part")
    kind = F.coalesce(F.nullif(F.col("p_type"), F.lit("ECONOMY")), F.lit("POS"))
    return part.select(
        "p_partkey",
        build_label(F.col("p_brand"), "/", kind, "/").alias("prefix"),
        build_label(F.nullif(F.col("p_type"), F.lit("PROMO")), " Picking").alias("label"),
    )


@query(
    "json_scalar",
    """SELECT page_id, CAST(to_json(url || ' "' || nullif(split_part(url, '/', 4), 'fr') || '" \\') AS VARCHAR) AS scalar,
              CASE WHEN url IS NULL THEN NULL ELSE '{"en_US":' || to_json(url) || '}' END AS localised FROM pages""",
)
def json_scalar_query(spark, sf):
    pages = table(spark, sf, "pages")
    language = F.nullif(F.split_part("url", F.lit("/"), F.lit(4)), F.lit("fr"))
    quoted = F.concat(F.col("url"), F.lit(' "'), language, F.lit('" \\'))
    return pages.select(
        "page_id", json_scalar(quoted).alias("scalar"), json_localised(F.col("url"), "en_US").alias("localised")
    )


@query(
    "bump_counters",
    """SELECT s_suppkey, s_name,
              CAST(CASE WHEN s_name ILIKE '%SUPPLIER%5' THEN s_nationkey + 1 ELSE s_nationkey END AS BIGINT) AS next
       FROM supplier""",
)
def bump_counters(spark, sf):
    counters = table(spark, sf, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").cast("long").alias("next"))
    return edit.bump_counters(counters, "s_name", "%SUPPLIER%5", "next")


@query(
    "shorten",
    """SELECT doc_id, left(text, 100) AS head, left(text, 500) AS longer FROM documents""",
)
def shorten_query(spark, sf):
    documents = table(spark, sf, "documents")
    return documents.select(
        "doc_id", shorten(F.col("text"), 100).alias("head"), shorten(F.col("text"), 500).alias("longer")
    )
