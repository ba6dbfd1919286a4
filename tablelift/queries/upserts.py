"""Inserts, replacements, renames and merges."""

from pyspark.sql import functions as F

from tablelift.operators import upsert
from tablelift.queries.registry import query, table


@query(
    "append_mapped",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS BIGINT) AS old_suppkey FROM customer
       UNION ALL SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey),
                        s_name || ' (migrated)', s_nationkey, s_acctbal, 'SUPPLIER', s_suppkey FROM supplier""",
)
def append_mapped(spark, sf):
    mapping = {
        "c_name": F.concat("s_name", F.lit(" (migrated)")),
        "c_nationkey": F.col("s_nationkey"),
        "c_acctbal": F.col("s_acctbal"),
        "c_mktsegment": "SUPPLIER",
    }
    customer, supplier = table(spark, sf, "customer"), table(spark, sf, "supplier")
    return upsert.append_mapped(customer, supplier, mapping, "c_custkey", "s_suppkey", "old_suppkey")


@query(
    "append_mapped_rerun",
    """WITH first AS (SELECT c_custkey, c_name, CAST(NULL AS BIGINT) AS old_suppkey FROM customer
           UNION ALL SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey),
                            s_name, s_suppkey FROM supplier WHERE s_acctbal > 0)
       SELECT * FROM first UNION ALL
       SELECT (SELECT max(c_custkey) FROM first) + row_number() OVER (ORDER BY s_suppkey), s_name, s_suppkey
       FROM supplier WHERE NOT s_acctbal > 0""",
)
def append_mapped_rerun(spark, sf):
    """A second run over all suppliers adds only those the first run left out."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    supplier = table(spark, sf, "supplier")
    mapping = {"c_name": F.col("s_name")}
    first = upsert.append_mapped(
        customer, supplier.where("s_acctbal > 0"), mapping, "c_custkey", "s_suppkey", "old_suppkey"
    )
    return upsert.append_mapped(first, supplier, mapping, "c_custkey", "s_suppkey", "old_suppkey")


@query(
    "insert_ignore",
    """WITH rows AS (SELECT doc_id // 2 AS doc_id, CAST(n_chars < 1000 AS INT) AS quality,
                            CAST(lang = 'de' AS INT) AS toxic FROM documents),
       single AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY quality, toxic) AS rn FROM rows)
       SELECT doc_id, quality, toxic FROM labels UNION ALL
       SELECT doc_id, quality, toxic FROM single
       WHERE rn = 1 AND doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def insert_ignore(spark, sf):
    rows = table(spark, sf, "documents").select(
        F.floor(F.col("doc_id") / 2).alias("doc_id"),
        (F.col("n_chars") < 1000).cast("int").alias("quality"),
        (F.col("lang") == "de").cast("int").alias("toxic"),
    )
    return upsert.insert_ignore(table(spark, sf, "labels"), rows, "doc_id", ["quality", "toxic"])


@query(
    "replace_by_key",
    """WITH rows AS (SELECT doc_id, CAST(2 AS INT) AS quality, CAST(n_chars > 1000 AS INT) AS toxic
                     FROM documents WHERE lang = 'fr')
       SELECT * FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM rows) UNION ALL SELECT * FROM rows""",
)
def replace_by_key(spark, sf):
    french = table(spark, sf, "documents").where("lang = 'fr'")
    rows = french.select(
        "doc_id", F.lit(2).alias("quality"), (F.col("n_chars") > 1000).cast("int").alias("toxic")
    )
    return upsert.replace_by_key(table(spark, sf, "labels"), rows, "doc_id")


@query(
    "replace_slice",
    """WITH bridge AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem),
       rows AS (SELECT DISTINCT l_suppkey, l_partkey + 100000 AS l_partkey FROM lineitem WHERE l_returnflag = 'A')
       SELECT * FROM bridge WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 3000)
       UNION ALL SELECT * FROM rows""",
)
def replace_slice(spark, sf):
    lines = table(spark, sf, "lineitem")
    bridge = lines.select("l_suppkey", "l_partkey").distinct()
    rows = lines.where("l_returnflag = 'A'").select("l_suppkey", (F.col("l_partkey") + 100000).alias("l_partkey"))
    migrated = table(spark, sf, "supplier").where("s_acctbal < 3000").select("s_suppkey")
    return upsert.replace_slice(bridge, "l_suppkey", migrated, rows, ["l_suppkey", "l_partkey"])


@query(
    "ensure_row",
    """SELECT s_suppkey, s_name, s_acctbal, 'absent' AS branch FROM supplier
       UNION ALL SELECT max(s_suppkey) + 1, 'Projects', NULL, 'absent' FROM supplier
       UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'present' FROM supplier""",
)
def ensure_row(spark, sf):
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    absent = upsert.ensure_row(supplier, F.col("s_name") == "Projects", {"s_name": "Projects"}, "s_suppkey")
    present = upsert.ensure_row(supplier, F.col("s_acctbal") > 0, {"s_name": "Projects"}, "s_suppkey")
    return absent.withColumn("branch", F.lit("absent")).unionByName(present.withColumn("branch", F.lit("present")))


def _settings(spark, sf):
    """A key/value table: the number of customers per segment, with an id and when it was changed."""
    counted = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("key"))
    dated = counted.agg(F.count(F.lit(1)).cast("string").alias("value"), F.min("c_custkey").alias("id"))
    return dated.withColumn("changed", F.lit("before"))


@query(
    "set_setting",
    """WITH settings AS (SELECT c_mktsegment AS key, CAST(count(*) AS VARCHAR) AS value, min(c_custkey) AS id, 'before' AS changed
                         FROM customer GROUP BY 1)
       SELECT * FROM settings WHERE key <> 'BUILDING'
       UNION ALL SELECT 'BUILDING', (SELECT CAST(min(s_suppkey) AS VARCHAR) FROM supplier WHERE s_acctbal > 5000),
                        (SELECT max(id) + 1 FROM settings), 'now'""",
)
def set_setting(spark, sf):
    plan = upsert.matching_id(table(spark, sf, "supplier"), F.col("s_acctbal") > 5000, "s_suppkey")
    return upsert.set_setting(_settings(spark, sf), "key", "BUILDING", plan, "value", {"changed": "now"}, "id")


@query(
    "retire_placeholder",
    """WITH settings AS (SELECT c_mktsegment AS key, CAST(count(*) AS VARCHAR) AS value, min(c_custkey) AS id FROM customer GROUP BY 1)
       SELECT 'row' AS kind, CAST(s_suppkey AS VARCHAR) AS key, s_name AS value, s_suppkey AS id, NULL AS changed FROM supplier
       UNION ALL SELECT 'setting', key, value, id, 'before' FROM settings WHERE key <> 'BUILDING'
       UNION ALL SELECT 'setting', 'BUILDING', (SELECT CAST(min(s_suppkey) AS VARCHAR) FROM supplier WHERE s_acctbal < 0),
                        (SELECT max(id) + 1 FROM settings), 'now'""",
)
def retire_placeholder(spark, sf):
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    with_placeholder = upsert.ensure_row(supplier, F.col("s_name") == "Projects", {"s_name": "Projects"}, "s_suppkey")
    rows, settings = upsert.retire_placeholder(
        with_placeholder,
        F.col("s_name") == "Projects",
        F.col("s_acctbal") < 0,
        "s_suppkey",
        _settings(spark, sf),
        "key",
        "BUILDING",
        "value",
        {"changed": "now"},
        "id",
    )
    kept = rows.select(
        F.lit("row").alias("kind"), F.col("s_suppkey").cast("string").alias("key"), F.col("s_name").alias("value"),
        F.col("s_suppkey").alias("id"), F.lit(None).cast("string").alias("changed"),
    )
    return kept.unionByName(settings.select(F.lit("setting").alias("kind"), "key", "value", "id", "changed"))


RENAMES = [("signup", "register"), ("register", "onboard"), ("gone", "found"), ("view", "look"), ("view", "peek"), ("click", "purchase")]


def _renamed_events(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    users = table(spark, sf, "events").select("user_id", "event_type").distinct()
    types = events.select("event_type").distinct()
    return upsert.rename_cascade(
        {"types": types, "events": events, "users": users},
        {"types": "event_type", "events": "event_type", "users": "event_type"},
        "types",
        RENAMES,
    )


RENAMED = """CASE event_type WHEN 'signup' THEN 'onboard' WHEN 'view' THEN 'look' WHEN 'click' THEN 'purchase'
             ELSE event_type END"""


@query(
    "rename_cascade",
    f"""SELECT 'events' AS part, event_id AS id, {RENAMED} AS event_type FROM events
        UNION ALL SELECT 'users', user_id, {RENAMED} FROM (SELECT DISTINCT user_id, event_type FROM events)""",
)
def rename_cascade(spark, sf):
    tables = _renamed_events(spark, sf).tables
    events = tables["events"].select(F.lit("events").alias("part"), F.col("event_id").alias("id"), "event_type")
    return events.unionByName(tables["users"].select(F.lit("users").alias("part"), F.col("user_id").alias("id"), "event_type"))


@query(
    "rename_collisions",
    f"""SELECT {RENAMED} AS name, count(*) AS n FROM (SELECT DISTINCT event_type FROM events)
        GROUP BY 1 HAVING count(*) > 1""",
)
def rename_collisions(spark, sf):
    return _renamed_events(spark, sf).collisions


@query(
    "rename_from_table",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'HOME' WHEN 'MACHINERY' THEN 'HOME 2' ELSE c_mktsegment END AS c_mktsegment
       FROM customer""",
)
def rename_from_table(spark, sf):
    """Pairs as a table: one per part, most of them about names nobody has, and a few in a chain."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    old = F.when(F.col("p_partkey") == 1, "BUILDING").when(F.col("p_partkey") == 2, "HOUSE").when(F.col("p_partkey") == 3, "MACHINERY")
    new = F.when(F.col("p_partkey") == 1, "HOUSE").when(F.col("p_partkey") == 2, "HOME").when(F.col("p_partkey") == 3, "HOME 2")
    pairs = table(spark, sf, "part").select(
        F.col("p_partkey").alias("ord"),
        F.coalesce(old, F.concat(F.lit("part "), F.col("p_partkey").cast("string"))).alias("old"),
        F.coalesce(new, F.col("p_name")).alias("new"),
    )
    segments = customer.select("c_mktsegment").distinct()
    done = upsert.rename_cascade(
        {"segments": segments, "customer": customer}, {"segments": "c_mktsegment", "customer": "c_mktsegment"}, "segments", pairs
    )
    return done.tables["customer"]


def _merged_events(spark, sf, pairs=(("error", "view"), ("nothing", "view"), ("click", "view"))):
    events = table(spark, sf, "events").select(
        "event_id", "event_type", F.concat_ws("|", F.col("user_id").cast("string"), "props").alias("name")
    )
    types = events.select("event_type").distinct()
    links = table(spark, sf, "events").select("user_id", "event_type").distinct()
    return upsert.merge_namespace(
        {"types": types, "events": events, "links": links},
        ("types", "event_type"),
        ("events", "event_type", "name"),
        ("links", "event_type", ["user_id", "event_type"]),
        pairs,
    )


MERGED = """WITH named AS (SELECT event_id, event_type, user_id || '|' || props AS name FROM events),
    one AS (SELECT event_id, name, CASE WHEN event_type = 'error' THEN 'view' ELSE event_type END AS event_type
            FROM named WHERE NOT (event_type = 'error' AND name IN (SELECT name FROM named WHERE event_type = 'view'))),
    two AS (SELECT event_id, CASE WHEN event_type = 'click' THEN 'view' ELSE event_type END AS event_type
            FROM one WHERE NOT (event_type = 'click' AND name IN (SELECT name FROM one WHERE event_type = 'view')))"""


@query("merge_from_table", f"{MERGED} SELECT event_id, event_type FROM two UNION ALL SELECT NULL, event_type FROM (SELECT DISTINCT event_type FROM events) WHERE event_type NOT IN ('error', 'click')")
def merge_from_table(spark, sf):
    """Pairs as a table: one per document, most of them a long chain of names nobody has; the names left come with the rows."""
    doc = F.col("doc_id")
    old = F.when(doc == 3, "error").when(doc == 5, "nothing").when(doc == 8, "click").otherwise(F.concat(F.lit("doc "), doc.cast("string")))
    new = F.when(doc.isin(3, 5, 8), "view").otherwise(F.concat(F.lit("doc "), (doc + 1).cast("string")))
    pairs = table(spark, sf, "documents").select(doc.alias("ord"), old.alias("old"), new.alias("new"))
    done = _merged_events(spark, sf, pairs)
    return done.tables["events"].select("event_id", "event_type").unionByName(
        done.tables["types"].select(F.lit(None).cast("long").alias("event_id"), "event_type")
    )


@query("merge_namespace", f"{MERGED} SELECT event_id, event_type FROM two")
def merge_namespace(spark, sf):
    return _merged_events(spark, sf).tables["events"].select("event_id", "event_type")


@query(
    "merge_dropped",
    f"{MERGED} SELECT event_id, event_type FROM events WHERE event_id NOT IN (SELECT event_id FROM two)",
)
def merge_dropped(spark, sf):
    return _merged_events(spark, sf).dropped.select("event_id", "event_type")


@query(
    "merge_duplicate_links",
    """SELECT user_id, 'view' AS event_type, count(*) AS n
       FROM (SELECT DISTINCT user_id, event_type FROM events) WHERE event_type IN ('error', 'click', 'view')
       GROUP BY user_id HAVING count(*) > 1""",
)
def merge_duplicate_links(spark, sf):
    return _merged_events(spark, sf).duplicate_links


def _dimension(spark, sf):
    counter = F.when(F.col("p_size") < 5, 0).when(F.col("p_size") >= 10, F.col("p_size"))
    part = table(spark, sf, "part").withColumn("counter_id", counter.cast("long"))
    counters = part.groupBy(F.col("p_size").cast("long").alias("id")).agg(
        F.min("p_type").alias("name"), F.min("p_brand").alias("prefix"), F.min("p_size").alias("padding")
    )
    makers = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.min("l_suppkey").alias("maker")
    )
    return upsert.ensure_dimension(
        part,
        "p_partkey",
        "counter_id",
        counters,
        "id",
        {
            "name": F.concat("p_name", F.lit(" Picking")),
            "prefix": F.concat(F.col("maker").cast("string"), F.lit("/"), F.coalesce(F.nullif(F.col("p_type"), F.lit("PROMO")), F.lit("POS")), F.lit("/")),
            "padding": 5,
        },
        context=makers,
    )


MADE = """WITH base AS (SELECT p_partkey, p_name, p_type, CASE WHEN p_size < 5 THEN 0 WHEN p_size >= 10 THEN p_size END AS counter_id FROM part),
    makers AS (SELECT l_partkey, min(l_suppkey) AS maker FROM lineitem GROUP BY l_partkey),
    made AS (SELECT p_partkey, p_name, p_type, maker,
                    (SELECT max(p_size) FROM part) + row_number() OVER (ORDER BY p_partkey) AS id
             FROM base JOIN makers ON l_partkey = p_partkey WHERE counter_id IS NULL OR counter_id = 0)"""


@query(
    "ensure_dimension",
    f"""{MADE} SELECT base.p_partkey, CAST(coalesce(made.id, base.counter_id) AS BIGINT) AS counter_id
        FROM base LEFT JOIN made ON made.p_partkey = base.p_partkey""",
)
def ensure_dimension(spark, sf):
    fact, _ = _dimension(spark, sf)
    return fact.select("p_partkey", "counter_id")


@query(
    "ensure_dimension_rows",
    f"""{MADE} SELECT CAST(p_size AS BIGINT) AS id, min(p_type) AS name, min(p_brand) AS prefix, min(p_size) AS padding
        FROM part GROUP BY p_size
        UNION ALL SELECT id, p_name || ' Picking', maker || '/' || coalesce(nullif(p_type, 'PROMO'), 'POS') || '/', 5 FROM made""",
)
def ensure_dimension_rows(spark, sf):
    _, counters = _dimension(spark, sf)
    return counters
