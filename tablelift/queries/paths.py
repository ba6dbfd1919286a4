"""Staged runs over several versions, and a renumbering run."""

from pyspark.sql import functions as F

from tablelift.operators import edit
from tablelift.plans.path import Stage, counted, reports, run_path
from tablelift.plans.renumber import renumber_and_chain
from tablelift.queries.registry import query, table
from tablelift.queries.sequences import finished, payload
from tablelift.scale import new_table_path
from tablelift.sources import SnapshotStore, file_manifest, mirror_files, read_table, run_sql, write_files


def _on(name, step):
    """A stage step that changes one table."""
    return lambda tables: {**tables, name: step(tables[name])}


def stages():
    return {
        1: Stage(before=[_on("orders", lambda df: edit.backup_column(df, "o_orderstatus", "status_bkp"))]),
        2: Stage(
            before=[_on("orders", lambda df: edit.delete_where(df, F.col("o_orderpriority") == "5-LOW"))],
            after=[_on("orders", lambda df: edit.update_where(df, F.col("o_orderstatus") == "P", {"o_orderstatus": "D"}))],
        ),
        3: Stage(after=[_on("orders", lambda df: edit.rename_column(df, "o_orderpriority", "legacy_priority"))]),
    }


def extras():
    return {2: Stage(after=[_on("orders", lambda df: edit.placeholder_rename(df, "o_orderstatus", "D", "MIGRATED-", "o_orderkey"))])}


PATH = """SELECT o_orderkey, o_orderpriority AS legacy_priority, o_orderstatus AS status_bkp,
                 CASE WHEN o_orderstatus = 'P' THEN 'MIGRATED-' || o_orderkey ELSE o_orderstatus END AS o_orderstatus
          FROM orders WHERE o_orderpriority <> '5-LOW'"""


def sources(spark, sf):
    return {
        "orders": table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"),
        "customer": table(spark, sf, "customer"),
    }


@query("staged_path", PATH)
def staged_path(spark, sf):
    store = SnapshotStore(spark, new_table_path(spark, "path"))
    return run_path(store, sources(spark, sf), 0, 3, stages(), extras=extras())["orders"]


@query("staged_resume", PATH)
def staged_resume(spark, sf):
    """Stop after version 2, then go on from its snapshot."""
    store = SnapshotStore(spark, new_table_path(spark, "path"))
    run_path(store, sources(spark, sf), 0, 2, stages(), extras=extras())
    return run_path(store, None, 0, 3, stages(), extras=extras(), resume_from=2)["orders"]


@query(
    "staged_rerun",
    """SELECT 2 AS version, o_orderkey, o_orderstatus FROM (
           SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'MIGRATED-' || o_orderkey ELSE o_orderstatus END AS o_orderstatus
           FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderkey % 2 = 0)
       UNION ALL SELECT 0, o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0""",
)
def staged_rerun(spark, sf):
    """A full run, then a shorter one over other rows: what can be read belongs to the second alone."""
    store = SnapshotStore(spark, new_table_path(spark, "path"))
    run_path(store, sources(spark, sf), 0, 3, stages(), extras=extras())
    even = {**store.read(0), "orders": store.read(0)["orders"].where("o_orderkey % 2 = 0")}
    run_path(store, even, 0, 2, stages(), extras=extras())
    found = [
        store.read(version)["orders"].select(F.lit(version).alias("version"), "o_orderkey", "o_orderstatus")
        for version in range(4)
        if version != 1 and store.exists(version)
    ]
    return found[0].unionByName(found[1]) if len(found) == 2 else found[0]


@query(
    "run_report",
    """SELECT 'lows deleted' AS report, 'orders' AS "table", count(*) AS rows_before, count(*) FILTER (o_orderpriority <> '5-LOW') AS rows_after,
              count(*) FILTER (o_orderpriority <> '5-LOW' AND o_orderstatus = 'P') AS pending FROM orders
       UNION ALL SELECT 'renamed', 'orders', count(*), count(*), count(*) FILTER (o_orderstatus = 'P') FROM orders WHERE o_orderpriority <> '5-LOW'""",
)
def run_report(spark, sf):
    """What the steps of a staged run did, as its last snapshot tells it."""
    low = _on("orders", lambda df: edit.delete_where(df, F.col("o_orderpriority") == "5-LOW"))
    rename = _on("orders", lambda df: edit.placeholder_rename(df, "o_orderstatus", "P", "MIGRATED-", "o_orderkey"))
    steps = {
        1: Stage(before=[counted("lows deleted", "orders", low, pending=F.col("o_orderstatus") == "P")]),
        2: Stage(after=[counted("renamed", "orders", rename, pending=F.col("o_orderstatus").startswith("MIGRATED-"))]),
    }
    store = SnapshotStore(spark, new_table_path(spark, "path"))
    run_path(store, sources(spark, sf), 0, 2, steps)
    found = reports(store.read(2))
    first, second = (found[name].select(F.lit(name).alias("report"), "*") for name in ("lows deleted", "renamed"))
    return first.unionByName(second)


@query("read_and_run_sql", "SELECT p_brand, count(*) AS n, sum(p_size) AS size FROM part WHERE p_size > 10 GROUP BY p_brand")
def read_and_run_sql(spark, sf):
    """A table of a snapshot folder read by name, then SQL over it; an empty text does nothing."""
    root = new_table_path(spark, "tables")
    table(spark, sf, "part").write.parquet(f"{root}/parts_by_name")
    read_table(spark, root, "parts_by_name")
    if run_sql(spark, "  ") is not None:
        raise ValueError("an empty text must do nothing")
    return run_sql(spark, "SELECT p_brand, count(*) AS n, sum(p_size) AS size FROM parts_by_name WHERE p_size > 10 GROUP BY p_brand")


def _renumbered(spark, sf):
    customer = table(spark, sf, "customer")
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderdate",
        F.col("o_orderkey").alias("seq"),
        F.lit(None).cast("long").alias("previous_id"),
        F.when(F.col("o_totalprice") > 300000, "stale").alias("hash"),
    )
    counter = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey") + 500000)
    companies = customer.select("c_custkey", counter.alias("counter_id"))
    counters = customer.select((F.col("c_custkey") + 500000).alias("counter_id"), F.lit(1).cast("long").alias("next"))
    return renumber_and_chain(
        orders,
        companies,
        counters,
        row_id="o_orderkey",
        company="o_custkey",
        company_id="c_custkey",
        counter_of="counter_id",
        counter_id="counter_id",
        counter_next="next",
        order=["o_orderdate", "o_orderkey"],
        qualifies=finished(),
        payload=payload(),
        sequence="seq",
        previous="previous_id",
        hash_column="hash",
    )


COVERED = """covered AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'),
    numbered AS (SELECT o_orderkey, o_custkey, row_number() OVER w AS seq, lag(o_orderkey) OVER w AS previous_id,
                        o_orderkey || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|' || o_orderstatus AS payload
                 FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_custkey IN (SELECT c_custkey FROM covered)
                 WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))"""


@query(
    "renumber_run",
    f"""WITH RECURSIVE {COVERED}, chain(o_custkey, o_orderkey, seq, hash) AS (
            SELECT o_custkey, o_orderkey, seq, sha256(payload) FROM numbered WHERE seq = 1
            UNION ALL SELECT t.o_custkey, t.o_orderkey, t.seq, sha256(c.hash || t.payload)
            FROM chain c JOIN numbered t ON t.o_custkey = c.o_custkey AND t.seq = c.seq + 1)
        SELECT o_orderkey, seq, previous_id, hash FROM chain JOIN numbered USING (o_orderkey, seq)
        UNION ALL SELECT o_orderkey, o_orderkey, NULL, CASE WHEN o_totalprice > 300000 THEN 'stale' END
        FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM numbered)""",
)
def renumber_run(spark, sf):
    return _renumbered(spark, sf).rows.select("o_orderkey", "seq", "previous_id", "hash")


@query(
    "renumber_counters",
    f"""WITH {COVERED}, due AS (SELECT o_custkey, count(*) + 1 AS next FROM numbered GROUP BY o_custkey)
        SELECT c_custkey + 500000 AS counter_id, coalesce(due.next, 1) AS next
        FROM customer LEFT JOIN due ON o_custkey = c_custkey""",
)
def renumber_counters(spark, sf):
    return _renumbered(spark, sf).counters


MIRRORED = """WITH old AS (SELECT page_id % 5 || '/' || page_id || '.html' AS path, CASE WHEN page_id % 3 = 0 THEN url ELSE html END AS content FROM pages WHERE page_id % 4 <> 0
                         UNION ALL SELECT 'extra/' || page_id, url FROM pages WHERE page_id % 7 = 0),
    new AS (SELECT page_id % 5 || '/' || page_id || '.html' AS path, html AS content FROM pages),
    did AS (SELECT coalesce(new.path, old.path) AS path, new.content, CASE WHEN old.path IS NULL THEN 'copy' WHEN new.path IS NULL THEN 'delete'
                WHEN new.content = old.content THEN 'keep' ELSE 'update' END AS action
            FROM old FULL JOIN new ON new.path = old.path)"""


@query(
    "mirror_files",
    f"""{MIRRORED} SELECT path, action, CASE WHEN action IN ('copy', 'update') THEN strlen(content) ELSE 0 END AS bytes,
            CASE WHEN content IS NOT NULL THEN sha256(content) END AS fingerprint FROM did""",
)
def mirror_tree(spark, sf):
    """Every page as a file; a folder with some of them, some old and some too many, made the same; what the folder holds then."""
    root = new_table_path(spark, "tree")
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    page = F.concat((F.col("page_id") % 5).cast("string"), F.lit("/"), F.col("page_id").cast("string"), F.lit(".html"))
    write_files(pages, f"{root}/new", page, "html")
    held = pages.where("page_id % 4 <> 0").select(page.alias("path"), F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(F.col("html")).alias("content"))
    extra = pages.where("page_id % 7 = 0").select(F.concat(F.lit("extra/"), F.col("page_id").cast("string")).alias("path"), F.col("url").alias("content"))
    write_files(held.unionByName(extra), f"{root}/old", "path", "content")
    done = mirror_files(spark, f"{root}/new", f"{root}/old")
    left = file_manifest(spark, f"{root}/old").select("path", "fingerprint")
    return done.join(left, "path", "full_outer").select("path", "action", "bytes", "fingerprint")


@query(
    "staged_parts",
    """SELECT o_orderkey, CASE WHEN o_orderkey // 1000 = 3 AND o_orderstatus = 'O' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
              CASE o_orderkey // 1000 WHEN 0 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS written_by
       FROM orders WHERE o_orderkey >= 500""",
)
def staged_parts(spark, sf):
    """A run that keeps orders in parts of 1,000 keys; every row with the version that wrote its part."""
    part = F.floor(F.col("o_orderkey") / 1000)
    store = SnapshotStore(spark, new_table_path(spark, "path"), {"orders": part})
    change = _on("orders", lambda df: edit.update_where(df, (part == 3) & (F.col("o_orderstatus") == "O"), {"o_orderstatus": "X"}))
    steps = {1: Stage(before=[change]), 2: Stage(after=[_on("orders", lambda df: edit.delete_where(df, F.col("o_orderkey") < 500))])}
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    last = run_path(store, {"orders": orders}, 0, 2, steps)["orders"]
    parts = spark.createDataFrame([(int(p[1:]), v) for p, v in store.parts(2, "orders").items()], "part long, written_by int")
    return last.withColumn("part", part).join(parts, "part").select("o_orderkey", "o_orderstatus", "written_by")
