"""Counts, grouped lists, assertions and reports."""

from pyspark.sql import functions as F

from tablelift.operators import checks
from tablelift.operators.joins import missing_in_target
from tablelift.operators.sequence import number_rows
from tablelift.queries.registry import query, table
from tablelift.scale import new_table_path
from tablelift.sources import report_document, write_report_object


@query("count_where", """SELECT count(*) AS n FROM events WHERE nullif(event_type, 'click') = 'error'""")
def count_where(spark, sf):
    return checks.count_where(table(spark, sf, "events"), F.nullif(F.col("event_type"), F.lit("click")) == "error")


@query(
    "census",
    """SELECT count(*) AS total, count(*) FILTER (quality IS NULL) AS unlabelled, count(*) FILTER (quality = 1) AS good,
              count(*) FILTER (toxic = 1 AND lang = 'de') AS toxic_german
       FROM documents LEFT JOIN labels ON labels.doc_id = documents.doc_id""",
)
def census(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return checks.census(
        joined,
        {
            "unlabelled": F.col("quality").isNull(),
            "good": F.col("quality") == 1,
            "toxic_german": (F.col("toxic") == 1) & (F.col("lang") == "de"),
        },
    )


@query(
    "collect_per_group",
    """WITH numbered AS (SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 7 AS piece
                         FROM events)
       SELECT user_id, piece, count(*) AS n, string_agg(event_id, ', ' ORDER BY event_id) AS ids
       FROM numbered GROUP BY user_id, piece""",
)
def collect_per_group(spark, sf):
    return checks.collect_per_group(table(spark, sf, "events"), "user_id", "event_id", "ids", entries=7)


@query(
    "collect_copies",
    """WITH numbered AS (SELECT o_custkey, o_orderpriority, o_orderkey,
                                (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) - 1) // 1000 AS piece
                         FROM orders)
       SELECT o_custkey, piece, count(*) AS n,
              string_agg(o_orderpriority, ', ' ORDER BY o_orderpriority, o_orderkey) AS priorities
       FROM numbered GROUP BY o_custkey, piece""",
)
def collect_copies(spark, sf):
    """Values that repeat within a group are listed as often as they occur."""
    orders = table(spark, sf, "orders")
    return checks.collect_per_group(orders, "o_custkey", "o_orderpriority", "priorities", tie="o_orderkey")


@query(
    "affected_rows",
    """SELECT count(*) AS rows, count(*) FILTER (event_type LIKE 'MIGRATED-%') AS renamed,
              count(*) FILTER (event_type = 'error') AS remaining
       FROM (SELECT CASE WHEN event_type = 'error' THEN 'MIGRATED-' || event_id ELSE event_type END AS event_type FROM events)""",
)
def affected_rows(spark, sf):
    from tablelift.operators.edit import placeholder_rename

    events = placeholder_rename(table(spark, sf, "events"), "event_type", "error", "MIGRATED-", "event_id")
    seen = checks.write_counted(
        events,
        new_table_path(spark, "affected"),
        {"renamed": F.col("event_type").startswith("MIGRATED-"), "remaining": F.col("event_type") == "error"},
    )
    return spark.range(1).select(*[F.lit(seen[name]).cast("long").alias(name) for name in ("rows", "renamed", "remaining")])


@query(
    "assertions",
    """SELECT 'placeholder' AS rule, count(*) FILTER (o_orderstatus = '/') AS n, 'OK' AS status FROM orders
       UNION ALL SELECT 'pending', count(*) FILTER (o_orderstatus = 'P'), 'WARN' FROM orders
       UNION ALL SELECT 'no customer', count(*) FILTER (o_custkey IS NULL OR o_custkey = 0),
                        CASE WHEN count(*) FILTER (o_custkey IS NULL OR o_custkey = 0) > 0 THEN 'WARN' ELSE 'OK' END FROM orders""",
)
def assertions(spark, sf):
    return checks.assertions(
        table(spark, sf, "orders"),
        {
            "placeholder": F.col("o_orderstatus") == "/",
            "pending": F.col("o_orderstatus") == "P",
            "no customer": F.col("o_custkey").isNull() | (F.col("o_custkey") == 0),
        },
    )


def issues(spark, sf):
    """Orders without lines are errors; unlabelled documents and over-long urls are warnings."""
    orders, documents = table(spark, sf, "orders"), table(spark, sf, "documents")
    pages = table(spark, sf, "pages")
    empty = missing_in_target(
        orders.select(F.col("o_orderkey"), "o_orderstatus"),
        table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")),
        "o_orderkey",
    )
    unlabelled = missing_in_target(documents.select("doc_id", "lang"), table(spark, sf, "labels"), "doc_id")
    return checks.issue_report(
        checks.issues_from(empty, "empty_order", "error", "o_orderkey", {"status": "o_orderstatus"}),
        checks.issues_from(unlabelled, "unlabelled", "warning", "doc_id", {"lang": "lang"}),
        checks.issues_from(pages.where(F.length("url") > 40), "long_url", "warning", "page_id"),
    )


ISSUES = """issues AS (
    SELECT 'empty_order' AS type, 'error' AS severity, CAST(o_orderkey AS VARCHAR) AS entity_id,
           '{"status":"' || o_orderstatus || '"}' AS detail
    FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'unlabelled', 'warning', CAST(doc_id AS VARCHAR), '{"lang":"' || lang || '"}'
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT 'long_url', 'warning', CAST(page_id AS VARCHAR), NULL FROM pages WHERE length(url) > 40)"""


@query("issue_report", f"WITH {ISSUES} SELECT type, severity, entity_id, detail FROM issues")
def issue_report(spark, sf):
    return issues(spark, sf)


@query("issue_counts", f"WITH {ISSUES} SELECT type, severity, count(*) AS n FROM issues GROUP BY type, severity")
def issue_counts(spark, sf):
    return checks.issue_counts(issues(spark, sf))


@query(
    "verdict",
    f"""WITH {ISSUES} SELECT count(*) FILTER (severity = 'error') AS errors,
               count(*) FILTER (severity = 'warning') AS warnings, 'failed' AS status FROM issues""",
)
def verdict(spark, sf):
    return checks.verdict(issues(spark, sf))


@query(
    "report_json",
    f"""WITH {ISSUES}, body AS (
            SELECT '{{"type":"' || type || '","severity":"' || severity || '","entity_id":"' || entity_id || '"'
                   || coalesce(',"detail":"' || replace(detail, '"', chr(92) || '"') || '"', '') || '}}' AS value FROM issues)
        SELECT 0 AS ord, '{{"type":"views","timestamp":"2024-01-02T03:04:05","database":"orders","stats":{{"total":'
               || (SELECT count(*) FROM orders) || '}},"errors":' || count(*) FILTER (severity = 'error')
               || ',"warnings":' || count(*) FILTER (severity = 'warning') || '}}' AS value FROM issues
        UNION ALL SELECT 1, value FROM body""",
)
def report_json(spark, sf):
    """Rows of JSON text: a header with the stated time, then one row per issue."""
    stats = table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("total"))
    at = F.to_timestamp(F.lit("2024-01-02 03:04:05"))
    return report_document(issues(spark, sf), stats, "views", "orders", at)


@query(
    "report_object",
    f"""WITH {ISSUES}, listed AS (
            SELECT CASE WHEN severity = 'error' THEN 1 ELSE 3 END AS section, type, entity_id,
                   '{{"type":"' || type || '","severity":"' || severity || '","entity_id":"' || entity_id || '"' || coalesce(',' || detail[2:], '}}') AS value FROM issues),
        numbered AS (SELECT section, row_number() OVER (PARTITION BY section ORDER BY type, entity_id, value) AS nth, value FROM listed),
        lines AS (SELECT section, nth, CASE WHEN nth > 1 THEN ',' ELSE '' END || value AS value FROM numbered
            UNION ALL SELECT 0, 0, '{{"type":"views","timestamp":"2024-01-02T03:04:05","database":"orders","stats":{{"total":' || (SELECT count(*) FROM orders) || '}},"errors":['
            UNION ALL SELECT 2, 0, '],"warnings":[' UNION ALL SELECT 4, 0, ']}}')
        SELECT row_number() OVER (ORDER BY section, nth) AS line, value FROM lines""",
)
def report_object(spark, sf):
    """One JSON document over several files, read back line by line in the order of the files."""
    stats = table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("total"))
    path = new_table_path(spark, "report")
    write_report_object(issues(spark, sf), stats, path, "views", "orders", at=F.to_timestamp(F.lit("2024-01-02 03:04:05")))
    lines = spark.read.option("lineSep", "\n").text(path).withColumn("file", F.input_file_name()).withColumn("place", F.monotonically_increasing_id())
    return number_rows(lines, None, ["file", "place"], "line").select("line", "value")
