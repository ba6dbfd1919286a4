"""Numbering, predecessor links, hash chains, counters and ordered reads."""

from pyspark.sql import functions as F

from tablelift.operators import ordering, sequence
from tablelift.queries.registry import query, table

ORDER = ["o_orderdate", "o_orderkey"]


def finished():
    return F.col("o_orderstatus").isin("O", "F")


def payload():
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return F.concat_ws("|", F.col("o_orderkey").cast("string"), day, F.col("o_orderstatus"))


def orders_of(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


NUMBERED = """numbered AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
           row_number() OVER w AS seq, lag(o_orderkey) OVER w AS previous_id
    FROM orders WHERE o_orderstatus IN ('O', 'F')
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))"""


@query(
    "gapless_sequence",
    f"""WITH {NUMBERED} SELECT orders.o_orderkey, coalesce(seq, orders.o_orderkey) AS seq
        FROM orders LEFT JOIN numbered USING (o_orderkey)""",
)
def gapless_sequence(spark, sf):
    rows = orders_of(spark, sf).withColumn("seq", F.col("o_orderkey"))
    numbered = sequence.gapless_sequence(rows, "o_custkey", ORDER, "seq", finished())
    return numbered.select("o_orderkey", "seq")


@query(
    "gapless_sequence_hot",
    """SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS seq
       FROM orders""",
)
def gapless_sequence_hot(spark, sf):
    """Three groups only, each with a third of the rows."""
    rows = orders_of(spark, sf).select("o_orderkey", "o_orderstatus", "o_orderdate")
    return sequence.number_rows(rows, "o_orderstatus", ORDER, "seq").drop("o_orderdate")


@query("previous_row", f"WITH {NUMBERED} SELECT o_orderkey, previous_id FROM numbered")
def previous_row(spark, sf):
    rows = orders_of(spark, sf).where(finished())
    return sequence.previous_row(rows, "o_custkey", ORDER, "o_orderkey", "previous_id").select("o_orderkey", "previous_id")


CHAINED = f"""{NUMBERED},
    texts AS (SELECT o_custkey, o_orderkey, seq, o_orderkey || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|' || o_orderstatus AS payload FROM numbered),
    chain(o_custkey, o_orderkey, seq, hash) AS (
        SELECT o_custkey, o_orderkey, seq, sha256(payload) FROM texts WHERE seq = 1
        UNION ALL SELECT t.o_custkey, t.o_orderkey, t.seq, sha256(c.hash || t.payload)
        FROM chain c JOIN texts t ON t.o_custkey = c.o_custkey AND t.seq = c.seq + 1)"""


@query("hash_chain", f"WITH RECURSIVE {CHAINED} SELECT o_orderkey, o_custkey, hash FROM chain")
def hash_chain(spark, sf):
    rows = orders_of(spark, sf).where(finished()).withColumn("payload", payload())
    chained = sequence.hash_chain(rows.select("o_custkey", *ORDER, "payload"), "o_custkey", ORDER, "payload")
    return chained.select("o_orderkey", "o_custkey", "hash")


@query(
    "chain_breaks",
    """SELECT o_orderkey, 'hash differs' AS reason FROM orders
       WHERE o_orderstatus IN ('O', 'F') AND o_totalprice > 450000""",
)
def chain_breaks(spark, sf):
    """Chain all orders, then change the payload of the expensive ones: exactly those must show."""
    orders = table(spark, sf, "orders").where(finished())
    rows = orders.select("o_custkey", *ORDER, "o_totalprice", payload().alias("payload"))
    chained = sequence.hash_chain(rows, "o_custkey", ORDER, "payload")
    tampered = F.when(F.col("o_totalprice") > 450000, F.concat("payload", F.lit("!"))).otherwise(F.col("payload"))
    return sequence.chain_breaks(chained.withColumn("payload", tampered), "o_custkey", ORDER, "payload", "o_orderkey")


@query(
    "next_counter",
    """SELECT c_custkey, coalesce(n + 1, c_nationkey) AS next FROM customer
       LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 300000
                  GROUP BY o_custkey) ON o_custkey = c_custkey""",
)
def next_counter(spark, sf):
    counters = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("next"))
    pending = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 300000)
    return sequence.next_counter(table(spark, sf, "orders"), "o_custkey", counters, "c_custkey", "next", pending)


@query(
    "surrogate_keys",
    """SELECT doc_id, (SELECT max(doc_id) FROM labels) + row_number() OVER (ORDER BY source, doc_id) AS new_id FROM documents""",
)
def surrogate_keys(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source")
    taken = table(spark, sf, "labels").select(F.col("doc_id").alias("new_id"))
    return sequence.surrogate_keys(documents, ["source", "doc_id"], "new_id", taken).select("doc_id", "new_id")


@query(
    "sorted_missing",
    """SELECT doc_id, source, row_number() OVER (ORDER BY source DESC, doc_id) AS ord FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def sorted_missing(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source")
    missing = documents.join(table(spark, sf, "labels"), "doc_id", "left_anti")
    numbered = sequence.number_rows(missing, None, [F.col("source").desc(), "doc_id"], "ord")
    return ordering.sort_by(numbered, "ord")


@query(
    "preview_topn",
    """SELECT url, page_id, (SELECT count(*) FROM pages) - 20 AS n_more FROM pages ORDER BY url, page_id LIMIT 20""",
)
def preview_topn(spark, sf):
    return ordering.preview(table(spark, sf, "pages").select("url", "page_id"), 20, "url", "page_id")


@query(
    "pick_one",
    """SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand = 'Brand#7' ORDER BY p_name, p_partkey LIMIT 1""",
)
def pick_one(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return ordering.pick_one(part, F.col("p_brand") == "Brand#7", "p_name", "p_partkey")


@query(
    "first_per_group",
    """SELECT * FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
                      FROM events) WHERE rn <= 5""",
)
def first_per_group(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return ordering.first_per_group(events, ["user_id"], ["ts", "event_id"], 5, "rn").drop("ts")


@query(
    "sample_per_row",
    """SELECT page_id, array_to_string(list_slice(regexp_extract_all(html, 'href="([^"]*)"', 1), 1, 2), ' ') AS sample FROM pages""",
)
def sample_per_row(spark, sf):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    pages = table(spark, sf, "pages").select("page_id", links.alias("links"))
    sampled = ordering.sample_per_row(pages, "links", 2, "sample")
    return sampled.select("page_id", F.array_join("sample", " ").alias("sample"))
