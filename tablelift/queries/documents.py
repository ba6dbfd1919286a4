"""XML and text checks, hierarchies and implied memberships."""

from pyspark.sql import functions as F

from tablelift.operators import documents as docs
from tablelift.operators import hierarchy
from tablelift.plans.validation import validate_views
from tablelift.queries.registry import query, table


@query(
    "extract_exprs",
    """SELECT page_id, array_to_string(links, ' ') AS links, len(links) AS n_links
       FROM (SELECT page_id, regexp_extract_all(html, '<a[^>]+href="([^"]+)"', 1) AS links FROM pages)
       WHERE len(links) > 0""",
)
def extract_exprs(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "html")
    found = docs.extract_exprs(pages, "html", "links", r"<a[^>]+href=\"([^\"]+)\"")
    return found.select("page_id", F.array_join("links", " ").alias("links"), "n_links")


def escaped(column):
    """Text as XML character data; control characters have no place there."""
    clean = F.regexp_replace(column, r"[^\x09\x0A\x0D\x20-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]", "")
    return F.replace(F.replace(clean, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


@query(
    "xml_wellformed",
    """SELECT doc_id, CASE WHEN lang = 'es' THEN false ELSE lang = 'de' OR source IN ('src3', 'src5') END AS malformed
       FROM documents""",
)
def xml_wellformed(spark, sf):
    """Whole texts as XML; an end tag is wrong for one language, text follows the root for two sources."""
    rows = table(spark, sf, "documents")
    body = F.concat(F.lit("<doc><p>"), escaped(F.col("text")), F.lit("</p>"))
    end = F.when(F.col("lang") == "de", "</dok>").otherwise("</doc>")
    tail = F.when(F.col("source").isin("src3", "src5"), "tail").otherwise("")
    document = F.when(F.col("lang") == "es", "").otherwise(F.concat(body, end, tail))
    checked = docs.xml_wellformed(rows.select("doc_id", document.alias("document")), "document")
    return checked.select("doc_id", F.col("error").isNotNull().alias("malformed"))


def part_views(spark, sf):
    """A view per part: brands and types as field names.

    Parts up to 20 are roots, parts up to 50 hang below the one 20 before, the others below the
    part whose key is their size.
    """
    part = table(spark, sf, "part")
    brand, kind = F.replace(F.col("p_brand"), F.lit("#"), F.lit("_")), F.lower("p_type")
    document = F.format_string(
        '<form n="%d"><field name="%s" kind="%s"/><field name="id"/><button name="go_%s"/>'
        '<group name="%s"><field name="owner.name"/></group>'
        "<xpath expr=\"//field[@name='%s']\"/><xpath expr=\"/form/group\"/>"
        "<xpath expr=\"//field[contains(@kind, '%s') and @name]\"/><xpath expr=\"/form[@n='%d' and not(@m)]\"/></form>",
        F.col("p_partkey"), brand, kind, brand, kind, brand, kind, F.col("p_size"),
    )
    return part.select(
        "p_partkey",
        "p_size",
        F.col("p_type").alias("model"),
        brand.alias("brand"),
        kind.alias("kind"),
        F.when(F.col("p_partkey") > 50, F.col("p_size").cast("long"))
        .when(F.col("p_partkey") > 20, F.col("p_partkey") - 20)
        .alias("parent_id"),
        F.when(F.col("p_size") == 13, F.concat(document, F.lit("<"))).otherwise(document).alias("document"),
    )


PART_VIEWS = """views AS (SELECT p_partkey, p_type AS model, replace(p_brand, '#', '_') AS brand, lower(p_type) AS kind,
                                 p_size, CASE WHEN p_partkey > 50 THEN CAST(p_size AS BIGINT) WHEN p_partkey > 20 THEN p_partkey - 20 END AS parent_id,
                                 p_size <> 13 AS sound FROM part)"""


@query(
    "field_refs_missing",
    f"""WITH {PART_VIEWS},
        fields AS (SELECT DISTINCT p_type AS model, replace(p_brand, '#', '_') AS name FROM part
                   WHERE p_size > 45 AND p_type <> 'PROMO'),
        names AS (SELECT p_partkey AS view_id, model, 'field' AS tag, brand AS name FROM views WHERE sound
                  UNION ALL SELECT p_partkey, model, 'group', kind FROM views WHERE sound)
        SELECT view_id, model, tag, name FROM names
        WHERE model IN (SELECT model FROM fields) AND (model, name) NOT IN (SELECT (model, name) FROM fields)""",
)
def field_refs_missing(spark, sf):
    views = part_views(spark, sf)
    fields = views.where("p_size > 45 AND model <> 'PROMO'").select("model", F.col("brand").alias("name"))
    return docs.field_refs_missing(views, "p_partkey", "model", "document", fields)


@query(
    "field_refs_first",
    f"""WITH {PART_VIEWS}, firsts AS (SELECT min(p_partkey) AS id FROM views GROUP BY model)
        SELECT p_partkey AS view_id, model, 'group' AS tag, kind AS name FROM views
        WHERE sound AND p_partkey IN (SELECT id FROM firsts)""",
)
def field_refs_first(spark, sf):
    """Only the first view of each model, against a dictionary that knows all brands in use."""
    views = part_views(spark, sf)
    fields = views.select("model", F.col("brand").alias("name"))
    return docs.field_refs_missing(views, "p_partkey", "model", "document", fields, first_per_model=True)


@query(
    "validate_views",
    """WITH RECURSIVE views AS (
           SELECT p_partkey AS id, p_type AS model, replace(p_brand, '#', '_') AS brand, lower(p_type) AS kind,
                  nullif(p_partkey // 2, p_partkey) AS parent, p_size <> 13 AS sound, p_size <> 20 AS active, p_size AS size,
                  p_type = 'PROMO' AS template FROM part),
       fine AS (SELECT id FROM views WHERE sound AND parent IS NULL
                UNION ALL SELECT v.id FROM views v JOIN fine f ON v.parent = f.id WHERE v.sound),
       pairs AS (SELECT c.id, c.brand <> p.brand AS other_brand, c.kind <> p.kind AS other_kind, c.size <> p.id AS other_size,
                        CASE WHEN p.parent IS NULL THEN 'orphan_xpath' ELSE 'unchecked_xpath' END AS type,
                        CASE WHEN p.parent IS NULL THEN 'error' ELSE 'warning' END AS severity
                 FROM views c JOIN views p ON p.id = c.parent WHERE c.sound AND p.sound AND c.active),
       fields AS (SELECT DISTINCT p_type AS model, replace(p_brand, '#', '_') AS name FROM part WHERE p_size > 45),
       names AS (SELECT id, model, brand AS name FROM views WHERE sound AND active AND NOT template
                 UNION ALL SELECT id, model, kind FROM views WHERE sound AND active AND NOT template)
       SELECT 'combination_error' AS type, 'error' AS severity, CAST(id AS VARCHAR) AS entity_id FROM views
       WHERE active AND parent IS NOT NULL AND id NOT IN (SELECT id FROM fine)
       UNION ALL SELECT type, severity, CAST(id AS VARCHAR) FROM pairs WHERE other_brand
       UNION ALL SELECT type, severity, CAST(id AS VARCHAR) FROM pairs WHERE other_kind
       UNION ALL SELECT type, severity, CAST(id AS VARCHAR) FROM pairs WHERE other_size
       UNION ALL SELECT 'qweb_error', 'error', CAST(id AS VARCHAR) FROM views WHERE template AND active AND NOT sound
       UNION ALL SELECT 'missing_field', 'warning', CAST(id AS VARCHAR) FROM names
                 WHERE model IN (SELECT model FROM fields) AND (model, name) NOT IN (SELECT (model, name) FROM fields)
       UNION ALL SELECT 'missing_asset', 'warning', CAST(page_id AS VARCHAR) FROM pages
                 WHERE regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) NOT IN (
                     SELECT regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) FROM pages WHERE contains(url, '.net/'))""",
)
def validate_views_query(spark, sf):
    """The whole validation run over part views and page paths."""
    parent = F.nullif(F.floor(F.col("p_partkey") / 2), F.col("p_partkey"))
    views = part_views(spark, sf).select(
        F.col("p_partkey").alias("id"),
        parent.alias("inherit_id"),
        "model",
        F.when(F.col("model") == "PROMO", "qweb").otherwise("form").alias("type"),
        (F.col("p_size") != 20).alias("active"),
        F.col("document").alias("arch_db"),
    )
    fields = part_views(spark, sf).where("p_size > 45").select("model", F.col("brand").alias("name"))
    path = F.regexp_extract("url", r"^https?://[^/]+(/[^?#]*)", 1)
    pages = table(spark, sf, "pages")
    assets = pages.select(F.col("page_id").alias("id"), path.alias("path"), F.lit("pages").alias("bundle"))
    files = pages.where(F.col("url").contains(".net/"))
    files = files.select(F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1).alias("path"))
    done = validate_views(views, fields, assets, files)
    return done.issues.select("type", "severity", "entity_id")


@query(
    "expr_targets_missing",
    f"""WITH {PART_VIEWS}, pairs AS (
            SELECT c.p_partkey AS view_id, c.parent_id, c.brand, c.kind, c.p_size, p.brand AS parent_brand, p.kind AS parent_kind,
                   CASE WHEN p.parent_id IS NOT NULL THEN 'not checkable here: the parent inherits' END AS error
            FROM views c JOIN views p ON p.p_partkey = c.parent_id WHERE c.sound AND p.sound)
        SELECT view_id, parent_id, '//field[@name=''' || brand || ''']' AS expr, error FROM pairs WHERE brand <> parent_brand
        UNION ALL SELECT view_id, parent_id, '//field[contains(@kind, ''' || kind || ''') and @name]', error
                  FROM pairs WHERE kind <> parent_kind
        UNION ALL SELECT view_id, parent_id, '/form[@n=''' || p_size || ''' and not(@m)]', error
                  FROM pairs WHERE p_size <> parent_id""",
)
def expr_targets_missing(spark, sf):
    views = part_views(spark, sf)
    return docs.expr_targets_missing(views, "p_partkey", "parent_id", "document")


def customer_tree(spark, sf):
    """Customers below the customer of half their number; some roots, dangling, looped or broken."""
    parent = (
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", None)
        .when(F.col("c_acctbal") < -900, -F.col("c_custkey") - 1)
        .when((F.col("c_acctbal") > 9500) & (F.col("c_mktsegment") == "MACHINERY"), F.col("c_custkey"))
        .otherwise(F.nullif(F.floor(F.col("c_custkey") / 2), F.col("c_custkey")))
    )
    return table(spark, sf, "customer").select(
        "c_custkey", parent.alias("parent_id"), ((F.col("c_acctbal") > 9800) & (F.col("c_nationkey") < 12)).alias("bad")
    )


@query(
    "lineage_check",
    """WITH RECURSIVE base AS (
           SELECT c_custkey AS id, c_acctbal > 9800 AND c_nationkey < 12 AS bad,
                  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL WHEN c_acctbal < -900 THEN -c_custkey - 1
                       WHEN c_acctbal > 9500 AND c_mktsegment = 'MACHINERY' THEN c_custkey
                       ELSE nullif(c_custkey // 2, c_custkey) END AS parent FROM customer),
       starts AS (SELECT b.id, b.parent,
                         CASE WHEN b.bad THEN 'broken' WHEN b.parent IS NULL THEN 'ok'
                              WHEN p.id IS NULL THEN 'missing_parent' WHEN b.parent = b.id THEN 'cycle' END AS status
                  FROM base b LEFT JOIN base p ON p.id = b.parent),
       down(id, parent, status, depth) AS (
           SELECT id, parent, status, CAST(0 AS BIGINT) FROM starts WHERE status IS NOT NULL
           UNION ALL SELECT s.id, s.parent, CASE WHEN d.status = 'ok' THEN 'ok' ELSE 'broken_ancestor' END,
                            CASE WHEN d.status = 'ok' THEN d.depth + 1 ELSE 0 END
           FROM down d JOIN starts s ON s.parent = d.id AND s.status IS NULL)
       SELECT id, parent, status, depth FROM down""",
)
def lineage_check(spark, sf):
    return hierarchy.lineage_check(customer_tree(spark, sf), "c_custkey", "parent_id", F.col("bad"))


@query(
    "lineage_doubled",
    """WITH doubled AS (SELECT c_custkey AS id, nullif(c_custkey // 2, c_custkey) AS parent FROM customer
                        UNION ALL SELECT c_custkey, c_custkey - 1 FROM customer WHERE c_nationkey = 3 AND c_custkey > 1),
       single AS (SELECT id, CASE WHEN count(parent) = count(*) THEN min(parent) END AS parent, count(*) AS n FROM doubled GROUP BY id)
       SELECT id, parent, n FROM single""",
)
def lineage_doubled(spark, sf):
    """One row per id, with the parent that counts and how many rows share the id."""
    customer = table(spark, sf, "customer")
    first = customer.select(F.col("c_custkey").alias("id"), F.nullif(F.floor(F.col("c_custkey") / 2), F.col("c_custkey")).alias("parent"))
    again = customer.where("c_nationkey = 3 AND c_custkey > 1").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") - 1).alias("parent"))
    rows = first.unionByName(again)
    fate = hierarchy.lineage_check(rows, "id", "parent").select("id", "parent")
    counted = hierarchy.doubled_ids(rows, "id")
    return fate.join(counted, "id", "left").select("id", "parent", F.coalesce("n", F.lit(1)).alias("n"))


@query(
    "implied_closure",
    """WITH RECURSIVE grants AS (SELECT c_custkey AS member, 'nation ' || c_nationkey AS grp FROM customer
                       UNION SELECT c_custkey, c_mktsegment FROM customer
                       UNION SELECT c_custkey, 'world' FROM customer WHERE c_acctbal > 5000),
       edges AS (SELECT 'nation ' || n_nationkey AS a, 'region ' || n_regionkey AS b FROM nation
                 UNION SELECT 'region ' || r_regionkey, 'world' FROM region
                 UNION SELECT c_mktsegment, 'nation ' || min(c_nationkey) FROM customer WHERE c_acctbal > 9000 GROUP BY 1
                 UNION SELECT 'world', 'everyone' FROM region UNION SELECT 'everyone', 'world' FROM region),
       closure AS (SELECT a, b FROM edges UNION SELECT c.a, e.b FROM closure c JOIN edges e ON e.a = c.b)
       SELECT DISTINCT member, b AS grp FROM grants JOIN closure ON a = grp
       WHERE a <> b AND (member, b) NOT IN (SELECT (member, grp) FROM grants)""",
)
def implied_closure(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    region = table(spark, sf, "region")

    def named(kind, number):
        return F.concat(F.lit(f"{kind} "), F.col(number).cast("string"))

    member = F.col("c_custkey").alias("member")
    grants = (
        customer.select(member, named("nation", "c_nationkey").alias("grp"))
        .unionByName(customer.select(member, F.col("c_mktsegment").alias("grp")))
        .unionByName(customer.where("c_acctbal > 5000").select(member, F.lit("world").alias("grp")))
    )
    first_nation = customer.where("c_acctbal > 9000").groupBy("c_mktsegment").agg(F.min("c_nationkey").alias("first"))
    edges = (
        nation.select(named("nation", "n_nationkey").alias("a"), named("region", "n_regionkey").alias("b"))
        .unionByName(region.select(named("region", "r_regionkey").alias("a"), F.lit("world").alias("b")))
        .unionByName(first_nation.select(F.col("c_mktsegment").alias("a"), named("nation", "first").alias("b")))
        .unionByName(region.select(F.lit("world").alias("a"), F.lit("everyone").alias("b")))
        .unionByName(region.select(F.lit("everyone").alias("a"), F.lit("world").alias("b")))
    )
    return hierarchy.implied_closure(grants, "member", "grp", edges, "a", "b")


PATHS = """paths AS (
    SELECT page_id, CASE WHEN url LIKE '%/fr/%' THEN regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1) || '*'
                         WHEN url LIKE '%#top' THEN '' ELSE regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1) END AS path
    FROM pages)"""


def page_paths(spark, sf):
    path = F.regexp_extract("url", r"^https?://[^/]+(/[^?#]*)", 1)
    shown = F.when(F.col("url").like("%/fr/%"), F.concat(path, F.lit("*"))).when(
        F.col("url").like("%#top"), F.lit("")
    )
    return table(spark, sf, "pages").select("page_id", F.coalesce(shown, path).alias("path"))


NORMAL = f"""WITH {PATHS} SELECT page_id, path, regexp_replace(path, '^/', '') AS normal FROM paths
             WHERE path <> '' AND NOT contains(path, '*')"""


@query("normalise_paths", NORMAL)
def normalise_paths(spark, sf):
    return docs.normalise_paths(page_paths(spark, sf), "path")


@query(
    "missing_paths",
    f"""SELECT page_id, path, normal FROM ({NORMAL})
        WHERE normal NOT IN (SELECT regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) FROM pages WHERE contains(url, '.net/'))""",
)
def missing_paths(spark, sf):
    files = table(spark, sf, "pages").where(F.col("url").contains(".net/"))
    files = files.select(F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1).alias("file"))
    return docs.missing_paths(page_paths(spark, sf), "path", files, "file").select("page_id", "path", "normal")
