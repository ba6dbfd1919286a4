"""URL filters: a blocked Bloom filter passes possible hits to an exact hash join.

What is listed comes in two tables: `rules` (host, path, verdict) fit their host and all its
subdomains where the URL's path starts with theirs, and `listed` (url) are single pages to block,
compared in canonical form.  Both become keys.  A URL has one key per shape of the rules (number of
host labels, length of the path) that it is long enough for, and the key of its own canonical form.

The filter has one 256-bit block per BLOCK_KEYS keys, rounded up to a power of two and never more
than MOST_BLOCKS blocks, so what is broadcast is bounded whatever is listed; a longer list only lets
more keys through.  A key belongs to one block and sets PROBES bits in it, so that testing it looks
up one row.  Keys that pass are counted, the distinct ones joined with the listed keys by a hash
join, which removes false positives, and what was found goes back to the URLs; a key that a third
of all URLs share is one row in the first join and spread out in the second.

Of the rules that fit a URL the longest wins (code points of host and path together, then of the
host).  Without one, a listed page is blocked and any other allowed.

Host: after the first `://` up to `/`, `?`, `#` or the end, only A-Z lower-cased; path: on from there up
to `?`, `#` or the end.  Canonical form: host without the ports 80 and 443 and without a leading `www.`,
path without one trailing slash.

Defined results: a URL that is null, empty or without `://` has empty host and path, and is no listed
page; rules with a null or with a path that neither is empty nor starts with a slash fit nothing; of
equal rules that differ in their verdict the one that blocks counts; rows that repeat are judged each,
null ids stay null; an empty table gives no rows, empty lists allow all; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.llm.common import class_join, written

BLOCK_KEYS = 16
MOST_BLOCKS = 1 << 18
PROBES = 8  # bits per key, two in each of the four words of a block
WORDS = [f"word{i}" for i in range(PROBES // 2)]
# The rules of the query.
RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]

ORACLE = f"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
parts AS (
    SELECT row_number() OVER () AS n, page_id,
        translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
    FROM pages),
best AS (
    SELECT n, max_by(rules.host || rules.path, length(rules.host || rules.path) * 1000 + length(rules.host)) AS rule,
        max_by(verdict, length(rules.host || rules.path) * 1000 + length(rules.host)) AS verdict
    FROM parts JOIN rules ON (parts.host = rules.host OR ends_with(parts.host, '.' || rules.host)) AND starts_with(parts.path, rules.path)
    GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)
"""


def lower(text: Column) -> Column:
    """A-Z only, as everywhere in the contracts."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return lower(raw), F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)


def canonical(host: Column, path: Column) -> Column:
    site = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    return F.concat(site, F.regexp_replace(path, "/$", ""))


def labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def rule_key(host: Column, path: Column) -> Column:
    """Unambiguous, since no host holds a slash and a path that is not empty starts with one."""
    return F.concat(F.lit("r"), host, path)


def page_key(host: Column, path: Column) -> Column:
    return F.concat(F.lit("u"), canonical(host, path))


def entries_of(rules: DataFrame, listed: DataFrame | None) -> DataFrame:
    """(key, size, host_size, rule, verdict), one row per key; listed pages have size -1 and no rule."""
    host, path = lower(F.col("host")), F.col("path")
    fine = (F.col("verdict").isNotNull()) & ((path == "") | path.startswith("/"))
    rule = F.concat(host, path)
    entries = rules.where(fine & host.isNotNull()).select(
        rule_key(host, path).alias("key"), F.length(rule).alias("size"), F.length(host).alias("host_size"),
        rule.alias("rule"), "verdict", labels(host).alias("labels"), F.length(path).alias("path_size"),
    )
    if listed is not None:
        host, path = host_and_path(F.col("url"))
        pages = listed.where(host != "").select(page_key(host, path).alias("key")).distinct()
        blank = [F.lit(-1).alias("size"), F.lit(-1).alias("host_size"), F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict")]
        entries = entries.unionByName(pages.select("key", *blank), allowMissingColumns=True)
    same = [c for c in entries.columns if c not in ("key", "verdict")]
    return entries.groupBy("key").agg(*[F.first(c).alias(c) for c in same], F.max("verdict").alias("verdict"))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def masks(key: Column) -> list[Column]:
    """The bits of a key in each word of its block, from six bits of a second hash each."""
    h = F.xxhash64(key, F.lit(1))
    bits = [F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(PROBES)]
    ones = [F.call_function("shiftleft", F.lit(1).cast("long"), b) for b in bits]
    return [ones[2 * i].bitwiseOR(ones[2 * i + 1]) for i in range(PROBES // 2)]


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, word0..word3): at most `blocks` rows."""
    words = [m.alias(w) for m, w in zip(masks(F.col("key")), WORDS, strict=True)]
    return keys.select(block_of(F.col("key"), blocks).alias("block"), *words).groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS])


def possible_hits(probes: DataFrame, filters: DataFrame, blocks: int) -> DataFrame:
    """The rows of `probes` whose key the filter does not rule out."""
    tested = probes.withColumn("block", block_of(F.col("key"), blocks)).join(F.broadcast(filters), "block")  # at most MOST_BLOCKS rows
    passed = F.lit(True)
    for word, mask in zip(WORDS, masks(F.col("key")), strict=True):
        passed &= F.col(word).bitwiseAND(mask) == mask
    return tested.where(passed).select(*probes.columns)


def probes_of(rows: DataFrame, shapes: list[tuple[int, int]], pages: bool) -> DataFrame:
    """(row, key): every key under which a URL may be listed."""
    held = labels(F.col("host"))
    made = F.array().cast("array<string>")
    if shapes:
        known = F.array(*[F.struct(F.lit(k).alias("labels"), F.lit(n).alias("path_size")) for k, n in shapes])
        fitting = F.filter(known, lambda s: (s.labels <= held) & (s.path_size <= F.length("path")))
        made = F.transform(fitting, lambda s: rule_key(F.call_function("substring_index", F.col("host"), F.lit("."), -s.labels), F.left(F.col("path"), s.path_size)))
    if pages:
        made = F.concat(made, F.when(F.col("host") != "", F.array(page_key(F.col("host"), F.col("path")))).otherwise(F.array().cast("array<string>")))
    return rows.select("row", F.explode(made).alias("key"))


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame | None = None, row_id: str = "page_id", url: str = "url") -> DataFrame:
    """(`row_id`, host, path, rule, verdict) of every row of `pages`.

    Only (labels, path length) pairs of the rules and the number of keys reach the driver: at most the
    labels of a host times the lengths of a path, however many rules there are.
    """
    host, path = host_and_path(F.col("__url"))
    rows = pages.select(F.col(f"`{row_id}`").alias("id"), F.col(f"`{url}`").alias("__url"))
    rows = written(rows.select("id", host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row")), "urls")
    entries = written(entries_of(rules, listed), "entries")
    blocks = 1
    while blocks * BLOCK_KEYS < entries.count() and blocks < MOST_BLOCKS:
        blocks *= 2
    shapes = [(s[0], s[1]) for s in entries.where("size >= 0").select("labels", "path_size").distinct().collect()]
    probes = probes_of(rows, sorted(shapes), listed is not None)
    possible = possible_hits(probes, bloom_filter(entries, blocks), blocks)
    possible = written(possible.withColumn("code", F.xxhash64("key")), "possible")  # class_join's first key is a long
    counted = possible.groupBy("code", "key").agg(F.count(F.lit(1)).alias("n_urls"))
    values = ["size", "host_size", "rule", "verdict"]
    found = written(entries.select("key", *values).hint("shuffle_hash").join(counted, "key"), "found")
    hits = class_join(possible, found, ["code", "key"], values, "n_urls", ["row"])
    best = hits.groupBy("row").agg(F.max(F.struct(*values)).alias("best"))
    judged = rows.join(best, "row", "left")
    verdict = F.coalesce(F.col("best.verdict"), F.lit("allow"))
    return judged.select(F.col("id").alias(row_id), "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))


def listed_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "host string, path string, verdict string")
