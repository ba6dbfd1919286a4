"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Every source gets a target in words: the sources, ordered by code point with null last, weigh
`weights` in turn and share `share` of all words; a target stops at `cap` times its source's
words and the excess is shared again by weight among the others.

The document rates are the solution of an entropy balancing problem: among all rates whose words
meet the targets, those nearest to 1 in relative entropy, counted per word.  Its convex dual has
one multiplier per source, the rates are exp(multiplier), and Newton steps on the dual need two
sums over the source's documents per step, which do not change between the steps and are summed
once.  The rates are then rounded into whole copies: within (source, hash bucket) the documents
are ordered by size and copy numbers are taken at even steps, so each source's words come near
its target whatever the sizes.

Defined results: null or empty text has size 0 and is taken with 0 words; null is a source of its
own; an empty table gives an empty result; equal rows are told apart by nothing and share what
their places in the order give; other columns pass through, and names of the added columns
overwrite equal names.  Reruns agree, since every order is by content.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablelift.llm.common import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BUCKET_ROWS = 4096  # documents of one source that are ordered together
NEWTON_STEPS = 60
PHASE = 0.381966011  # where in each bucket the even steps begin
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(
    sized: DataFrame, source: str, size: str, weights: Sequence[int], share: float, cap: int
) -> DataFrame:
    """One row per source: its words, documents, weight and target.

    Capped sources are those whose cap lies lowest per weight.  Sorted that way, the level (words
    per weight) that the rest can share is known at each source, and the first source whose cap is
    above it ends the capped ones.  The windows hold one row per source.
    """
    sums = sized.groupBy(F.col(source).alias("source")).agg(
        F.sum(size).alias("source_size"), F.count(F.lit(1)).alias("source_docs")
    )
    place = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(w) for w in weights])
    weighed = sums.withColumn("weight", F.element_at(turn, F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1))
    by_cap = Window.orderBy(
        F.col("source_size") * F.lit(float(cap)) / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levelled = weighed.select(
        "*",
        (
            (F.lit(share) * F.sum("source_size").over(everything) - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
            / F.sum("weight").over(onward)
        ).alias("level"),
        F.row_number().over(by_cap).alias("nth"),
    )
    fits = F.col("level") <= F.col("source_size") * F.lit(float(cap)) / F.col("weight")
    level = F.min(F.when(fits, F.struct("nth", "level"))).over(everything)["level"]
    target = F.least(F.col("source_size") * F.lit(float(cap)), F.col("level") * F.col("weight"))
    return (
        levelled.withColumn("level", F.coalesce(level, F.lit(0.0)))
        .select("source", "source_size", "source_docs", "weight", target.alias("target"))
    )


def balanced_rate(words: Column, target: Column, cap: int, steps: int = NEWTON_STEPS) -> Column:
    """exp of the dual optimum: Newton steps on sum(size) * exp(m) - target * m, from m = 0.

    Gradient and curvature are both sums over the documents.  The function is convex and the steps
    approach the optimum from above after the first one, so they cannot overshoot.
    """

    def step(m: Column, _: Column) -> Column:
        curvature = words * F.exp(m)
        return m - (curvature - target) / curvature

    optimum = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0.0), step)
    solved = F.least(F.round(F.exp(optimum), 9), F.lit(float(cap)))
    return F.when((words > 0) & (target > 0), solved).otherwise(F.lit(0.0))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
) -> DataFrame:
    """`docs` with size, source_size, target, rate, copies and taken (size times copies)."""
    added = ["size", "source_size", "target", "rate", "copies", "taken"]
    kept = [c for c in docs.columns if c not in added]
    order = F.md5(F.concat_ws(":", F.col(doc_id).cast("string"), F.coalesce(F.col(text), F.lit(""))))
    sized = docs.select(
        *kept, word_count(F.col(text)).alias("size"), F.conv(F.substring(order, 1, 15), 16, 10).cast("long").alias("__order")
    )
    per_source = targets(docs.select(F.col(source), word_count(F.col(text)).alias("size")), source, "size", weights, share, cap)
    rated = per_source.select(
        F.col("source").alias("__source"),
        "source_size",
        "target",
        balanced_rate(F.col("source_size").cast("double"), F.col("target"), cap).alias("rate"),
        F.ceil(F.col("source_docs") / F.lit(BUCKET_ROWS)).cast("long").alias("__buckets"),
    )
    rated = written(rated, "rates")
    if rated.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rated = F.broadcast(rated)
    placed = sized.join(rated, F.col(source).eqNullSafe(F.col("__source")))
    bucket = F.pmod(F.col("__order"), F.col("__buckets")).alias("__bucket")
    within = Window.partitionBy("__source", "__bucket").orderBy(F.col("size").desc(), "__order")
    place = F.row_number().over(within)
    whole = F.floor("rate")
    part = F.col("rate") - whole
    extra = F.floor(place * part + F.lit(PHASE)) - F.floor((place - 1) * part + F.lit(PHASE))
    return (
        placed.withColumn("__bucket", bucket)
        .withColumn("copies", (whole + extra).cast("long"))
        .withColumn("taken", F.col("size") * F.col("copies"))
        .select(*kept, *added)
    )


def repeated(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: each document as often as it has copies."""
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return mixed.where("copies > 0").select(*columns, copies.alias("__copy")).select(*columns)


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), coalesce(text, ''))), 1, 15) AS BIGINT) AS ord
  FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight FROM sums),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST) AS nth FROM weighed),
levelled AS (
  SELECT o.*, (1.5::DOUBLE * (SELECT sum(source_size) FROM sums) - 2 * coalesce((SELECT sum(p.source_size) FROM ordered p WHERE p.nth < o.nth), 0))
    / (SELECT sum(p.weight) FROM ordered p WHERE p.nth >= o.nth) AS level FROM ordered o),
chosen AS (
  SELECT coalesce(min_by(level, nth), 0) AS level FROM levelled WHERE level <= source_size * 2.0::DOUBLE / weight),
rated AS (
  SELECT source, source_size, n, least(source_size * 2.0::DOUBLE, (SELECT level FROM chosen) * weight) AS target FROM levelled),
solved AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(round(target / source_size, 9), 2.0::DOUBLE) ELSE 0 END AS rate FROM rated),
placed AS (
  SELECT d.doc_id, d.size, s.source_size, s.target, s.rate,
         row_number() OVER (PARTITION BY s.source, d.ord % CAST(ceil(s.n / {BUCKET_ROWS}.0) AS BIGINT) ORDER BY d.size DESC, d.ord) AS place
  FROM sized d JOIN solved s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
       size * CAST(floor(rate) + floor(place * (rate - floor(rate)) + {PHASE}::DOUBLE) - floor((place - 1) * (rate - floor(rate)) + {PHASE}::DOUBLE) AS BIGINT) AS taken
FROM placed
"""
