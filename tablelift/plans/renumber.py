"""Renumber and re-chain the documents of each company, if any is incomplete."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.functions import is_true
from tablelift.operators.checks import issues_from
from tablelift.operators.joins import precheck_count
from tablelift.operators.sequence import chain_breaks, gapless_sequence, hash_chain, next_counter
from tablelift.scale import lookup_join, once


class Renumbered(NamedTuple):
    rows: DataFrame
    counters: DataFrame
    ran: bool
    counts: DataFrame  # outcome, n: chained, no payload, remaining
    issues: DataFrame  # rows of the chain that do not verify, with the reason


def renumber_and_chain(
    rows: DataFrame,
    companies: DataFrame,
    counters: DataFrame,
    *,
    row_id: str,
    company: str,
    company_id: str,
    counter_of: str,
    counter_id: str,
    counter_next: str,
    order: list[Column | str],
    qualifies: Column,
    payload: Column,
    sequence: str,
    previous: str,
    hash_column: str,
) -> Renumbered:
    """Rebuild sequence, predecessor and hash of all qualifying rows.

    Nothing happens unless some qualifying row of a company with a counter
    lacks its number or hash.  Once one does, all rows of such companies are
    rebuilt, since every later hash depends on the earlier ones.  The result is
    written once and then verified; what does not verify is reported.
    """
    covered = companies.where(F.col(counter_of).isNotNull()).select(F.col(company_id).alias(company))
    lacking = F.col(hash_column).isNull() | F.col(sequence).isNull()
    needed = precheck_count(rows, covered, (company, company), fact_where=qualifies & lacking).first()[0]
    def judged(done: DataFrame, ran: bool) -> tuple[DataFrame, DataFrame]:
        """What came of the chain: counts, and an issue per row without payload or with a broken link."""
        inside = lookup_join(done, covered.distinct(), company, "left_semi").where(qualifies)
        breaks = chain_breaks(
            inside.withColumn("__payload", payload), company, [sequence, row_id], "__payload", row_id, hash_column
        )
        broken = once(breaks, "breaks")
        outcomes = inside.agg(
            F.count_if(F.col(hash_column).isNotNull() & F.lit(ran)).alias("chained"),
            F.count_if(payload.isNull()).alias("no payload"),
            F.count_if(lacking).alias("remaining"),
        )
        listed = F.array(*[F.struct(F.lit(c).alias("outcome"), F.col(c).alias("n")) for c in outcomes.columns])
        return outcomes.select(F.inline(listed)), issues_from(broken, "chain_break", "warning", row_id, {"reason": "reason"})

    if not needed:
        return Renumbered(rows, counters, False, *judged(rows, False))

    marks = covered.distinct().withColumn("__covered", F.lit(True))
    marked = lookup_join(rows, marks, company, "left")
    chosen = is_true(qualifies & F.col("__covered"))
    numbered = gapless_sequence(
        marked.where(chosen), company, order, sequence, previous=previous, row_id=row_id
    ).drop("__covered")
    chained = hash_chain(numbered.withColumn("__payload", payload), company, [sequence], "__payload", hash_column)
    rest = marked.where(~chosen).select(*rows.columns)
    rebuilt = rest.unionByName(chained.select(*rows.columns))

    owners = companies.where(F.col(counter_of).isNotNull()).select(
        F.col(company_id).alias("__company"), F.col(counter_of).alias(counter_id)
    )
    due = next_counter(
        rows.where(qualifies),
        company,
        owners.withColumn("__due", F.lit(None).cast("long")),
        "__company",
        "__due",
    ).groupBy(counter_id).agg(F.max("__due").alias("__due"))
    updated = counters.join(due, counter_id, "left").withColumn(
        counter_next, F.coalesce("__due", counter_next).cast(counters.schema[counter_next].dataType)
    )
    rebuilt = once(rebuilt, "chained")
    return Renumbered(rebuilt, updated.select(*counters.columns), True, *judged(rebuilt, True))
