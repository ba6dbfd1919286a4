"""Counts, post-conditions and issue reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablelift.operators.sequence import collect_in_pieces

ISSUE_COLUMNS = ("type", "severity", "entity_id", "detail")


def count_where(df: DataFrame, predicate: Column, out: str = "n") -> DataFrame:
    return df.agg(F.count_if(predicate).alias(out))


def census(df: DataFrame, flags: Mapping[str, Column], total: str = "total") -> DataFrame:
    """The total and one count per flag, in a single pass."""
    return df.agg(
        F.count(F.lit(1)).alias(total), *[F.count_if(flag).alias(name) for name, flag in flags.items()]
    )


def collect_per_group(
    df: DataFrame, key: str | Sequence[str], value: str, out: str, separator: str = ", ", tie: str | None = None,
    entries: int = 1000,
) -> DataFrame:
    """The values of each group as sorted, joined text, in pieces of at most `entries` values."""
    pieces = collect_in_pieces(df, key, value, "__values", tie, entries=entries)
    joined = F.array_join(F.col("__values").cast("array<string>"), separator)
    return pieces.withColumn(out, joined).drop("__values")


def write_counted(df: DataFrame, path: str, counts: Mapping[str, Column]) -> dict[str, int]:
    """Write the table and count its rows in the same pass.

    Returns `rows` and one number per named predicate.
    """
    seen = Observation()
    observed = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(predicate).alias(name) for name, predicate in counts.items()],
    )
    observed.write.mode("overwrite").parquet(path)
    return dict(seen.get)


def assertions(df: DataFrame, rules: Mapping[str, Column], max_bad: int = 0) -> DataFrame:
    """One row per rule: how many rows violate it, and OK or WARN.

    A rule's predicate describes a bad row; all rules share one pass.
    """
    counted = df.agg(*[F.count_if(bad).alias(f"__rule_{i}") for i, bad in enumerate(rules.values())])
    rows = F.array(
        *[F.struct(F.lit(name).alias("rule"), F.col(f"__rule_{i}").alias("n")) for i, name in enumerate(rules)]
    )
    return counted.select(F.inline(rows)).withColumn(
        "status", F.when(F.col("n") > max_bad, "WARN").otherwise("OK")
    )


def issues_from(
    df: DataFrame, kind: str, severity: str, entity_id: str, detail: Mapping[str, Column | str] | None = None
) -> DataFrame:
    """Rows as issues: type, severity, entity and a JSON object with the details."""
    parts = [(F.col(v) if isinstance(v, str) else v).cast("string").alias(k) for k, v in (detail or {}).items()]
    body = F.to_json(F.struct(*parts)) if parts else F.lit(None).cast("string")
    return df.select(
        F.lit(kind).alias("type"),
        F.lit(severity).alias("severity"),
        F.col(entity_id).cast("string").alias("entity_id"),
        body.alias("detail"),
    )


def issue_report(*checks: DataFrame) -> DataFrame:
    """All issues of several checks in one table."""
    report, *others = checks
    for check in others:
        report = report.unionByName(check)
    return report


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("type", "severity").agg(F.count(F.lit(1)).alias("n"))


def verdict(issues: DataFrame) -> DataFrame:
    """One row: errors, warnings, and whether the run passed; warnings alone do not fail it."""
    counted = issues.agg(
        F.count_if(F.col("severity") == "error").alias("errors"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
    )
    status = (
        F.when(F.col("errors") > 0, "failed").when(F.col("warnings") > 0, "passed with warnings").otherwise("passed")
    )
    return counted.withColumn("status", status)
