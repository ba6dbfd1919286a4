"""Validation reports as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.operators.sequence import number_rows
from tablelift.scale import materialise, range_partitions


def report_document(
    issues: DataFrame, stats: DataFrame, kind: str, database: str, at: Column | None = None
) -> DataFrame:
    """The report as rows of JSON text, ready for `write.text`.

    The first row is the header: type, timestamp, database, the one-row `stats`
    and the number of errors and warnings.  Each issue follows as a row of its
    own, since a report may hold more issues than one value can carry.  `at`
    is the time to state, by default now.
    """
    counts = issues.agg(
        F.count_if(F.col("severity") == "error").alias("errors"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
    )
    header = stats.select(
        F.lit(0).alias("ord"),
        F.to_json(
            F.struct(
                F.lit(kind).alias("type"),
                _stated(at).alias("timestamp"),
                F.lit(database).alias("database"),
                F.struct(*[F.col(c) for c in stats.columns]).alias("stats"),
                counts.select("errors").scalar().alias("errors"),
                counts.select("warnings").scalar().alias("warnings"),
            )
        ).alias("value"),
    )
    body = issues.select(F.lit(1).alias("ord"), F.to_json(F.struct("*")).alias("value"))
    return header.unionByName(body)


def _stated(at: Column | None) -> Column:
    return F.date_format(F.current_timestamp() if at is None else at, "yyyy-MM-dd'T'HH:mm:ss")


def write_report(
    issues: DataFrame, stats: DataFrame, path: str, kind: str, database: str, enabled: bool = True, at: Column | None = None
) -> dict | None:
    """Write `<path>/issues` and `<path>/summary` as JSON when enabled.

    Both have one shape whatever the number of issues: the issues are JSON
    lines, written in parallel, and the summary is one object with the stats
    and the numbers of errors and warnings.
    """
    if not enabled:
        return None
    spark = issues.sparkSession
    issues.write.mode("overwrite").json(f"{path}/issues")
    written = spark.read.schema(issues.schema).json(f"{path}/issues")
    totals = written.agg(
        F.count_if(F.col("severity") == "error").alias("n_errors"),
        F.count_if(F.col("severity") == "warning").alias("n_warnings"),
    )
    found = totals.first()
    summary = stats.select(
        F.lit(kind).alias("type"),
        _stated(at).alias("timestamp"),
        F.lit(database).alias("database"),
        F.struct(*[F.col(c) for c in stats.columns]).alias("stats"),
        F.lit(found.n_errors).alias("n_errors"),
        F.lit(found.n_warnings).alias("n_warnings"),
    )
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    return {"errors": found.n_errors, "warnings": found.n_warnings, "passed": found.n_errors == 0}


def report_lines(issues: DataFrame, stats: DataFrame, kind: str, database: str, at: Column | None = None) -> DataFrame:
    """(section, nth, value): the lines of one JSON object, in the order of `section` and `nth`.

    Its keys are type, timestamp, database, stats, errors and warnings.  Every
    issue is an object in a line of its own: type, severity, entity_id and the
    keys of its detail, or `detail` itself where that is no object.  Errors are one list, all other severities the other,
    each ordered by type, entity and detail.
    """
    head = F.struct(F.lit(kind).alias("type"), _stated(at).alias("timestamp"), F.lit(database).alias("database"), F.struct(*stats.columns).alias("stats"))
    header = F.concat(F.regexp_replace(F.to_json(head), r"\}$", ""), F.lit(',"errors":['))
    own = F.regexp_replace(F.to_json(F.struct("type", "severity", "entity_id")), r"\}$", "")
    keys = F.when(F.col("detail").rlike(r"(?s)^\{.*\}$"), F.col("detail")).otherwise(F.to_json(F.struct("detail")))
    detail = F.when(keys.isNull() | (keys == "{}"), "}").otherwise(F.concat(F.lit(","), F.substr(keys, F.lit(2))))
    listed = issues.select(
        F.when(F.col("severity") == "error", 1).otherwise(3).alias("section"), "type", "entity_id", F.concat(own, detail).alias("value")
    )
    numbered = number_rows(listed, "section", ["type", "entity_id", "value"], "nth")
    body = numbered.select("section", "nth", F.concat(F.when(F.col("nth") > 1, ",").otherwise(""), F.col("value")).alias("value"))
    first = F.lit(0).cast("long").alias("nth")
    fixed = [stats.select(F.lit(0).alias("section"), first, header.alias("value"))]
    fixed += [issues.sparkSession.range(1).select(F.lit(n).alias("section"), first, F.lit(text).alias("value")) for n, text in ((2, '],"warnings":['), (4, "]}"))]
    for part in fixed:
        body = body.unionByName(part)
    return body


def write_report_object(
    issues: DataFrame, stats: DataFrame, path: str, kind: str, database: str, enabled: bool = True, at: Column | None = None
) -> bool:
    """Write `path` as text files that, joined in the order of their names, are one JSON object (`report_lines`).

    The lines are dealt over the files by ranges and written in parallel, so no
    task and no value holds the whole report.  Returns whether it was written.
    """
    if not enabled:
        return False
    lines = materialise(report_lines(issues, stats, kind, database, at), "report")  # ranges are drawn from it first
    placed = lines.repartitionByRange(range_partitions(lines), "section", "nth").sortWithinPartitions("section", "nth")
    placed.select("value").write.mode("overwrite").text(path)
    return True
