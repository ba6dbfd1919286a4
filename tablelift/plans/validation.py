"""The validation run after a migration: six checks, one report."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.functions import is_true, shorten
from tablelift.operators.checks import issue_report, issues_from, verdict
from tablelift.operators.documents import (
    ERROR_LENGTH,
    INVALID,
    expr_targets_missing,
    field_refs_missing,
    has_doctype,
    missing_paths,
    parse_once,
)
from tablelift.operators.hierarchy import lineage_check
from tablelift.scale import materialise


class Validation(NamedTuple):
    issues: DataFrame
    stats: DataFrame
    verdict: DataFrame


# fixed values: the kinds of views whose field references are checked
FIELD_VIEW_KINDS = ("form", "tree", "search", "kanban", "pivot", "graph")
TEMPLATE_KIND = "qweb"
# fixed values: the counters of the report and the issues they count
COUNTED = {
    "broken_xpath": "orphan_xpath",
    "broken_combine": "combination_error",
    "broken_qweb": "qweb_error",
    "broken_fields": "missing_field",
    "missing_assets": "missing_asset",
}


def validate_views(
    views: DataFrame,
    fields: DataFrame,
    assets: DataFrame | None = None,
    files: DataFrame | None = None,
    *,
    row_id: str = "id",
    parent: str = "inherit_id",
    document: str = "arch_db",
    kind: str = "type",
    model: str = "model",
    active: Column | None = None,
    first_per_model: bool = False,
) -> Validation:
    """Check inheritance, expression targets, templates, field references and files.

    Reads only; missing fields and files, expressions that cannot be checked
    here and documents that declare a type are warnings, the rest are errors.
    """
    active = F.col("active") if active is None else active
    shown = is_true(active)
    inherited = shown & F.col(parent).isNotNull()
    columns = views.select(
        F.col(row_id).alias("id"), F.col(parent).alias("parent"), F.col(kind).alias("kind"), F.col(model).alias("model"),
        shown.alias("shown"), inherited.alias("inherited"), has_doctype(F.col(document)).alias("declared"), F.col(document).alias("document"),
    )
    facts = materialise(parse_once(columns, "document"), "facts")  # every document is parsed here

    # an inactive row is a valid ancestor, so lineage is traced over all rows
    lineage = lineage_check(facts, "id", "parent", F.col("error").isNotNull())
    unsound = lineage.where(F.col("status") != "ok").join(facts.where("inherited").select("id"), "id", "left_semi")
    combination = issues_from(unsound, "combination_error", "error", "id", {"parent": "parent", "error": "status"})

    asked = facts.where("inherited").select(F.col("id").alias("view_id"), F.col("parent").alias("parent_id"), F.explode("exprs").alias("expr"))
    targets = expr_targets_missing(views, row_id, parent, document, found=asked)
    orphans = issues_from(
        targets.where("error IS NULL"), "orphan_xpath", "error", "view_id", {"parent": "parent_id", "xpath": "expr"}
    )
    invalid = F.startswith("error", F.lit(INVALID))
    rejected = issues_from(
        targets.where(invalid), "orphan_xpath", "error", "view_id",
        {"parent": "parent_id", "xpath": "expr", "xpath_error": "error"},
    )
    unchecked = issues_from(
        targets.where(~invalid), "unchecked_xpath", "warning", "view_id",
        {"parent": "parent_id", "xpath": "expr", "reason": "error"},
    )
    declared = issues_from(facts.where("shown AND declared"), "document_type", "warning", "id")

    templates = facts.where(F.col("shown") & (F.col("kind") == TEMPLATE_KIND) & F.col("error").isNotNull())
    templates = templates.withColumn("error", shorten(F.col("error"), ERROR_LENGTH))
    qweb = issues_from(templates, "qweb_error", "error", "id", {"error": "error"})

    checked = facts.where(F.col("shown") & F.col("kind").isin(*FIELD_VIEW_KINDS) & F.col("model").isNotNull())
    names = checked.select(F.col("id").alias("view_id"), "model", F.inline("names"))
    refs = field_refs_missing(checked, "id", "model", "document", fields, first_per_model, names)
    missing_fields = issues_from(
        refs, "missing_field", "warning", "view_id", {"model": "model", "field": "name", "tag": "tag"}
    )

    parts = [combination, orphans, rejected, unchecked, declared, qweb, missing_fields]
    if assets is not None and files is not None:
        lost = missing_paths(assets, "path", files, "path", "normal")
        parts.append(issues_from(lost, "missing_asset", "warning", "id", {"path": "path", "bundle": "bundle"}))
    issues = materialise(issue_report(*parts), "issues")

    totals = facts.agg(
        F.count_if("shown").alias("total_views"),
        F.count_if("inherited").alias("inherited_views"),
        F.count_if(F.col("shown") & (F.col("kind") == TEMPLATE_KIND)).alias("qweb_views"),
    )
    counted = issues.agg(*[F.count_if(F.col("type") == t).alias(n) for n, t in COUNTED.items()])
    stats = totals.withColumns({n: counted.select(n).scalar() for n in COUNTED})
    return Validation(issues, stats, verdict(issues))
