"""The stages for a business database moved from version 12 to 18.

Tables are passed as a dict of DataFrames under their database names.  A step
whose table or column is missing hands its input on unchanged, since not every
database has every module.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.functions import build_label, counter_name, json_scalar
from tablelift.operators import edit, hierarchy, joins, upsert
from tablelift.operators.checks import assertions
from tablelift.operators.dedup import duplicate_keys
from tablelift.plans.cleanup import Deduplicated, dedup_hierarchy
from tablelift.plans.path import Stage, Step, Tables, counted, with_report
from tablelift.plans.preflight import missing_by_class, view_census
from tablelift.plans.renumber import renumber_and_chain
from tablelift.plans.validation import validate_views
from tablelift.sources import change_catalog, change_lists, has_column

# fixed values: what became of modules, per version that made the change
CHANGES = {
    13: {"obsolete": [], "merged": [], "renamed": []},
    14: {"obsolete": [], "merged": [], "renamed": []},
    15: {
        "obsolete": [
            "l10n_ch_base_bank",
            "l10n_ch_isrb",
            "project_timeline_task_dependency",
            "account_reconcile_reconciliation_date",
        ],
        "merged": ["project_category", "project_deadline"],
        "renamed": [("crm_phone", "crm_phonecall")],
    },
    16: {
        "obsolete": [
            "account_reconciliation_widget",
            "account_statement_import",
            "account_statement_import_file_reconciliation_widget",
        ],
        "merged": [
            "account_balance_line",
            "l10n_ch_states",
            "project_task_dependency",
            "web_ir_actions_act_view_reload",
            "mail_activity_creator",
            "website_sale_require_login",
        ],
        "renamed": [
            ("account_statement_import_file_reconcile_oca", "account_statement_import_file_reconcile_oca"),
            ("mass_editing", "server_action_mass_edit"),
            ("crm_project", "crm_lead_to_task"),
        ],
    },
    17: {
        "obsolete": [],
        "merged": ["project_list", "web_advanced_search", "web_listview_range_select"],
        "renamed": [],
    },
    18: {
        "obsolete": ["account_payment_paired_internal_transfer", "account_reconciliation_widget"],
        "merged": ["account_payment_partner", "hr_expense_report_merge_attachment"],
        "renamed": [
            ("account_payment_mode", "account_payment_base_oca"),
            ("account_payment_sale", "account_payment_base_oca_sale"),
            ("account_payment_order", "account_payment_batch_oca"),
            ("account_payment_order_tier_validation", "account_payment_batch_oca_tier_validation"),
            ("account_banking_pain_base", "account_payment_sepa_base"),
            ("account_banking_sepa_credit_transfer", "account_payment_sepa_credit_transfer"),
            ("account_banking_mandate", "account_payment_mandate"),
            ("account_banking_mandate_sale", "account_payment_mandate_sale"),
            ("account_banking_sepa_direct_debit", "account_payment_sepa_direct_debit"),
            ("base_delivery_carrier_label", "delivery_shipping_label_default"),
            ("l10n_fr_oca", "l10n_fr_account_oca"),
        ],
    },
}

# fixed values: modules renamed, and merged into another, by the step to version 18
RENAMED_MODULES = [
    ("account_payment_mode", "account_payment_base_oca"),
    ("account_banking_pain_base", "account_payment_sepa_base"),
    ("account_banking_sepa_credit_transfer", "account_payment_sepa_credit_transfer"),
    ("account_payment_order", "account_payment_batch_oca"),
]
MERGED_MODULES = [("account_payment_partner", "account_payment_base_oca")]

# fixed values: report lines whose untracked expressions are in the way of version 18
REPORT_LINES = [
    "tax_report_16",
    "tax_report_23",
    "tax_report_TIC_total",
    "tax_report_X4",
    "tax_report_Y1",
    "tax_report_Y2",
    "tax_report_Y3",
    "tax_report_Z4",
    "tax_report_32",
]

# fixed values: fields dropped on the way to version 17, as (name, model or any)
DROPPED_FIELDS = [
    ("kanban_state_label", None),
    ("phone", "hr.employee"),
    ("hr_responsible_id", "hr.job"),
    ("address_home_id", "hr.employee"),
    ("manager_id", "project.task"),
]

# fixed values: settings, placeholders, patterns and defaults the stages write or look for
PLAN_SETTING = "analytic.project_plan"
PLAN_PLACEHOLDER = "migration_PROJECTS"
ALWAYS_TRUE_DOMAIN = '[(1,"=",1)]'
COMPILED_ASSETS = ["/web/assets/%", "%.assets_%"]
SIGNALING = "%signaling%"
PAYMENT_COLUMNS = [
    "payment_order_ok",
    "no_debit_before_maturity",
    "default_payment_mode",
    "default_invoice",
    "default_target_move",
    "default_date_type",
    "default_date_prefered",
    "group_lines",
]
CHAINED_STATES = ["paid", "done", "invoiced"]
# fixed values: data entries that lost their model, and a module that is gone
UNTYPED_DATA = ("website_sale", ["recommended_products", "product_comment"])
REMOVED_MODULE = "account_usability"
# fixed values: a new counter of a picking type
COUNTER_NAME = " Picking POS"
COUNTER_CODE = "POS"
COUNTER_DEFAULTS = {"padding": 5, "implementation": "standard", "number_increment": 1, "number_next": 1, "active": True}


def on(table: str, step: Callable[[DataFrame], DataFrame], *columns: str) -> Step:
    """A step that changes one table, skipped when the table or a needed column is missing."""

    def run(tables: Tables) -> Tables:
        df = tables.get(table)
        if df is None or not all(has_column(df, c) for c in columns):
            return tables
        return {**tables, table: step(df)}

    return run


def needs(step: Step, *names: str) -> Step:
    """A step skipped unless all tables are there."""
    return lambda tables: step(tables) if all(n in tables for n in names) else tables


# ---- before the first version -------------------------------------------------------------


def neutralise() -> list[Step]:
    """Switch off mail servers and scheduled jobs, remembering which jobs were on."""

    def jobs(df: DataFrame) -> DataFrame:
        kept = edit.add_column(df, "active_bkp", "boolean", if_absent=True)
        return edit.set_constant(edit.backup_column(kept, "active", "active_bkp"), "active", False)

    return [
        on("fetchmail_server", lambda df: edit.set_constant(df, "active", False)),
        on("ir_mail_server", lambda df: edit.set_constant(df, "active", False)),
        on("ir_cron", jobs),
    ]


def missing_modules(tables: Tables, target: DataFrame, origin: int, final: int, core_author: str) -> DataFrame:
    """Installed modules the target version lacks, with class and label, sorted by name."""
    spark = target.sparkSession
    catalog = change_catalog(change_lists(spark, CHANGES), origin, final)
    wanted = (F.col("state") == "installed") & ~F.col("author").isin(core_author)
    source = tables["ir_module_module"].select("name", "state", "author")
    classified = missing_by_class(source, target, "name", catalog, wanted)
    return classified.select("name", "class", "label").orderBy("name")


def views_before(tables: Tables) -> DataFrame:
    """The census of views asked for before a run; custom means without a module reference."""
    return view_census(
        tables["ir_ui_view"],
        "id",
        "key",
        "inherit_id",
        "arch_db",
        F.coalesce(F.col("active"), F.lit(False)),
        F.col("model_data_id").isNull(),
    )


def duplicate_views(tables: Tables) -> DataFrame:
    return duplicate_keys(tables["ir_ui_view"], "key", "id", F.col("active"))


# ---- versions 13 to 17 ----------------------------------------------------------------------


def _to_13() -> list[Step]:
    module, names = UNTYPED_DATA
    lost = (F.col("module") == module) & F.col("name").isin(names)
    return [
        on("account_account_type", lambda df: edit.add_column(df, "analytic_policy", "string")),
        on("ir_model_data", lambda df: edit.update_where(df, lost, {"model": "ir.ui.view"})),
    ]


def _to_15() -> list[Step]:
    entry = (F.col("module") == "base") & (F.col("name") == f"module_{REMOVED_MODULE}")
    return [
        on("ir_module_module", lambda df: edit.delete_where(df, F.col("name") == REMOVED_MODULE)),
        on("ir_model_data", lambda df: edit.delete_where(df, entry)),
    ]


def _setting_row(settings: DataFrame) -> tuple[dict[str, Column], str | None]:
    """What a new row of the settings holds besides key and value, and its id column."""
    now = F.current_timestamp()
    dates = {name: now for name in ("create_date", "write_date") if name in settings.columns}
    return dates, "id" if "id" in settings.columns else None


def _ensure_plan(tables: Tables) -> Tables:
    now = F.current_timestamp()
    named = F.col("name") == "Projects"
    default = {
        "name": "Projects",
        "complete_name": PLAN_PLACEHOLDER,
        "default_applicability": "optional",
        "create_date": now,
        "write_date": now,
    }
    plans = upsert.ensure_row(tables["account_analytic_plan"], named, default, "id")
    chosen = upsert.matching_id(plans, named, "id")
    settings = tables["ir_config_parameter"]
    settings = upsert.set_setting(settings, "key", PLAN_SETTING, chosen, "value", *_setting_row(settings))
    return {**tables, "account_analytic_plan": plans, "ir_config_parameter": settings}


def _drop_fields(df: DataFrame) -> DataFrame:
    doomed = F.lit(False)
    for name, model in DROPPED_FIELDS:
        match = F.col("name") == name
        doomed = doomed | (match if model is None else match & (F.col("model") == model))
    return edit.delete_where(df, doomed)


def _retire_plan(tables: Tables) -> Tables:
    plans, settings = upsert.retire_placeholder(
        tables["account_analytic_plan"],
        F.col("complete_name") == PLAN_PLACEHOLDER,
        F.col("complete_name") == "Projects",
        "id",
        tables["ir_config_parameter"],
        "key",
        PLAN_SETTING,
        "value",
        *_setting_row(tables["ir_config_parameter"]),
    )
    return {**tables, "account_analytic_plan": plans, "ir_config_parameter": settings}


# ---- version 18, before -----------------------------------------------------------------------


def _tracked(tables: Tables, model: str, module: str, names: list[str] | None = None) -> DataFrame:
    data = tables["ir_model_data"].where((F.col("module") == module) & (F.col("model") == model))
    return data if names is None else data.where(F.col("name").isin(names))


def _drop_untracked_expressions(tables: Tables) -> Tables:
    kept = joins.delete_orphans(
        tables["account_report_expression"],
        "id",
        ("report_line_id", _tracked(tables, "account.report.line", "l10n_fr", REPORT_LINES), "res_id"),
        (_tracked(tables, "account.report.expression", "l10n_fr"), "res_id"),
        F.col("label") == "balance",
    )
    return {**tables, "account_report_expression": kept}


def _open_plan_rule(tables: Tables) -> Tables:
    rule = _tracked(tables, "ir.rule", "analytic", ["analytic_plan_comp_rule"]).select(F.col("res_id").alias("id"))
    rules = edit.update_by_keys(tables["ir_rule"], "id", rule.dropna(), {"domain_force": ALWAYS_TRUE_DOMAIN})
    return {**tables, "ir_rule": rules}


def _rename_payment_modules(tables: Tables) -> Tables:
    modules = tables["ir_module_module"]
    installed = modules.where((F.col("name") == "account_payment_mode") & (F.col("state") == "installed"))
    if installed.isEmpty():
        return tables
    columns = {"ir_module_module": "name", "ir_model_data": "module", "ir_module_module_dependency": "name"}
    cascade = upsert.rename_cascade(tables, columns, "ir_module_module", RENAMED_MODULES)
    renamed = cascade.tables
    dependencies = renamed["ir_module_module_dependency"]
    merger = upsert.merge_namespace(
        renamed,
        ("ir_module_module", "name"),
        ("ir_model_data", "module", "name"),
        ("ir_module_module_dependency", "name", dependencies.columns),
        MERGED_MODULES,
    )
    merged = with_report(merger.tables, "modules.rename_collisions", cascade.collisions)
    merged = with_report(merged, "modules.dropped_data", merger.dropped)
    merged = with_report(merged, "modules.duplicate_links", merger.duplicate_links)
    search = (F.col("module") == "account_payment_base_oca") & (F.col("name") == "view_account_invoice_report_search")
    unlocked = edit.update_where(merged["ir_model_data"], search, {"noupdate": False})
    return {**merged, "ir_model_data": unlocked}


def _before_18(legacy_barcode: str) -> list[Step]:
    return [
        needs(_drop_untracked_expressions, "account_report_expression", "ir_model_data"),
        on("web_tour_tour", lambda df: edit.delete_where(df, F.col("user_id").isNull())),
        needs(_open_plan_rule, "ir_rule", "ir_model_data"),
        needs(_rename_payment_modules, "ir_module_module", "ir_model_data", "ir_module_module_dependency"),
        on("res_partner", lambda df: edit.rename_column(df, "barcode", legacy_barcode), "barcode"),
        on("account_analytic_plan", lambda df: edit.nullify(df, "default_applicability", "optional")),
        on("ir_ui_view", lambda df: edit.delete_where(df, F.col("model") == "res.config.settings")),
        _signal,
    ]


def _signal(tables: Tables) -> Tables:
    """Advance the counters running workers watch to notice changes."""
    step = on("counters", lambda df: edit.bump_counters(df, "name", SIGNALING, "value"))
    return step(tables)


# ---- version 18, after ------------------------------------------------------------------------


def _migrate_payment_modes(tables: Tables) -> Tables:
    modes, lines = tables["account_payment_mode"], tables["account_payment_method_line"]
    for column in ("old_payment_mode_id", "old_refund_payment_mode_id"):
        lines = edit.add_column(lines, column, "int", if_absent=True)
    copied = ["payment_method_id", "bank_account_link", "company_id", "create_uid", "create_date"]
    copied += ["write_uid", "write_date", "show_bank_account", "active"]
    mapping = {
        "name": json_scalar(F.col("name")),
        "journal_id": F.col("fixed_journal_id"),
        "selectable": True,
        "old_refund_payment_mode_id": F.col("refund_payment_mode_id"),
        **{c: F.col(c) for c in copied},
    }
    lines = upsert.append_mapped(lines, modes, mapping, "id", "id", "old_payment_mode_id")
    if "refund_payment_method_line_id" not in lines.columns:
        lines = edit.add_column(lines, "refund_payment_method_line_id", "int")
    lines = joins.remap_self_reference(
        lines, "old_refund_payment_mode_id", "old_payment_mode_id", "id", "refund_payment_method_line_id"
    )
    result = {**tables, "account_payment_method_line": lines}

    bridge = "account_journal_account_payment_method_line_rel"
    variable = "account_payment_mode_variable_journal_rel"
    if bridge in tables and variable in tables:
        migrated = lines.where(F.col("old_payment_mode_id").isNotNull())
        pairs = joins.expand_relation(
            migrated,
            tables[variable],
            ("old_payment_mode_id", "payment_mode_id"),
            F.col("bank_account_link") == "variable",
            {"account_payment_method_line_id": "id", "account_journal_id": "journal_id"},
        )
        result[bridge] = upsert.insert_ignore(tables[bridge], pairs, tables[bridge].columns)
    if "account_move" in tables:
        result["account_move"] = joins.update_from_chain(
            tables["account_move"],
            _mode_links(modes, lines),
            {"preferred_payment_method_line_id": "line.id"},
            tie="line.id",
            only_null=True,
        )
    return result


def _mode_links(modes: DataFrame, lines: DataFrame) -> list[joins.Link]:
    return [
        joins.Link("mode", modes, "payment_mode_id", "id"),
        joins.Link("line", lines, "mode.id", "old_payment_mode_id"),
    ]


def _migrate_payment_orders(tables: Tables) -> Tables:
    modes, methods = tables["account_payment_mode"], tables["account_payment_method"]
    if has_column(methods, "payment_order_only"):
        given = F.col("payment_order_only").isNotNull()
        methods = edit.update_where(methods, given, {"payment_order_ok": F.col("payment_order_only")})
    lines = joins.update_from(
        tables["account_payment_method_line"],
        modes,
        {"old_payment_mode_id": "id"},
        {c: c for c in PAYMENT_COLUMNS},
        unique=True,
    )
    result = {**tables, "account_payment_method": methods, "account_payment_method_line": lines}

    bridge = "account_journal_account_payment_method_line_rel"
    old_bridge = "account_journal_account_payment_mode_rel"
    if bridge in tables and old_bridge in tables:
        remapped = joins.remap_bridge(
            tables[old_bridge],
            "account_payment_mode_id",
            lines,
            "old_payment_mode_id",
            "id",
            "account_payment_method_line_id",
        )
        migrated = lines.where(F.col("old_payment_mode_id").isNotNull()).select("id")
        result[bridge] = upsert.replace_slice(
            tables[bridge], "account_payment_method_line_id", migrated, remapped, tables[bridge].columns
        )
    links = [*_mode_links(modes, lines), joins.Link("method", methods, "line.payment_method_id", "id")]
    columns = {"payment_method_line_id": "line.id", "payment_method_code": "method.code"}
    result["account_payment_order"] = joins.update_from_chain(
        tables["account_payment_order"], links, columns, tie="line.id"
    )
    return result


def _make_counters(tables: Tables) -> Tables:
    if not has_column(tables["stock_warehouse"], "pos_type_id"):
        return tables
    houses = tables["stock_warehouse"].select(
        F.col("pos_type_id").alias("id"),
        F.col("id").alias("warehouse_id"),
        F.col("code").alias("warehouse_code"),
        F.col("name").alias("warehouse_name"),
        F.col("company_id").alias("warehouse_company_id"),
    )
    types, counters = upsert.ensure_dimension(
        tables["stock_picking_type"],
        "id",
        "sequence_id",
        tables["ir_sequence"],
        "id",
        {
            "name": build_label(F.col("warehouse_name"), COUNTER_NAME),
            "prefix": build_label(
                F.col("warehouse_code"), "/", F.coalesce(F.col("sequence_code"), F.lit(COUNTER_CODE)), "/"
            ),
            "company_id": F.col("warehouse_company_id"),
            **COUNTER_DEFAULTS,
        },
        context=houses,
        order=["warehouse_id"],
    )
    return {**tables, "stock_picking_type": types, "ir_sequence": counters}


def missing_counter_objects(tables: Tables, catalog: DataFrame, truncate: bool = False) -> DataFrame:
    """Standard counters without a database object of their name, with start and step."""
    standard = tables["ir_sequence"].where(F.col("implementation") == "standard")
    name = counter_name("ir_sequence_", F.col("id"), truncate=truncate)
    columns = standard.select("id", "number_increment", "number_next")
    return joins.expected_missing(columns, name, catalog, "relname", "relname")


def picking_checks(tables: Tables) -> DataFrame:
    """Post-conditions of version 18: no placeholder names, no picking type without a counter."""
    placeholder = {"picking without a name": F.col("name") == "/"}
    types, houses = tables["stock_picking_type"], tables["stock_warehouse"]
    used = houses.select(F.col("pos_type_id").alias("id"))
    lacking = {"picking type without a counter": F.col("sequence_id").isNull() | (F.col("sequence_id") == 0)}
    named = assertions(tables["stock_picking"], placeholder)
    return named.unionByName(assertions(types.join(used, "id"), lacking))


def _after_18() -> list[Step]:
    line, mode = "account_payment_method_line", "account_payment_mode"
    return [
        needs(_migrate_payment_modes, mode, line),
        needs(_migrate_payment_orders, mode, line, "account_payment_order", "account_payment_method"),
        counted(
            "pickings.renamed",
            "stock_picking",
            on("stock_picking", lambda df: edit.placeholder_rename(df, "name", "/", "MIGRATED-", "id")),
            renamed=F.col("name").startswith("MIGRATED-"),
            remaining=F.col("name") == "/",
        ),
        needs(_make_counters, "stock_picking", "stock_picking_type", "stock_warehouse", "ir_sequence"),
        needs(_check_pickings, "stock_picking", "stock_picking_type", "stock_warehouse"),
        needs(_follow_implied_groups, "res_groups_users_rel", "res_groups_implied_rel"),
        _signal,
    ]


def _follow_implied_groups(tables: Tables) -> Tables:
    """Members of a group become members of the groups it implies; who was added is reported."""
    grants = tables["res_groups_users_rel"]
    added = hierarchy.implied_closure(grants, "uid", "gid", tables["res_groups_implied_rel"], "gid", "hid")
    result = {**tables, "res_groups_users_rel": grants.unionByName(added.select(*grants.columns))}
    return with_report(result, "groups.added", added)


def _check_pickings(tables: Tables) -> Tables:
    if not has_column(tables["stock_warehouse"], "pos_type_id"):
        return tables
    return with_report(tables, "pickings.checks", picking_checks(tables))


def stages(legacy_barcode: str = "legacy_18_0_barcode") -> dict[int, Stage]:
    """All stages; `legacy_barcode` is the name under which the upgrade expects the old column."""
    return {
        13: Stage(before=_to_13()),
        15: Stage(before=_to_15()),
        17: Stage(
            before=[
                needs(_ensure_plan, "account_analytic_plan", "ir_config_parameter"),
                on("ir_model_fields", _drop_fields),
            ],
            after=[needs(_retire_plan, "account_analytic_plan", "ir_config_parameter")],
        ),
        18: Stage(before=_before_18(legacy_barcode), after=_after_18()),
    }


# ---- after the last version -----------------------------------------------------------------


def purge_and_reset() -> list[Step]:
    """Drop compiled assets and take pending upgrades as done."""
    stale = (F.col("res_model") == "ir.ui.view") & (F.col("mimetype") == "text/css")
    pending = F.col("state") == "to upgrade"
    return [
        on("ir_attachment", lambda df: edit.delete_like(df, "name", COMPILED_ASSETS, stale)),
        on("ir_module_module", lambda df: edit.update_where(df, pending, {"state": "installed"})),
    ]


def dedup_views(tables: Tables) -> Deduplicated:
    return dedup_hierarchy(
        tables["ir_ui_view"], "key", "id", "inherit_id", F.col("model_data_id").isNotNull(), F.col("active")
    )


class Modules(NamedTuple):
    kept: DataFrame
    absent: DataFrame
    dependents: DataFrame


def cleanup_modules(tables: Tables, manifest: DataFrame) -> Modules:
    """Drop modules without files unless installed; say who depends on the installed ones."""
    modules, needed = tables["ir_module_module"], tables["ir_module_module_dependency"]
    absent = joins.absent_from_manifest(modules, "name", manifest, "name", "state")
    owners = modules.where("state = 'installed'").select(F.col("id").alias("module_id"), F.col("name").alias("owner"))
    edges = needed.select("module_id", F.col("name").alias("needs")).join(owners, "module_id")
    cautious = absent.where("verdict = 'caution'")
    return Modules(
        joins.drop_safe(modules, "id", absent),
        absent.select("id", "name", "state", "verdict"),
        joins.dependents(cautious, "name", edges, "owner", "needs"),
    )


def rebuild_order_chain(tables: Tables, payload: Column) -> Tables:
    """Renumber and re-chain point-of-sale orders if any number or hash is missing."""
    if "pos_order" not in tables:
        return tables
    done = renumber_and_chain(
        tables["pos_order"],
        tables["res_company"],
        tables["ir_sequence"],
        row_id="id",
        company="company_id",
        company_id="id",
        counter_of="l10n_fr_pos_cert_sequence_id",
        counter_id="id",
        counter_next="number_next",
        order=["date_order", "id"],
        qualifies=F.col("state").isin(CHAINED_STATES),
        payload=payload,
        sequence="l10n_fr_secure_sequence_number",
        previous="previous_order_id",
        hash_column="l10n_fr_hash",
    )
    result = {**tables, "pos_order": done.rows, "ir_sequence": done.counters}
    result = with_report(result, "orders.chain", done.counts)
    return with_report(result, "orders.chain_issues", done.issues)


def finish(
    payload: Column,
    manifest: DataFrame | None = None,
    relations: DataFrame | None = None,
    fields: DataFrame | None = None,
) -> list[Step]:
    """The steps after the last version, in order; each reports what it did and what it could not do.

    `relations` (relname) turns on the check for counters without a database
    object, `fields` (model, name) the validation of the views, which only warns.
    """

    def views(tables: Tables) -> Tables:
        done = dedup_views(tables)
        result = with_report({**tables, "ir_ui_view": done.rows}, "views.redirects", done.log)
        return with_report(with_report(result, "views.failures", done.failures), "views.summary", done.summary)

    def modules(tables: Tables) -> Tables:
        done = cleanup_modules(tables, manifest)
        result = with_report({**tables, "ir_module_module": done.kept}, "modules.absent", done.absent)
        return with_report(result, "modules.dependents", done.dependents)

    def counters(tables: Tables) -> Tables:
        return with_report(tables, "counters.missing", missing_counter_objects(tables, relations))

    def validation(tables: Tables) -> Tables:
        done = validate_views(tables["ir_ui_view"], fields)
        result = with_report(with_report(tables, "views.issues", done.issues), "views.stats", done.stats)
        return with_report(result, "views.verdict", done.verdict)

    steps = [*purge_and_reset(), needs(views, "ir_ui_view")]
    if manifest is not None:
        steps.append(needs(modules, "ir_module_module", "ir_module_module_dependency"))
    steps.append(needs(lambda t: rebuild_order_chain(t, payload), "pos_order", "res_company", "ir_sequence"))
    if relations is not None:
        steps.append(needs(counters, "ir_sequence"))
    if fields is not None:
        steps.append(needs(validation, "ir_ui_view"))
    return steps


def known_changes(spark: SparkSession, origin: int, final: int) -> DataFrame:
    return change_catalog(change_lists(spark, CHANGES), origin, final)
