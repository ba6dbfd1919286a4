"""The business stages end to end on a small database."""

import hashlib

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablelift.plans import business
from tablelift.plans.path import Stage, counted, reports, run_path, version_path
from tablelift.plans.validation import validate_views
from tablelift.scale import new_table_path
from tablelift.sources import SnapshotStore, change_lists, file_manifest, has_table, mirror_files, read_change_files, read_table, run_sql, write_files, write_report, write_report_object


@pytest.fixture(scope="module")
def database(frame):
    return {
        "ir_module_module": frame(
            "id int, name string, author string, state string",
            (1, "base", "core", "installed"), (2, "account_usability", "x", "installed"),
            (3, "account_payment_mode", "x", "installed"), (4, "account_payment_partner", "x", "installed"),
            (5, "account_payment_order", "x", "to upgrade"), (6, "mass_editing", "x", "installed"),
            (7, "gone", "x", "installed"), (8, "old", "x", "uninstalled"), (9, "project_list", None, "installed"),
            (10, "web_advanced_search", "x", "installed"),
        ),
        "ir_module_module_dependency": frame(
            "module_id int, name string", (7, "account_payment_mode"), (3, "base"), (6, "gone"), (7, "account_payment_partner")
        ),
        "ir_model_data": frame(
            "module string, name string, model string, res_id int, noupdate boolean",
            ("website_sale", "product_comment", None, 1, False), ("base", "module_account_usability", "m", 2, False),
            ("l10n_fr", "tax_report_16", "account.report.line", 100, False),
            ("l10n_fr", "tracked", "account.report.expression", 201, False),
            ("analytic", "analytic_plan_comp_rule", "ir.rule", 50, True),
            ("account_payment_mode", "view_account_invoice_report_search", "ir.ui.view", 3, True),
            ("account_payment_partner", "view_account_invoice_report_search", "ir.ui.view", 4, True),
            ("account_payment_partner", "other", "ir.ui.view", 5, True),
        ),
        "ir_model_fields": frame(
            "id int, name string, model string",
            (1, "phone", "hr.employee"), (2, "phone", "res.partner"), (3, "kanban_state_label", "any"), (4, "phone", None),
        ),
        "ir_cron": frame("id int, active boolean", (1, True), (2, False)),
        "account_account_type": frame("id int", (1,)),
        "account_analytic_plan": frame(
            "id int, name string, complete_name string, default_applicability string, create_date timestamp, write_date timestamp",
            (1, "Other", "Other", "optional", None, None),
        ),
        "ir_config_parameter": frame(
            "key string, value string, create_date timestamp, write_date timestamp",
            ("analytic.project_plan", "77", None, None), ("web.base.url", "u", None, None),
        ),
        "account_report_expression": frame(
            "id int, label string, report_line_id int", (200, "balance", 100), (201, "balance", 100), (202, "balance", 101), (203, "tag", 100)
        ),
        "web_tour_tour": frame("id int, user_id int", (1, None), (2, 5)),
        "ir_rule": frame("id int, domain_force string", (50, "old"), (51, "keep")),
        "res_partner": frame("id int, barcode string", (1, "x")),
        "ir_ui_view": frame(
            "id int, name string, key string, model string, type string, active boolean, inherit_id int, arch_db string, model_data_id int, xml_id string",
            (1, "a", "k", "res.partner", "form", True, None, "<form><field name='name'/></form>", 11, "a"),
            (2, "b", "k", "res.partner", "form", True, None, "<form><field name='bad'/></form>", None, None),
            (3, "c", "c", "res.partner", "form", True, 2, "<d><xpath expr=\"//field[@name='name']\"/><xpath expr=\"//nope\"/></d>", None, None),
            (4, "d", None, "res.config.settings", "form", True, None, "<form/>", None, None),
            (5, "e", "q", None, "qweb", True, None, "<t><p></t>", 12, "e"),
            (6, "f", "k", "res.partner", "form", False, None, "<form/>", 13, "f"),
        ),
        "account_payment_mode": frame(
            "id int, name string, company_id int, payment_method_id int, fixed_journal_id int, bank_account_link string, create_date timestamp,"
            " create_uid int, write_date timestamp, write_uid int, show_bank_account string, refund_payment_mode_id int, active boolean,"
            " payment_order_ok boolean, no_debit_before_maturity boolean, default_payment_mode string, default_invoice boolean,"
            " default_target_move string, default_date_type string, default_date_prefered string, group_lines boolean",
            (1, 'Wire "A"', 1, 10, None, "variable", None, 1, None, 1, "full", 2, True, True, False, "same", None, "posted", "due", "now", True),
            (2, "Refund", 1, 11, 30, "fixed", None, 1, None, 1, None, None, False, None, None, None, None, None, None, None, None),
        ),
        "account_payment_method_line": frame(
            "id int, name string, payment_method_id int, bank_account_link string, journal_id int, selectable boolean, company_id int,"
            " create_uid int, create_date timestamp, write_uid int, write_date timestamp, show_bank_account string, active boolean,"
            " refund_payment_method_line_id int",
            (7, '"Manual"', 10, "fixed", 30, True, 1, 1, None, 1, None, None, True, None),
        ),
        "account_payment_method": frame(
            "id int, code string, payment_order_only boolean, payment_order_ok boolean", (10, "sct", True, None), (11, "sdd", None, False)
        ),
        "account_payment_mode_variable_journal_rel": frame("payment_mode_id int, journal_id int", (1, 30), (1, 31), (2, 32)),
        "account_journal_account_payment_mode_rel": frame("account_payment_mode_id int, account_journal_id int", (1, 40), (9, 41)),
        "account_journal_account_payment_method_line_rel": frame(
            "account_payment_method_line_id int, account_journal_id int", (7, 30)
        ),
        "account_move": frame(
            "id int, payment_mode_id int, preferred_payment_method_line_id int", (1, 1, None), (2, 2, 7), (3, None, None)
        ),
        "account_payment_order": frame(
            "id int, payment_mode_id int, payment_method_line_id int, payment_method_code string", (1, 2, 7, "x"), (2, None, 7, "y")
        ),
        "stock_picking": frame("id int, name string, company_id int", (1, "/", 1), (2, "/", 1), (3, "OUT/3", 1)),
        "stock_picking_type": frame("id int, name string, sequence_code string, sequence_id int", (1, "pos", None, 0), (2, "out", "OUT", 4), (3, "shop", "S", None)),
        "stock_warehouse": frame("id int, pos_type_id int, code string, name string, company_id int", (1, 1, "WH", "Main", 1), (2, 3, "W2", "Side", 2)),
        "ir_sequence": frame(
            "id int, name string, prefix string, padding int, company_id int, implementation string, number_increment int, number_next int, active boolean",
            (4, "out", "OUT/", 5, 1, "standard", 1, 8, True), (5, "cert", None, 0, 1, "no_gap", 1, 99, True),
        ),
        "ir_attachment": frame("id int, name string, res_model string, mimetype string", (1, "/web/assets/1", None, None), (2, "doc", None, None)),
        "counters": frame("name string, value long", ("base_registry_SIGNALING", 5), ("other", 5)),
        "pos_order": frame(
            "id int, company_id int, state string, date_order string, previous_order_id int, l10n_fr_hash string, l10n_fr_secure_sequence_number int",
            (1, 1, "done", "2024-01-02", None, "x", 9), (2, 1, "paid", "2024-01-01", None, None, None), (3, 1, "draft", "2024-01-01", None, "d", 4),
            (4, 2, "done", "2024-01-01", None, None, 1),
        ),
        "res_company": frame("id int, name string, l10n_fr_pos_cert_sequence_id int", (1, "A", 5), (2, "B", None)),
    }


def test_preflight(database, frame, rows):
    target = frame("name string, shortdesc string, author string", ("base", "b", "core"), ("account_usability", "u", "x"))
    found = business.missing_modules(database, target, 14, 18, "core")
    assert rows(found) == [
        ("account_payment_mode", "renamed", "account_payment_mode -> account_payment_base_oca"),
        ("account_payment_partner", "merged", "account_payment_partner"),
        ("gone", "missing", "gone"),
        ("mass_editing", "renamed", "mass_editing -> server_action_mass_edit"),
        ("web_advanced_search", "merged", "web_advanced_search"),
    ]
    census = business.views_before(database).first().asDict()
    assert census == {"total": 6, "custom": 3, "module": 3, "duplicate_keys": 1, "custom_with_exprs": 1}


@pytest.fixture(scope="module")
def migrated(spark, database, frame):
    """All stages from 12 to 18 and the clean-up, resumed once from version 17."""
    store = SnapshotStore(spark, new_table_path(spark, "business"))
    payload = F.concat_ws("|", F.col("id").cast("string"), "date_order")
    manifest = frame("name string", ("base",), ("account_payment_base_oca",), ("mass_editing",), ("project_list",), ("account_payment_batch_oca",))
    relations, fields = frame("relname string", ("ir_sequence_004",)), frame("model string, name string", ("res.partner", "name"))
    options = {"finish": business.finish(payload, manifest, relations, fields), "prepare": business.neutralise()}
    run_path(store, database, 12, 17, business.stages())
    return run_path(store, None, 12, 18, business.stages("legacy_barcode"), resume_from="17", **options)


def test_the_run_returns_its_reports(migrated, rows):
    found = reports(migrated)
    assert sorted(found) == [
        "counters.missing", "modules.absent", "modules.dependents", "modules.dropped_data", "modules.duplicate_links",
        "modules.rename_collisions", "orders.chain", "orders.chain_issues", "pickings.checks", "pickings.renamed", "views.failures",
        "views.issues", "views.redirects", "views.stats", "views.summary", "views.verdict",
    ]
    assert rows(found["modules.rename_collisions"]) == []
    assert rows(found["modules.dropped_data"], "name") == [("view_account_invoice_report_search",)]
    assert rows(found["modules.duplicate_links"], "module_id", "n") == [(7, 2)]
    assert rows(found["pickings.renamed"]) == [("stock_picking", 3, 3, 2, 0)]
    assert rows(found["pickings.checks"], "n", "status") == [(0, "OK"), (0, "OK")]
    assert ("gone", "caution") in rows(found["modules.absent"], "name", "verdict")
    assert rows(found["views.summary"]) == [(2, 0, 1, 0)]
    assert rows(found["orders.chain"]) == [("chained", 2), ("no payload", 0), ("remaining", 0)]
    assert rows(found["orders.chain_issues"]) == []
    assert ("ir_sequence_006",) in rows(found["counters.missing"], "relname")
    assert rows(found["views.verdict"], "status") == [("failed",)]


def test_stages(migrated, database, rows):
    t = migrated
    assert rows(t["ir_module_module"], "name", "state") == [
        ("base", "installed"), ("account_payment_base_oca", "installed"), ("account_payment_batch_oca", "installed"),
        ("mass_editing", "installed"), ("gone", "installed"), ("project_list", "installed"), ("web_advanced_search", "installed"),
    ]
    assert rows(t["ir_module_module_dependency"]) == [
        (7, "account_payment_base_oca"), (3, "base"), (6, "gone"), (7, "account_payment_base_oca")
    ]
    data = {(r.module, r.name): (r.model, r.noupdate) for r in t["ir_model_data"].collect()}
    assert data[("website_sale", "product_comment")] == ("ir.ui.view", False)
    assert data[("account_payment_base_oca", "view_account_invoice_report_search")] == ("ir.ui.view", False)
    assert data[("account_payment_base_oca", "other")] == ("ir.ui.view", True)
    assert len(data) == 6
    assert rows(t["ir_model_fields"], "id") == [(2,), (4,)]
    assert t["account_account_type"].columns == ["id", "analytic_policy"]
    assert rows(t["account_analytic_plan"], "name", "default_applicability") == [("Other", None)]
    assert rows(t["ir_config_parameter"], "key", "value") == [("analytic.project_plan", None), ("web.base.url", "u")]
    assert rows(t["account_report_expression"], "id") == [(201,), (202,), (203,)]
    assert rows(t["web_tour_tour"], "id") == [(2,)]
    assert rows(t["ir_rule"]) == [(50, '[(1,"=",1)]'), (51, "keep")]
    assert t["res_partner"].columns == ["id", "legacy_barcode"]
    assert rows(t["ir_attachment"], "id") == [(2,)]
    assert rows(t["counters"]) == [("base_registry_SIGNALING", 7), ("other", 5)]


def test_payment_stage(migrated, rows):
    t = migrated
    lines = {r.id: r for r in t["account_payment_method_line"].collect()}
    assert sorted(lines) == [7, 8, 9]
    assert lines[8].name == '"Wire \\"A\\""'
    assert (lines[8].old_payment_mode_id, lines[8].refund_payment_method_line_id, lines[8].default_target_move) == (1, 9, "posted")
    assert (lines[9].journal_id, lines[9].selectable, lines[9].active, lines[9].refund_payment_method_line_id) == (30, True, False, None)
    # the second block empties and refills what the first one inserted
    assert rows(t["account_journal_account_payment_method_line_rel"]) == [(7, 30), (8, 40)]
    assert rows(t["account_move"], "id", "preferred_payment_method_line_id") == [(1, 8), (2, 7), (3, None)]
    assert rows(t["account_payment_order"]) == [(1, 2, 9, "sdd"), (2, None, 7, "y")]
    assert rows(t["account_payment_method"], "id", "payment_order_ok") == [(10, True), (11, False)]


def test_picking_stage(migrated, frame, rows):
    t = migrated
    assert rows(t["stock_picking"], "name") == [("MIGRATED-1",), ("MIGRATED-2",), ("OUT/3",)]
    assert rows(t["stock_picking_type"], "id", "sequence_id") == [(1, 6), (2, 4), (3, 7)]
    made = rows(t["ir_sequence"].where("id > 5"), "id", "name", "prefix", "padding", "company_id", "number_next")
    assert made == [(6, "Main Picking POS", "WH/POS/", 5, 1, 1), (7, "Side Picking POS", "W2/S/", 5, 2, 1)]
    existing = frame("relname string", ("ir_sequence_004",))
    assert rows(business.missing_counter_objects(t, existing), "relname") == [("ir_sequence_006",), ("ir_sequence_007",)]
    assert rows(business.picking_checks(t), "n", "status") == [(0, "OK"), (0, "OK")]


def test_clean_up(migrated, rows):
    t = migrated
    assert rows(t["ir_ui_view"], "id", "inherit_id") == [(1, None), (3, 1), (5, None)]
    first = hashlib.sha256(b"2|2024-01-01").hexdigest()
    second = hashlib.sha256((first + "1|2024-01-02").encode()).hexdigest()
    columns = ["id", "previous_order_id", "l10n_fr_hash", "l10n_fr_secure_sequence_number"]
    assert rows(t["pos_order"], *columns) == [(1, 2, second, 2), (2, None, first, 1), (3, None, "d", 4), (4, None, None, 1)]
    assert rows(t["ir_sequence"].where("id = 5"), "number_next") == [(3,)]


def test_clean_up_reports(database, frame, rows):
    done = business.dedup_views(database)
    assert rows(done.summary) == [(2, 0, 1, 0)]
    found = business.cleanup_modules(database, frame("name string", ("base",), ("mass_editing",)))
    assert ("gone", "caution") in rows(found.absent, "name", "verdict")
    assert rows(found.dependents.where("name = 'gone'")) == [("gone", "mass_editing")]
    assert ("old",) not in list(rows(found.kept, "name"))


def test_validation_and_report(spark, database, frame, rows):
    fields = frame("model string, name string", ("res.partner", "name"))
    assets = frame("id int, path string, bundle string", (1, "/web/a.js", "b"), (2, "web/b.js", "b"), (3, "web/*.js", "b"), (4, None, "b"))
    done = validate_views(database["ir_ui_view"], fields, assets, frame("path string", ("web/a.js",)))
    assert rows(done.issues, "type", "severity", "entity_id") == [
        ("missing_asset", "warning", "2"), ("missing_field", "warning", "2"), ("orphan_xpath", "error", "3"),
        ("orphan_xpath", "error", "3"), ("qweb_error", "error", "5"),
    ]
    assert done.stats.first().asDict() == {
        "total_views": 5, "inherited_views": 1, "qweb_views": 1, "broken_xpath": 2, "broken_combine": 0,
        "broken_qweb": 1, "broken_fields": 1, "missing_assets": 1,
    }
    path = new_table_path(spark, "report")
    assert write_report(done.issues, done.stats, path, "views", "db", enabled=False) is None
    assert write_report(done.issues, done.stats, path, "views", "db") == {"errors": 3, "warnings": 2, "passed": False}
    summary = spark.read.json(f"{path}/summary").first()
    assert (summary.type, summary.database, summary.n_errors) == ("views", "db", 3)
    assert spark.read.json(f"{path}/issues").count() == 5


def test_expressions_that_xpath_rejects_fail_the_validation(frame, rows):
    doc = "<d><xpath expr='//field['/><xpath expr='count(//field) = 1'/><xpath expr='(//field)[2]'/></d>"
    views = frame("id int, inherit_id int, arch_db string, type string, model string, active boolean",
                  (1, None, "<f><field name='a'/></f>", "form", "m", True), (2, 1, doc, "form", "m", True))
    done = validate_views(views, frame("model string, name string", ("m", "a")))
    found = done.issues.selectExpr("type", "severity", "get_json_object(detail, '$.xpath')", "get_json_object(detail, '$.xpath_error') IS NOT NULL")
    assert rows(found) == [("orphan_xpath", "error", "//field[", True), ("orphan_xpath", "error", "(//field)[2]", False)]
    assert done.stats.first().broken_xpath == 2


def test_reports_have_one_shape_whatever_their_length(spark, frame):
    stats = frame("total long", (1,))
    shapes = set()
    for n in (0, 1, 1000, 1001):
        issues = spark.range(n).selectExpr("'t' AS type", "'error' AS severity", "cast(id AS string) AS entity_id", "cast(NULL AS string) AS detail")
        path = new_table_path(spark, "report")
        assert write_report(issues, stats, path, "views", "db")["errors"] == n
        shapes.add(spark.read.json(f"{path}/summary").schema.simpleString())
    assert len(shapes) == 1


@pytest.mark.parametrize("n", [0, 1, 7, 2500])
def test_a_report_object_is_one_document(spark, frame, both, n):
    detail = "CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN '{}' WHEN 2 THEN concat('{\"path\":\"a', id, '\\\\n\"}') ELSE 'plain \"text\"' END"
    issues = spark.range(n).repartition(5).selectExpr("concat('t', id % 3) AS type", "CASE WHEN id % 2 = 0 THEN 'error' ELSE 'warning' END AS severity", "cast(id AS string) AS entity_id", f"{detail} AS detail")
    path = new_table_path(spark, "report").removeprefix("file:")
    stats = frame("total long, broken long", (n, 2))
    assert not write_report_object(issues, stats, path, "views", "db", enabled=False)
    assert write_report_object(issues, stats, path, "views", 'd"b', at=F.to_timestamp(F.lit("2024-01-02 03:04:05")))
    parts = sorted(Path(path).glob("part-*"))
    report = json.loads("".join(p.read_text() for p in parts))
    assert list(report) == ["type", "timestamp", "database", "stats", "errors", "warnings"]
    assert (report["type"], report["timestamp"], report["database"], report["stats"]) == ("views", "2024-01-02T03:04:05", 'd"b', {"total": n, "broken": 2})
    found = report["errors"] + report["warnings"]
    assert all(e["severity"] == "error" for e in report["errors"]) and all(e["severity"] == "warning" for e in report["warnings"])
    assert sorted(int(e["entity_id"]) for e in found) == list(range(n))
    for e in found:
        i = int(e["entity_id"])
        own = [{}, {}, {"path": f"a{i}\n"}, {"detail": 'plain "text"'}][i % 4]
        assert e == {"type": f"t{i % 3}", "severity": e["severity"], "entity_id": str(i), **own}
    assert n < 2500 or len(parts) > 1


def test_files_are_mirrored(spark, frame, rows, tmp_path):
    src, dst = tmp_path / "a b%20ü", tmp_path / "dst"
    files = frame("path string, text string", ("x.txt", "one"), ("deep/er/y z.txt", "zwei ü"), ("deep/%41.txt", ""), ("n.txt", None), (None, "lost"), ("twice", "b"), ("twice", "a"))
    assert rows(write_files(files, str(src), "path", "text")) == [("x.txt", 3), ("deep/er/y z.txt", 7), ("deep/%41.txt", 0), ("n.txt", 0), ("twice", 1)]
    found = {r.path: (r.length, r.fingerprint) for r in file_manifest(spark, str(src)).collect()}
    assert found == {p: (len(t), hashlib.sha256(t).hexdigest()) for p, t in (("x.txt", b"one"), ("deep/er/y z.txt", "zwei ü".encode()), ("deep/%41.txt", b""), ("n.txt", b""), ("twice", b"a"))}
    assert rows(file_manifest(spark, str(src), "*.txt", content=False), "path", "fingerprint") == [("x.txt", "3"), ("deep/er/y z.txt", "7"), ("deep/%41.txt", "0"), ("n.txt", "0")]
    assert file_manifest(spark, str(dst)).count() == 0

    first = mirror_files(spark, str(src), str(dst))
    assert rows(first, "path", "action") == [(p, "copy") for p in found]
    (dst / "x.txt").write_text("two")
    (dst / "more").mkdir()
    (dst / "more" / "extra").write_bytes(b"0" * 10)
    (dst / "n.txt").unlink()
    again = mirror_files(spark, str(src), str(dst))
    assert rows(again) == [("x.txt", "update", 3), ("more/extra", "delete", 0), ("n.txt", "copy", 0), ("deep/er/y z.txt", "keep", 0), ("deep/%41.txt", "keep", 0), ("twice", "keep", 0)]
    assert {r.path: (r.length, r.fingerprint) for r in file_manifest(spark, str(dst)).collect()} == found
    assert rows(mirror_files(spark, str(src), str(dst)).where("action <> 'keep'")) == []
    plan = file_manifest(spark, str(src), content=False)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_path_rules():
    assert version_path(12, 15) == [13, 14, 15]
    assert version_path(12, 15, "13") == [14, 15]
    for bad in ("x", "-1", "", 12, 15, 16):
        with pytest.raises(ValueError):
            version_path(12, 15, bad)


def test_a_counted_step_runs_once(spark, rows):
    looked = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            looked.add(batch.num_rows)
            yield batch

    def step(tables):
        return {**tables, "t": tables["t"].mapInArrow(look, "id long").where("id % 4 <> 0")}

    store = SnapshotStore(spark, new_table_path(spark, "store"))
    steps = {1: Stage(before=[counted("first", "t", step, odd=F.col("id") % 2 == 1), counted("second", "t", step)], after=[counted("idle", "t", lambda t: t)])}
    last = run_path(store, {"t": spark.range(1000)}, 0, 1, steps)
    assert looked.value == 1000 + 750
    assert {n: tuple(r.first()) for n, r in reports(last).items()} == {"first": ("t", 1000, 750, 500), "second": ("t", 750, 750), "idle": ("t", 750, 750)}
    assert last["t"].count() == 750


def _bytes_of(store, version):
    """Bytes of the folders that this version wrote."""
    root = Path(store.root.removeprefix("file:"))
    return sum(p.stat().st_size for d in (root / "data").glob(f"{version}-*") for p in d.rglob("*.parquet"))


def test_only_changed_parts_are_written(spark, rows):
    part = F.floor(F.col("id") / 100)
    store = SnapshotStore(spark, new_table_path(spark, "store"), {"t": part})
    source = spark.range(10_000).selectExpr("id", "concat('text ', id * 7919 % 10007, repeat('x', cast(id % 50 AS int))) AS text", "cast(NULL AS int) AS none")

    def one_part(t):
        return {**t, "t": t["t"].withColumn("text", F.when(part == 17, "new").otherwise(F.col("text")))}

    def drop_and_add(t):
        more = t["t"].where("id < 3").withColumn("id", F.col("id") + 20_000)
        return {**t, "t": t["t"].where(part != 5).unionByName(more)}

    steps = {1: Stage(before=[one_part]), 2: Stage(before=[drop_and_add]), 3: Stage(before=[lambda t: t]), 4: Stage(before=[lambda t: {"t": t["t"].repartition(3)}])}
    last = run_path(store, {"t": source}, 0, 4, steps)["t"]
    want = source.withColumn("text", F.when(part == 17, "new").otherwise(F.col("text"))).where(part != 5)
    want = want.unionByName(source.where("id < 3").withColumn("id", F.col("id") + 20_000))
    assert last.columns == ["id", "text", "none"]
    assert rows(last) == rows(want)
    assert _bytes_of(store, 1) < 0.03 * _bytes_of(store, 0)
    assert _bytes_of(store, 4) == 0  # the same rows in another order
    written = store.parts(4, "t")
    assert len(written) == 100 and "=5" not in written
    assert {p for p, v in written.items() if v == 1} == {"=17"} and {p for p, v in written.items() if v == 2} == {"=200"}

    again = run_path(store, None, 0, 4, steps, resume_from=2, prune=True)["t"]
    assert rows(again) == rows(want)
    assert rows(SnapshotStore(spark, store.root).read(1)["t"]) == rows(source.withColumn("text", F.when(part == 17, "new").otherwise(F.col("text"))))


def test_parts_of_other_shapes(spark, frame, rows):
    store = SnapshotStore(spark, new_table_path(spark, "store"), {"t": "p", "m": "p", "never": "p"})
    table = frame("p string, v int", (None, 1), ("", 2), ("a/b=c", 3), ("null", 4), ("=", 4))
    maps = spark.sql("SELECT 1 AS p, map('k', 1) AS m UNION ALL SELECT 2, map('k', 2)")
    first = store.write(0, {"t": table, "m": maps, "e": frame("p string")})
    assert rows(first["t"]) == rows(table) and first["m"].count() == 2
    base = store.entries(0)
    same = store.write(1, first, base={**base})
    assert rows(same["t"]) == rows(table) and set(store.parts(1, "t").values()) == {0} and set(store.parts(1, "m").values()) == {1}
    wider = store.write(2, {"t": same["t"].withColumn("w", F.lit(1))}, base=store.entries(1))
    assert set(store.parts(2, "t").values()) == {2} and wider["t"].columns == ["p", "v", "w"]
    swapped = store.write(3, {"t": wider["t"].withColumn("v", F.when(F.col("p") == "", 3).when(F.col("v") == 3, 2).otherwise(F.col("v")))}, base=store.entries(2))
    assert rows(swapped["t"], "v") == [(1,), (3,), (2,), (4,), (4,)] and sorted(store.parts(3, "t").values()) == [2, 2, 2, 3, 3]
    none = store.write(4, {"t": swapped["t"].limit(0)}, base=store.entries(3))
    assert none["t"].count() == 0 and none["t"].columns == ["p", "v", "w"]
    assert rows(store.read(3)["t"], "v") == [(1,), (3,), (2,), (4,), (4,)]


def test_withdrawn_attempts_are_removed_on_request(spark, frame, rows):
    store = SnapshotStore(spark, new_table_path(spark, "store"))
    assert store.prune() == []
    for n in range(3):
        run_path(store, {"t": frame("x int", (n,))}, 0, 1, {1: Stage(before=[lambda t: {"t": t["t"].withColumn("x", F.col("x") + 1)}])})
    folder = Path(store.root.removeprefix("file:")) / "data"
    assert len(list(folder.iterdir())) == 6
    assert len(store.prune()) == 4 and len(list(folder.iterdir())) == 2
    assert rows(store.read(0)["t"]) == [(2,)] and rows(store.read(1)["t"]) == [(3,)]


def test_untouched_tables_are_not_copied(spark, frame, rows):
    store = SnapshotStore(spark, new_table_path(spark, "store"))
    tables = {"a": frame("x int", (1,)), "b": frame("x int", (2,))}

    def grow(t):
        return {**t, "a": t["a"].withColumn("x", F.col("x") + 1)}

    stages = {2: Stage(before=[grow]), 3: Stage(after=[grow])}
    out = run_path(store, tables, 1, 3, stages, upgrade=lambda version, t: t)
    assert rows(out["a"]) == [(3,)]
    assert store.manifest(3) == {"a": 3, "b": 1}
    assert rows(store.read(2)["a"]) == [(2,)]
    with pytest.raises(FileNotFoundError):
        store.read(9)
    run_path(store, {"a": frame("x int", (10,)), "b": frame("x int", (20,))}, 1, 2, stages)
    assert store.manifest(2) == {"a": 2, "b": 1}
    assert rows(store.read(2)["a"]) == [(11,)] and rows(store.read(2)["b"]) == [(20,)]
    # version 3 belongs to the earlier run: withdrawn, not mixed
    with pytest.raises(FileNotFoundError):
        store.read(3)


def test_a_run_may_start_from_its_own_store(spark, frame, rows):
    store = SnapshotStore(spark, new_table_path(spark, "store"))
    store.write(0, {"a": frame("x int", (1,), (2,))})
    out = run_path(store, store.read(0), 0, 1, {1: Stage(before=[lambda t: {**t, "a": t["a"].where("x > 1")}])})
    assert rows(out["a"]) == [(2,)] and rows(store.read(0)["a"]) == [(1,), (2,)]
    assert rows(run_path(store, store.read(1), 0, 1, {})["a"]) == [(2,)]


def test_an_unreadable_marker_is_not_an_absent_one(spark, frame, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    assert store.folders(3) == {}
    store.write(3, {"a": frame("x int", (1,))})
    for part in (tmp_path / "store" / "3" / "complete").glob("*.parquet"):
        part.write_bytes(b"not a table")
    with pytest.raises(Exception, match="(?i)parquet|CANNOT_READ|FAILED_READ"):
        store.folders(3)


def test_implied_groups_follow(frame, rows):
    users = frame("uid int, gid int", (1, 10), (2, 20), (3, None))
    implied = frame("gid int, hid int", (10, 11), (11, 12), (12, 10), (20, 11), (30, 31))
    out = business._follow_implied_groups({"res_groups_users_rel": users, "res_groups_implied_rel": implied})
    assert rows(reports(out)["groups.added"]) == [(1, 11), (1, 12), (2, 10), (2, 11), (2, 12)]
    assert out["res_groups_users_rel"].count() == 8


def test_settings_are_whole_rows(spark, frame, rows):
    plans = frame("id int, name string, complete_name string, default_applicability string, create_date timestamp, write_date timestamp", (4, "Projects", "Projects", None, None, None))
    settings = frame("id int, key string, value string, create_date timestamp, write_date timestamp", (7, "analytic.project_plan", "1", None, None), (8, "web.base.url", "u", None, None))
    for step in (business._ensure_plan, business._retire_plan):
        out = step({"account_analytic_plan": plans.withColumn("complete_name", F.lit(business.PLAN_PLACEHOLDER)) if step is business._retire_plan else plans, "ir_config_parameter": settings})
        row = out["ir_config_parameter"].where("key = 'analytic.project_plan'").first()
        assert row.id == 9 and row.create_date is not None and row.write_date is not None


def test_sources(spark, frame, rows):
    root = new_table_path(spark, "tables")
    frame("x int", (1,), (2,)).write.parquet(f"{root}/numbers")
    assert rows(read_table(spark, root, "numbers")) == [(1,), (2,)]
    assert rows(run_sql(spark, "SELECT x FROM numbers WHERE x > 1")) == [(2,)]
    assert run_sql(spark, "  ") is None
    with pytest.raises(Exception) as error:
        run_sql(spark, "SELECT nothing FROM numbers")
    assert any("nothing" in note for note in error.value.__notes__)
    assert has_table({"a": None}, "a") and not has_table({}, "a")
    assert has_table(spark, "numbers")


def test_change_files(spark, tmp_path, rows):
    pytest.importorskip("yaml")
    (tmp_path / "15.0").mkdir()
    (tmp_path / "15.0" / "known_changes.yaml").write_text(
        "obsolete:\n  - a\n  -\nmerged_in_core: []\nrenamed:\n  - old: b\n    new: c\n  - old: d\n"
    )
    (tmp_path / "17.0").mkdir()
    (tmp_path / "17.0" / "known_changes.yaml").write_text("obsolete: [late]\nrenamed: []\n")
    found = read_change_files(str(tmp_path), 14, 16)
    assert found == {15: {"obsolete": ["a"], "merged": [], "renamed": [("b", "c"), ("d", None)]}}
    assert rows(change_lists(spark, found), "kind", "old", "new") == [
        ("obsolete", "a", None), ("renamed", "b", "c"), ("renamed", "d", None)
    ]
