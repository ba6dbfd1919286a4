"""Small tables with NULLs, ties, chains and collisions, where rewrites usually go wrong."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tablelift import scale
from tablelift.functions import any_like, counter_name, json_localised, json_scalar, numeric_text, path_without_root
from tablelift.operators import checks, dedup, documents, edit, hierarchy, joins, ordering, sequence, upsert
from tablelift.sources import change_catalog, change_lists, invalid_changes


def test_excluding_an_author_also_drops_unknown_authors(frame, rows):
    modules = frame("name string, author string, state string",
                    ("a", None, "installed"), ("b", "core", "installed"), ("c", "x", "installed"), ("d", "x", "uninstalled"))
    target = frame("name string", ("z",))
    wanted = (F.col("state") == "installed") & ~F.col("author").isin("core")
    assert rows(joins.missing_in_target(modules, target, "name", wanted), "name") == [("c",)]


def test_a_null_key_has_no_counterpart(frame, rows, both):
    src = frame("k string, v int", ("a", 1), (None, 2), ("b", 3))
    dst = frame("k string", ("a",), (None,))
    assert rows(joins.missing_in_target(src, dst, "k"), "v") == [(2,), (3,)]


@pytest.mark.parametrize(
    ("tracked", "left"),
    [
        ([(2,)], [2, 3, 4, 5]),  # 1 is untracked and in scope
        ([(2,), (None,)], [1, 2, 3, 4, 5]),  # a NULL protects everything
        ([], [3, 4, 5]),  # nothing is tracked
    ],
)
def test_not_in_with_null(frame, rows, both, tracked, left):
    expr = frame("id int, label string, parent int",
                 (1, "balance", 10), (2, "balance", 10), (3, "balance", 11), (4, "other", 10), (5, None, 10))
    scope = frame("res_id int", (10,), (None,))
    kept = joins.delete_orphans(
        expr, "id", ("parent", scope, "res_id"), (frame("res_id int", *tracked), "res_id"), F.col("label") == "balance"
    )
    assert rows(kept, "id") == [(i,) for i in left]


def test_membership_is_three_valued(frame, rows, both):
    df = frame("id int", (1,), (2,), (None,))
    out = rows(joins.with_membership(df, "id", frame("k int", (1,)), "k", "m"))
    assert out == [(1, True), (2, False), (None, None)]
    out = rows(joins.with_membership(df, "id", frame("k int"), "k", "m"))
    assert out == [(1, False), (2, False), (None, False)]
    out = rows(joins.with_membership(df, "id", frame("k int", (1,), (None,)), "k", "m"))
    assert out == [(1, True), (2, None), (None, None)]


def test_unknown_rows_survive_a_delete(frame, rows):
    files = frame("id int, name string, res_model string, mimetype string",
                  (1, "/web/assets/x", None, None), (2, None, "ir.ui.view", "text/css"), (3, None, "ir.ui.view", None),
                  (4, "a.assets_b", None, None), (5, "a.assetsXb", None, None), (6, None, None, None))
    stale = (F.col("res_model") == "ir.ui.view") & (F.col("mimetype") == "text/css")
    kept = edit.delete_like(files, "name", ["/web/assets/%", "%.assets_%"], stale)
    # the underscore is a wildcard, so row 5 goes as well
    assert rows(kept, "id") == [(3,), (6,)]
    assert rows(edit.delete_where(files, F.col("name") != "x"), "id") == [(2,), (3,), (6,)]


def test_update_sees_old_values_and_skips_unknown(frame, rows):
    df = frame("id int, a string, b string", (1, "x", "p"), (2, None, "q"))
    out = edit.update_where(df, F.col("a") == "x", {"a": F.col("b"), "b": F.col("a")})
    assert rows(out) == [(1, "p", "x"), (2, None, "q")]


def test_several_matches_take_the_lowest(frame, rows, both):
    lines = frame("id int, old_id int, ref int", (1, 7, None), (2, 7, None), (3, 8, 7), (4, 9, 99))
    out = joins.remap_self_reference(lines, "ref", "old_id", "id", "new_ref")
    assert rows(out, "id", "new_ref") == [(1, None), (2, None), (3, 1), (4, None)]


def test_a_matched_null_is_copied_and_a_guard_respected(frame, rows, both):
    left = frame("id int, k int, v string", (1, 1, "a"), (2, 2, "b"), (3, 3, "c"), (4, None, "d"))
    right = frame("k2 int, w string", (1, None), (2, "B"))
    out = joins.update_from(left, right, {"k": "k2"}, {"v": "w"})
    assert rows(out, "id", "v") == [(1, None), (2, "B"), (3, "c"), (4, "d")]
    out = joins.update_from(left, right, {"k": "k2"}, {"v": "w"}, where=F.col("id") > 1)
    assert rows(out, "id", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def test_a_chain_fills_only_nulls_or_overwrites(frame, rows, both):
    moves = frame("id int, mode int, line int", (1, 10, None), (2, 10, 5), (3, 11, None), (4, None, None))
    links = [
        joins.Link("mode", frame("id int", (10,), (11,)), "mode", "id"),
        joins.Link("line", frame("id int, old int", (101, 10), (102, 10)), "mode.id", "old"),
    ]
    guarded = joins.update_from_chain(moves, links, {"line": "line.id"}, tie="line.id", only_null=True)
    assert rows(guarded, "id", "line") == [(1, 101), (2, 5), (3, None), (4, None)]
    written = joins.update_from_chain(moves, links, {"line": "line.id"}, tie="line.id")
    assert rows(written, "id", "line") == [(1, 101), (2, 101), (3, None), (4, None)]


def test_a_rerun_appends_nothing(frame, rows, both):
    target = frame("id long, name string", (5, "x"))
    source = frame("id long, title string", (1, "a"), (2, "b"))
    mapping = {"name": F.col("title")}
    once = upsert.append_mapped(target, source, mapping, "id", "id", "old_id")
    assert rows(once) == [(5, "x", None), (6, "a", 1), (7, "b", 2)]
    assert rows(upsert.append_mapped(once, source, mapping, "id", "id", "old_id")) == rows(once)


@pytest.mark.parametrize(
    ("pairs", "names", "after"),
    [
        ([("a", "b"), ("b", "c")], ["a"], ["c"]),
        ([("b", "c"), ("a", "b")], ["a"], ["b"]),
        ([("a", "b"), ("b", "c")], ["b"], ["c"]),
        ([("x", "y")], ["a"], ["a"]),
        ([("a", "a")], ["a"], ["a"]),
        ([("a", "b"), ("c", "a"), ("a", "d")], ["a", "c"], ["b", "d"]),
    ],
)
def test_rename_pairs_apply_in_order(frame, rows, pairs, names, after):
    master = frame("name string", *[(n,) for n in names])
    data = frame("module string", *[(n,) for n in names])
    done = upsert.rename_cascade({"m": master, "d": data}, {"m": "name", "d": "module"}, "m", pairs)
    assert rows(done.tables["m"]) == [(n,) for n in after]
    assert rows(done.tables["d"]) == [(n,) for n in after]


def test_a_dependant_is_renamed_only_if_the_master_has_the_name(frame, rows):
    done = upsert.rename_cascade(
        {"m": frame("name string", ("z",)), "d": frame("module string", ("a",))}, {"m": "name", "d": "module"}, "m", [("a", "b")]
    )
    assert rows(done.tables["d"]) == [("a",)]


def test_rename_onto_a_taken_name_is_reported(frame, rows):
    master = frame("name string", ("a",), ("b",), (None,))
    done = upsert.rename_cascade({"m": master}, {"m": "name"}, "m", [("a", "b")])
    assert rows(done.tables["m"]) == [("b",), ("b",), (None,)]
    assert rows(done.collisions) == [("b", 2)]


def test_merge_drops_taken_names_and_keeps_nulls(frame, rows, both):
    tables = {
        "m": frame("name string", ("old",), ("new",), ("x",)),
        "d": frame("module string, name string", ("old", "a"), ("old", "b"), ("old", None), ("new", "a"), ("x", "a"), (None, "a")),
        "l": frame("owner int, name string", (1, "old"), (1, "new"), (2, "old")),
    }
    done = upsert.merge_namespace(tables, ("m", "name"), ("d", "module", "name"), ("l", "name", ["owner", "name"]), [("old", "new")])
    assert rows(done.tables["m"]) == [("new",), ("x",)]
    assert rows(done.tables["d"]) == [("new", "a"), ("new", "b"), ("new", None), ("x", "a"), (None, "a")]
    assert rows(done.dropped) == [("old", "a")]
    assert rows(done.tables["l"]) == [(1, "new"), (1, "new"), (2, "new")]
    assert rows(done.duplicate_links) == [(1, "new", 2)]


def test_merges_chain_in_order(frame, rows):
    tables = {
        "m": frame("name string", ("a",), ("b",), ("c",)),
        "d": frame("module string, name string", ("a", "1"), ("a", "2"), ("a", "3"), ("b", "1"), ("c", "2")),
        "l": frame("name string", ("a",), ("b",)),
    }
    done = upsert.merge_namespace(tables, ("m", "name"), ("d", "module", "name"), ("l", "name", ["name"]), [("a", "b"), ("b", "c")])
    assert rows(done.tables["m"]) == [("c",)]
    assert rows(done.tables["d"]) == [("c", "1"), ("c", "2"), ("c", "3")]
    assert rows(done.dropped) == [("a", "1"), ("a", "2")]


def test_catalog_precedence_and_bad_entries(spark, frame, rows):
    lists = {
        15: {"obsolete": ["a", "", "null"], "renamed": [("r", "r15"), ("self", "self")]},
        16: {"obsolete": ["a"], "merged": ["a", "m"], "renamed": [("r", "r16"), ("m", "n"), ("lost", None)]},
        18: {"obsolete": ["late"]},
    }
    changes = change_lists(spark, lists)
    catalog = change_catalog(changes, 14, 17)
    missing = frame("name string", ("a",), ("m",), ("r",), ("self",), ("lost",), ("late",), ("",))
    out = dict((r[0], (r[1], r[2])) for r in joins.classify(missing, catalog, "name").collect())
    assert out == {
        "a": ("obsolete", "a"), "m": ("merged", "m"), "r": ("renamed", "r -> r16"), "self": ("renamed", "self -> self"),
        "lost": ("missing", "lost"), "late": ("missing", "late"), "": ("missing", ""),
    }
    assert rows(invalid_changes(changes, 14, 17), "old") == [("lost",)]


def test_padding_keeps_or_cuts_long_numbers(frame, rows):
    ids = frame("id int", (7,), (1000,), (1234,), (12345,))
    out = ids.select("id", counter_name("s_", F.col("id")).alias("full"), counter_name("s_", F.col("id"), truncate=True).alias("cut"))
    assert rows(out) == [(7, "s_007", "s_007"), (1000, "s_1000", "s_100"), (1234, "s_1234", "s_123"), (12345, "s_12345", "s_123")]


def test_missing_counter_means_null_or_zero(frame, rows, both):
    fact = frame("id int, counter int", (1, None), (2, 0), (3, 5))
    dim = frame("id int, name string", (5, "five"))
    names = frame("id int, label string", (1, "one"), (2, "two"), (3, "three"))
    fact2, dim2 = upsert.ensure_dimension(fact, "id", "counter", dim, "id", {"name": F.col("label")}, context=names)
    assert rows(fact2) == [(1, 6), (2, 7), (3, 5)]
    assert rows(dim2) == [(5, "five"), (6, "one"), (7, "two")]


def test_slice_is_rebuilt_not_extended(frame, rows, both):
    bridge = frame("line int, journal int", (1, 1), (1, 2), (9, 9))
    fresh = frame("line int, journal int", (1, 3), (1, 3), (2, 4))
    out = upsert.replace_slice(bridge, "line", frame("id int", (1,), (2,)), fresh, ["line", "journal"])
    assert rows(out) == [(1, 3), (2, 4), (9, 9)]


def test_insert_ignore_lets_null_keys_in(frame, rows):
    target = frame("k int, v string", (1, "a"))
    new = frame("k int, v string", (1, "b"), (2, "d"), (2, "c"), (None, "e"), (None, "e"))
    assert rows(upsert.insert_ignore(target, new, "k", ["v"])) == [(1, "a"), (2, "c"), (None, "e"), (None, "e")]


def test_placeholder_is_retired_once(frame, rows):
    settings = frame("key string, value string", ("plan", "9"), ("other", "1"))

    def retire(*plans):
        table = frame("id int, name string", *plans)
        kept, after = upsert.retire_placeholder(
            table, F.col("name") == "temp", F.col("name") == "real", "id", settings, "key", "plan", "value"
        )
        return rows(kept), rows(after)

    assert retire((1, "temp"), (2, "real"), (3, "real")) == ([(2, "real"), (3, "real")], [("other", "1"), ("plan", "2")])
    assert retire((1, "temp")) == ([], [("other", "1"), ("plan", None)])
    assert retire((2, "real")) == ([(2, "real")], [("other", "1"), ("plan", "9")])


CHAIN = [
    (1, 1, "2024-01-01", "a"), (2, 1, "2024-01-01", "b"), (3, 1, "2024-01-02", None), (4, 1, "2024-01-03", "c"),
    (5, 2, "2024-01-01", "d"), (6, 1, "2024-01-04", "e"), (7, 1, "2024-01-05", "f"), (8, None, "2024-01-01", "g"),
]


def expected_chain():
    out = {}
    for company in (1, 2, None):
        last = ""
        for row, _, _, text in sorted((r for r in CHAIN if r[1] == company), key=lambda r: (r[2], r[0])):
            last = "" if text is None else hashlib.sha256((last + text).encode()).hexdigest()
            out[row] = last or None
    return sorted(out.items())


def test_hash_chain_restarts_after_a_gap(frame, rows, both):
    orders = frame("id int, company int, day string, text string", *CHAIN)
    chained = sequence.hash_chain(orders, "company", ["day", "id"], "text")
    assert rows(chained, "id", "hash") == expected_chain()
    breaks = sequence.chain_breaks(chained, "company", ["day", "id"], "text", "id")
    assert rows(breaks) == [(3, "no payload")]
    forged = edit.update_where(chained, F.col("id") == 6, {"hash": "0"})
    found = sequence.chain_breaks(forged, "company", ["day", "id"], "text", "id")
    assert rows(found) == [(3, "no payload"), (6, "hash differs"), (7, "hash differs")]


def test_chain_carries_across_arrow_batches(spark, frame, rows):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        orders = frame("id int, company int, day string, text string", *CHAIN)
        assert rows(sequence.hash_chain(orders, "company", ["day", "id"], "text"), "id", "hash") == expected_chain()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_sequence_touches_qualifying_rows_only(frame, rows, both):
    orders = frame("id int, company int, state string, seq long, prev int",
                   (1, 1, "done", 50, 3), (2, 1, "draft", 60, None), (3, 1, "paid", None, None), (4, 1, None, 70, 9), (5, 2, "done", 1, 1))
    out = sequence.gapless_sequence(
        orders, "company", ["id"], "seq", F.col("state").isin("done", "paid"), previous="prev", row_id="id"
    )
    assert rows(out, "id", "seq", "prev") == [(1, 1, None), (2, 60, None), (3, 2, 1), (4, 70, 9), (5, 1, None)]


def test_counters_without_rows_or_owner_stay(frame, rows):
    counters = frame("company int, next int", (1, 8), (2, 9))
    orders = frame("company int", (1,), (1,), (3,))
    assert rows(sequence.next_counter(orders, "company", counters, "company", "next")) == [(1, 3), (2, 9)]


def test_lists_come_in_pieces(frame, rows, both):
    df = frame("k int, v int", *[(1, i) for i in range(8)], (2, 1), (2, 1))
    out = sequence.collect_in_pieces(df, "k", "v", "vs", entries=3)
    assert rows(out, "k", "piece", "vs", "n") == [
        (1, 0, [0, 1, 2], 3), (1, 1, [3, 4, 5], 3), (1, 2, [6, 7], 2), (2, 0, [1], 1),
    ]


VIEWS = [
    # id, key, module reference, parent
    (1, "k", None, None),
    (2, "k", 20, None),
    (3, "k", 30, None),
    (4, "", None, None),
    (5, "", None, None),
    (6, None, None, None),
    (7, "c", None, 1),  # child of a loser
    (8, "c2", None, 3),
    (9, "s", 90, 10),  # survivor that is a child of its loser 10
    (10, "s", None, None),
    (11, "c3", None, 10),
]


def test_dedup_of_a_hierarchy(frame, rows, both):
    views = frame("id int, key string, ref int, parent int", *VIEWS)
    losers = dedup.losers_of(views, "key", "id", F.col("ref").isNotNull())
    assert rows(losers) == [(1, 2), (10, 9), (3, 2)]
    moved = dedup.redirect_children(views, "parent", losers, "id", same_table=True)
    assert rows(moved.losers) == [(1, 2), (3, 2)]
    assert rows(moved.log) == [(11, 10, 9, False), (7, 1, 2, True), (8, 3, 2, True), (9, 10, 9, False)]
    done = dedup.delete_losers(moved.children, "id", moved.losers, moved.children, "parent", "id")
    assert rows(done.rows, "id", "parent") == [
        (10, None), (11, 10), (2, None), (4, None), (5, None), (6, None), (7, 2), (8, 2), (9, 10),
    ]
    assert rows(done.failures) == []
    summary = dedup.dedup_summary(views, done, moved.log, "key", "id")
    assert rows(summary) == [(2, 0, 4, 1)]


@pytest.mark.parametrize("depth", [1, 2, 5])
def test_a_survivor_below_its_loser_keeps_the_loser(frame, rows, both, depth):
    # loser 1 -> 2 -> ... -> survivor 1 + depth, whose key the loser shares
    tree = [(1, "k", None, None)] + [(n, f"c{n}", None, n - 1) for n in range(2, depth + 1)] + [(depth + 1, "k", 9, depth)]
    views = frame("id int, key string, ref int, parent int", *tree, (50, "x", None, 1))
    losers = dedup.losers_of(views, "key", "id", F.col("ref").isNotNull())
    moved = dedup.redirect_children(views, "parent", losers, "id", same_table=True)
    assert rows(moved.losers) == []
    assert rows(moved.children, "id", "parent") == rows(views, "id", "parent")
    assert set(rows(moved.log, "done")) == {(False,)}


def test_redirects_that_close_a_loop_together_fail_together(frame, rows, both):
    # 1 -> 2 -> 13 and 11 -> 12 -> 3: each survivor (3, 13) lies below the other's loser
    views = frame("id int, key string, ref int, parent int",
                  (1, "a", None, None), (2, "b", None, 1), (13, "z", 9, 2), (11, "z", None, None), (12, "y", None, 11), (3, "a", 9, 12),
                  (21, "m", None, None), (22, "m", 9, None), (23, "n", None, 21))
    losers = dedup.losers_of(views, "key", "id", F.col("ref").isNotNull())
    assert rows(losers) == [(1, 3), (11, 13), (21, 22)]
    moved = dedup.redirect_children(views, "parent", losers, "id", same_table=True)
    assert rows(moved.losers) == [(21, 22)]
    fate = hierarchy.lineage_check(moved.children, "id", "parent")
    assert fate.where("status <> 'ok'").count() == 0
    assert rows(moved.children.where("id = 23"), "parent") == [(22,)]


def test_losers_with_children_stay(frame, rows, both):
    # 4 hangs below loser 2 and is no loser; 5 and 6 are losers below losers
    tree = frame("id int, parent int", (1, None), (2, 1), (3, None), (4, 2), (5, 3), (6, 5), (7, 8), (8, None))
    losers = frame("loser_id int, survivor_id int", (1, 9), (2, 9), (3, 9), (5, 9), (6, 9), (8, 9), (7, 9))
    done = dedup.delete_losers(tree, "id", losers, tree, "parent", "id")
    # 6, 5, 3 go in turn; 8 comes before its child 7; 2 is held by 4 and so holds 1
    assert rows(done.rows, "id") == [(1,), (2,), (4,), (8,)]
    assert rows(done.failures) == [(1, "Still has 1 children"), (2, "Still has 1 children"), (8, "Still has 1 children")]


def test_xml_errors(frame, rows):
    docs = frame("id int, doc string", (1, "<a/>"), (2, "<a>"), (3, ""), (4, None), (5, "<a/>tail"), (6, "<a b='<'/>"))
    out = documents.xml_wellformed(docs, "doc")
    assert rows(out.where("error is not null"), "id") == [(2,), (5,), (6,)]
    assert out.where("length(error) > 200").count() == 0


def test_field_references(frame, rows, both):
    views = frame("id int, model string, doc string",
                  (1, "m", "<f><field name='a'/><field name='zz'/><field name='id'/><a name='go'/><field name='p.q'/></f>"),
                  (2, "m", "<f><group name='g'/><field name=''/></f>"), (3, "other", "<f name='x'/>"),
                  (4, "m", "<broken"), (5, None, "<f name='x'/>"))
    fields = frame("model string, name string", ("m", "a"), ("n", "zz"))
    assert rows(documents.field_refs_missing(views, "id", "model", "doc", fields)) == [(1, "m", "field", "zz"), (2, "m", "group", "g")]
    assert rows(documents.field_refs_missing(views, "id", "model", "doc", fields, first_per_model=True)) == [(1, "m", "field", "zz")]


PARENT = "<form><sheet><field name='a'/><group><field name='b' k='1'/></group></sheet></form>"
EXPRESSIONS = {
    "//field[@name='a']": True, "//form": True, "/form/sheet": True, "/sheet": False, "sheet/field": True, ".//group": True,
    ".//form": False, "//field[@name='c']": False, "//group/field[1]": True, "//sheet/field[2]": False, "//field[last()]": True,
    "//field[@name='b'][@k='1']": True, "//field[@name='b' and @k='1']": True, "//field[@name='a' and @k='1']": False,
    "sheet/field[contains(@name, 'a')]": True, "field[contains(@name, 'a')]": False, "//*[@k]": True, "//x | //group": True,
    "count(//field) > 1": True, "//field[": None, "nosuch(//field)": None, ".": True, "//group/..": True,
    "//field[not(@k)]": True, "//field[@name!='a' and @name!='b']": False, "//field[@name='z' or starts-with(@name, 'b')]": True,
    "//sheet[@name='a|b'] | //field[1]": True, "/form//field[@k=\"1\"]": True, "..": True, "//group[text()='x']": False,
    "//sheet/*[last()]/field": True, "//field[2][@k]": False, "following-sibling::x": False, "//": None, "": None,
}


def test_expression_targets(frame, rows, both):
    def escape(expression):
        return expression.replace("&", "&amp;").replace("<", "&lt;").replace('"', "&quot;")

    child = "<data>" + "".join(f'<xpath expr="{escape(e)}"/>' for e in EXPRESSIONS) + "<xpath/></data>"
    views = frame("id int, parent int, doc string", (1, None, PARENT), (2, 1, child), (3, 1, "<broken"), (4, 9, child),
                  (5, 6, child), (6, None, "<broken"), (7, 8, child), (8, None, ""))
    out = documents.expr_targets_missing(views, "id", "parent", "doc", entries=4)
    found = {r.expr: r.error for r in out.collect()}
    assert rows(out.select("view_id").distinct()) == [(2,)]
    wanted = {e: hit for e, hit in EXPRESSIONS.items() if e}
    assert set(found) == {e for e, hit in wanted.items() if not hit}
    assert {e for e, error in found.items() if error} == {e for e, hit in wanted.items() if hit is None}


def test_expression_targets_of_all_forms(frame, rows, both):
    parent = "<form><sheet class=' x  oe '><!-- c --><field name='a'/><group><field name='b' k='1'/></group></sheet></form>"
    wanted = {
        "count(//field) > 1": True, "count(//field)": True, "count(//field) - 2": False, "count(//field) > 2": False, "sheet[position()=1]": True,
        "//group[field]": True, "//sheet[group/field]": True, "//sheet[nosuch]": False, "(//field)[1]": True, "(//field)[3]": False,
        "//field/ancestor::sheet": True, "//group/following-sibling::field": False, "//group/preceding-sibling::field": True, "following-sibling::x": False,
        "sheet[hasclass('oe', 'x')][group]": True, "//sheet[hasclass('o')][group]": False, "//sheet[@class='hasclass(1)'][group]": False,
        "sheet/@class": True, "field/@name": False, "//field[position()=last() and @k]": True, "//x/.. | (//y)": False, "self::form": True, "/": True,
        "//field[": None, "nosuch(//field)": None, "//form | //field[": None, "//sheet[count('x')]": None, "//": None, "a)] | /*[(b": None, "$x": None,
    }
    child = "<data>" + "".join(f'<xpath expr="{e.replace("<", "&lt;")}"/>' for e in wanted) + "</data>"
    views = frame("id int, parent int, doc string", (1, None, parent), (2, 1, child), (3, None, "<!DOCTYPE a><a/>"), (4, 3, child),
                  (5, None, "<broken"), (6, 5, child), (7, 1, "<form/>"), (8, 7, "<d><xpath expr='//a['/><xpath expr='(//a)[1]'/><xpath expr='(//form)[1]'/></d>"))
    out = documents.expr_targets_missing(views, "id", "parent", "doc", entries=4)
    found = {r.expr: r.error for r in out.where("view_id = 2").collect()}
    assert set(found) == {e for e, hit in wanted.items() if not hit}
    assert {e for e, error in found.items() if error and error.startswith("invalid expression: ")} == {e for e, hit in wanted.items() if hit is None}
    assert all(error is None for e, error in found.items() if wanted[e] is False)
    assert rows(out.where("view_id <> 2").selectExpr("view_id", "expr", "substring_index(error, ':', 1)")) == [
        (8, "//a[", "invalid expression"), (8, "(//a)[1]", "not checkable here")]


def test_jobs_do_not_grow_with_the_expressions(frame, jobs):
    def targets(n):
        forms = [f"//group[field][{i}]" for i in range(n)] + [f"count(//field) > {i}" for i in range(n)] + [f"//a[{i}" for i in range(n)]
        child = "<data>" + "".join(f'<xpath expr="{e.replace(">", "&gt;")}"/>' for e in forms) + "</data>"
        views = frame("id int, parent int, doc string", (1, None, PARENT), (2, 1, child))
        found = documents.expr_targets_missing(views, "id", "parent", "doc", entries=50)
        assert found.count() == (n - 1) + (n - 2) + n

    assert jobs(lambda: targets(5)) == jobs(lambda: targets(300))


def test_targets_in_what_a_parent_inherits_are_not_errors(frame, rows, both):
    doc = "<d><xpath expr=\"//field[@name='a']\"/></d>"
    views = frame("id int, parent int, doc string", (1, None, "<f><field name='a'/></f>"), (2, 1, "<d/>"), (3, 2, doc), (4, 3, doc), (5, 1, doc),
                  (6, None, "<!DOCTYPE a SYSTEM 'nope.dtd'><a/>"), (7, 6, doc), (8, None, "<!doctype a><a/>"), (9, 8, doc))
    out = documents.expr_targets_missing(views, "id", "parent", "doc")
    assert rows(out, "view_id", "error") == [(3, "not checkable here: the parent inherits"), (4, "not checkable here: the parent inherits")]


def test_lineage_of_deep_chains_and_cycles(frame, rows, both):
    chain = [(i, i - 1 if i > 1 else None) for i in range(1, 151)]
    odd = [(201, 999), (202, 201), (301, 302), (302, 301), (303, 301), (304, 303), (401, 401), (402, 401)]
    out = hierarchy.lineage_check(frame("id int, parent int", *chain, *odd), "id", "parent", F.col("id") == 120)
    status = {r.id: (r.status, r.depth) for r in out.collect()}
    assert len(status) == len(chain) + len(odd)
    assert all(status[i] == ("ok", i - 1) for i in range(1, 120))
    assert status[120][0] == "broken"
    assert all(status[i][0] == "broken_ancestor" for i in range(121, 151))
    wanted = {201: "missing_parent", 202: "broken_ancestor", 301: "cycle", 302: "cycle", 303: "broken_ancestor",
              304: "broken_ancestor", 401: "cycle", 402: "broken_ancestor"}
    assert {i: status[i][0] for i in wanted} == wanted


def test_lineage_has_one_row_per_id(frame, rows, both):
    tree = frame("id int, parent int", (1, None), (2, 1), (2, 7), (3, 2), (4, 4), (4, None))
    out = hierarchy.lineage_check(tree, "id", "parent")
    assert rows(out) == [(1, None, "ok", 0), (2, 1, "ok", 1), (3, 2, "ok", 2), (4, None, "ok", 0)]
    assert rows(hierarchy.doubled_ids(tree, "id")) == [(2, 2), (4, 2)]


def test_updates_keep_column_types(frame, rows, both):
    df = frame("id int, small smallint, note string", (1, 1, "a"), (2, 2, "b"))
    for out in (
        edit.update_where(df, F.col("id") == 1, {"small": 5}),
        joins.update_from(df, frame("id int, v string", (1, "5")), {"id": "id"}, {"small": "v"}),
        joins.update_from_chain(
            df, [joins.Link("one", frame("id int, to int", (1, 9)), "id", "id"), joins.Link("two", frame("key int, v long", (9, 5), (9, 5)), "one.to", "key")],
            {"small": "two.v"}, tie="two.v",
        ),
    ):
        assert out.schema == df.schema
        assert rows(out, "small") == [(5,), (2,)]


def test_renames_from_a_table_of_pairs(spark, frame, rows):
    pairs = frame("ord long, old string, new string", (0, "a", "b"), (1, "b", "c"), (2, "x", "y"), (3, None, "q"), *[(n, f"u{n}", f"v{n}") for n in range(4, 40)])
    tables = {"t": frame("name string", ("a",), ("d",), ("v7",))}
    spark.conf.set("spark.tablelift.broadcastRows", "2")
    try:
        out = upsert.rename_cascade(tables, {"t": "name"}, "t", pairs)
        assert rows(out.tables["t"]) == [("c",), ("d",), ("v7",)]
    finally:
        spark.conf.unset("spark.tablelift.broadcastRows")


def test_salted_joins_take_maps_inside_structs(spark, frame, rows, split):
    df = spark.sql("SELECT id % 2 AS k, named_struct('m', map('a', id)) AS s, array(map('b', id)) AS x, id AS v FROM range(40)")
    out = scale.lookup_join(df, frame("k long, name string", (0, "even"), (1, "odd")), "k")
    assert out.groupBy("name").count().orderBy("name").collect() == [("even", 20), ("odd", 20)]


def test_a_chain_of_large_joins_runs_its_source_once(spark, frame, split):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    out = spark.range(200).withColumn("k", F.col("id") % 3).mapInArrow(count, "id long, k long")
    for n in range(4):
        out = scale.lookup_join(out, spark.range(3).select(F.col("id").alias("k"), F.lit(n).alias(f"c{n}")), "k")
    assert out.count() == 200
    assert seen.value == 200


def test_every_hot_key_is_spread(spark, frame, split):
    df = spark.range(9000).select((F.col("id") % 1500).alias("k"), "id")
    assert scale.hot_keys(df, "k").count() == 1500


def test_implied_memberships_close_and_settle(frame, rows, both):
    grants = frame("u int, g string", (1, "a"), (2, "b"), (2, "c"), (3, "z"), (4, "x"))
    edges = frame("g string, implied string", ("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x"), ("q", None), ("a", "a"))
    added = hierarchy.implied_closure(grants, "u", "g", edges, "g", "implied")
    assert rows(added) == [(1, "b"), (1, "c"), (1, "d"), (2, "d"), (4, "y")]
    assert hierarchy.implied_closure(grants.unionByName(added), "u", "g", edges, "g", "implied").count() == 0


def test_dependents_keep_the_lonely(frame, rows, both):
    items = frame("name string", ("a",), ("b",))
    needed = frame("owner string, needs string, state string",
                   ("x", "a", "installed"), ("x", "a", "installed"), ("y", "a", "removed"), ("z", "c", "installed"))
    out = joins.dependents(items, "name", needed, "owner", "needs", F.col("state") == "installed")
    assert rows(out) == [("a", "x"), ("b", None)]


def test_previews_and_picks(frame, rows):
    df = frame("id int, xs array<int>", (3, [1, 2, 3]), (1, [4]), (2, []))
    assert rows(ordering.preview(df, 2, "id"), "id", "n_more") == [(1, 1), (2, 1)]
    assert rows(ordering.preview(df, 9, "id"), "id", "n_more") == [(1, 0), (2, 0), (3, 0)]
    assert rows(ordering.pick_one(df, F.col("id") > 1, "id"), "id") == [(2,)]
    assert rows(ordering.sample_per_row(df, "xs", 2, "two"), "id", "two") == [(1, [4]), (2, []), (3, [1, 2])]


def test_strict_schema_changes(frame):
    df = frame("a int, b int", (1, 2))
    with pytest.raises(ValueError):
        edit.add_column(df, "a", "int")
    assert edit.add_column(df, "a", "int", if_absent=True).columns == ["a", "b"]
    with pytest.raises(ValueError):
        edit.rename_column(df, "x", "y")
    with pytest.raises(ValueError):
        edit.rename_column(df, "a", "b")
    assert edit.rename_column(df, "x", "y", if_present=True).columns == ["a", "b"]


def test_text_functions(frame, rows):
    df = frame("s string", ('a"b\\c\n',), (None,), ("/web/x",), ("//y",), ("",), ("12",), ("/lib/*",))
    out = {r[0]: r[1:] for r in rows(df.select("s", json_scalar(F.col("s")), path_without_root(F.col("s")), numeric_text(F.col("s"))))}
    assert out['a"b\\c\n'][0] == '"a\\"b\\\\c\\n"'
    assert out[None] == (None, None, None)
    assert (out["/web/x"][1], out["//y"][1], out[""][1], out["/lib/*"][1]) == ("web/x", "/y", None, None)
    assert out["12"][2] is True and out[""][2] is False
    localised = df.where("s = '12'").select(json_localised(F.col("s"), "en_US")).first()[0]
    assert localised == '{"en_US":"12"}'
    assert df.where(any_like(F.col("s"), ["/w%", "1_"])).count() == 2


def test_verdict_ignores_warnings(frame, rows):
    def status(*severities):
        issues = frame("type string, severity string", *[("t", s) for s in severities])
        return checks.verdict(issues).first().status

    assert status() == "passed"
    assert status("warning", "warning") == "passed with warnings"
    assert status("warning", "error") == "failed"
