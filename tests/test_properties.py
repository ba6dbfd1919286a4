"""Laws that hold for any input: idempotence, uniqueness, order, agreement of both paths."""

import hashlib
import subprocess
import sys
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablelift.operators import dedup, hierarchy, joins, sequence, upsert
from tablelift.scale import lookup_join
from tablelift.sources import apply_mirror, mirror_plan
from tests.conftest import SPLIT

few = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.one_of(st.none(), st.integers(0, 3))
pairs = st.lists(st.tuples(keys, st.one_of(st.none(), st.sampled_from("abc"))), max_size=12)


def both_ways(spark, build):
    """The result with ordinary limits and with all large-data paths forced; they must agree."""
    small = build().collect()
    for key, value in SPLIT.items():
        spark.conf.set(key, value)
    try:
        large = build().collect()
    finally:
        for key in SPLIT:
            spark.conf.unset(key)
    assert Counter(map(repr, map(tuple, small))) == Counter(map(repr, map(tuple, large)))
    return [tuple(r) for r in small]


@few
@given(facts=pairs, lookups=pairs)
def test_split_joins_agree_with_plain_joins(spark, frame, facts, lookups):
    left = frame("k int, v string", *facts)
    right = frame("k int, w string", *lookups)
    for how in ("inner", "left", "left_semi", "left_anti"):
        both_ways(spark, lambda how=how: lookup_join(left, right, "k", how))


@few
@given(rows=st.lists(st.tuples(keys, st.integers(0, 3)), max_size=20))
def test_numbers_are_gapless_and_linked(spark, frame, rows):
    df = frame("part int, day int, id int", *[(p, d, i) for i, (p, d) in enumerate(rows)])
    out = both_ways(
        spark, lambda: sequence.number_rows(df, "part", ["day", "id"], "seq", previous="prev", row_id="id")
    )
    groups = defaultdict(list)
    for part, day, row, seq, prev in out:
        groups[part].append((seq, day, row, prev))
    for members in groups.values():
        members.sort()
        assert [m[0] for m in members] == list(range(1, len(members) + 1))
        assert members == sorted(members, key=lambda m: (m[1], m[2]))
        assert [m[3] for m in members] == [None, *[m[2] for m in members[:-1]]]


@few
@given(rows=st.lists(st.tuples(keys, st.one_of(st.none(), st.text("xyz€", max_size=3))), max_size=20))
def test_chains_verify(spark, frame, rows):
    df = frame("part int, text string, id int", *[(p, t, i) for i, (p, t) in enumerate(rows)])
    out = both_ways(spark, lambda: sequence.hash_chain(df, "part", ["id"], "text"))
    last = defaultdict(str)
    for part, text, _, value in sorted(out, key=lambda r: r[2]):
        last[part] = "" if text is None else hashlib.sha256((last[part] + text).encode()).hexdigest()
        assert value == (last[part] or None)


@few
@given(src=pairs, dst=pairs)
def test_a_mirrored_table_equals_its_source(frame, rows, src, dst):
    def unique(entries):
        return list({k: (k, v) for k, v in entries if k is not None}.values())

    source, target = frame("k int, v string", *unique(src)), frame("k int, v string", *unique(dst))
    once = apply_mirror(source, target, mirror_plan(source, target, "k", "v"), "k")
    assert rows(once) == rows(source)
    assert rows(mirror_plan(source, once, "k", "v").where("action <> 'keep'")) == []


@few
@given(target=pairs, new=pairs)
def test_inserting_and_replacing_twice_changes_nothing(frame, rows, target, new):
    def keyed(entries):
        return [(k, v) for k, v in entries if k is not None]

    base = frame("k int, v string", *{k: (k, v) for k, v in keyed(target)}.values())
    fresh = frame("k int, v string", *keyed(new))
    once = upsert.insert_ignore(base, fresh, "k", ["v"])
    assert once.groupBy("k").count().where("count > 1").count() == 0
    assert rows(upsert.insert_ignore(once, fresh, "k", ["v"])) == rows(once)
    replaced = upsert.replace_by_key(base, fresh, "k")
    assert rows(upsert.replace_by_key(replaced, fresh, "k")) == rows(replaced)


@few
@given(renames=st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from("abcdef")), max_size=5), names=st.sets(st.sampled_from("abcd")))
def test_resolved_renames_equal_renaming_in_turn(renames, names):
    current = {n: n for n in names}
    for old, new in renames:
        if old in current.values():
            current = {n: new if c == old else c for n, c in current.items()}
    final = upsert.resolve_renames(renames, set(names))
    assert {n: final.get(n, n) for n in names} == current


@few
@given(merges=st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from("abcde")), max_size=4), owned=st.sets(st.tuples(st.sampled_from("abcde"), st.integers(0, 3)), min_size=1))
def test_merging_at_once_equals_merging_in_turn(frame, rows, merges, owned):
    master, data = set("abcd"), Counter(owned)
    for old, new in merges:
        if old not in master or old == new:
            continue
        taken = {n for m, n in data if m == new}
        data = Counter({k: c for k, c in data.items() if not (k[0] == old and k[1] in taken)})
        moved = Counter()
        for (m, n), c in data.items():
            moved[(new if m == old else m, n)] += c
        data = moved
        master.discard(old)
    tables = {
        "m": frame("name string", *[(n,) for n in "abcd"]),
        "d": frame("module string, name int", *sorted(owned)),
        "l": frame("name string", ("a",)),
    }
    done = upsert.merge_namespace(tables, ("m", "name"), ("d", "module", "name"), ("l", "name", ["name"]), merges)
    assert rows(done.tables["d"]) == list(data.elements())
    assert rows(done.tables["m"]) == [(n,) for n in master]


@few
@given(parents=st.lists(st.one_of(st.none(), st.integers(0, 12)), min_size=1, max_size=12))
def test_lineage_agrees_with_walking_up(spark, frame, parents):
    tree = dict(enumerate(parents))

    def walk(node):
        seen, steps = [], 0
        while True:
            parent = tree[node]
            if parent is None:
                return ("ok", steps)
            if parent not in tree:
                return ("missing_parent" if steps == 0 else "broken_ancestor", 0)
            steps += 1
            seen.append(node)
            node = parent
            if node in seen:
                return ("cycle" if node == seen[0] else "broken_ancestor", 0)

    df = frame("id int, parent int", *tree.items())
    out = both_ways(spark, lambda: hierarchy.lineage_check(df, "id", "parent"))
    assert {r[0]: (r[2], r[3]) for r in out} == {n: walk(n) for n in tree}


@few
@given(rows_in=st.lists(st.tuples(st.sampled_from(["k", "l", "", None]), st.booleans(), st.one_of(st.none(), st.integers(0, 9))), max_size=10))
def test_dedup_leaves_one_row_per_key(frame, rows, rows_in):
    df = frame("id int, key string, good boolean, parent int", *[(i, k, g, p) for i, (k, g, p) in enumerate(rows_in)])
    losers = dedup.losers_of(df, "key", "id", F.col("good"))
    moved = dedup.redirect_children(df, "parent", losers, "id", same_table=True)
    done = dedup.delete_losers(moved.children, "id", moved.losers, moved.children, "parent", "id")
    def cycles(df):
        return {r[0] for r in rows(hierarchy.lineage_check(df, "id", "parent").where("status = 'cycle'"), "id")}

    assert cycles(moved.children) <= cycles(df)
    kept = {r[0] for r in rows(done.rows, "id")}
    failed = {r[0] for r in rows(losers, "loser_id")} - {r[0] for r in rows(moved.losers, "loser_id")}
    failed |= {r[0] for r in rows(done.failures, "id")}
    for key in ("k", "l"):
        members = [i for i, (k, _, _) in enumerate(rows_in) if k == key]
        if members:
            best = min(members, key=lambda i: (not rows_in[i][1], i))
            assert best in kept
            assert {i for i in members if i in kept} - {best} <= failed


@few
@given(left=st.lists(keys, max_size=8), right=st.lists(keys, max_size=6))
def test_membership_follows_sql(spark, frame, left, right):
    df, others = frame("id int", *[(k,) for k in left]), frame("k int", *[(k,) for k in right])

    def sql_in(value):
        if not right:
            return False
        if value is not None and value in right:
            return True
        return None if value is None or None in right else False

    out = both_ways(spark, lambda: joins.with_membership(df, "id", others, "k", "m"))
    assert Counter(out) == Counter((k, sql_in(k)) for k in left)


def test_task_functions_need_no_installed_package(tmp_path):
    """Executors may not have the package; what is sent to them must load without it."""
    from pyspark import cloudpickle

    from tablelift.operators import documents

    sent = [documents._evaluate, documents.xml_error.func, sequence._chainer(["a"], "b", None)]
    (tmp_path / "sent").write_bytes(cloudpickle.dumps(sent))
    code = "import pickle, sys; pickle.load(open('sent', 'rb')); assert 'tablelift' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})
