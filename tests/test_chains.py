"""Ordered pair tables of any length against applying the pairs one after another."""

import random
from collections import Counter

import pytest

from tablelift.operators import chains, dedup, hierarchy, upsert


def renamed_in_turn(pairs, names):
    """What becomes of every name, of the names there are and of those that only dependants use."""
    master, data = Counter(names), {}
    everything = {n for n, _ in pairs} | set(names)
    data = {n: n for n in everything}
    for old, new in pairs:
        if old is None or new is None or old == new or not master[old]:
            continue
        master[new] += master.pop(old)
        data = {n: new if c == old else c for n, c in data.items()}
    return {n: c for n, c in data.items() if n != c}


def merged_in_turn(pairs, names, owned):
    """(rows left, rows dropped) of (namespace, name) rows."""
    master, data, dropped = set(names), list(owned), []
    for old, new in pairs:
        if old not in master or old == new or new is None:
            continue
        taken = {n for m, n in data if m == new and n is not None}
        dropped += [r for r in data if r[0] == old and r[1] in taken]
        data = [(new if m == old else m, n) for m, n in data if not (m == old and n in taken)]
        master.discard(old)
    return Counter(data), len(dropped), master


def tables_of(frame, pairs, names):
    return frame("ord long, old string, new string", *[(i, *p) for i, p in enumerate(pairs)]), frame("old string", *[(n,) for n in names])


CASES = [
    ([], ["a"]),
    ([("a", "b")], []),
    ([("a", "b"), ("b", "a")], ["a", "b"]),
    ([("a", "b"), ("b", "c"), ("c", "a")], ["a"]),
    ([("a", "b"), ("a", "c"), ("b", "a"), ("a", "d")], ["a", "b"]),
    ([("q", "r"), ("p", "q"), ("q", "s")], ["p"]),
    ([("a", "a"), (None, "x"), ("a", None), ("a", "z")], ["a", None]),
    ([(f"n{i}", f"n{i + 1}") for i in range(70)], ["n0", "n31", "n70"]),
    ([(f"n{i + 1}", f"n{i}") for i in range(70)], ["n70", "n31"]),
    ([(f"n{i}", "hub") for i in range(30)] + [("hub", "end")] + [(f"m{i}", "hub") for i in range(30)], [f"n{i}" for i in range(20)] + ["m3"]),
]


SPLIT = [len(CASES) - 1, len(CASES)]  # run once more with the large-data paths forced


@pytest.fixture(params=[*[(i, "small") for i in range(len(CASES) + 2)], *[(i, "split") for i in SPLIT]], ids=str)
def case(request):
    if request.param[1] == "split":
        request.getfixturevalue("split")
    return request.param[0]


def test_renames_of_a_table_equal_renaming_in_turn(frame, case):
    if case < len(CASES):
        pairs, names = CASES[case]
    else:
        rng = random.Random(case)
        pool = [f"x{i}" for i in range(12)]
        pairs = [(rng.choice(pool), rng.choice(pool)) for _ in range(60)]
        names = rng.sample(pool, 5)
    found = {r.old: r.new for r in chains.renames_from(*tables_of(frame, pairs, names)).collect()}
    assert {o: n for o, n in found.items() if o != n} == renamed_in_turn(pairs, names)
    listed = upsert.resolve_renames(pairs, set(names) - {None})
    assert {o: n for o, n in listed.items() if o != n} == renamed_in_turn(pairs, names)


def test_merges_of_a_table_equal_merging_in_turn(frame, case):
    rng = random.Random(case)
    if case < len(CASES):
        pairs, names = CASES[case]
    else:
        pool = [f"x{i}" for i in range(14)]
        pairs = [(rng.choice(pool), rng.choice(pool)) for _ in range(40)]
        names = rng.sample(pool, 9)
    used = sorted({n for p in pairs for n in p if n} | {n for n in names if n} | {"other"})
    owned = [(n, str(k)) for n in used for k in range(6) if rng.random() < 0.4] + [(used[0], None), (None, "1")]
    pair_table, _ = tables_of(frame, pairs, names)
    tables = {
        "m": frame("name string", *[(n,) for n in names]),
        "d": frame("module string, name string", *owned),
        "l": frame("name string", *[(n,) for n in used]),
    }
    left, lost, master = merged_in_turn(pairs, [n for n in names if n], owned)
    for given in (pair_table, pairs):
        done = upsert.merge_namespace(tables, ("m", "name"), ("d", "module", "name"), ("l", "name", ["name"]), given)
        assert Counter(map(tuple, done.tables["d"].collect())) == left
        assert done.dropped.count() == lost
        assert {r.name for r in done.tables["m"].collect() if r.name} == master


def test_rounds_grow_with_the_logarithm_of_a_chain(frame, jobs):
    def renames(n):
        pairs, names = tables_of(frame, [(f"n{i}", f"n{i + 1}") for i in range(n)], ["n0"])
        assert dict(map(tuple, chains.renames_from(pairs, names).where("old = 'n0'").collect())) == {"n0": f"n{n}"}

    few, many = jobs(lambda: renames(20)), jobs(lambda: renames(1280))
    per_round = jobs(lambda: renames(40)) - few
    assert per_round > 0 and many - few <= 6 * per_round


def test_long_pair_tables_stay_with_spark(spark, monkeypatch):
    """No list of names or pairs is collected, however long the tables are."""
    n = 20_000
    pairs = spark.range(n).selectExpr("id AS ord", "concat('a', id % 5000) AS old", "concat('a', (id * 7919 + 13) % 5000) AS new")
    names = spark.range(0, 5000, 3).selectExpr("concat('a', id) AS name")
    listed = [(f"a{i % 5000}", f"a{(i * 7919 + 13) % 5000}") for i in range(n)]
    want = upsert.resolve_renames(listed, {f"a{i}" for i in range(0, 5000, 3)})
    seen = []
    whole = type(names).collect
    monkeypatch.setattr(type(names), "collect", lambda df: seen.append(len(rows := whole(df))) or rows)
    done = upsert.rename_cascade({"m": names}, {"m": "name"}, "m", pairs)
    merged = upsert.merge_namespace(
        {"m": names, "d": names.selectExpr("name AS module", "name AS owned"), "l": names}, ("m", "name"), ("d", "module", "owned"), ("l", "name", ["name"]), pairs
    )
    assert max(seen, default=0) <= 1
    monkeypatch.undo()
    assert Counter(r.name for r in done.tables["m"].collect()) == Counter(want.get(f"a{i}", f"a{i}") for i in range(0, 5000, 3))
    left, _, master = merged_in_turn_fast(listed, {f"a{i}" for i in range(0, 5000, 3)})
    assert {(r.owned, r.module) for r in merged.tables["d"].collect()} == left
    assert {r.name for r in merged.tables["m"].collect()} == master


def merged_in_turn_fast(pairs, names):
    """Every name owns itself, so nothing is dropped: only where it ends matters."""
    order, gone = upsert.resolve_merges(pairs, names)
    ends = {member: target for target, members in order.items() for member in members}
    return {(n, ends.get(n, n)) for n in names}, gone, names - gone


def test_rounds_of_guarded_deletes_grow_with_the_logarithm_of_the_depth(frame, jobs):
    def deleted(depth):
        """A line of losers, each waiting for the one below; the lowest has a child that stays."""
        tree = frame("id int, parent int", (0, None), *[(i, i - 1) for i in range(1, depth + 1)], (depth + 1, depth), (1000, None), (1001, 1000))
        losers = frame("loser_id int", *[(i,) for i in range(1, depth + 1)], (1001,))
        done = dedup.delete_losers(tree, "id", losers, tree, "parent", "id")
        assert done.rows.count() == depth + 3 and done.failures.count() == depth

    counts = {depth: jobs(lambda d=depth: deleted(d)) for depth in (6, 12, 24, 96)}
    assert counts[24] - counts[12] <= counts[12] - counts[6] + 2
    assert counts[96] - counts[24] <= 2 * (counts[24] - counts[12]) + 2


def test_blocked_losers_with_shared_ids_and_branches(frame, rows, both):
    tree = [(0, None), (1, 0), (2, 1), (3, 1), (4, 2), (4, 3), (5, 4), (6, 5), (7, 3), (8, 7), (9, 8), (10, 9)]
    losers = [1, 2, 3, 4, 5, 7, 8, 9]

    def in_turn():
        left, failed = list(tree), {}
        for loser in sorted(losers, reverse=True):
            children = [i for i, p in left if p == loser]
            if children:
                failed[loser] = len(children)
            else:
                left = [r for r in left if r[0] != loser]
        return left, failed

    left, failed = in_turn()
    df = frame("id int, parent int", *tree)
    done = dedup.delete_losers(df, "id", frame("loser_id int", *[(i,) for i in losers]), df, "parent", "id")
    assert rows(done.rows) == left
    assert rows(done.failures) == [(i, f"Still has {n} children") for i, n in failed.items()]


@pytest.mark.parametrize("shape", ["chain", "cycle", "ladder", "tree", "hub"])
def test_implied_groups_end_in_few_rounds(frame, jobs, shape):
    n = 400
    edges = {
        "chain": [(i, i + 1) for i in range(n)],
        "cycle": [(i, (i + 1) % n) for i in range(n)] + [(n, 0)],
        "ladder": [(i, i + k) for i in range(n) for k in (1, 2, 3)],
        "tree": [(i, 2 * i + k) for i in range(n) for k in (1, 2)],
        "hub": [(i, n) for i in range(n)] + [(n, n + 1 + i) for i in range(n)],
    }[shape]
    reach, last = {0}, {0}
    by = {}
    for a, b in edges:
        by.setdefault(a, []).append(b)
    while last:
        last = {b for a in last for b in by.get(a, [])} - reach
        reach |= last
    grants, implied = frame("u int, g int", (7, 0)), frame("g int, h int", *edges)
    added = []
    spent = jobs(lambda: added.extend(hierarchy.implied_closure(grants, "u", "g", implied, "g", "h").collect()))
    assert {r.g for r in added} == reach - {0}
    assert spent < 120  # a round per edge of a chain would take thousands
    again = frame("u int, g int", (7, 0), *[(7, g) for g in reach - {0}])
    assert shape != "tree" or hierarchy.implied_closure(again, "u", "g", implied, "g", "h").isEmpty()
