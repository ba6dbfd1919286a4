"""URL filter, lexical search and hard negatives against brute force on small fixtures."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tablelift.llm import hard_negatives, lexical, url_filter

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


# ---------------------------------------------------------------- URL filter


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def judged(url, rules, listed):
    host, path = parts(url)
    fitting = [
        (len(h) + len(p), len(h), h.translate(LOWER) + p, v)
        for h, p, v in rules
        if None not in (h, p, v) and (p == "" or p[0] == "/") and ("." + host).endswith("." + h.translate(LOWER)) and path.startswith(p)
    ]
    if fitting:
        return host, path, *max(fitting)[2:]

    def canonical(host, path):
        return re.sub(r"^www\.", "", re.sub(r":(80|443)\Z", "", host)) + re.sub(r"/\Z", "", path)

    pages = {canonical(*parts(u)) for u in listed if parts(u)[0]}
    return host, path, None, "block" if host and canonical(host, path) in pages else "allow"


RULES = url_filter.RULES
WIDE = [
    *RULES, ("COM", "/", "block"), ("org", "", "allow"), ("a.org", "/x", "block"), ("org", "/xyz1", "allow"), ("b.org", "/xyz", "block"), (None, "/", "block"),
    ("x", None, "block"), ("y", "/", None), ("bad", "x/", "block"), ("", "", "block"), ("Upper.NET", "/Case/", "block"),
]
URLS = [
    None, "", "no scheme.com/", "http://", "http:///en/", "http://com", "http://com/", "http://example.com/en", "http://example.com/en/", "https://WWW.Example.com/en/1?x#y",
    "https://m.www.example.com/en/", "http://notexample.com/en/", "http://a.net/es/9", "http://net/fr/", "http://net/en/", "http://.net/fr/", "http://a..net/fr/",
    "x?u=http://a.net/es/", "http://a.net?/es/", "http://a.net#/es/", "http://a.net/ES/", "http://a.b.org/xyz12", "http://c.a.org/xyz12", "http://a.org", "http://b.org/xyz",
    "http://upper.net/Case/1", "http://upper.net/case/1", "http://x.", "http://x/", "http://é.com/ü/😀", "http://a.net/fr/\nline", "http://a\nb.com/x", "http://shop.de/list/",
    "http://www.shop.de:443/list?x", "http://shop.de/list/1", "http://shop.de:8080/list", "http://" + "a." * 3000 + "com/en/", "http://big.com/" + "x" * 100_000, "://com/a", "http://u@com/",
]
LISTED = ["https://www.Shop.de/list", None, "", "plain", "http://shop.de/list/", "http:///x", "http://example.com/en/", "http://only.fr"]


@pytest.mark.parametrize("rules, listed", [(RULES, None), (WIDE, LISTED), ([], LISTED), ([], None), (RULES, [])])
def test_url_filter_against_every_rule(spark, rules, listed):
    rows = [(i, u, "h", "k", 7, "r") for i, u in enumerate(URLS)] * 3 + [(None, "http://a.net/es/", "h", "k", 7, "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, Host string, `a.b` string, `row` int, verdict string").repartition(3)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    block = None if listed is None else spark.createDataFrame([(u,) for u in listed], "url string")
    found = url_filter.judge(pages, table, block)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = [(r[0], *judged(r[1], rules, listed or [])) for r in rows]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_url_filter_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty, url_filter.listed_rules(spark)).collect() == []


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(4000).selectExpr("concat('k', id) key")
    others = spark.range(4000).selectExpr("concat('o', id) key")
    few = url_filter.bloom_filter(keys, 256)
    assert few.count() <= 256
    assert url_filter.possible_hits(keys, few, 256).count() == 4000
    assert url_filter.possible_hits(others, few, 256).count() < 200
    full = url_filter.bloom_filter(keys, 1)  # as good as no filter, and still right
    assert url_filter.possible_hits(keys, full, 1).count() == 4000


def test_url_filter_is_right_behind_a_filter_that_passes_everything(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MOST_BLOCKS", 1)
    rules = [(f"h{i}.com", "/", "block") for i in range(300)] + RULES
    pages = spark.createDataFrame([(i, f"http://w.h{i}.com/x") for i in range(0, 600, 7)], "page_id long, url string")
    found = url_filter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert sorted((r.page_id, r.rule, r.verdict) for r in found) == [(i, f"h{i}.com/" if i < 300 else "com/", "block" if i < 300 else "allow") for i in range(0, 600, 7)]


# ---------------------------------------------------------------- lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def ranked(docs, items, top=10):
    """(item_id, rank, doc_id, score) by the formula, over all pairs."""
    counts = [(i, Counter(terms_of(t))) for i, t in docs if terms_of(t)]
    n_docs, n_words = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc_id, c in counts:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def lexical_tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1.0, "x", 3, 4, "y") for i, t in docs], "doc_id long, text string, score double, Terms string, N int, `a.b` int, task string")
    q = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, w int, Block string")
    return d.repartition(3), q


def lexical_corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(150)] + ["Élan", "ÉLAN", "naïve", "x2", "日本"]
    weights = [1 / (k + 1) for k in range(len(words))]

    def text(n):
        return "".join(w.upper() + ", " if rng.random() < 0.3 else w + " _" for w in rng.choices(words, weights, k=n))

    docs = [(i, text(rng.choice([0, 1, 2, 5, 30, 80]))) for i in range(250)]
    docs += [(i, docs[40][1]) for i in range(250, 330)] + [(7, docs[41][1]), (7, docs[41][1]), (None, docs[41][1]), (None, docs[40][1])]  # copies, repeated and missing ids
    docs += [(400, None), (401, ""), (402, " \t.;"), (403, text(20_000)), (404, "A" * 700_000 + " w1 w2"), (405, "w1 " * 250_000), (-3, docs[40][1])]
    items = [(i, text(rng.choice([1, 3, 12, 40]))) for i in range(40)] + [(1, "w149 x2"), (None, "w1"), (50, None), (51, ""), (52, "nowhere else"), (53, docs[40][1])]
    return docs, items + [(54, "w1 " * 10), (55, "a" * 700_000)]


@pytest.mark.parametrize("block, leaf, query_terms", [(8192, 8, 1 << 20), (16, 1, 100), (50, 3, 40)])
def test_lexical_search_against_all_pairs(spark, block, leaf, query_terms):
    docs, items = lexical_corpus(block)
    found = lexical.search(*lexical_tables(spark, docs, items), block=block, leaf=leaf, query_terms=query_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == ranked(docs, items)


def test_lexical_search_of_nothing(spark):
    docs, items = lexical_corpus(1)
    for d, q in ((docs, []), ([], items), ([], []), ([(1, None)], items), (docs, [(1, "nowhere")])):
        assert lexical.search(*lexical_tables(spark, d, q)).collect() == []
    assert [tuple(r) for r in lexical.search(*lexical_tables(spark, [(5, "a b")], [(1, "B c")])).collect()] == ranked([(5, "a b")], [(1, "B c")])


def test_ball_trees_prune_and_lose_nothing(spark):
    rng = np.random.default_rng(3)
    width, n = 60, 2000
    sets = [np.unique(rng.integers(0, width, 8) // (1 + rng.integers(0, 4))) for _ in range(n)]
    ptr = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    rows = lexical.Rows(ptr, np.concatenate(sets), rng.integers(1, 10**6, ptr[-1]))
    weight = rng.integers(1, 9000, width)
    tree = lexical.BallTree(rows, weight, 8)
    full = np.zeros((n, width), np.int64)
    full[np.repeat(np.arange(n), np.diff(ptr)), rows.term] = rows.value * weight[rows.term]
    assert sorted(tree.order.tolist()) == list(range(n))
    looked = 0
    for _ in range(50):
        query = np.unique(rng.integers(0, width, 6))
        bounds = tree.bounds(query)
        scores = full[:, query].sum(axis=1)[tree.order]
        assert all(scores[a:b].max() <= bounds[k] for k, (a, b, _) in enumerate(tree.nodes))
        best, dense = lexical.Best(10), np.zeros(width, np.int64)
        dense[query] = weight[query]
        looked += tree.search(query, dense, list(range(n)), best)
        want = sorted(((-s, i) for i, s in enumerate(full[:, query].sum(axis=1).tolist()) if s), key=lambda x: x)[:10]
        assert sorted((-s, -i) for s, _, i in best.held) == want
    assert looked < 0.8 * 50 * n


# ---------------------------------------------------------------- hard negatives


def mined(rows, every=100, count=5, low=80, high=100):
    """All (anchor, positive, rank, negative, scores) by looking at every pair."""
    once = {}
    for i, label, x in rows:
        if i is None or label is None or x is None or any(v is None or abs(v) > hard_negatives.LARGEST for v in x):
            continue
        once[i] = min(once.get(i, (label, x)), (label, x))
    out = []
    for a, (label, x) in once.items():
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), i, m == label) for i, (m, y) in once.items() if i != a and len(y) == len(x))
        for ps, positive, _ in [s for s in scored if s[2]][:count]:
            fitting = [s for s in scored if not s[2] and low * -ps <= high * -s[0] <= high * -ps][:count]
            out += [(a, positive, k + 1, i, -ps, -s) for k, (s, i, _) in enumerate(fitting)]
    return sorted(out)


def clustered_vectors(seed, n, dim=12, spread=25):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-200, 200, (6, dim))
    rows = []
    for i in range(n):
        crowd = i % 3 == 0  # a third of all rows in one place
        x = centres[0 if crowd else rng.integers(0, 6)] + rng.integers(-2 if crowd else -spread, 3 if crowd else spread, dim)
        rows.append((i - 50, int(rng.integers(0, 2 if crowd else 4)), x.tolist()))
    return rows


AWKWARD = [
    (None, 1, [1] * 12), (4000, None, [1] * 12), (4001, 1, None), (4002, 1, [1, None] * 6), (4100, 0, [0] * 12), (4003, 0, [0] * 12), (4004, 1, [0] * 12),
    (4200, 2, [5, 5]), (4201, 2, [5, 4]), (4202, 3, [5, 4]), (4203, 3, [4, 4]), (4300, 1, []), (4301, 1, []), (4302, 2, []), (4400, 9, [7] * 12),
    (4500, 1, [1 << 26, 1 << 26, 3]), (4501, 1, [1 << 26, 1 << 26, 2]), (4502, 2, [1 << 26, 1 << 26, 1]), (4503, 1, [1 << 27, 0, 0]), (4600, 1, [-9, 3]), (4601, 1, [8, 1]), (4602, 4, [8, 1]),
]


@pytest.mark.parametrize("block, clusters, members", [(8192, 64, 512), (40, 3, 2), (7, 1, 1)])
def test_hard_negatives_against_all_pairs(spark, monkeypatch, block, clusters, members):
    monkeypatch.setattr(hard_negatives, "MEMBERS", members)
    monkeypatch.setattr(hard_negatives, "LEAST_BLOCK", 5)
    monkeypatch.setattr(hard_negatives, "STEP", 9)
    rows = clustered_vectors(block, 700) + AWKWARD
    rows += [(i, 1, rows[60][2]) for i in range(800, 900)] + [(50, 0, rows[61][2]), (50, 0, rows[61][2]), (51, 3, rows[62][2])]  # copies and repeated ids
    named = [(*r, "b", 1, 2, "k") for r in rows]
    table = spark.createDataFrame(named, "vec_id long, label int, x array<long>, Block string, dim int, `a.b` int, chunk string").repartition(4)
    found = hard_negatives.mine(table, every=50, block=block, clusters=clusters)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined(rows, every=50)
    assert len(want) > 100
    assert sorted(map(tuple, found.collect())) == want


def test_hard_negatives_of_few_rows(spark):
    schema = "vec_id long, label int, x array<long>"
    for rows in ([], [(100, 1, [1, 2])], [(100, 1, [1, 2]), (1, 1, [1, 1])], [(100, 1, [1, 2]), (1, 2, [1, 1])], [(100, 1, [1, 2]), (1, 1, [1, 1]), (2, 2, [3, 0])]):
        assert sorted(map(tuple, hard_negatives.mine(spark.createDataFrame(rows, schema)).collect())) == mined(rows)


def test_components_as_the_query_wants_them(spark):
    rows = [(1, 3, [0.5, -0.001]), (7, 9, [1.0]), (14, 3, [0.1]), (3, 1, [float("nan")]), (4, 1, [float("inf")]), (5, 1, [None, 1.0]), (6, 1, None), (8, None, [1.0]), (None, 1, [2.0])]
    found = hard_negatives.quantised(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(1, 3, [128, -1]), (7, 0, [256]), (14, 4, [25]), (8, None, [256]), (None, 1, [512])], key=repr)


def test_lists_are_left_early_in_clustered_vectors():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 32))
    x = np.floor(256 * (centres[rng.integers(0, 20, 4000)] + 0.1 * rng.normal(size=(4000, 32)))).astype(int)
    mine = np.floor(256 * (centres[3] + 0.1 * rng.normal(size=(30, 32)))).astype(int)

    def rows(vectors, first):
        return pa.table({"vec_id": range(first, first + len(vectors)), "label": rng.integers(0, 2, len(vectors)), "x": vectors.tolist(), "wanted": [[]] * len(vectors)})

    members, block = hard_negatives.Members(rows(mine, 10_000), 32), hard_negatives.Block(rows(x, 0), 32)
    found, shown = hard_negatives.best_positives(members, block, 5)
    scores = mine @ x.T
    for i in range(30):
        same = np.flatnonzero(block.labels == members.labels[i])
        want = sorted((-int(scores[i, k]), int(k)) for k in same)[:5]
        assert sorted((-s, p) for a, p, s in found if a == 10_000 + i) == want
    assert shown < 0.5 * 0.5 * 30 * 4000  # half of the rows have a member's label
