"""The operators on small fixtures: brute force, nulls, empty and long texts, ties, repeats, empty tables."""

import hashlib
import random
import re
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelift.llm import common, decontam, html_content, licences, mixing, neardup, neighbours, packing, quality, repeats, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def babble(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=5):
    """Texts with copies, near copies, shared passages, long ones and awkward ones."""
    rng = random.Random(seed)
    passage = babble(rng, 90)
    rows = [(i, babble(rng, rng.choice([0, 1, 2, 3, 30, 120, 300])), f"s{rng.choice([0, 0, 0, 1, 2])}") for i in range(60)]
    for i in range(60, 110):  # a hot group of near copies
        words = rows[50][1].split() or passage.split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(900)}"
        rows.append((i, " ".join(words), "s0"))
    rows += [(i, rows[i - 110][1], "s0") for i in range(110, 130)]  # exact copies
    rows += [(i, f"{babble(rng, rng.randint(0, 40))} {passage} {babble(rng, rng.randint(0, 40))}", "s1") for i in range(130, 170)]
    rows += [(170, None, None), (171, "", "s2"), (172, "É" * 150, None), (173, "ab" * 400, "s1"), (174, babble(rng, 20_000, 9000), "s2"), (175, " \t\n", "s0")]
    return rows


def groups_of(sets, percent):
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    names = sorted(sets)
    for k, a in enumerate(names):
        for b in names[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in names}


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_against_all_pairs(documents, n, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)  # lists are compared in several blocks
    rows = corpus()
    sets = {i: shingle_set(t, n) for i, t, _ in rows}
    root = groups_of(sets, 80)
    found = neardup.near_duplicates(documents(rows), n, 80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == [
        (i, len(sets[i]), root[i], root[i] == i) for i in sorted(sets)
    ]


def test_near_duplicates_with_repeated_and_null_ids(documents):
    a, b = babble(random.Random(1), 50), babble(random.Random(2), 50)
    rows = [(9, a, "s"), (9, a, "s"), (3, a, "s"), (9, b, "s"), (7, b, "s"), (None, a, "s"), (None, None, "s"), (5, None, "s")]
    found = neardup.near_duplicates(documents(rows), 5, 80).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in found if r.doc_id is not None) == [
        (3, 3, True), (5, 5, True), (7, 3, False), (9, 3, False), (9, 3, False), (9, 3, False),
    ]
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)] * 2
    once = neardup.one_per_id(documents(rows))
    assert sorted((r.doc_id or -1) for r in once.collect()) == [-1, -1, 3, 5, 7, 9]


def test_components_of_long_chains(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100 + i, 101 + i) for i in range(0, 30)] + [(500, 400), (500, 450), (7, 7)]
    found = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 131), 100), **dict.fromkeys((400, 450, 500), 400)}


def removed(rows, length=100):
    seen, out = {}, {}
    for i, text, _ in sorted((r for r in rows), key=lambda r: r[0]):
        data = (text or "").encode()
        mark = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if data[k : k + length] in seen:
                mark[k : k + length] = b"\1" * length
            seen.setdefault(data[k : k + length], i)
        kept = bytes(c for c, m in zip(data, mark, strict=True) if not m)
        runs = sum(1 for k, m in enumerate(mark) if m and (k == 0 or not mark[k - 1]))
        out[i] = (i, len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("texts", [8, 2, 1])
def test_repeats_against_all_windows(documents, texts, monkeypatch):
    monkeypatch.setattr(repeats, "TEXTS", texts)  # keys with more texts are divided further
    rows = corpus(11)
    expected = removed(rows)
    found = repeats.remove_repeats(documents(rows), texts=True).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == [expected[i] for i in sorted(expected)]
    by_id = {i: (t or "").encode() for i, t, _ in rows}
    for r in found:
        spans = [(s.start, s.end) for s in r.spans]
        left = b"".join(by_id[r.doc_id][a:b] for a, b in zip([0] + [e for _, e in spans], [s for s, _ in spans] + [r.n_bytes], strict=True))
        assert bytes(r.kept) == left


def test_repeats_in_periodic_and_nul_texts(documents):
    rows = [(1, "ab" * 300, "s"), (2, "b" + "ab" * 70, "s"), (3, "\0" * 250, "s"), (4, "a\0" * 99 + "b", "s"), (5, "x" * 99, "s"), (6, "x" * 99, "s")]
    expected = removed(rows)
    found = repeats.remove_repeats(documents(rows)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == [expected[i] for i in sorted(expected)]


def test_repeats_with_repeated_and_null_ids(documents):
    text = babble(random.Random(4), 60)
    found = repeats.remove_repeats(documents([(2, text, "s"), (2, text, "s"), (1, text, "s"), (None, text, "s")])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in found) == [(-1, 0), (1, 0), (2, len(text)), (2, len(text))]


def test_repeats_of_rows_that_share_an_id(documents):
    rng = random.Random(12)
    a, b, c = (babble(rng, 40)[:150].ljust(150, "x") for _ in range(3))
    fresh = [babble(rng, 60, 4000) for _ in range(4)]
    rows = [(1, f"{a} {fresh[0]}", "s"), (2, f"{a} {b} {fresh[1]}", "s"), (2, f"{fresh[2]} {b} {c} {a}", "s"), (2, f"{c}|{c}", "s"), (3, f"{b} {fresh[3]} {c}", "s")]
    rows += [(k, f"{fresh[k % 4][:50]}{k} {a} {k}", "s") for k in range(20, 50) for _ in range(2)] + [(20, f"{a} other {fresh[3]}", "s")]
    found = repeats.remove_repeats(documents(rows), texts=True).collect()

    def kept(i, text):
        earlier = [t for j, t, _ in rows if j < i]
        gone = [False] * len(text)
        for at in range(len(text) - 99):
            if any(text[at : at + 100] in t for t in earlier) or text.find(text[at : at + 100]) < at:
                gone[at : at + 100] = [True] * 100
        return "".join(x for x, g in zip(text, gone, strict=True) if not g)

    assert sorted((r.doc_id, r.kept.decode()) for r in found) == sorted((i, kept(i, t)) for i, t, _ in rows)


def test_items_in_documents_against_sets(spark, documents):
    rng = random.Random(8)
    items = [(k, babble(rng, rng.choice([2, 5, 9, 40, 200])), "x") for k in range(30)] + [(40, None, "x"), (41, "", "x"), (None, "a b c d e f", "x")]
    rows = [(i, babble(rng, rng.choice([3, 50, 3000]), 4000), "s") for i in range(40)]
    for i in range(40, 90):  # items inside long texts, some with a few words changed
        words = rng.choice(items[:30])[1].split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, f"{babble(rng, 700, 4000)} {' '.join(words).upper()} {babble(rng, 50, 4000)}", "s"))
    rows += [(90, items[0][1], "s"), (91, None, "s"), (None, items[3][1], "s"), (40, "another text of document forty", "s")]
    bench = spark.createDataFrame(items, "item_id long, text string, doc_id string")
    found = decontam.contained_items(documents(rows), bench).collect()
    of_doc, of_item = {}, {k: shingle_set(t, 5) for k, t, _ in items if k is not None}
    for i, text, _ in rows:
        of_doc.setdefault(i, set()).update(shingle_set(text, 5))
    expected = [
        (i, k, len(of_doc[i] & runs), len(runs)) for i in of_doc if i is not None for k, runs in of_item.items()
        if runs and 100 * len(of_doc[i] & runs) >= 80 * len(runs)
    ]
    assert sorted((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in found) == sorted(expected) and expected
    assert decontam.contained_items(documents(rows), bench.limit(0)).count() == 0
    assert decontam.contained_items(documents([]), bench).count() == 0


def test_mix_meets_targets(documents, spark):
    rows = corpus()
    mixed = mixing.mix(documents(rows).withColumn("size", F.lit("x")))
    found = mixed.collect()
    assert len(found) == len(rows)
    by_source = {}
    for r in found:
        held = by_source.setdefault(r.source, [0, 0, r.source_size, r.target, 0])
        held[0] += r.size
        held[1] += r.taken
        held[4] = max(held[4], r.size)
        assert r.taken == r.size * r.copies <= 2 * r.size
    total = sum(h[0] for h in by_source.values())
    assert sum(h[3] for h in by_source.values()) == pytest.approx(1.5 * total)
    for size, taken, stated, target, largest in by_source.values():
        assert size == stated and target <= 2 * size and abs(taken - target) <= largest
    again = {(r.doc_id, r.taken) for r in mixing.mix(documents(rows).repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in found}
    copies = mixing.repeated(mixed, ["doc_id", "text"])
    assert copies.count() == sum(r.copies for r in found) and copies.columns == ["doc_id", "text"]


def test_mix_against_sql(spark, documents):
    rows = corpus(6) + [(0, "a b c", "s0"), (0, "a b c", "s0"), (None, "x y", "s1")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    expected = con.execute(mixing.ORACLE).fetchall()
    found = mixing.mix(documents(rows)).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    assert mixing.mix(documents([])).count() == 0
    assert mixing.mix(documents([(1, None, None), (2, "", "a")])).select("taken").distinct().collect()[0][0] == 0


def test_mix_runs_no_python(spark):
    docs = spark.range(100).selectExpr("id AS doc_id", "repeat('word ', cast(id AS int)) AS text", "concat('s', id % 3) AS source")
    mixed = mixing.repeated(mixing.mix(docs), docs.columns)
    assert mixed.count() > 100
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_long_white_space_goes_past_the_pattern():
    encoding, _ = packing.encoder(Path(packing.VOCABULARY).read_bytes())
    for white in (" ", "\n", "\u3000", " \t"):
        for n in (1, 2, 3000, packing.WHITE_RUN // len(white)):  # the pattern alone
            for text in ("x" + white * n + "y", white * n, white * n + "?", "x" + white * n, "a  b" + white * n + " c" + white * n + "\nd"):
                if not packing.LONG_WHITE.search(text):
                    assert packing.token_ids(encoding, text).tolist() == encoding.encode_ordinary(text)
        for n in (packing.WHITE_RUN + 1, 3 * packing.WHITE_RUN + 2, 1_000_000):
            for text in ("x" + white * n + "y", white * n, white * n + "7", "x" + white * n, "é" + white * n + "z" + white * n + "!"):
                assert encoding.decode_bytes(packing.token_ids(encoding, text).tolist()).decode() == text
    text = "x" + " " * 5000 + "word"  # the last space belongs to the word, as ever
    assert packing.token_ids(encoding, text).tolist()[-1:] == encoding.encode_ordinary(" word")[-1:]


def test_packing_of_very_long_texts_of_one_class(documents):
    kinds = [" ", "\n", "a", "7", "!", "\0", "日", "😀", "\u0301", "ab ", "\u3000 "]
    rows = [(i, "x" + kind * (1_000_000 // len(kind)) + "y", "s") for i, kind in enumerate(kinds)] + [(99, " " * 10_000_000, "s"), (98, "b" * 10_000_000, "s")]
    texts = {}
    for r in sorted(packing.documents_of(packing.pack(documents(rows))).collect(), key=lambda r: r.piece_at):
        texts[r.doc_id] = texts.get(r.doc_id, b"") + bytes(r.piece)
    assert {i: t.decode() for i, t in texts.items()} == {i: t for i, t, _ in rows}


def test_packing_keeps_ids_of_any_type(spark):
    docs = spark.createDataFrame([("a", "one two"), (None, "three"), ("a", None)], "doc_id string, text string")
    found = packing.documents_of(packing.pack(docs)).collect()
    assert sorted((r.doc_id or "", bytes(r.piece)) for r in found) == [("", b"three"), ("a", b""), ("a", b"one two")]


def test_packing_round_trip(documents):
    rows = corpus() + [(None, "no id", "s"), (3, "again three", "s"), (300, "<|endoftext|> <s>", "s")]
    packed = packing.pack(documents(rows), length=64, horizon=4096)
    found = packed.collect()
    assert len({r.pack_id for r in found}) == len(found)
    for r in found:
        assert len(r.ids) == 2 * 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 64
        assert r.resets == r.cu_seqlens[:-1] and len(r.doc_ids) == len(r.piece_at) == len(r.resets)
    pieces = {}
    for r in packing.documents_of(packed).collect():
        pieces.setdefault(r.doc_id, []).append((r.piece_at, bytes(r.piece)))
    texts = {}
    for i, text, _ in rows:
        texts.setdefault(i, []).append((text or "").encode())
    single = {i: t[0] for i, t in texts.items() if len(t) == 1}
    assert {i: b"".join(p for _, p in sorted(pieces[i])) for i in single} == single
    assert len(pieces[3]) == sum(1 for p in pieces[3])
    waste = sum(64 - r.n_tokens for r in found) / (64 * len(found))
    assert waste < 0.02
    assert packing.pack(documents([])).count() == 0


def brute_neighbours(rows, k):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[i] = min(usable.get(i, v), v)
    out = {}
    for q in usable:
        if q % 20 == 0:
            near = sorted((-float(np.dot(usable[q], v)), i) for i, v in usable.items() if i != q and len(v) == len(usable[q]))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def test_neighbours_small_and_awkward(spark):
    rng = np.random.RandomState(2)
    rows = [(i, rng.randint(-4, 5, 6).astype(float).tolist()) for i in range(90)]
    rows += [(i, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for i in range(100, 160)]  # one very common vector
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (204, [float("nan")] * 6), (205, [float("inf")] + [0.0] * 5)]
    rows += [(220, [1.0, 1.0]), (221, [2.0, 0.5]), (None, [1.0] * 6), (0, rows[0][1]), (3, [9.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, "q") for i, v in rows], "vec_id long, embedding array<float>, label int, ids string")
    found = {}
    for r in neighbours.nearest(df, 20, block=40, query_block=3).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    assert found == brute_neighbours(rows, 20)
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_neighbours_recall(spark):
    rng = np.random.RandomState(3)
    vectors = rng.randn(6000, 64)
    vectors[:1500] = vectors[0] + 0.05 * vectors[:1500]  # a crowd of near copies
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    index = neighbours.PermutationIndex(vectors, rng.permutation(6000))
    queries = vectors[::40]
    hits = 0
    for query, (rows, scores) in zip(queries, index.search(queries, 21), strict=True):
        assert np.allclose(scores, vectors[rows] @ query)
        hits += len(set(np.argsort(-(vectors @ query), kind="stable")[:20]) & set(rows.tolist()))
    assert hits / (20 * len(queries)) >= 0.93


def test_neighbours_in_crowds_and_of_varied_lengths():
    rng = np.random.RandomState(4)
    plain = rng.randn(4000, 64)
    plain /= np.linalg.norm(plain, axis=1, keepdims=True)
    shapes = {}
    for noise in (0.05, 0.01, 0.001):
        shapes[f"crowd {noise}"] = plain.copy()
        shapes[f"crowd {noise}"][:1300] = plain[0] + noise * plain[:1300]
    for sigma in (0.25, 0.5):
        shapes[f"lengths {sigma}"] = plain * np.exp(sigma * rng.randn(4000, 1))
    shapes["ties"] = np.repeat(rng.randint(-1, 2, (4000, 4)), 16, axis=1).astype(float) + 0.5
    for name, vectors in shapes.items():
        index = neighbours.PermutationIndex(vectors, rng.permutation(4000))
        queries = vectors[:1300:40]
        for query, (rows, scores) in zip(queries, index.search(queries, 21), strict=True):
            exact = (vectors * query).sum(axis=1)
            assert len(set(rows.tolist())) == len(rows) and (scores == exact[rows]).all()
            assert set(np.flatnonzero(exact >= np.partition(exact, -21)[-21])) <= set(rows.tolist()), name


def labelled_texts(seed, n, spoil):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        text, bad = babble(rng, rng.randint(20, 120)), rng.random() < 0.2
        rows.append((i, spoil(text, rng) if bad else text, "s"))
        if rng.random() < 0.7:
            marks.append((i, 0 if bad else 1, 1 if bad else 0))
    return rows, marks


def test_quality_is_learnt_and_scored(spark, documents):
    rows, marks = labelled_texts(1, 500, lambda t, rng: " ".join(w + rng.choice(["***", "%%%"]) for w in t.split()))
    docs = documents([*rows, (900, None, "s"), (901, "", "s"), (None, "a", "s")])
    labels = spark.createDataFrame([*marks, (None, 1, 0), (3, None, None), (5, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    scored = quality.score(docs, quality.train(spark, docs, labels), ["doc_id", "score", "text"], "chance")
    assert scored.columns == ["doc_id", "score", "text", "chance"]
    verdict = {r.doc_id: r.chance for r in scored.collect()}
    assert len(verdict) == 503 and all(0 <= p <= 1 for p in verdict.values())
    truth = {i: q for i, q, _ in marks}
    held = [r.doc_id for r in docs.where(quality.held_out(F.col("doc_id"))).collect() if r.doc_id in truth]
    assert np.mean([(verdict[i] >= quality.THRESHOLD) == truth[i] for i in held]) > 0.97
    empty = quality.train(spark, docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, empty, ["doc_id"]).collect()} == {0.5}
    assert quality.score(docs.limit(0), empty, ["doc_id"]).count() == 0


def test_ftrl_separates():
    rng = np.random.RandomState(0)
    rows = [(np.array([i % 2, 2 + rng.randint(30), 64]), np.array([1.0, 1.0, 1.0]), i % 2) for i in range(400)]
    weights, intercept = quality.ftrl(rows, bits=6)
    assert weights[1] + intercept > 0.5 > -0.5 > weights[0] + intercept


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_rows_that_share_a_labelled_id_are_learnt_from_once(spark, documents, operator):
    rng = random.Random(4)
    rows = [(i, babble(rng, 40) + (" vile" if i % 3 == 0 else ""), "s") for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 != 0), int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    weights, intercept = operator.train(spark, documents(rows), labels)
    copied = rows + [(i, rows[i][1], "s") for i in (4, 9, 12)] * 300
    again, again_intercept = operator.train(spark, documents(copied), labels)
    assert np.array_equal(weights, again) and intercept == again_intercept


def test_repeats_in_rows_that_are_the_same_many_times(documents):
    passage = babble(random.Random(6), 60)
    rows = [(1, f"{passage} {passage} and {passage}", "s"), (2, f"first {passage} end", "s"), (3, "other", "s")]
    once = removed(rows)
    found = repeats.remove_repeats(documents([rows[0]] * 3000 + rows[1:])).collect()
    assert len(found) == 3002
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == set(once.values())
    assert once[1][2] > 0 and all(len(r.spans) <= 2 for r in found)


def test_toxicity_from_positive_and_unlabelled_texts(spark, documents):
    def spoil(text, rng):
        words = text.split()
        for _ in range(max(2, len(words) // 15)):
            words.insert(rng.randrange(len(words)), rng.choice(["Scum.", "moron", "trash"]))
        return " ".join(words)

    rows, marks = labelled_texts(2, 900, spoil)
    docs = documents([*rows, (990, None, "s"), (None, "moron", "s")])
    labels = spark.createDataFrame([*marks, (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    verdict = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(spark, docs, labels), ["doc_id"]).collect()}
    truth = {i: t for i, _, t in marks}
    held = [r.doc_id for r in docs.where(quality.held_out(F.col("doc_id"))).collect() if r.doc_id in truth]
    assert np.mean([(verdict[i] >= toxicity.THRESHOLD) == truth[i] for i in held]) > 0.95
    assert verdict[990] < 0.5
    none = toxicity.train(spark, docs, labels.limit(0))
    assert max(r.score for r in toxicity.score(docs, none, ["doc_id"]).collect()) < 0.01


def test_licence_scan_of_a_table(documents):
    rows = [(1, "Released under the MIT License.", "s"), (2, None, "s"), (2, None, "s"), (None, "cc by", "s")]
    found = licences.scan(documents(rows)).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.n_base, r.base_labels, r.labels, r.score) for r in found) == [
        (-1, 2, 1, "cc-by", "cc-by", 0.0), (1, 5, 1, "mit", "mit", 1.0), (2, 0, 0, "", "", 0.0), (2, 0, 0, "", "", 0.0),
    ]
    assert licences.scan(documents([])).count() == 0


def test_marginals_against_enumeration():
    source = "<body><nav><a href=x>one</a></nav><div class=content><p>Two words here.<p>More.</div>tail"
    trees = html_content.forest([html_content.read_page(source)])
    rng = np.random.RandomState(1)
    model = html_content.Model(rng.randn(html_content.FEATURES) * 0.5, rng.randn(html_content.EDGES, 2, 2))
    content, pair = html_content.marginals(trees, model)
    n = len(trees.parent)
    unary = np.bincount(trees.owner, model.unary[trees.feature], n)
    total, one, both = 0.0, np.zeros(n), np.zeros((n, 2, 2))
    for bits in range(1 << n):
        y = np.array([bits >> i & 1 for i in range(n)])
        inner = np.flatnonzero(trees.parent >= 0)
        weight = np.exp(unary @ y + model.edge[trees.kind[inner], y[trees.parent[inner]], y[inner]].sum())
        total += weight
        one += weight * y
        both[inner, y[trees.parent[inner]], y[inner]] += weight
    assert np.allclose(content, one / total)
    inner = trees.parent >= 0
    assert np.allclose(pair[inner], both[inner] / total)


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/'>Home</a><li>News</ul></nav>"
    "<!-- <p>no</p> --><div class=ad>Buy this now.</div><article><h1>A &amp; B</h1><p>First  line\n goes&nbsp;on <b>here<br>and</b> ends.<p>Second &eacute;"
    "<script>var a='</p>';</script> part &copy 5 &lt;tag&gt;.</p><ul><li>Item one is here.<li>Item two.</ul></article>"
    "<div id='comments'><p>Nice text, I liked it.</p></div><form><label>Name</label></form><footer>&copy; me</foo"
)


def test_pages(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (4, "w", "<p>"), (5, "x", "<p <p"), (6, "y", "plain text only, nothing else, but a full sentence.")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    found = html_content.extract(df).collect()
    assert [r.asDict().keys() for r in found][0] == {"page_id", "url", "text", "n_chars"}
    expected = "A & B\nFirst line goes on here and ends.\nSecond é part © 5 <tag>.\nItem one is here.\nItem two."
    texts = {r.page_id: r.text for r in found}
    assert texts[1] == expected and sum(r.page_id == 1 for r in found) == 2
    assert texts[2] == texts[None] == texts[4] == texts[5] == ""
    assert all(r.n_chars == len(r.text) for r in found)
    assert html_content.extract(df.limit(0)).count() == 0


def test_page_model_on_pages_it_has_not_seen():
    from tablelift.llm.html_pages import MARK, labelled_pages
    from tablelift.llm.html_tree import read_page

    pages = labelled_pages(120, seed=99)
    found = html_content.texts_of([p.replace(MARK, "") for p in pages], html_content.trained())
    expected = ["\n".join(t.replace(MARK, "") for t in read_page(p).text if MARK in t) for p in pages]
    assert sum(a == b for a, b in zip(found, expected, strict=True)) >= 114
