"""Shared text helpers, suffix arrays, packing and the licence automaton against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tablelift.llm import common, licences, packing
from tablelift.llm.suffix_groups import suffix_arrays

TEXTS = ["", None, " a  b\tA\x0bz ", "É ß\x00x", "one", "  ", "x" * 3000 + " y", "a b c d e a b"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def test_words_are_cut_and_hashed_by_content():
    words = common.Words(pa.array(TEXTS))
    raw = words.data.tobytes()
    found = [raw[a:b].decode().translate(LOWER) for a, b in zip(words.start, words.end, strict=True)]
    assert found == [w for t in TEXTS for w in WORD.findall((t or "").translate(LOWER))]
    assert words.counts.tolist() == [len(WORD.findall(t or "")) for t in TEXTS]
    by_hash = {}
    for word, value in zip(found, words.hash.tolist(), strict=True):
        assert by_hash.setdefault(word, value) == value
    assert len(set(by_hash.values())) == len(by_hash)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_shingles(n):
    grams, bounds = common.shingles(common.Words(pa.array(TEXTS)), n)
    named = {}
    for i, text in enumerate(TEXTS):
        words = WORD.findall((text or "").translate(LOWER))
        runs = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)] or ([tuple(words)] if words else [])
        assert bounds[i + 1] - bounds[i] == len(runs)
        for run, value in zip(runs, grams[bounds[i] : bounds[i + 1]].tolist(), strict=True):
            assert named.setdefault(run, value) == value
    assert len(set(named.values())) == len(named)


def test_slices_keep_all_rows():
    batch = pa.record_batch({"text": pa.array(["a" * k for k in range(50)] + [None, "b" * 500])})
    parts = list(common.slices(iter([batch, batch.slice(3, 4), batch.slice(0, 0)]), "text", 100))
    assert sum(p.num_rows for p in parts) == batch.num_rows + 4
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 100 for p in parts)


@pytest.mark.parametrize("seed", range(60))
def test_suffix_arrays_of_many_texts(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(rng.randint(1, 12)):
        text = bytes(rng.randint(0, rng.choice([0, 1, 2, 25])) for _ in range(rng.randint(0, 40)))
        texts.append(text * rng.randint(1, 4) if rng.random() < 0.3 else text)
    bounds = np.cumsum([0] + [len(t) for t in texts])
    order = suffix_arrays(np.frombuffer(b"".join(texts), np.uint8), bounds)
    for i, text in enumerate(texts):
        assert (order[bounds[i] : bounds[i + 1]] - bounds[i]).tolist() == sorted(range(len(text)), key=lambda k: text[k:])


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_decreasing(seed):
    rng = random.Random(seed)
    length = rng.choice([1, 8, 64, 100])
    sizes = [rng.randint(1, length) for _ in range(rng.randint(0, 300))]
    rows = packing.best_fit(sizes, length)
    assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
    bins = []
    for size in sorted(sizes, reverse=True):
        fitting = [(free, k) for k, free in enumerate(bins) if free >= size]
        if fitting:
            bins[min(fitting)[1]] -= size
        else:
            bins.append(length - size)
    assert sorted(length - sum(sizes[i] for i in r) for r in rows) == sorted(bins)


def base_places(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER).encode())
    places = []
    for phrase, label in licences.PHRASES:
        parts = phrase.encode().split()
        places += [(i, label) for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
    return len(words), places


def test_licence_places_and_spans():
    mit = licences.TEMPLATES[0][1]
    texts = [
        None, "", "cc by cc by nc MIT license mit License. apache\nlicense", "gnu gnu general public-license gnu general public license",
        f"x {mit} y {mit}", mit.replace("obtaining", "getting"), " ".join(mit.split()[:20]), "the of and software " * 50, "İ ß cc by",
    ]
    rng = random.Random(3)
    vocabulary = sorted({w for t, _ in licences.PHRASES for w in t.split()} | {"x", "software"})
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    auto = licences.build(licences.TEMPLATES, licences.PHRASES)
    rows = licences.scan_texts(auto, pa.array(texts), licences.TEMPLATES, licences.PHRASES)
    for text, row in zip(texts, rows, strict=True):
        count, places = base_places(text)
        starts = [p for p, _ in places]
        assert row[:5] == (count, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))
        assert set(filter(None, row[4].split(","))) <= set(filter(None, row[5].split(","))) and 0 <= row[6] <= 1
    words = len(licences.word_list(mit))
    assert rows[4][5:] == ("mit", 1.0, [f"mit:1-{words}:1.0", f"mit:{words + 2}-{2 * words + 1}:1.0"])
    assert rows[5][5] == "mit" and 0.9 < rows[5][6] < 1.0
    assert rows[6][5] == ""


def test_matching_statistics_against_all_substrings():
    templates = (("t", "a b a c a b d"), ("u", "b a b a"))
    auto = licences.build(templates, (("z z", "z"),))
    held = [licences.word_list(t) for _, t in templates] + [["z", "z"]]
    code = {w: int(np.searchsorted(auto.vocabulary, common.Words(pa.array([w]), licences.SEPARATORS).hash[0])) for w in "abcdz"}
    rng = random.Random(1)
    for _ in range(50):
        words = [rng.choice("abcdz") for _ in range(30)]
        _, matches = licences.stream(auto, [code[w] for w in words], 0)
        maximal = set()
        for end in range(len(words)):
            for start in range(end + 1):
                run = words[start : end + 1]
                inside = [any(h[i : i + len(r)] == r for h in held for i in range(len(h))) for r in (run, words[start : end + 2], words[max(start - 1, 0) : end + 1])]
                if inside[0] and len(run) >= licences.MIN_MATCH and (end + 1 == len(words) or not inside[1]) and (start == 0 or not inside[2]):
                    maximal.add((start, end))
        assert {(m.start, m.end) for m in matches} == maximal
        assert all(held[m.template][m.at : m.at + m.end - m.start + 1] == words[m.start : m.end + 1] for m in matches)


def test_pages_with_thousands_of_open_elements_are_read():
    from tablelift.llm.html_tree import read_page

    page = read_page("<html><html><body><body>" + "<div><span><ul><li>" * 3000 + "deep" + "</div>" * 4000 + "<p>end")
    assert [t for t in page.text if t] == ["deep", "end"]
    assert page.parent[-1] == page.parent[-2] == 1 or page.tag[page.parent[-1]] >= 0
