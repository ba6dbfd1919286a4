"""The pipeline stage by stage against brute force, its registration, and life without this package."""

import re
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tablelift.llm import mixing, packing, queries
from tests.llm.test_operators import groups_of, shingle_set

ROOT = Path(__file__).resolve().parent.parent.parent
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(input rows, output rows) of every stage, each written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        found[name] = (docs.collect(), out.collect(), out.columns)
        docs = out
    return found


def test_stages_in_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "packing"]
    for name in list(stages)[:-1]:
        assert sorted(stages[name][2]) == ["doc_id", "lang", "n_chars", "source", "text"]


def test_quality_keeps_clean_documents(spark, stages):
    before, after, _ = stages["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    assert kept <= {r.doc_id for r in before}
    good, bad = ([i for i, q in labels.items() if q == mark] for mark in (1, 0))
    assert sum(i in kept for i in good) >= 0.98 * len(good)
    assert sum(i not in kept for i in bad) >= 0.7 * len(bad)  # 87 labels in this table


def test_one_document_of_each_group_stays(stages):
    before, after, _ = stages["near_duplicates"]
    root = groups_of({r.doc_id: shingle_set(r.text, 5) for r in before}, 80)
    assert sorted(r.doc_id for r in after) == sorted(i for i, r in root.items() if i == r)


def test_contaminated_documents_go(spark, stages):
    before, after, _ = stages["decontamination"]
    items = [shingle_set(r.text, 5) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = []
    for row in before:
        runs = shingle_set(row.text, 5)
        if not any(100 * len(runs & item) >= 80 * len(item) for item in items if item):
            clean.append(row.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(clean)


def test_the_mix_repeats_whole_documents(stages):
    before, after, _ = stages["mixing"]
    rows = {r.doc_id: r for r in before}
    copies = Counter(r.doc_id for r in after)
    assert max(copies.values()) <= 2 and all(tuple(rows[r.doc_id]) == tuple(r) for r in after)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for i, r in rows.items()}
    taken = sum(size[i] * n for i, n in copies.items())
    largest = max(size.values())
    assert abs(taken - 1.5 * sum(size.values())) <= largest * len({r.source for r in before})


def test_packed_rows_hold_every_document(spark, stages):
    before, after, _ = stages["packing"]
    encoding, end = packing.encoder(Path(packing.VOCABULARY).read_bytes())
    expected = sum(len(encoding.encode_ordinary(r.text or "")) + 1 for r in before)
    assert sum(r.n_tokens for r in after) == expected
    assert all(r.n_tokens <= packing.LENGTH and len(r.ids) == 2 * packing.LENGTH for r in after)


def test_run_returns_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sum(r.n_tokens for r in rows) == sum(r.n_tokens for r in stages["packing"][1])


def test_registration():
    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names
    assert set(queries.ORACLES) == {"op2_decontamination", "op10_mixing", "op11_hard_negatives", "op12_lexical", "op13_url_filter"}
    assert entry.oracle_sql()["op10_mixing"] == mixing.ORACLE


def test_the_library_lives_without_this_package(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", ".git", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; assert len(e.queries()) > 100 and not [n for n in e.queries() if n.startswith('op') or n == 'pipeline']"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True)


def test_errors_inside_the_package_are_not_hidden(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__"))
    (copy / "tablelift" / "llm" / "mixing.py").write_text("import no_such_library\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, capture_output=True, text=True)
    assert done.returncode and "no_such_library" in done.stderr
