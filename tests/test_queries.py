"""Every registered query against its SQL twin over whole tables."""

import pytest

import __spark_entry__ as entry
import check_oracles
from tablelift.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"

# queries with a path of their own for large inputs
SCALED = [
    "collect_per_group", "collect_copies", "duplicate_lists", "redirect_children", "delete_losers",
    "dedup_hierarchy", "field_refs_missing", "expr_targets_missing", "lineage_check", "implied_closure",
    "missing_class_counts", "delete_orphans", "update_from", "update_chain", "remap_bridge", "child_lists",
    "gapless_sequence", "gapless_sequence_hot", "previous_row", "hash_chain", "surrogate_keys", "renumber_run",
    "append_mapped", "insert_ignore", "merge_namespace", "ensure_dimension", "dedup_hierarchy_deep", "rename_from_table",
    "lineage_doubled", "validate_views", "run_report",
]


@pytest.fixture(scope="module")
def con():
    return check_oracles.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert check_oracles.compare(spark, con, SF, name) == ""


@pytest.mark.parametrize("name", SCALED)
def test_query_split(spark, con, name):
    settings = {**check_oracles.SPLIT, "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert check_oracles.compare(spark, con, SF, name) == ""
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["class", "n"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
