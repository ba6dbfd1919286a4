"""Change lists per version: what became obsolete, moved into the core or was renamed."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.scale import listed_frame

SCHEMA = "version int, kind string, ord int, old string, new string"
KINDS = ("obsolete", "merged", "renamed")


def change_lists(spark: SparkSession, lists: Mapping[int, Mapping[str, list]]) -> DataFrame:
    """Hand-written lists as rows.

    ``{18: {"obsolete": ["a"], "merged": ["b"], "renamed": [("c", "d")]}}``;
    `ord` keeps the position within a list, so that a later entry can win.
    """
    rows = []
    for version, kinds in lists.items():
        for kind in KINDS:
            for position, entry in enumerate(kinds.get(kind) or []):
                old, new = entry if kind == "renamed" else (entry, None)
                rows.append((int(version), kind, position, old, new))
    return listed_frame(spark, rows, SCHEMA)


def read_change_files(folder: str, origin: int, final: int, name: str = "known_changes.yaml") -> dict[int, dict]:
    """The lists of ``<folder>/<version>.0/<name>`` for the versions after `origin` up to `final`.

    A version without a file has no changes.  The files list `obsolete`,
    `merged_in_core` and `renamed` (pairs of `old` and `new`).
    """
    try:
        import yaml
    except ImportError as error:
        raise ImportError("reading change files needs the yaml package; pass the lists instead") from error
    lists = {}
    for version in range(origin + 1, final + 1):
        path = Path(folder) / f"{version}.0" / name
        if not path.is_file():
            continue
        found = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
        lists[version] = {
            "obsolete": [entry for entry in found.get("obsolete") or [] if entry],
            "merged": [entry for entry in found.get("merged_in_core") or [] if entry],
            "renamed": [(entry.get("old"), entry.get("new")) for entry in found.get("renamed") or []],
        }
    return lists


def _named(column: str) -> Column:
    """Neither NULL, empty nor the text "null"."""
    return F.coalesce(~F.col(column).isin("", "null"), F.lit(False))


def _between(changes: DataFrame, origin: int, final: int) -> DataFrame:
    return changes.where((F.col("version") > origin) & (F.col("version") <= final))


def change_catalog(changes: DataFrame, origin: int, final: int) -> DataFrame:
    """One row per (kind, old) for the versions after `origin` up to `final`.

    The latest version's `new` wins for a name renamed twice.  Renames without
    a new name are left out here; `invalid_changes` lists them.
    """
    renamed = F.col("kind") == "renamed"
    return (
        _between(changes, origin, final)
        .where(_named("old") & (~renamed | _named("new")))
        .groupBy("kind", "old")
        .agg(F.max_by("new", F.struct("version", "ord")).alias("new"))
    )


def invalid_changes(changes: DataFrame, origin: int, final: int) -> DataFrame:
    """Rename entries of the traversed versions that name no target."""
    return _between(changes, origin, final).where(
        (F.col("kind") == "renamed") & _named("old") & ~_named("new")
    )
