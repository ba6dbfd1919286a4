"""A run through consecutive versions, one snapshot per version."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablelift.scale import local_frame, materialise_counted, once
from tablelift.sources.snapshots import SnapshotStore

Tables = dict[str, DataFrame]
Step = Callable[[Tables], Tables]


@dataclass(frozen=True)
class Stage:
    """The steps of one version, around whatever upgrade runs in between."""

    before: Sequence[Step] = ()
    after: Sequence[Step] = ()


def version_path(origin: int, final: int, resume_from: int | str | None = None) -> list[int]:
    """The versions to go through; a checkpoint lies strictly between origin and final."""
    if resume_from is None:
        return list(range(origin + 1, final + 1))
    text = str(resume_from)
    if not (text.isascii() and text.isdigit()):
        raise ValueError(f"checkpoint must be a version number, got {resume_from!r}")
    checkpoint = int(text)
    if checkpoint <= origin:
        raise ValueError(f"checkpoint {checkpoint} must be greater than the origin {origin}")
    if checkpoint >= final:
        raise ValueError(f"checkpoint {checkpoint} must be less than the final version {final}")
    return list(range(checkpoint + 1, final + 1))


REPORT = "report."


def with_report(tables: Tables, name: str, df: DataFrame) -> Tables:
    """The tables and one more report; it is written with the next snapshot and travels on with it."""
    return {**tables, f"{REPORT}{name}": df}


def reports(tables: Mapping[str, DataFrame]) -> Tables:
    """What the run has reported so far, by name."""
    return {name.removeprefix(REPORT): df for name, df in tables.items() if name.startswith(REPORT)}


def counted(name: str, table: str, step: Step, **predicates: Column) -> Step:
    """A step that reports what it did to a table: rows before and after, and rows after per predicate.

    The step runs once: its result is written and counted in one pass, and the
    rows before are those of a stored table (written first if it is none).
    """

    def run(tables: Tables) -> Tables:
        if table not in tables:
            return step(tables)
        entering = once(tables[table], "counted")
        done = step({**tables, table: entering})
        left, seen = materialise_counted(done[table], "counted", {"rows_after": F.lit(True), **predicates})
        if done[table] is not entering:
            done = {**done, table: left}
        facts = {"rows_before": entering.count(), **{n: seen[n] for n in ("rows_after", *predicates)}}
        schema = StructType.fromDDL(", ".join(["`table` string", *[f"`{n}` long" for n in facts]]))
        return with_report(done, name, local_frame(entering.sparkSession, [(table, *facts.values())], schema))

    return run


def _apply(tables: Tables, steps: Sequence[Step]) -> Tables:
    for step in steps:
        tables = step(dict(tables))
    return tables


def run_path(
    store: SnapshotStore,
    source: Mapping[str, DataFrame] | None,
    origin: int,
    final: int,
    stages: Mapping[int, Stage],
    *,
    extras: Mapping[int, Stage] | None = None,
    prepare: Sequence[Step] = (),
    upgrade: Callable[[int, Tables], Tables] | None = None,
    finish: Sequence[Step] = (),
    resume_from: int | str | None = None,
    prune: bool = False,
) -> Tables:
    """Run every stage from origin to final and return the last snapshot's tables.

    Per version: the stage's `before`, the site's own `extras` before, the
    `upgrade` callable, `after`, and the extras' `after`.  Each version is
    written before the next one starts, which ends its lineage and makes it a
    restart point.  All snapshots after the starting point are withdrawn first,
    so that no version left over from an earlier run can be mistaken for this
    run's; files are never overwritten, so the source may come from this store.  ``prepare`` runs on a fresh start only; ``finish`` runs on
    the final version and is written with it.  ``prune`` deletes what earlier runs have left, once
    this one is complete.
    """
    versions = version_path(origin, final, resume_from)
    extras = extras or {}
    if resume_from is None:
        if source is None:
            raise ValueError("a fresh run needs source tables")
        withdraw(store, origin)
        tables = store.write(origin, _apply(dict(source), prepare))
        entries = store.entries(origin)
    else:
        tables = store.read(int(resume_from))
        entries = store.entries(int(resume_from))
        withdraw(store, int(resume_from) + 1)

    for version in versions:
        stage, extra = stages.get(version, Stage()), extras.get(version, Stage())
        result = _apply(tables, [*stage.before, *extra.before])
        if upgrade is not None:
            result = upgrade(version, result)
        result = _apply(result, [*stage.after, *extra.after])
        if version == final:
            result = _apply(result, finish)
        unchanged = {name: entries[name] for name, df in result.items() if df is tables.get(name)}
        tables = store.write(version, result, unchanged, entries)
        entries = store.entries(version)
    if prune:
        store.prune()
    return tables


def withdraw(store: SnapshotStore, first: int) -> None:
    """Withdraw every snapshot from `first` on, also those beyond the end of this run: they belong to another."""
    for version in store.versions():
        if version >= first:
            store.invalidate(version)
