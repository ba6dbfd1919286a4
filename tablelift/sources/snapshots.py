"""Tables on disk: Parquet tables in folders that are written once, and a marker per version."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.scale import listed_frame, local_frame, orderable

COMPLETE = "complete"
MARKER_SCHEMA = "name string, folder string, part string, print string, schema string"


class Entry(NamedTuple):
    """A table in the store, or one part of it: its folder and, for parts, value, fingerprint and the table's schema."""

    folder: str
    part: str | None = None
    print: str | None = None
    schema: str | None = None


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of a snapshot folder, also registered as a view of that name."""
    df = spark.read.parquet(f"{root}/{name}")
    df.createOrReplaceTempView(name)
    return df


def read_declared(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read with declared names and types; Catalyst prunes what is not used."""
    return spark.read.schema(schema).parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, schema: str, **options: str) -> DataFrame:
    """A table of a live database with declared types; filters reach the database.

    Pass `partitionColumn`, `lowerBound`, `upperBound` and `numPartitions` to
    read a large table in parallel.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    return reader.option("customSchema", schema).options(**options).load()


def run_sql(spark: SparkSession, text: str) -> DataFrame | None:
    """Run one SQL text over the registered views; an empty text does nothing."""
    if not text.strip():
        return None
    try:
        return spark.sql(text)
    except Exception as error:
        error.add_note(f"failed query: {text}")
        raise


class SnapshotStore:
    """A chain of snapshots below one folder, each finished by a marker.

    Every attempt writes to a folder of its own, ``<root>/data/<version>-<attempt>/<table>``, and
    nothing in it is ever overwritten; the marker ``<root>/<version>/complete`` lists the tables
    with the folder that holds them.  So a table no step has touched is not
    copied, a run may read the snapshot it is about to replace, and a version
    never mixes files of two runs.  A version counts as present only once its
    marker is written: a run that dies half-way cannot be resumed from it.

    ``parted`` names tables that are kept in parts, with the column or
    expression whose values divide them (a company, a month, a range of ids;
    there is a folder per value).  Of these only the parts that a version has
    changed are written, the marker names the others where they are.
    """

    def __init__(self, spark: SparkSession, root: str, parted: Mapping[str, str | Column] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.parted = {name: F.col(by) if isinstance(by, str) else by for name, by in (parted or {}).items()}

    def _marker(self, version: int) -> str:
        return f"{self.root}/{version}/{COMPLETE}"

    def _mark(self, version: int, written: Mapping[str, Sequence[Entry]]) -> None:
        rows = [(name, *entry) for name, entries in sorted(written.items()) for entry in entries]
        marker = local_frame(self.spark, rows, T.StructType.fromDDL(MARKER_SCHEMA))
        marker.coalesce(1).write.mode("overwrite").parquet(self._marker(version))

    def entries(self, version: int) -> dict[str, list[Entry]]:
        """Where each table of a version lies, part by part, below the root; empty if there is no complete snapshot.

        Only a missing marker means that; one that cannot be read is an error.
        """
        try:
            rows = self.spark.read.schema(MARKER_SCHEMA).parquet(self._marker(version)).collect()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return {}
            raise
        found: dict[str, list[Entry]] = {}
        for row in rows:
            found.setdefault(row.name, []).append(Entry(*row[1:]))
        return found

    def folders(self, version: int) -> dict[str, str]:
        """Where each table of a version lies; of a table in parts, where its latest part does."""
        return {name: max((e.folder for e in held), key=_version_of) for name, held in self.entries(version).items()}

    def manifest(self, version: int) -> dict[str, int]:
        """Which version wrote each table."""
        return {name: _version_of(folder) for name, folder in self.folders(version).items()}

    def parts(self, version: int, name: str) -> dict[str | None, int]:
        """Which version wrote each part of a table."""
        return {e.part: _version_of(e.folder) for e in self.entries(version).get(name, [])}

    def exists(self, version: int) -> bool:
        return bool(self.entries(version))

    def versions(self) -> list[int]:
        """All versions that have a marker, complete or withdrawn."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        names = [entry.getPath().getName() for entry in files.listStatus(path)]
        return sorted(int(name) for name in names if name.isdigit())

    def invalidate(self, version: int) -> None:
        """Forget a snapshot, so that nobody resumes from an earlier run's leftovers."""
        if self.exists(version):
            self._mark(version, {})

    def write(
        self, version: int, tables: Mapping[str, DataFrame], unchanged: Mapping[str, Sequence[Entry]] | None = None,
        base: Mapping[str, Sequence[Entry]] | None = None,
    ) -> dict[str, DataFrame]:
        """Write the changed tables to a new folder, then the marker; returns all tables as read back.

        ``unchanged`` has the entries of tables that are taken over as they are, ``base`` those of
        the version before, from which a table in parts takes over what has not changed.
        """
        unchanged, base = dict(unchanged or {}), dict(base or {})
        attempt = f"data/{version}-{uuid.uuid4().hex[:12]}"
        result, written = {}, {}
        for name, df in tables.items():
            if name in unchanged:
                result[name], written[name] = df, list(unchanged[name])
                continue
            folder = f"{attempt}/{name}"
            written[name] = self._write_parts(df, self.parted[name], folder, base.get(name, [])) if name in self.parted else []
            if not written[name]:
                df.write.mode("errorifexists").parquet(f"{self.root}/{folder}")
                written[name] = [Entry(folder)]
            result[name] = self._load(written[name], df.schema)
        self._mark(version, written)
        return result

    def _write_parts(self, df: DataFrame, by: Column, folder: str, base: Sequence[Entry]) -> list[Entry]:
        """Write the parts that differ from `base`; the entries of all parts, none for a table without rows.

        A part's fingerprint is its number of rows and two sums of row hashes,
        so the table is computed twice, and only what changed is written.  A
        table whose schema differs from `base`, or with columns that cannot be
        hashed, is written whole.
        """
        schema, hashed = df.schema.simpleString(), orderable(df)
        placed = df.withColumn("__part", F.coalesce(by.cast("string"), F.lit("")))
        placed = placed.withColumn("__part", F.when(by.isNotNull(), F.concat(F.lit("="), "__part")).otherwise("null"))
        sums = [F.sum(F.xxhash64(*hashed, F.lit(seed)).cast("decimal(20,0)")).cast("string") for seed in (1, 2)]
        prints = placed.groupBy("__part").agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums).alias("print"))
        now = {row[0]: row[1] for row in prints.collect()}  # one row per folder
        same = len(hashed) == len(df.columns)
        kept = [e for e in base if same and e.part in now and e.schema == schema and e.print == now[e.part]]
        fresh = sorted(now.keys() - {e.part for e in kept})
        if fresh:
            numbers = listed_frame(self.spark, list(zip(fresh, range(len(fresh)), strict=True)), "__part string, __number int")
            chosen = placed.join(numbers, "__part").drop("__part")
            chosen.write.mode("errorifexists").partitionBy("__number").parquet(f"{self.root}/{folder}")
        return kept + [Entry(f"{folder}/__number={n}", part, now[part], schema) for n, part in enumerate(fresh)]

    def _load(self, entries: Sequence[Entry], schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*[f"{self.root}/{e.folder}" for e in entries])

    def read(self, version: int) -> dict[str, DataFrame]:
        entries = self.entries(version)
        if not entries:
            raise FileNotFoundError(f"no complete snapshot of version {version} below {self.root}")
        return {name: self._load(held) for name, held in entries.items()}

    def prune(self) -> list[str]:
        """Delete the folders that no marker names, left by withdrawn or broken attempts; returns them.

        Tables read from withdrawn snapshots end here, and no other run may be
        writing to the store meanwhile.
        """
        named = {e.folder.split("/")[1] for v in self.versions() for held in self.entries(v).values() for e in held}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/data")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        lost = sorted(entry.getPath().getName() for entry in files.listStatus(path) if entry.getPath().getName() not in named)
        for name in lost:
            files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(path, name), True)
        return lost


def _version_of(folder: str) -> int:
    return int(folder.split("/")[1].split("-")[0])
