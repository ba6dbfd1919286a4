"""Size checks, hot-key splitting and lineage cuts shared by the operators.

Three rules hold everywhere in the package:

* one task never receives an unbounded group: groups are counted first, and
  those above the limit are cut into ranges or salted;
* a side is broadcast only after its rows have been counted;
* what is looked at several times is written once first, so a chain of joins
  never runs its source again;
* loops cut their lineage with a table written below ``spark.checkpoint.dir``,
  so a lost executor costs one stage and not the whole history.

The limits are session settings (``spark.tablelift.*``), which lets the tests
force the large-data paths on small tables.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIB = 1 << 20
UNKNOWN_SIZE = 1 << 60  # Spark's default for relations without statistics lies above this


@dataclass(frozen=True)
class Limits:
    """What one task, one list and one broadcast may hold."""

    small_input: int = 256 * MIB  # bytes read; above this a side is not counted for a broadcast
    join_input: int = 2048 * MIB  # bytes read; below this no join key needs splitting
    group_rows: int = 5_000_000  # rows of one group that one task may sort or chain
    hot_rows: int = 2_000_000  # rows of one join key that one task may receive
    broadcast_rows: int = 200_000  # rows of a counted broadcast side
    range_bytes: int = 128 * MIB  # input bytes per range partition

    @classmethod
    def of(cls, spark: SparkSession) -> Limits:
        names = {
            "small_input": "spark.tablelift.smallInputBytes",
            "join_input": "spark.tablelift.joinInputBytes",
            "group_rows": "spark.tablelift.groupRows",
            "hot_rows": "spark.tablelift.hotRows",
            "broadcast_rows": "spark.tablelift.broadcastRows",
            "range_bytes": "spark.tablelift.rangeBytes",
        }
        found = {field: spark.conf.get(key, None) for field, key in names.items()}
        return cls(**{field: int(value) for field, value in found.items() if value is not None})


def as_list(names: str | Sequence[str] | None) -> list[str]:
    """One name or several, as a list."""
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def input_bytes(df: DataFrame) -> int:
    """Bytes of all relations the plan reads, from Catalyst's statistics (nothing is run)."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        total += int(str(leaves.next().stats().sizeInBytes()))
    return total


def scratch_dir(spark: SparkSession) -> str:
    """This session's folder for intermediate tables, below the one the cluster names.

    The tables in it belong to the session: what a query returns may still read
    them, so they live until `release_scratch` or until the cluster clears the
    folder.  Only a session in one process may get a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tablelift-"))
        named = spark.sparkContext.getCheckpointDir()
    return f"{named.rstrip('/')}/tablelift-{spark.sparkContext.applicationId}"


def release_scratch(spark: SparkSession) -> None:
    """Delete this session's intermediate tables; DataFrames that still read them end here."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_table_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write `df` to the scratch folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = new_table_path(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_counted(
    df: DataFrame, label: str, counts: Mapping[str, Column]
) -> tuple[DataFrame, dict[str, int]]:
    """`materialise`, with rows counted per predicate in the same pass."""
    seen = Observation()
    metrics = [F.count_if(predicate).alias(name) for name, predicate in counts.items()]
    written = materialise(df.observe(seen, *metrics), label)
    return written, dict(seen.get)


def is_stored(df: DataFrame) -> bool:
    """Does the plan only read, filter and rename stored or driver-held rows?"""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.children().size() == 1 and node.nodeName() in ("Project", "Filter"):
        node = node.children().head()
    return node.children().isEmpty()


def once(df: DataFrame, label: str = "once") -> DataFrame:
    """`df`, written first unless it is stored already: for inputs that several jobs look at."""
    return df if is_stored(df) else materialise(df, label)


def range_partitions(df: DataFrame) -> int:
    """How many range partitions keep each of them near `range_bytes`."""
    spark = df.sparkSession
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = input_bytes(df)
    return configured if size >= UNKNOWN_SIZE else max(configured, -(-size // Limits.of(spark).range_bytes))


def checked_broadcast(df: DataFrame) -> DataFrame:
    """Hint a broadcast if, and only if, a bounded count shows it is small.

    Rows and estimated bytes must both fit; `df` should be stored, as it is counted first.
    """
    limits = Limits.of(df.sparkSession)
    if input_bytes(df) > limits.small_input:
        return df
    if df.limit(limits.broadcast_rows + 1).count() > limits.broadcast_rows:
        return df
    return F.broadcast(df)


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few driver-held rows as a local relation, whose size Catalyst knows."""
    columns = [pa.array([row[i] for row in rows]) for i in range(len(schema.fields))]
    table = pa.Table.from_arrays(columns, names=schema.names)
    df = spark.createDataFrame(table)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def listed_frame(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A driver-held list as a DataFrame, hinted for a broadcast while it is short."""
    rows = list(rows)
    df = local_frame(spark, rows, T.StructType.fromDDL(schema))
    return F.broadcast(df) if len(rows) <= Limits.of(spark).broadcast_rows else df


def largest_group(df: DataFrame, part: str | Sequence[str]) -> int:
    """Rows of the biggest group; partial aggregation keeps the shuffle to one row per key."""
    names = as_list(part)
    counted = df.groupBy(*names).count() if names else df.agg(F.count(F.lit(1)).alias("count"))
    return counted.agg(F.max("count")).first()[0] or 0


def groups_fit(df: DataFrame, part: str | Sequence[str]) -> bool:
    """True when every group, as counted, is small enough for one task.

    No group is larger than the table: where stored rows are that few, counting
    them all, without a shuffle, tells enough.
    """
    most = Limits.of(df.sparkSession).group_rows
    return (is_stored(df) and df.count() <= most) or largest_group(df, part) <= most


def _comparable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_comparable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def orderable(df: DataFrame) -> list[str]:
    """Columns that can be hashed and compared: no map or variant at any depth."""
    return [f.name for f in df.schema.fields if _comparable(f.dataType)]


def _is_hot(keys: list[str]) -> Column:
    condition = F.lit(True)
    for i, key in enumerate(keys):
        condition = condition & F.col(key).eqNullSafe(F.col(f"__hot_{i}"))
    return condition


def hot_keys(df: DataFrame, on: str | Sequence[str]) -> DataFrame | None:
    """Every join key above the limit, with the number of tasks it should be spread over.

    The list is a table; it is broadcast only when its rows fit one.
    """
    keys = as_list(on)
    limits = Limits.of(df.sparkSession)
    heavy = df.groupBy(*keys).count().where(F.col("count") > limits.hot_rows)
    fan = F.ceil(F.col("count") / limits.hot_rows).cast("long").alias("__fan")
    renamed = heavy.select(*[F.col(k).alias(f"__hot_{i}") for i, k in enumerate(keys)], fan)
    found, seen = materialise_counted(renamed, "hot", {"keys": F.lit(True)})
    if not seen["keys"]:
        return None
    return F.broadcast(found) if seen["keys"] <= max(limits.broadcast_rows, 1) else found


def lookup_join(fact: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join a large table to a lookup when one key may hold a third of its rows.

    `how` is inner, left, left_semi or left_anti.  Small inputs, and lookups
    whose counted rows fit a broadcast, are joined as they are.  Otherwise the
    rows of each hot key (NULL included) are spread over several salts, and
    only that key's lookup rows are repeated once per salt.  Both sides are
    written before they are counted, unless they are stored tables: each source
    is run once, however many joins follow one another.  The salt is a hash
    of the row and of its input partition: copies of one row spread out too, and
    a retried task sends each row to the same place.
    """
    keys = as_list(on)
    if input_bytes(fact) <= Limits.of(fact.sparkSession).join_input:
        return fact.join(lookup, keys, how)
    lookup = once(lookup, "lookup")
    hinted = checked_broadcast(lookup)
    if hinted is not lookup:
        return fact.join(hinted, keys, how)
    fact = once(fact, "fact")
    hot = hot_keys(fact, keys)
    if hot is None:
        return fact.join(lookup, keys, how)
    row_hash = F.xxhash64(*orderable(fact), F.spark_partition_id())
    salted = (
        fact.join(hot, _is_hot(keys), "left")
        .withColumn("__salt", F.coalesce(F.pmod(row_hash, F.col("__fan")), F.lit(0)))
        .select(*fact.columns, "__salt")
    )
    repeated = (
        lookup.join(hot, _is_hot(keys), "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__fan") - 1, F.lit(0)))))
        .select(*lookup.columns, F.col("__salt").cast("long").alias("__salt"))
    )
    return salted.join(repeated, [*keys, "__salt"], how).drop("__salt")
