"""Numbering, predecessor links, hash chains and ordered reads.

Ordered work per group is where one big group hurts.  Groups are counted first;
as long as each fits one task a window does the job.  Otherwise the rows are
range-partitioned by (group, order), written once, and numbered from their
place in the written ranges plus the row counts of the ranges before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions import is_true
from tablelift.scale import (
    Limits,
    as_list,
    groups_fit,
    input_bytes,
    largest_group,
    lookup_join,
    materialise,
    new_table_path,
    once,
    range_partitions,
)

Order = Sequence[Column | str]


def _columns(order: Order | Column | str) -> list[Column]:
    if isinstance(order, (str, Column)):
        order = [order]
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _ranged(df: DataFrame, part: list[str], order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Written rows with their range and slot, and one head row per (group, range)."""
    keys = [F.col(p) for p in part] + order
    placed = (
        df.repartitionByRange(range_partitions(df), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("__slot", F.monotonically_increasing_id())
    )
    fixed = materialise(placed, "ranges").withColumn("__range", F.shiftright("__slot", 33))
    heads = fixed.groupBy(*part, "__range").agg(
        F.min("__slot").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    return fixed, heads


def _ranges_of(part: list[str]) -> Window:
    """The ranges of one group in order; a group has no more of them than there are partitions."""
    return Window.partitionBy(*[F.col(p) for p in part]).orderBy("__range")


def _same_group(part: list[str], prefix: str) -> Column:
    """Null-safe equality of the group columns with their renamed copies."""
    condition = F.lit(True)
    for i, p in enumerate(part):
        condition = condition & F.col(p).eqNullSafe(F.col(f"{prefix}{i}"))
    return condition


def _renamed(part: list[str], prefix: str) -> list[Column]:
    return [F.col(p).alias(f"{prefix}{i}") for i, p in enumerate(part)]


def number_rows(
    df: DataFrame,
    part: str | Sequence[str] | None,
    order: Order | Column | str,
    out: str,
    *,
    previous: str | None = None,
    row_id: str | None = None,
) -> DataFrame:
    """Number the rows of each group 1..n in a total order.

    `order` must be unique within a group (end it with an id).  With `previous`
    the column of that name gets the `row_id` of the row before.  Without
    `part` the whole table is one group.
    """
    part, order = as_list(part), _columns(order)
    columns_in = df.columns
    if input_bytes(df) > Limits.of(df.sparkSession).small_input:
        df = once(df, "numbering")  # it is counted, and then numbered
    if groups_fit(df, part):
        window = Window.partitionBy(*[F.col(p) for p in part]).orderBy(*order)
        columns = {out: F.row_number().over(window).cast("long")}
        if previous:
            columns[previous] = F.lag(row_id).over(window)
        return df.withColumns(columns)

    fixed, heads = _ranged(df, part, order)
    earlier = _ranges_of(part).rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
    keep = ["__first", "__before"]
    if previous:
        tails = fixed.groupBy(*part, "__range").agg(F.max_by(row_id, "__slot").alias("__tail"))
        tails = tails.withColumn("__tail_before", F.lag("__tail").over(_ranges_of(part))).select(
            *_renamed(part, "__tail_"), F.col("__range").alias("__tail_range"), "__tail_before"
        )
        same = (F.col("__range") == F.col("__tail_range")) & _same_group(part, "__tail_")
        heads = heads.join(tails, same)
        keep.append("__tail_before")
    heads = heads.select(*_renamed(part, "__head_"), F.col("__range").alias("__head_range"), *keep)
    same = (F.col("__range") == F.col("__head_range")) & _same_group(part, "__head_")
    numbered = fixed.join(heads, same).withColumn(
        out, F.col("__slot") - F.col("__first") + F.col("__before") + 1
    )
    columns = [*[c for c in columns_in if c not in (out, previous)], out]
    if previous:
        inside = Window.partitionBy("__range", *part).orderBy("__slot")
        numbered = numbered.withColumn(
            previous, F.coalesce(F.lag(row_id).over(inside), F.col("__tail_before"))
        )
        columns.append(previous)
    return numbered.select(*columns)


def gapless_sequence(
    df: DataFrame,
    part: str | Sequence[str],
    order: Order,
    out: str,
    where: Column | None = None,
    *,
    previous: str | None = None,
    row_id: str | None = None,
) -> DataFrame:
    """Renumber the qualifying rows 1..n per group; other rows keep what they had."""
    id_type = df.schema[row_id].dataType if row_id else T.LongType()
    held = df if out in df.columns else df.withColumn(out, F.lit(None).cast("long"))
    if previous and previous not in held.columns:
        held = held.withColumn(previous, F.lit(None).cast(id_type))
    if where is None:
        return number_rows(held, part, order, out, previous=previous, row_id=row_id).select(*held.columns)
    chosen = number_rows(held.where(where), part, order, out, previous=previous, row_id=row_id)
    rest = held.where(~is_true(where))
    return chosen.select(*held.columns).unionByName(rest)


def previous_row(df: DataFrame, part: str | Sequence[str], order: Order, row_id: str, out: str) -> DataFrame:
    """The id of the row before, in the order of each group."""
    numbered = number_rows(df, part, order, "__seq", previous=out, row_id=row_id)
    return numbered.drop("__seq")


def _group_starts(columns: list[pa.Array], rows: int) -> list[int]:
    """Positions at which any column differs from the row before, NULLs being equal."""
    changed = np.zeros(rows, dtype=bool)
    changed[:1] = True
    for column in columns:
        here, before = column.slice(1), column.slice(0, rows - 1)
        differs = pc.fill_null(pc.not_equal(here, before), False)
        one_null = pc.xor(here.is_null(), before.is_null())
        changed[1:] |= pc.or_(differs, one_null).to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed).tolist()


def _chainer(part: list[str], payload: str, carry: str | None) -> Callable:
    """Arrow batches of sorted rows in, the same batches plus one hash column out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, last = None, b""
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = [batch.column(p) for p in part]
            texts = batch.column(payload).cast(pa.binary()).to_pylist()
            starts = _group_starts(groups, batch.num_rows)
            hashes = []
            for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                group = tuple(column[start].as_py() for column in groups)
                if group != current:
                    begin = batch.column(carry)[start].as_py() if carry else None
                    current, last = group, (begin or "").encode()
                for text in texts[start:end]:
                    if text is None:
                        last = b""
                        hashes.append(None)
                    else:
                        last = hashlib.sha256(last + text).hexdigest().encode()
                        hashes.append(last)
            names = [n for n in batch.schema.names if n != carry]
            links = pa.array(hashes, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], links], [*names, "__hash"])

    return run


def _chain_sorted(df: DataFrame, part: list[str], order: list[Column], payload: str, carry: str | None) -> DataFrame:
    keys = [F.col(p) for p in part]
    fields = [f for f in df.schema.fields if f.name != carry]
    schema = T.StructType([*fields, T.StructField("__hash", T.StringType())])
    laid_out = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return laid_out.mapInArrow(_chainer(part, payload, carry), schema)


def hash_chain(
    df: DataFrame, part: str | Sequence[str], order: Order, payload: str, out: str = "hash"
) -> DataFrame:
    """``h = sha256(previous h || payload)`` in hex along each group.

    A NULL payload gets no hash, and the row after it starts from the empty
    text again.  Rows stream through in order with one hash kept per group.  A
    link needs the one before it, so a group larger than `group_rows` is cut
    into segments: round k chains the k-th segment of every group, is written,
    and hands its last hashes to round k+1.
    """
    part, order = as_list(part), _columns(order)
    base = df.drop(out)
    if groups_fit(base, part):
        return _chain_sorted(base, part, order, payload, None).withColumnRenamed("__hash", out)

    spark = df.sparkSession
    limit = Limits.of(spark).group_rows
    numbered = number_rows(base, part, order, "__seq")
    segmented = numbered.withColumn("__segment", F.floor((F.col("__seq") - 1) / limit).cast("int"))
    segmented = materialise(segmented, "segments", partition_by="__segment")
    rounds = -(-largest_group(segmented, part) // limit)
    root = new_table_path(spark, "chain")
    carry = None
    chained_schema = None
    for number in range(rounds):
        piece = segmented.where(F.col("__segment") == number).drop("__segment")
        if carry is None:
            piece = piece.withColumn("__carry", F.lit(None).cast("string"))
        else:
            piece = piece.join(carry, _same_group(part, "__part_"), "left")
            piece = piece.drop(*[f"__part_{i}" for i in range(len(part))])
        chained = _chain_sorted(piece, part, [F.col("__seq")], payload, "__carry")
        chained_schema = chained.schema
        chained.write.mode("errorifexists").parquet(f"{root}/round={number}")
        done = spark.read.schema(chained_schema).parquet(f"{root}/round={number}")
        last = done.where(F.col("__seq") == (number + 1) * limit)
        carry = last.select(*_renamed(part, "__part_"), F.col("__hash").alias("__carry"))
    whole = spark.read.schema(chained_schema).parquet(*[f"{root}/round={n}" for n in range(rounds)])
    return whole.drop("__seq").withColumnRenamed("__hash", out)


def chain_breaks(
    df: DataFrame, part: str | Sequence[str], order: Order, payload: str, row_id: str, hash_column: str = "hash"
) -> DataFrame:
    """Links that do not verify; all links are checked in parallel.

    A stored hash is compared with the one made from its predecessor's stored
    hash, so each check needs two neighbouring rows only.
    """
    linked = previous_row(df, part, order, hash_column, "__prev")
    expected = F.sha2(F.concat(F.coalesce(F.col("__prev"), F.lit("")), F.col(payload)).cast("binary"), 256)
    reason = (
        F.when(F.col(payload).isNull(), "no payload")
        .when(F.col(hash_column).isNull(), "no hash")
        .when(F.col(hash_column) != expected, "hash differs")
    )
    return linked.select(row_id, reason.alias("reason")).where("reason is not null")


def next_counter(
    df: DataFrame, part: str, counters: DataFrame, owner: str, value: str, where: Column | None = None
) -> DataFrame:
    """Set the counter of each group to its row count plus one.

    Counters of groups without rows stay as they are, and so do groups that
    have no counter.
    """
    rows = df if where is None else df.where(where)
    counted = rows.groupBy(F.col(part).alias(owner)).agg((F.count(F.lit(1)) + 1).alias("__next"))
    joined = counters.join(counted, [owner], "left")
    kept = F.coalesce(F.col("__next"), F.col(value)).cast(counters.schema[value].dataType)
    return joined.withColumn(value, kept).select(*counters.columns)


def surrogate_keys(rows: DataFrame, order: Order, out: str, after: DataFrame | None = None) -> DataFrame:
    """Consecutive new ids in the given order, starting after the largest id of `after`."""
    numbered = number_rows(rows, None, order, "__seq")
    start = F.lit(0).cast("long")
    if after is not None:
        start = F.coalesce(after.agg(F.max(out).cast("long").alias("m")).scalar(), start)
    return numbered.withColumn(out, F.col("__seq") + start).drop("__seq")


def collect_in_pieces(
    df: DataFrame, key: str | Sequence[str], value: str, out: str, tie: str | None = None, *, entries: int
) -> DataFrame:
    """The ordered values per key, as arrays of at most `entries` values.

    A key with more values gets several rows, numbered by `piece` from 0, so
    nothing is cut off and no array grows with the data; `n` is the size of the
    piece.  Values are distinct unless `tie` names a unique column, which then
    orders equal values.
    """
    keys = as_list(key)
    rows = df.select(*keys, value, tie) if tie else df.select(*keys, value).distinct()
    numbered = number_rows(rows, keys, [value, tie] if tie else [value], "__seq")
    pieces = numbered.withColumn("piece", F.floor((F.col("__seq") - 1) / entries))
    listed = F.array_sort(F.collect_list(F.struct(F.col("__seq"), F.col(value).alias("v"))))
    return pieces.groupBy(*keys, "piece").agg(
        F.transform(listed, lambda entry: entry["v"]).alias(out), F.count(F.lit(1)).alias("n")
    )
