"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

An item is found in a document that holds at least `percent` of the item's distinct runs of `n`
words (both sets hashed alike).  Jaccard similarity says nothing here, since a document may be a
thousand times longer than the item; so items are partitioned by size (powers of two), and the
signature of an item is its bottom-k MinHash values with k = size - need + 1, where `need` is the
number of runs that must be shared.  A document that shares `need` runs must hold one of those k
values: the search has no false negatives, whatever the document's length.

Signatures go to the tasks as a table of MASKS entries, one bit per size class: its size is fixed,
however many items there are (more items only let more through).  In one pass over the documents a
document is a candidate of the classes whose need does not exceed its own size and of which it holds a
signature value; of candidates, the runs that may belong to items are kept.  These are joined to
the items' runs, and counting them per (document, item) is the exact containment.

Defined results: null, empty and wordless texts and items match nothing; a text of fewer than `n` words
is one run, its whole sequence, found only as such; rows that share an id are one document or item whose
runs are put together; rows without an id take no part; an empty table gives no pairs; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import int64_list, one_value, slices, written
from tablelift.llm.neardup import sets_of

MASK_BITS = 22
CLASSES = 15  # size classes 1, 2-3, 4-7, ...; the last holds all larger items
FULL_RUN = 1 << 15  # mark of a run of some item, signature or not


def item_runs(items: DataFrame, n: int, percent: int) -> DataFrame:
    """(item_id, value, size, need, class, signed) of every distinct run of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column("item_id").cast(pa.int64()), int64_list(sets_of(part.column("text"), n))], ["item_id", "runs"])

    runs = items.where(F.col("item_id").isNotNull()).select("item_id", "text").mapInArrow(run, "item_id long, runs array<long>")
    runs = runs.select("item_id", F.explode("runs").alias("value")).distinct()
    merged = runs.groupBy("item_id").agg(F.array_sort(F.collect_list("value")).alias("runs"))  # one item's runs
    size = F.size("runs")
    need = F.ceil(size * F.lit(percent) / 100).cast("int")
    kind = F.least(F.floor(F.log2(size)).cast("int"), F.lit(CLASSES - 1))
    sized = merged.select("item_id", "runs", size.alias("size"), need.alias("need"), kind.alias("class"))
    placed = sized.select("item_id", "size", "need", "class", F.posexplode("runs").alias("place", "value"))
    return placed.withColumn("signed", F.col("place") <= F.col("size") - F.col("need")).drop("place")


def signature_table(runs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Class bits of the signature values and a mark of all runs by hash prefix, and the least need per class."""
    at = F.shiftright("value", 63 - MASK_BITS).cast("int")
    bit = F.when(F.col("signed"), F.expr("shiftleft(1, class)")).otherwise(0)
    marks = runs.groupBy(at.alias("at")).agg((F.bit_or(bit).cast("int").bitwiseOR(F.lit(FULL_RUN))).alias("mask"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << MASK_BITS, np.uint16)
        for batch in batches:
            table[batch.column("at").to_numpy()] = batch.column("mask").to_numpy().astype(np.uint16)
        yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary())], ["masks"])

    made = one_value(marks.repartition(1).mapInArrow(run, "masks binary"))
    masks = np.zeros(1 << MASK_BITS, np.uint16) if made is None else np.frombuffer(made, np.uint16)
    needs = np.full(CLASSES, np.iinfo(np.int64).max, np.int64)
    for row in runs.groupBy("class").agg(F.min("need").alias("need")).collect():  # at most CLASSES rows
        needs[row["class"]] = row["need"]
    return masks, needs


def candidates(docs: DataFrame, masks: np.ndarray, needs: np.ndarray, n: int) -> DataFrame:
    """(doc_id, value): the possible item runs of every document that holds an eligible signature value."""
    shared = docs.sparkSession.sparkContext.broadcast((masks, needs))  # 2**MASK_BITS entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, needs = shared.value
        for part in slices(batches, "text"):
            ids, kept = [], []
            names = part.column("doc_id").to_pylist()
            for i, runs in enumerate(sets_of(part.column("text"), n)):
                found = masks[(runs >> np.uint64(63 - MASK_BITS)).astype(np.int64)]
                eligible = np.flatnonzero(needs <= len(runs))
                if names[i] is not None and (found & np.uint16((1 << eligible).sum())).any():
                    ids.append(names[i])
                    kept.append(runs[found != 0])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), int64_list(kept)], ["doc_id", "runs"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, runs array<long>")


def contained_items(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of every item found in a document."""
    runs = written(item_runs(items, n, percent), "items")
    masks, needs = signature_table(runs)
    held = candidates(docs, masks, needs, n).select("doc_id", F.explode("runs").alias("value"))
    shared = held.join(runs.select("value", "item_id", "size", "need"), "value")
    counted = shared.groupBy("doc_id", "item_id").agg(
        F.count_distinct("value").alias("n_shared"), F.max("size").cast("long").alias("n_item"), F.max("need").alias("need")
    )
    containment = (F.col("n_shared") / F.col("n_item")).alias("containment")
    return counted.where("n_shared >= need").select("doc_id", "item_id", "n_shared", "n_item", containment)


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE = f"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t FROM documents
  UNION ALL SELECT 'i', item_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') FROM benchmark),
words AS (SELECT side, id, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM texts WHERE id IS NOT NULL),
runs AS (
  SELECT DISTINCT side, id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ') || ' '] ELSE [] END) AS run FROM words),
sizes AS (SELECT id, count(*) AS n_item FROM runs WHERE side = 'i' GROUP BY id),
shared AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared FROM runs d JOIN runs i ON d.run = i.run
  WHERE d.side = 'd' AND i.side = 'i' GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item::DOUBLE AS containment
FROM shared JOIN sizes ON sizes.id = item_id WHERE 100 * n_shared >= 80 * n_item
"""
