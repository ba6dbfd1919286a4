"""Quality classifier: hashed word n-grams, logistic regression learnt by FTRL, scored as sparse dot products.

A text's words are read twice: as themselves (lower case) and as their shape: which kinds of bytes
the word holds, with which it begins and ends, how long it is, and whether it repeats the word
before.  Runs of one and two words and of one to three shapes are hashed to 2**bits columns; a
column's value is SCALE times its share of the text's runs.  Follow-the-regularised-leader updates
the columns of one document at a time, in an order given by a hash.

Training takes at most TRAIN_ROWS labelled rows, those of smallest hash of doc_id, of which each
needs its text only inside one task; the weights are 2**bits numbers whatever the data.  Scoring
reads every whole text, in slices, without a shuffle.

Defined results: null, empty or wordless texts have no columns and score the intercept; rows
without a label, a null label or a null doc_id are not learnt from but are scored; several labels
of one document count as their largest; of rows that share an id one is learnt from, and all are
scored; with no labelled rows at all the model is empty and every score is 0.5; extra columns are ignored by scoring.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.llm.common import Words, mix, one_value, slices

BITS = 18
TRAIN_ROWS = 4000
UPDATES = 16_000  # documents learnt from, repeats counted
SCALE = 10.0
FOLDS = 5  # rows whose crc32(doc_id) divides by this are held out
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def sample_labels(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most `rows` (doc_id, label, order) of the folds that may be learnt from, by smallest hash."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    single = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return single.withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(rows)


def byte_kinds() -> np.ndarray:
    """1 lower case, 2 upper case, 4 digit, 8 other ASCII, 16 beyond ASCII, 0 white space."""
    kinds = np.full(256, 8, np.uint8)
    kinds[97:123], kinds[65:91], kinds[48:58], kinds[128:] = 1, 2, 4, 16
    kinds[[32, 9, 10, 11, 12, 13]] = 0
    return kinds


KINDS = byte_kinds()


def columns(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed columns of every run of every text, and their n + 1 bounds per text."""
    words = Words(texts)
    n, bounds = len(words.hash), words.bounds
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    kinds = KINDS[words.data]
    held = np.bitwise_or.reduceat(kinds, words.start).astype(np.uint64)
    length = np.minimum(np.log2(words.end - words.start).astype(np.uint64), 4)
    edge = KINDS[words.data[words.end - 1]]
    last = np.where(edge == 8, words.data[words.end - 1], edge + 128).astype(np.uint64)
    shape = held | kinds[words.start].astype(np.uint64) << np.uint64(8) | last << np.uint64(16) | length << np.uint64(24)
    again = np.zeros(n, bool)
    again[1:] = words.hash[1:] == words.hash[:-1]
    again[bounds[:-1][bounds[:-1] < n]] = False
    shape = mix(shape | again.astype(np.uint64) << np.uint64(32))
    begins = np.zeros(n, bool)
    begins[bounds[:-1][bounds[:-1] < n]] = True

    def before(values: np.ndarray, k: int) -> np.ndarray:
        """The value k words earlier in the same text, or 0."""
        moved = np.zeros_like(values)
        moved[k:] = values[: n - k]
        for j in range(k):  # words with fewer than k words before them
            at = bounds[:-1] + j
            moved[at[(at < bounds[1:])]] = 0
        return moved

    one, two, three = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    runs = (
        words.hash,
        words.hash * one + before(words.hash, 1) * two,
        shape * three,
        shape * one + before(shape, 1) * three,
        shape * two + before(shape, 1) * one + before(shape, 2) * three,
    )
    table = np.empty((n, len(runs)), np.int64)
    for k, run in enumerate(runs):
        table[:, k] = (mix(run + np.uint64(k)) >> np.uint64(64 - bits)).astype(np.int64)
    return table.ravel(), bounds * len(runs)


def sparse_scores(index: np.ndarray, bounds: np.ndarray, weights: np.ndarray, scale: float = SCALE) -> np.ndarray:
    """Dot products of each text's column shares with the weights."""
    sums = np.concatenate([[0.0], np.cumsum(weights[index])])
    return scale * (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, alpha: float = 0.3, beta: float = 1.0,
    l1: float = 0.02, l2: float = 1e-4, updates: int = UPDATES,
) -> tuple[np.ndarray, float]:
    """Weights and intercept after passes over (columns, values, label) in the given order, `updates` in all."""
    size = (1 << bits) + 1  # the last column is the intercept
    z, squares = np.zeros(size), np.zeros(size)

    def weights_at(index: np.ndarray) -> np.ndarray:
        part = z[index]
        active = np.sign(part) * np.maximum(np.abs(part) - l1, 0.0)
        return -active / ((beta + np.sqrt(squares[index])) / alpha + l2)

    for _ in range(-(-updates // max(len(rows), 1))):
        for index, values, label in rows:
            w = weights_at(index)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ values, -35.0, 35.0)))
            g = (p - label) * values
            root = np.sqrt(squares[index])
            z[index] += g - (np.sqrt(squares[index] + g * g) - root) / alpha * w
            squares[index] += g * g
    learnt = weights_at(np.arange(size))
    return learnt[:-1], float(learnt[-1])


def example(index: np.ndarray, bits: int = BITS, scale: float = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """One text's distinct columns with their values, and the intercept's column."""
    found, counts = np.unique(index, return_counts=True)
    return np.append(found, 1 << bits), np.append(scale * counts / max(len(index), 1), 1.0)


def one_text_each(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, label, order, text) of the chosen ids: one row each, that of smallest text hash where several share an id."""
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    first = found.groupBy("doc_id", "label", "order").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("first"))
    return first.select("doc_id", "label", "order", "first.text")


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """The model learnt from at most `rows` labelled documents, in one task."""
    chosen = sample_labels(labels, "quality", rows)  # at most `rows` rows
    texts = one_text_each(docs, chosen)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            for part in slices([batch], "text"):
                index, bounds = columns(part.column("text"))
                marks = part.column("label").to_pylist()
                order = part.column("order").to_pylist()
                for i, mark in enumerate(marks):
                    examples.append((order[i], len(index), *example(index[bounds[i] : bounds[i + 1]]), mark))
        examples.sort(key=lambda e: (e[0], len(e[2]), float(e[3].sum()), e[4]))
        weights, intercept = ftrl([e[2:] for e in examples])
        model = np.append(weights, intercept).astype("<f8").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    learnt = one_value(texts.repartition(1).mapInArrow(fit, "model binary"))
    model = np.zeros((1 << BITS) + 1) if learnt is None else np.frombuffer(learnt, "<f8")
    return model[:-1], float(model[-1])


def score(docs: DataFrame, model: tuple[np.ndarray, float], keep: list[str], name: str = "score") -> DataFrame:
    """The `keep` columns of every document with its score as `name`, one pass and no shuffle."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 2**bits numbers
    chosen = docs.select(*[c for c in keep if c != "text"], "text")
    out = docs.select(*keep, F.lit(0.0).alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = shared.value
        for part in slices(batches, "text"):
            index, bounds = columns(part.column("text"))
            logit = sparse_scores(index, bounds, weights) + intercept
            chance = 1.0 / (1.0 + np.exp(-np.clip(logit, -35.0, 35.0)))
            yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(chance)], [*keep, name])

    return chosen.mapInArrow(run, out)
